"""Decoder of ACE tables (text, type 1), the public format of continuous-energy neutron data.

A table is a header, 16 integers (NXS), 32 places (JXS, from 1) and the
numbers themselves (XSS). Energies are in MeV there and in eV here.
"""

from __future__ import annotations

from collections.abc import Iterator

#: Fixed values of the format: lines of pairs after the header, widths of an integer and of a number, and numbers to a line.
PAIR_LINES, INTEGER, NUMBER, IN_LINE = 4, 9, 20, 4
#: Total, elastic and inelastic channels, and the discrete levels and continuum that make up the last.
TOTAL, ELASTIC, INELASTIC, LEVELS = 1, 2, 4, range(51, 92)


def _integers(lines: list[str]) -> list[int]:
    return [int(x) for line in lines for i in range(0, len(line), INTEGER) if (x := line[i : i + INTEGER].strip())]


def _numbers(lines: list[str]) -> list[float]:
    return [float(x) for line in lines for i in range(0, len(line), NUMBER) if (x := line[i : i + NUMBER].strip())]


def _header(lines: list[str]) -> int:
    """Lines of the header: 2, or in the later form 2 and the comments it announces."""
    first = lines[0].split()
    return 2 + int(lines[1].split()[3]) if first and first[0].startswith("2.") and len(first) > 1 else 2


def _isotope(za: int) -> tuple[int, int]:
    """Z and A; a mass above 300 marks an excited state, by hundreds."""
    z, a = divmod(za, 1000)
    while a > 300 and a > 3 * z:
        a -= 100
    return z, a


def tables(text: str) -> Iterator[tuple[int, int, dict[int, tuple[list[float], list[float]]]]]:
    """(Z, A, channel -> energies and values) of every table of a file, in order.

    The inelastic channel is the sum of its levels where the table has only
    those. A channel with a threshold starts there.
    """
    lines = text.splitlines()
    at = 0
    while at < len(lines):
        if not lines[at].strip():
            at += 1
            continue
        at += _header(lines[at:]) + PAIR_LINES
        nxs, jxs = _integers(lines[at : at + 2]), [0, *_integers(lines[at + 2 : at + 6])]
        at += 6
        rows = -(-nxs[0] // IN_LINE)
        xss = [0.0, *_numbers(lines[at : at + rows])]  # places count from 1
        at += rows
        n, reactions, grid = nxs[2], nxs[3], jxs[1]
        energy = [e * 1e6 for e in xss[grid : grid + n]]
        found = {TOTAL: (energy, xss[grid + n : grid + 2 * n]), ELASTIC: (energy, xss[grid + 3 * n : grid + 4 * n])}
        levels, first = [0.0] * n, n
        for i in range(reactions):
            mt, place = int(xss[jxs[3] + i]), jxs[7] + int(xss[jxs[6] + i]) - 1
            start, size = int(xss[place]) - 1, int(xss[place + 1])
            values = xss[place + 2 : place + 2 + size]
            found[mt] = (energy[start : start + size], values)
            if mt in LEVELS:
                first = min(first, start)
                for j, v in enumerate(values, start):
                    levels[j] += v
        if INELASTIC not in found and first < n:
            found[INELASTIC] = (energy[first:], levels[first:])
        yield *_isotope(nxs[1]), found


def decode(path: str, content: bytes) -> Iterator[tuple[str, int, int, int, float, float]]:
    """(evaluation, Z, A, MT, energy, xs) rows of a file; the evaluation is the name of the file's folder."""
    evaluation = path.rstrip("/").rsplit("/", 2)[-2]
    for z, a, found in tables(content.decode("ascii")):
        for mt, (energies, values) in sorted(found.items()):
            for e, v in zip(energies, values, strict=True):
                yield evaluation, z, a, mt, e, v
