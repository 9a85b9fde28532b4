from __future__ import annotations

import base64
import hashlib

import pytest

from sparvane.llm import warc

PAGE = "<html><head><title>A &amp; b</title></head><body><a href='/x?a=1&amp;b=2'>x</a><article><p>Text é.</p></article></body></html>"


def test_round_trip():
    records = [([("WARC-Type", "response"), ("X", "a: b")], b"block\r\n\r\nmore"), ([("WARC-Type", "metadata")], b""), ([("WARC-Type", "é")], bytes(range(256)))]
    data = b"".join(warc.encode(h, b) for h, b in records)
    assert warc.parse(data) == [([*h, ("Content-Length", str(len(b)))], b) for h, b in records]
    assert warc.parse(b"") == []


@pytest.mark.parametrize("data", [b"x", b"WARC/1.1\r\nA: b\r\n\r\n", b"WARC/1.1\r\nContent-Length: 9\r\n\r\nshort\r\n\r\n", b"WARC/1.1\r\nbad\r\n\r\n"])
def test_broken_records(data):
    with pytest.raises(ValueError):
        warc.parse(data)


def test_folded_headers():
    assert warc.get(warc.parse(b"WARC/1.0\r\nA: b\r\n c\r\ncontent-length: 0\r\n\r\n\r\n\r\n")[0][0], "a") == "b c"


def test_derivatives_are_linked():
    headers, block = warc.parse(warc.response(7, "http://e.example/\r\nx", PAGE))[0]
    payload = block.partition(b"\r\n\r\n")[2]
    assert payload.decode() == PAGE and warc.get(headers, "WARC-Target-URI") == "http://e.example/ x"
    assert warc.get(headers, "WARC-Payload-Digest") == "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
    (meta, m), (conv, c) = warc.derive(headers, block)
    for h, b in ((meta, m), (conv, c)):
        assert warc.get(h, "WARC-Refers-To") == warc.get(headers, "WARC-Record-ID")
        assert warc.get(h, "WARC-Refers-To-Payload-Digest") == warc.get(headers, "WARC-Payload-Digest")
        assert warc.get(h, "WARC-Block-Digest") == warc.digest(b) and warc.get(h, "WARC-Date") == warc.get(headers, "WARC-Date")
    assert c.decode() == "Text é."
    lines = m.decode().split("\r\n")
    assert "http-header: HTTP/1.1 200 OK" in lines and "title: A & b" in lines and "outlink: /x?a=1&b=2" in lines
    assert len({warc.get(h, "WARC-Record-ID") for h in (headers, meta, conv)}) == 3
    assert warc.derive(meta, m) == []


def test_other_character_sets():
    block = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=latin-1\r\n\r\n".encode() + "<p>é</p>".encode("latin-1")
    out = warc.derive([("WARC-Type", "response"), ("WARC-Record-ID", "<i>")], block)
    assert out[1][1].decode() == "é"
    assert warc.derive([("WARC-Type", "response")], b"no http charset=odd-one")[1][1] == b"no http charset=odd-one"


def test_all_pages(spark):
    rows = [(1, "http://a", PAGE, "x"), (2, None, None, "x"), (None, "u", "", "x"), (1, "http://a", PAGE, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, record string")
    got = warc.digests(df).collect()
    assert len(got) == 8 and {r.warc_type for r in got} == {"metadata", "conversion"}
    made = warc.derivatives(warc.responses(df)).collect()
    assert all(warc.parse(bytes(r.record)) and hashlib.sha256(bytes(r.record)).hexdigest() in {g.record_sha256 for g in got} for r in made)
    assert warc.digests(df.limit(0)).collect() == []


def http(head: str, payload: bytes) -> tuple[list, bytes]:
    return [("WARC-Type", "response"), ("WARC-Record-ID", "<urn:uuid:1>"), ("WARC-Target-URI", "http://x/")], head.replace("\n", "\r\n").encode() + b"\r\n\r\n" + payload


def test_encoded_payloads_are_decoded():
    import gzip
    import zlib

    page = "<p>Größe und Text</p>".encode()
    packed = gzip.compress(page)
    chunked = b"".join(b"%x;n=1\r\n%s\r\n" % (len(packed[i : i + 7]), packed[i : i + 7]) for i in range(0, len(packed), 7)) + b"0\r\n\r\n"
    raw = zlib.compressobj(wbits=-15)
    cases = [
        ("HTTP/1.1 200 OK\nContent-Type: text/html; charset=utf-8\nContent-Encoding: gzip", packed),
        ("HTTP/1.1 200 OK\nContent-Encoding: gzip\nTransfer-Encoding: chunked", chunked),
        ("HTTP/1.1 200 OK\nContent-Encoding: deflate", zlib.compress(page)),
        ("HTTP/1.1 200 OK\nContent-Encoding: deflate", raw.compress(page) + raw.flush()),
        ("HTTP/1.1 200 OK\nContent-Encoding: gzip", page),  # says so and is not
        ("HTTP/1.1 200 OK\nTransfer-Encoding: chunked", page),
    ]
    for head, payload in cases:
        made = warc.derive(*http(head, payload))
        assert [h[0][1] for h, _ in made] == ["metadata", "conversion"] and made[1][1].decode() == "Größe und Text", head


@pytest.mark.parametrize("charset", ["idna", "undefined", "punycode", "hex", "base64", "x\\0y", "no-such-set", ""])
def test_any_character_set_name(charset):
    (_, meta), (_, text) = warc.derive(*http(f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset={charset}", "<p>gr\u00fc\u00df dich</p>".encode()))
    assert b"charset-detected: " in meta and (text.startswith(b"gr") or charset == "punycode")


def test_lists_of_codings_and_odd_status_lines():
    import gzip

    page = b"<article><p>Text of some length.</p></article>"
    chunked = lambda d: b"".join(f"{len(d[i : i + 7]):x}\r\n".encode() + d[i : i + 7] + b"\r\n" for i in range(0, len(d), 7)) + b"0\r\n\r\n"
    for head, payload in (
        ("HTTP/1.1 200 OK\r\nTransfer-Encoding: gzip, chunked", chunked(gzip.compress(page))),
        ("HTTP/1.1 200 OK\r\nTransfer-Encoding: Chunked ", chunked(page)),
        ("HTTP/1.1  200  OK\r\nContent-Encoding: gzip\r\nTransfer-Encoding: identity,chunked", chunked(gzip.compress(page))),
    ):
        assert warc.derive(*http(head, payload))[1][1] == b"Text of some length."


def test_what_is_no_page_has_no_conversion():
    for head in ("HTTP/1.1 301 Moved\nLocation: /y\nContent-Type: text/html", "HTTP/1.1 200 OK\nContent-Type: image/png", "HTTP/1.1 404 No"):
        made = warc.derive(*http(head, b"\x89PNG <p>x</p>"))
        assert [h[0][1] for h, _ in made] == ["metadata"] and b"http-header" in made[0][1]


def test_files_round_trip(spark, tmp_path):
    records = [warc.response(i, f"http://x/{i}", f"<p>text {i}</p>") for i in range(5)]
    (tmp_path / "a.warc.gz").write_bytes(warc.file_of(records))
    (tmp_path / "b.warc").write_bytes(b"".join(records[:2]))
    got = warc.files(spark, str(tmp_path)).collect()
    assert sorted(bytes(r.record) for r in got) == sorted(records + records[:2])
    assert warc.derivatives(warc.files(spark, str(tmp_path))).where("warc_type = 'conversion'").count() == 7
