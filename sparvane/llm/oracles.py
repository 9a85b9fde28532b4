"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

from sparvane.llm.sharding import PRIME, round_keys


def suffix_dedup(length: int = 400) -> str:
    """Every string of ``length`` bytes by its MD5; runs of those that occur twice; the bytes between the runs."""
    return f"""
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
n AS (SELECT doc_id, b, octet_length(b) AS n FROM d),
w AS (SELECT doc_id, i, md5(b[i:i + {length - 1}]) AS h FROM (SELECT doc_id, b, unnest(range(1, n - {length - 2})) AS i FROM n WHERE n >= {length})),
r AS (SELECT doc_id, i FROM w QUALIFY count(*) OVER (PARTITION BY h) > 1),
g AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + {length} THEN 0 ELSE 1 END AS fresh FROM r),
s AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS run FROM g),
runs AS (SELECT doc_id, min(i) AS lo, max(i) + {length} AS hi FROM s GROUP BY doc_id, run),
t AS (SELECT doc_id, sum(hi - lo) AS removed, count(*) AS spans, max(hi) AS last FROM runs GROUP BY doc_id),
p AS (SELECT doc_id, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 1) AS a, lo AS z FROM runs UNION ALL SELECT t.doc_id, last, n + 1 FROM t JOIN n ON n.doc_id = t.doc_id),
k AS (SELECT p.doc_id, string_agg(substr(hex(b), 2 * (a - 1) + 1, 2 * (z - a)), '' ORDER BY a) AS x FROM p JOIN n ON n.doc_id = p.doc_id GROUP BY p.doc_id)
SELECT n.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
  CASE WHEN k.x IS NULL THEN sha256(b) ELSE sha256(unhex(k.x)) END AS kept_sha256
FROM n LEFT JOIN t ON t.doc_id = n.doc_id LEFT JOIN k ON k.doc_id = n.doc_id"""


def sharding(n_shards: int = 16, key: int = 20240229) -> str:
    """CRC-32 byte by byte from a table made by its rule; the Feistel rounds nested, walked by recursion."""
    rounds = "SELECT doc_id, size, crc, n, a, p % a AS lo, p // a AS hi FROM {source}"
    for i, (k1, k2, k3) in enumerate(round_keys(key, 6)):
        side, other = ("lo", "hi") if i % 2 == 0 else ("hi", "lo")
        y = f"(({other} + {k1}) % {PRIME})"
        mix = f"(({y} * {y} % {PRIME} * {k2} + {k3}) % {PRIME})"
        rounds = f"SELECT doc_id, size, crc, n, a, {'(lo + ' + mix + ') % a AS lo, hi' if side == 'lo' else 'lo, (hi + ' + mix + ') % a AS hi'} FROM ({rounds})"
    image = f"SELECT doc_id, size, crc, n, a, hi * a + lo AS p FROM ({rounds})"
    bit = "CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END"
    entry = "SELECT i, CAST(i AS BIGINT) AS c FROM range(256) t(i)"
    for _ in range(8):
        entry = f"SELECT i, {bit} AS c FROM ({entry})"
    return f"""
WITH RECURSIVE t AS (SELECT list(c ORDER BY i) AS t FROM ({entry})),
h AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) AS n_bytes, string_split(regexp_replace(hex(encode(coalesce(text, ''))), '(..)', '\\1 ', 'g'), ' ') AS x FROM documents),
v AS (SELECT doc_id, n_bytes, list_transform(x[:n_bytes], lambda y: CAST('0x' || y AS BIGINT)) AS x FROM h),
c AS (SELECT doc_id, n_bytes + 1 AS size, xor(list_reduce(list_prepend(4294967295, x), lambda s, b: xor(s // 256, t[xor(s, b) % 256 + 1])), 4294967295) AS crc FROM v CROSS JOIN t),
m AS (SELECT doc_id, size, crc, row_number() OVER (ORDER BY doc_id NULLS FIRST, crc, size) - 1 AS p, count(*) OVER () AS n FROM c),
f AS (SELECT doc_id, size, crc, n, CAST(ceil(sqrt(n)) AS BIGINT) AS a, p FROM m),
walk AS ({image.format(source="f")} UNION ALL {image.format(source="(SELECT * FROM walk WHERE p >= n)")})
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(crc AS BIGINT) AS text_crc32, 'rows' AS law, CAST(p % {n_shards} AS INT) AS shard, CAST(p // {n_shards} AS BIGINT) AS slot, CAST(NULL AS INT) AS grown_shard FROM walk WHERE p < n"""


def fill_in_middle() -> str:
    """Code points by substring, draws from the digest's first four groups."""
    draw = lambda i: f"CAST('0x' || substring(h, {8 * i + 1}, 8) AS BIGINT)"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n, {draw(0)} AS h1, {draw(1)} AS h2, {draw(2)} AS h3, {draw(3)} AS h4 FROM d),
c AS (SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT doc_id, t, n, form, a, b, substring(t, 1, a) AS prefix, substring(t, a + 1, b - a) AS middle, substring(t, b + 1) AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p"""


def collocations(least: int = 30, longest: int = 4, top: int = 2000, within: int = 80) -> str:
    """Every contiguous run of words of every piece, counted."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{letters}', '{letters.lower()}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS words FROM d),
g AS (SELECT lang, words, unnest(range(1, {longest} + 1)) AS k FROM w),
p AS (SELECT lang, k, array_to_string(words[i:i + k - 1], ' ') AS phrase FROM (SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM g)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM p GROUP BY ALL HAVING count(*) >= {least}),
n AS (SELECT lang, sum(len(words)) AS n FROM w GROUP BY lang),
s AS (SELECT lang, f, array_to_string(words[i:i + m - 1], ' ') AS phrase FROM (SELECT lang, f, words, m, unnest(range(1, len(words) - m + 2)) AS i FROM (SELECT lang, f, string_split(phrase, ' ') AS words, unnest(range(2, k)) AS m FROM f WHERE k > 2))),
x AS (SELECT lang, phrase, max(f) AS longer FROM s GROUP BY ALL),
c AS (SELECT f.lang, f.phrase, f.f AS a, string_split(f.phrase, ' ') AS words, unnest(range(1, k)) AS cut FROM f LEFT JOIN x ON x.lang = f.lang AND x.phrase = f.phrase WHERE k > 1 AND (longer IS NULL OR 100 * longer < {within} * f.f)),
z AS (SELECT c.lang, c.phrase, c.a, c.cut, l.f AS l, r.f AS r, (2000000::HUGEINT * c.a) // (l.f + r.f) AS score FROM c
  JOIN f AS l ON l.lang = c.lang AND l.phrase = array_to_string(words[1:cut], ' ') JOIN f AS r ON r.lang = c.lang AND r.phrase = array_to_string(words[cut + 1:], ' ')),
b AS (SELECT * FROM z QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
t AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score FROM b QUALIFY rank <= {top})
SELECT t.lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM t JOIN n ON n.lang = t.lang"""
