"""Main text of web pages by wrappers: union-free regular expressions inferred per host.

A page is a stream of tags and texts. Inference starts with a page's own
stream and aligns it with the next page of the host: equal tags match,
differing texts become slots, what stands in only one of the two becomes an
optional group, and what stands several times in a row a repeated group. The
result, a regular expression without unions, is the wrapper so far and is
aligned with the next page. Aligning two wrappers works the same way, so
every task infers wrappers of the pages it reads and these are merged per
host: a host with a third of all pages costs a few rows per task.

Long streams are first cut at keys that occur once in both, so that
aligning takes time in proportion to their length, but for a logarithm.

A wrapper's slots say which texts are the article: those of the best level
the host has (main, an article, an element named as content, any other).
A text that stands at its place on all of a host's pages, of two or more, may
be the template's, but as well a heading or a sentence that its articles
share, so that alone drops nothing: within main, an article or named content
it goes only where the whole block is a link, and on pages without any of
these where no text of the page's own comes before or none after it.
Menus, headers, footers, sidebars, notices, adverts, forms and comments vary
too; their elements, and names in the class, id or role of containers, tell
them apart; a name counts as a whole, so "science-form" is no form, and a
paragraph's own does not. Each page's text is then read through its host's
slots.

Blocks: a tag that is not inline ends a block. Character references are
decoded, white space becomes one space, empty blocks are dropped.

Cases: null html is empty and gives empty text; a null or odd url belongs to
host ""; truncated or unclosed tags end where the page does; a page without
any slot its host's wrapper takes for the article is read by the general
rule; repeated pages are returned each; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import html
import json
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparvane.llm.common import materialize, table

#: HTML element names by how they are treated.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template noscript iframe svg math object canvas audio video head title".split())
#: Elements that leave head open; any other, and text, ends it.
HEAD_ONLY = frozenset("base basefont bgsound head link meta noframes noscript script style template title".split())
PLAIN = frozenset("script style textarea title".split())
BOILERPLATE_TAGS = frozenset("nav header footer aside form button select textarea fieldset dialog menu".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
#: Words in class, id or role that mark what is not the article, and what is.
BOILERPLATE_WORDS = frozenset("ad ads adv advert adverts advertisement advertisements adsense banner breadcrumb breadcrumbs byline-links comment comments commentlist consent cookie cookies disqus footer form gdpr header masthead menu modal nav navbar navigation newsletter notice notices notification overlay pagination pager popup promo promoted promotion recommended related reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription tags toolbar topbar widget".split())
#: Elements that hold the article or all of the page; their words say nothing of their text.
WHOLE_TAGS = frozenset("html body main article".split())
#: Elements of running text: their own class, id and role do not make them boilerplate inside an article.
TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figcaption dd dt".split())
#: Words beside those above in names of containers.
NEUTRAL_WORDS = frozenset("area bar block bottom box button col column container content fixed group header inner item items js left link links list main outer page panel right row section site slot the top unit wide wrap wrapper".split())
#: The last step of the path of a block that is a link as a whole.
LINKED = "/a"
#: Product of the lengths of two streams up to which they are aligned without cutting them first.
SMALL = 250_000
MAIN_WORDS = frozenset("article articlebody entry main maincontent post postbody story".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)(>|\Z|(?=<))|([^<]+|<)", re.S)
NAMED = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
WORDS = re.compile(r"[a-z]+")

Node = list  # ["t", tag] | ["x", text or None, path] | ["o", nodes] | ["r", nodes]


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """("open" | "close", element, its class, id and role words) and ("text", text, "")."""
    at, skip = 0, None
    while at < len(page):
        if skip:  # the content of a plain-text element ends at its end tag alone
            found = re.compile(rf"</{skip}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            yield "close", skip, ""
            if not found:
                return
            at, skip = found.end(), None
            continue
        m = TOKEN.match(page, at)
        if not m:  # a "<" that opens nothing
            yield "text", page[at], ""
            at += 1
            continue
        at = m.end()
        if m[5] is not None:
            yield "text", m[5], ""
        elif m[2]:
            name = m[2].lower()
            if m[1]:
                yield "close", name, ""
            else:
                words = " ".join(x for _, *v in NAMED.findall(m[3]) for x in v if x).lower() if m[3] else ""
                yield "open", name, words
                if name in PLAIN and not m[3].endswith("/"):
                    skip = name


def events(page: str) -> Iterator[tuple[str, str | None, tuple[str, ...]]]:
    """("tag", element, path) at block limits, ("text", text, path) and ("link", text, path) within a link; path: the open block elements, with their words."""
    stack: list[str] = []
    names: list[str] = []
    raw, linked = 0, False

    def pop(to: int) -> None:
        nonlocal raw
        for x in names[to:]:
            raw -= x in RAW
        del names[to:], stack[to:]

    for kind, value, words in tokens(page):
        if kind == "text":
            if names and names[-1] == "head" and value.strip():
                pop(names.index("head"))
            if not raw:
                yield "link" if linked else "text", value, tuple(stack)
            continue
        linked = kind == "open" if value == "a" else linked and value in INLINE
        if kind == "open" and "head" in names and (value == "body" or names[-1] == "head" and value not in HEAD_ONLY):
            pop(names.index("head"))
        if value in INLINE and not (kind == "open" and words and set(WORDS.findall(words)) & BOILERPLATE_WORDS):
            if kind == "close" and value in names:  # an inline element that was kept for its words
                pop(len(names) - 1 - names[::-1].index(value))
            continue
        if kind == "open":
            if value in CLOSES_P and "p" in names:
                pop(len(names) - 1 - names[::-1].index("p"))
            elif value in ("li", "tr", "td", "th", "dt", "dd", "option"):
                same = ("dt", "dd") if value in ("dt", "dd") else ("td", "th") if value in ("td", "th") else (value,)
                if names and names[-1] in same:
                    pop(len(names) - 1)
            if not raw:
                yield "tag", value, tuple(stack)
            if value not in VOID:
                names.append(value)
                stack.append(f"{value}.{words}" if words else value)
                raw += value in RAW
        elif value in names:
            pop(len(names) - 1 - names[::-1].index(value))
            if not raw:
                yield "tag", "/" + value, tuple(stack)


def clean(parts: list[str]) -> str:
    return " ".join(html.unescape("".join(parts)).split())


def nodes_of(page: str) -> Iterator[Node]:
    """A page's tags, and a text for each block."""
    held: list[str] = []
    where: tuple[str, ...] = ()
    plain = False  # some of the block is no link

    def text() -> Iterator[Node]:
        found = clean(held)
        held.clear()
        if found:
            yield ["x", found, "/".join(where) + ("" if plain else LINKED)]

    for kind, value, path in events(page):
        if kind == "tag":
            yield from text()
            plain = False
            yield ["t", value]
            continue
        if path != where:
            yield from text()
            where, plain = path, False
        held.append(value)
        plain = plain or kind == "text" and bool(value.strip())
    yield from text()


def stream(page: str) -> list[Node]:
    """A page as a wrapper of its own, one text per block."""
    return fold(list(nodes_of(page)))


def shape(node: Node) -> str:
    if node[0] == "t":
        return "<" + node[1]
    if node[0] == "x":
        return "#" + node[2]
    return node[0] + "(" + " ".join(map(shape, node[1])) + ")"


def join_text(a: Node, b: Node) -> Node:
    return a if a[1] == b[1] else ["x", None, a[2]]


def align(a: list[Node], b: list[Node]) -> list[Node]:
    """The least general wrapper found that takes what a or b takes."""
    x, y = [_key(n) for n in a], [_key(n) for n in b]
    if x == y:
        return [_merge(m, n) for m, n in zip(a, b, strict=True)]
    out: list[Node] = []
    for equal, i, j, p, q in _matches(x, y):
        if equal:
            out += [_merge(m, n) for m, n in zip(a[i:j], b[p:q], strict=True)]
        else:
            for rest in (a[i:j], b[p:q]):
                if rest:
                    out.append(rest[0] if len(rest) == 1 and rest[0][0] in "or" else ["o", rest])
    return fold(out)


def _matches(x: list[str], y: list[str], i: int = 0, p: int = 0) -> Iterator[tuple[bool, int, int, int, int]]:
    """(equal, i, j, p, q): stretches of x and y that match or not, in order.

    Long streams are cut at the longest ascending row of keys that occur
    once in each; a stretch that stays long and has none is a mismatch.
    """
    same = 0
    while same < min(len(x), len(y)) and x[same] == y[same]:
        same += 1
    if same:
        yield True, i, i + same, p, p + same
        x, y, i, p = x[same:], y[same:], i + same, p + same
    if not x or not y:
        if x or y:
            yield False, i, i + len(x), p, p + len(y)
        return
    if len(x) * len(y) <= SMALL:
        for op, j, k, q, r in SequenceMatcher(None, x, y, autojunk=False).get_opcodes():
            yield op == "equal", i + j, i + k, p + q, p + r
        return
    once_x, once_y = _once(x), _once(y)
    row = _ascending([(k, once_y[v]) for v, k in sorted(once_x.items(), key=lambda kv: kv[1]) if v in once_y])
    if not row:
        yield False, i, i + len(x), p, p + len(y)
        return
    j = q = 0
    for k, r in [*row, (len(x), len(y))]:
        yield from _matches(x[j:k], y[q:r], i + j, p + q)
        if k < len(x):
            yield True, i + k, i + k + 1, p + r, p + r + 1
        j, q = k + 1, r + 1


def _once(keys: list[str]) -> dict[str, int]:
    """Keys that occur once, and where."""
    counts = Counter(keys)
    return {k: i for i, k in enumerate(keys) if counts[k] == 1}


def _ascending(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest row of pairs whose second members ascend; the first ones do already."""
    ends: list[int] = []
    last: list[int] = []
    before: list[int] = []
    for n, (_, v) in enumerate(pairs):
        at = bisect_left(ends, v)
        before.append(last[at - 1] if at else -1)
        if at == len(ends):
            ends.append(v)
            last.append(n)
        else:
            ends[at], last[at] = v, n
    out, n = [], last[-1] if last else -1
    while n >= 0:
        out.append(pairs[n])
        n = before[n]
    return out[::-1]


def _key(node: Node) -> str:
    """What may match: repeated and optional groups match by what they hold."""
    return "(" + " ".join(sorted({k for n in node[1] for k in _leaves(n)})) + ")" if node[0] in "or" else shape(node)


def _leaves(node: Node) -> set[str]:
    return {k for n in node[1] for k in _leaves(n)} if node[0] in "or" else {shape(node)}


def _merge(a: Node, b: Node) -> Node:
    if a[0] == "x":
        return join_text(a, b)
    if a[0] == "t":
        return a
    if _shapes(a[1]) == _shapes(b[1]):
        return ["r" if "r" in (a[0], b[0]) else "o", [_merge(m, n) for m, n in zip(a[1], b[1], strict=True)]]
    return _any_order([a, b])


def _shapes(nodes: list[Node]) -> list[str]:
    return [shape(n) for n in nodes]


def _parts(nodes: list[Node]) -> Iterator[list[Node]]:
    """Stretches without groups, cut again where the tag that opens one comes back."""
    part: list[Node] = []
    for node in nodes:
        if node[0] in "or":
            if part:
                yield part
            part = []
            yield from _parts(node[1])
        else:
            if part and node[0] == "t" and node == part[0]:
                yield part
                part = []
            part.append(node)
    if part:
        yield part


def _any_order(groups: list[Node]) -> Node:
    """One repeated group of optional parts for a row of groups; its size is that of the markup's variety, not of the pages."""
    parts: dict[str, list[Node]] = {}
    for part in _parts(groups):
        k = " ".join(_shapes(part))
        parts[k] = [_merge(m, n) for m, n in zip(parts[k], part, strict=True)] if k in parts else part
    if len(parts) == 1:
        return ["r", next(iter(parts.values()))]
    return ["r", [["o", parts[k]] for k in sorted(parts)]]


def fold(nodes: list[Node], longest: int = 64) -> list[Node]:
    """Turn what stands several times in a row into repeated groups, and groups in a row into one."""
    shapes = _shapes(nodes)
    out: list[Node] = []
    i = 0
    while i < len(nodes):
        for n in range(2, min(longest, (len(nodes) - i) // 2) + 1):
            if shapes[i] == shapes[i + n] and nodes[i][0] == "t" and shapes[i : i + n] == shapes[i + n : i + 2 * n] and all(x[0] in "tx" for x in nodes[i : i + n]):
                j, body = i + n, nodes[i : i + n]
                while shapes[j : j + n] == shapes[i : i + n]:
                    body = [_merge(a, b) for a, b in zip(body, nodes[j : j + n], strict=True)]
                    j += n
                out.append(["r", body])
                i = j
                break
        else:
            out.append(nodes[i])
            i += 1
    again: list[Node] = []
    i = 0
    while i < len(out):
        j = i
        while j < len(out) and out[j][0] in "or":
            j += 1
        if j - i > 1 or j - i == 1 and any(x[0] in "or" for x in out[i][1]):
            again.append(_any_order(out[i:j]))
        else:
            again.append(out[i])
        i = max(j, i + 1)
    return again


def slots(wrapper: list[Node]) -> dict[str, bool]:
    """Paths of texts -> whether some text there differs between places of the wrapper."""
    out: dict[str, bool] = {}
    for node in wrapper:
        if node[0] == "x":
            out[node[2]] = out.get(node[2], False) or node[1] is None
        elif node[0] in "or":
            for path, varies in slots(node[1]).items():
                out[path] = out.get(path, False) or varies
    return out


def _marked(words: str) -> bool:
    """Whether one of the names is made of words of boilerplate, but for neutral ones."""
    for name in words.split():
        found = set(WORDS.findall(name))
        if found & BOILERPLATE_WORDS and found <= BOILERPLATE_WORDS | NEUTRAL_WORDS:
            return True
    return False


def boilerplate(path: str) -> bool:
    steps = path.split("/")
    for at, step in enumerate(steps):
        name, _, words = step.partition(".")
        inside = any(x.partition(".")[0] in ("article", "main") for x in steps[:at])
        if name in BOILERPLATE_TAGS and not (name == "header" and any(x.partition(".")[0] == "article" for x in steps[:at])):
            return True
        if words and name not in WHOLE_TAGS and not (inside and name in TEXT_TAGS) and name != "header" and _marked(words):
            return True
    return False


def level(path: str) -> int:
    """3: in main; 2: in an article; 1: in an element named as content; 0: elsewhere."""
    best = 0
    for step in path.split("/"):
        name, _, words = step.partition(".")
        if name == "main" or words == "main":
            return 3
        if name == "article":
            best = 2
        elif words and set(WORDS.findall(words)) & MAIN_WORDS:
            best = max(best, 1)
    return best


def article_paths(wrapper: list[Node]) -> list[str]:
    """The slots that hold the article: those of the best level there is."""
    found = [p for p in slots(wrapper) if not boilerplate(p)]
    best = max(map(level, found), default=0)
    return sorted(p for p in found if level(p) == best)


def literals(blocks: list[tuple[str, str]]) -> set[str]:
    """Places with their texts, of one page."""
    return {f"{p}\x1f{v}" for v, p in blocks}


def extract(page: str, paths: set[str], template: set[str] = frozenset()) -> str:
    """The page's text in these slots, without the template's own; where it has none of them, by the general rule."""
    own = _blocks(page)
    blocks = [(v, p) for v, p in own if p in paths]
    if not blocks:
        rest = [(v, p) for v, p in own if not boilerplate(p)]
        best = max((level(p) for _, p in rest), default=0)
        blocks = [(v, p) for v, p in rest if level(p) == best]
    shared = [f"{p}\x1f{v}" in template for v, p in blocks]
    if all(shared):  # copies of one page
        return "\n".join(v for v, _ in blocks)
    first, last = shared.index(False), len(shared) - shared[::-1].index(False)
    drop = [s and (p.endswith(LINKED) or level(p) == 0 and not first <= i < last) for i, (s, (_, p)) in enumerate(zip(shared, blocks, strict=True))]
    return "\n".join(v for (v, _), d in zip(blocks, drop, strict=True) if not d)


def _blocks(page: str) -> list[tuple[str, str]]:
    """A page's texts with their paths."""
    return [(n[1], n[2]) for n in nodes_of(page) if n[0] == "x"]


#: Wrappers that a task holds before it hands them on.
HOSTS_HELD = 2_000


#: Wrappers that one task merges, at most, of tasks whose numbers are near.
MERGED = 128


class Inferred:
    """A host's wrapper so far, its pages, and the texts that all of them have at the same place."""

    def __init__(self, nodes: list[Node], pages: int, common: set[str]) -> None:
        self.nodes, self.pages, self.common = nodes, pages, common

    @classmethod
    def of(cls, page: str) -> Inferred:
        return cls(stream(page), 1, literals(_blocks(page)))

    def join(self, other: Inferred) -> None:
        self.nodes, self.pages, self.common = align(self.nodes, other.nodes), self.pages + other.pages, self.common & other.common


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, paths, template): the article's slots of each host's wrapper, and the texts that are its template's."""
    schema = pa.schema([("host", pa.string()), ("part", pa.int64()), ("wrapper", pa.string()), ("pages", pa.int64()), ("common", pa.list_(pa.string()))])
    ddl = "host string, part long, wrapper string, pages long, common array<string>"

    def rows(held: dict[str, Inferred], part: int) -> dict[str, list]:
        found = list(held.values())
        return {"host": list(held), "part": [part] * len(held), "wrapper": [json.dumps(x.nodes) for x in found], "pages": [x.pages for x in found], "common": [sorted(x.common) for x in found]}

    def infer(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Inferred] = {}
        part = TaskContext.get().partitionId()
        for batch in batches:
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html"), strict=True):
                own = Inferred.of(page.as_py())
                if host in held:
                    held[host].join(own)
                else:
                    held[host] = own
                if len(held) >= HOSTS_HELD:
                    yield table(rows(held, part), schema)
                    held = {}
        if held:
            yield table(rows(held, part), schema)

    def joined(part: pa.Table) -> tuple[str, int, Inferred]:
        found = sorted(zip(*(part.column(c).to_pylist() for c in ("wrapper", "pages", "common")), strict=True))
        out = Inferred(json.loads(found[0][0]), found[0][1], set(found[0][2]))
        for nodes, n, common in found[1:]:
            out.join(Inferred(json.loads(nodes), n, set(common)))
        return part.column("host")[0].as_py(), part.column("part")[0].as_py(), out

    def merge(part: pa.Table) -> pa.Table:
        host, number, out = joined(part)
        return pa.table(rows({host: out}, number), schema=schema)

    last_schema = pa.schema([("host", pa.string()), ("paths", pa.list_(pa.string())), ("template", pa.list_(pa.string()))])

    def last(part: pa.Table) -> pa.Table:
        host, _, out = joined(part)
        template = sorted(out.common) if out.pages > 1 else []
        return pa.table({"host": [host], "paths": [article_paths(out.nodes)], "template": [template]}, schema=last_schema)

    found = pages.select("host", "html").mapInArrow(infer, ddl)
    for _ in range(2):  # a tree: no task merges the wrappers of more than MERGED others, up to MERGED ** 3 tasks
        found = found.withColumn("part", F.floor(F.col("part") / MERGED)).groupBy("host", "part").applyInArrow(merge, ddl)
    return found.groupBy("host").applyInArrow(last, "host string, paths array<string>, template array<string>")


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every page."""
    rows = pages.select(F.col("page_id"), F.col("url"), F.coalesce("html", F.lit("")).alias("html"), F.lower(F.coalesce(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit(""))).alias("host"))

    @F.pandas_udf("string")
    def read(html_, paths, template):  # noqa: ANN001, ANN202
        import pandas as pd

        listed = lambda x: set(x) if x is not None else set()
        return pd.Series([extract(h, listed(p), listed(t)) for h, p, t in zip(html_, paths, template, strict=True)])

    # written first: a small table is then broadcast by its size, and a host with very many pages can be split
    found = rows.join(materialize(wrappers(rows), "wrappers"), "host", "left")
    return found.select("page_id", "url", read("html", "paths", "template").alias("text")).withColumn("n_chars", F.length("text").cast("long"))
