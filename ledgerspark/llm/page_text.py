"""Main text of web pages by differencing a page with its neighbour by URL.

Pages are ordered by host and path; each is paired with the neighbour of its host that shares more of the path. The
text lines of the two are aligned by a longest common subsequence, and what they share is the site's, not the page's:
it is deleted. Only hashes of lines travel for that.

Copies would delete each other. So pages of a host with equal lines take one place together, and a neighbour that shares
nearly all text of either page does not decide: pages that such links chain together are one run, and each of its
pages is compared with the nearest page before or after the run. A run that has no such page keeps what its markup leaves.

Markup then decides what differencing cannot know. A shared line stays where the page itself marks it as article text,
because articles quote the same passages; and lines that differ from page to page go where the markup names them as
menu, advert, form, comment and the like, or where an article is marked and they stand outside of it. What encloses an
article is layout: a form, or an element with such a word only as a part of its class name, does not hide the article.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ledgerspark.operators.ordering import add_dense_key
from ledgerspark.staging import stage_table

# fixed values: elements and words of the markup
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html legend li main nav ol option p pre section select summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
NEVER_TEXT = frozenset(
    "aside button canvas dialog footer form head iframe nav noscript object script select style svg template textarea title".split()
)
NAMED = frozenset(
    "ad ads advert advertisement adverts advertising alert banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer "
    "disqus footer header login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promotion "
    "related replies reply respond search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget widgets".split()
)
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
READERS = frozenset("comment comments reply replies related".split())
# elements whose start ends an open paragraph or item of the same kind
CLOSES = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}

# what a class or id may say besides, inside of an article
BESIDE = frozenset(
    "area articles bar block body bottom box btn button buttons card container content cta form group icons inline inner item items link "
    "links list media message more outer panel posts post reader readers row section slot stories tools top unit user wrap wrapper".split()
)
# blocks of running text, whose class or id (often made from a heading) never hides them inside of an article
TEXT_BLOCKS = frozenset("blockquote caption dd dl dt h1 h2 h3 h4 h5 h6 li ol p pre table tbody td tfoot th thead tr ul".split())

#: Two pages of which either shares this much of its text with the other are near copies.
COPY_SHARE = 0.9

_QUOTED = r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+"
_RAW, _NAME = "(?P<raw>script|style|textarea|title|noscript|iframe|template)", "[a-zA-Z][a-zA-Z0-9:-]*"


def _markup(attributes: str, otherwise: str) -> re.Pattern[str]:
    return re.compile(
        rf"<!--.*?(?:-->|(?P<open>\Z))|<{_RAW}\b{attributes}>.*?(?:</(?P=raw)\s*>|(?P<unended>\Z))"
        rf"|<(?P<end>/?)(?P<name>{_NAME})(?:(?P<attrs>{attributes})>|(?P<broken>{otherwise})>)|<[!?/][^>]*>",
        re.S | re.I,
    )


#: Markup with quoted '>' in attributes; and without, for the rest of a page after a tag whose quotes never end.
_TAG, _PLAIN_TAG = _markup(_QUOTED, "[^>]*+"), _markup("[^>]*+", "(?!)")
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_ABOUT_LAYOUT = re.compile(r"(?:with|without|no|has)-")
_SPACE = re.compile(r"\s+")


#: Kinds of boilerplate by firmness. An article in a form or a layout element is one; so is one in a named element where
#: the page marks no other.
HIDES = ("form", "layout", "named", "boilerplate")


def _tags(page: str) -> Iterator[re.Match[str]]:
    """Comments and tags in order, in time that grows with the page: only one tag is ever read on to the page's end in vain."""
    pattern, at, last = _TAG, 0, page.rfind(">") + 1
    while m := pattern.search(page, at, last):
        at = m.end()
        yield m
        if m["open"] is not None or m["unended"] is not None:
            return
        if m["broken"] is not None:
            pattern = _PLAIN_TAG


def _says_so(name: str) -> bool:
    """Whether a class or id of an element inside an article names boilerplate and nothing else: related-posts, not related-work."""
    words = [w for w in re.split(r"[^a-z0-9]+", name) if w]
    return any(w in NAMED for w in words) and all(w in NAMED or w in BESIDE or w.isdigit() for w in words)


def _role(name: str, attributes: str, in_article: bool) -> str:
    """'main', 'article', one of HIDES or '' for an element."""
    if name in NEVER_TEXT:
        return "form" if name == "form" else "boilerplate"
    found = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in _ATTRIBUTE.finditer(attributes)}
    role = found.get("role", "")
    names = {c for c in (found.get("class", "") + " " + found.get("id", "")).split() if not _ABOUT_LAYOUT.match(c)}
    words = {word for c in names for word in re.split(r"[^a-z0-9]+", c)}
    if name == "article" and words & READERS:
        return "boilerplate"
    if name in ("article", "main") or role in ("main", "article") or found.get("itemprop") == "articlebody":
        if in_article and name not in BLOCKS:
            return ""
        return "main" if name == "main" or role == "main" else "article"
    if name == "header" and not in_article:
        return "named"
    if role == "form":
        return "form"
    if role in ROLES or found.get("aria-hidden") == "true" or "hidden" in re.split(r"\s+", _ATTRIBUTE.sub("", attributes).lower()):
        return "boilerplate"
    if name in ("html", "body"):
        return ""
    named = words & NAMED
    if in_article:
        if name in TEXT_BLOCKS:
            return ""
        names = {c for c in names if _says_so(c)}
        named &= {word for c in names for word in re.split(r"[^a-z0-9]+", c)} - {"header"}  # an article's own head
    if not named:
        return ""
    if any(re.split(r"[^a-z0-9]+", c)[0] in READERS for c in names):
        return "boilerplate"
    return "named" if names & named else "layout"


def _kind(roles: list[str]) -> str:
    """'article', 'held' (an article in a named element), one of HIDES or '' for text in elements of these roles."""
    kind = ""
    for role in roles:
        if role == "main":
            kind = "article"
        elif role == "article":
            kind = "held" if kind in ("named", "held") else kind if kind == "boilerplate" else "article"
        elif role:
            kind = max(kind, role, key=HIDES.index) if kind in HIDES else role
    return kind


def page_lines(page: str | None) -> list[tuple[str, str]]:
    """(text, kind) of the page's blocks in order; kind is 'article', 'boilerplate' or ''.

    Where nothing else is left, a form is taken for the page's layout.
    """
    page = page or ""
    lines: list[tuple[str, str]] = []
    open_tags: list[tuple[str, str]] = []
    pieces: list[str] = []

    def flush() -> None:
        if pieces:
            text = _SPACE.sub(" ", html.unescape("".join(pieces))).strip()
            pieces.clear()
            if text:
                lines.append((text, _kind([r for _, r in open_tags])))

    def close(to: int) -> None:
        flush()
        del open_tags[to:]

    at = 0
    for m in _tags(page):
        if m.start() > at:
            pieces.append(page[at : m.start()])
        at = len(page) if m["open"] is not None or m["unended"] is not None else m.end()
        name = (m["name"] or "").lower()
        attributes = m["attrs"] or m["broken"] or ""
        if not name:
            continue  # comment, declaration or raw element: no text
        if name == "br":
            pieces.append(" ")
            continue
        if name in VOID and name != "hr":
            continue
        role = "" if m["end"] or name == "hr" else _role(name, attributes, any(r in ("article", "main") for _, r in open_tags))
        if name not in BLOCKS and not role:
            if m["end"]:
                held = [i for i, (n, r) in enumerate(open_tags) if n == name and r]
                if held:
                    close(held[-1])
            continue
        if m["end"]:
            for i in range(len(open_tags) - 1, -1, -1):
                if open_tags[i][0] == name:
                    close(i)
                    break
            else:
                flush()
            continue
        flush()
        if open_tags and (open_tags[-1][0] == "p" and name in BLOCKS or open_tags[-1][0] in CLOSES.get(name, ())):
            close(len(open_tags) - 1)
        if name != "hr" and not attributes.endswith("/"):
            open_tags.append((name, role))
    pieces.append(page[at:].partition("<!--")[0])
    flush()
    kinds = {kind for _, kind in lines}
    means = {"article": "article", "": ""}
    if "article" not in kinds:
        means["held"] = "article"
        if not kinds & {"held", ""}:
            means["form"] = ""
    return [(text, means.get(kind, "boilerplate")) for text, kind in lines]


def _matching(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """One longest common subsequence of sequences in which no value is frequent, by increasing match positions."""
    where = defaultdict(list)
    for j, x in enumerate(b):
        where[x].append(j)
    tails: list[int] = []
    ends: list[tuple] = []
    for i, x in enumerate(a):
        for j in reversed(where.get(x, ())):
            k = bisect_left(tails, j)
            entry = (i, j, ends[k - 1] if k else None)
            if k == len(tails):
                tails.append(j)
                ends.append(entry)
            else:
                tails[k], ends[k] = j, entry
    out, entry = [], ends[-1] if ends else None
    while entry:
        out.append(entry[:2])
        entry = entry[2]
    return out[::-1]


def _lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Lengths of the longest common subsequences of a with every prefix of b, one row at a time."""
    b_values, row = np.array(b), np.zeros(len(b) + 1, np.int64)
    for x in a:
        row[1:] = np.maximum(row[1:], row[:-1] + (b_values == x))
        np.maximum.accumulate(row, out=row)
    return row


def common_lines(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Index pairs of one longest common subsequence, in memory that grows with the lines, not with their matches."""
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    stop = 0
    while stop < min(len(a), len(b)) - start and a[-1 - stop] == b[-1 - stop]:
        stop += 1
    head = [(i, i) for i in range(start)]
    tail = [(len(a) - k, len(b) - k) for k in range(stop, 0, -1)]
    x, y = a[start : len(a) - stop], b[start : len(b) - stop]
    if not x or not y:
        return head + tail
    values, counts = np.unique(np.array(y), return_counts=True)
    many = dict(zip(values.tolist(), counts.tolist(), strict=True))
    if len(x) == 1 or sum(many.get(v, 0) for v in x) <= 1_000_000:
        inner = _matching(x, y)
    else:  # halve one side where the two halves' lengths add up best
        half = len(x) // 2
        cut = int(np.argmax(_lengths(x[:half], y) + _lengths(x[half:][::-1], y[::-1])[::-1]))
        inner = common_lines(x[:half], y[:cut]) + [(i + half, j + cut) for i, j in common_lines(x[half:], y[cut:])]
    return head + [(i + start, j + start) for i, j in inner] + tail


def candidate_lines(lines: list[tuple[str, str]]) -> list[tuple[int, str]]:
    """The lines that may stay: the marked article (place -1, as sharing does not matter there), else all that the
    markup does not name as boilerplate, with their places."""
    if any(kind == "article" for _, kind in lines):
        return [(-1, text) for text, kind in lines if kind == "article"]
    return [(i, text) for i, (text, kind) in enumerate(lines) if not kind]


def main_text(candidates: list[tuple[int, str]], shared: set[int]) -> str:
    return "\n\n".join(text for place, text in candidates if place not in shared)


def line_hashes(lines: list[tuple[str, str]]) -> list[int]:
    """48 bits of hash of each line, and below them 16 bits for the length of the text that it may add to the page."""
    wanted = "article" if any(kind == "article" for _, kind in lines) else ""
    return [
        (xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) >> 16 << 16 | (min(len(text), 65_535) if kind == wanted else 0)) - (1 << 63)
        for text, kind in lines
    ]


def _content(host: str | None, row: bytes, hashes: list[int]) -> bytes:
    """Equal for pages of a host with equal lines; pages without a host go by their row."""
    return xxhash.xxh3_128_digest(np.array(hashes, np.int64).tobytes() + (row if host is None else host.encode("utf-8", "surrogatepass")))


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (page, row, host, path, page_id) those with text: lines, whether an article is marked, content, host, path, page_id."""
    for batch in batches:
        pages = [page_lines(p.as_py()) for p in batch.column(0)]
        lines = [line_hashes(p) for p in pages]
        marked = [any(kind == "article" for _, kind in p) for p in pages]
        keys = [_content(*x) for x in zip(batch.column(2).to_pylist(), batch.column(1).to_pylist(), lines, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(lines, pa.list_(pa.int64())), pa.array(marked, pa.bool_()), pa.array(keys, pa.binary()), *batch.columns[2:]],
            names=["lines", "marked", "key", *batch.schema.names[2:]],
        ).filter(pa.array([any(x & 0xFFFF for x in a) for a in lines], pa.bool_()))


def compare(a: list[int], b: list[int]) -> tuple[list[tuple[int, int]], bool]:
    """Index pairs of the common lines of two pages, and whether the pages are near copies."""
    pairs = common_lines([x >> 16 for x in a], [x >> 16 for x in b])
    near = any(
        sum(x[p[side]] & 0xFFFF for p in pairs) >= COPY_SHARE * sum(v & 0xFFFF for v in x) for side, x in enumerate((a, b))
    )
    return pairs, near


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(place, common lines' places on the page and on the other one, near) of (place, lines, other)."""
    for batch in batches:
        found = [compare(a, b) for a, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
        sides = [pa.array([[p[side] for p in pairs] for pairs, _ in found], pa.list_(pa.int32())) for side in (0, 1)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *sides, pa.array([near for _, near in found], pa.bool_())], names=["place", "shared", "other_shared", "near"]
        )


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("place", pa.int32()), ("text", pa.string())]))
    for batch in batches:
        pages = [page_lines(p.as_py()) for p in batch.column(0)]
        lines = [[{"place": i, "text": t} for i, t in candidate_lines(p)] for p in pages]
        keys = [
            _content(host, row, line_hashes(p))
            for host, row, p in zip(batch.column(2).to_pylist(), batch.column(1).to_pylist(), pages, strict=True)
        ]
        yield pa.RecordBatch.from_arrays(
            [pa.array(lines, kind), pa.array(keys, pa.binary()), *batch.columns[3:]], names=["lines", "key", *batch.schema.names[3:]]
        )


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [
            main_text([(x["place"], x["text"]) for x in lines], set(shared or ()))
            for lines, shared in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
        ]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def extract_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every row of pages (page_id, url, html, further columns ignored).

    Blocks are trimmed, have single spaces, character references decoded, and are joined by an empty line. A null or
    empty html, or a page without main text, gives an empty text. A page without a host in its URL, or alone on its
    host, has no neighbour, and only its markup is used; so have near copies (COPY_SHARE) that fill a host. Neighbours
    on a tie: the one before. Rows of a host with equal lines count as one page for pairing, at the first of their
    paths, and each get the result; an empty table stays empty.
    """
    url, page = F.col("url"), F.coalesce("html", F.lit(""))
    host, path = (F.try_parse_url(url, F.lit(part)) for part in ("HOST", "PATH"))
    keyed = pages.select(
        page.alias("page"),
        F.unhex(F.md5(F.concat_ws("\n", F.coalesce(F.col("page_id").cast("string"), F.lit("-")), F.coalesce(url, F.lit("-"))))).alias("row"),
        F.when(host != "", F.lower(host)).alias("host"), F.coalesce(path, F.lit("")).alias("path"),
        F.col("page_id").cast("bigint").alias("page_id"), url,
    )
    found = (
        keyed.where("host is not null").select("page", "row", "host", "path", "page_id")
        .mapInArrow(_hashes, "lines array<bigint>, marked boolean, key binary, host string, path string, page_id bigint")
    )
    contents = stage_table(
        found.groupBy("key").agg(
            F.first("host").alias("host"), F.min(F.struct("path", "page_id")).alias("at"),
            F.first("marked").alias("marked"), F.first("lines").alias("lines"),
        ),
        "page-lines",
    )
    ordered = add_dense_key(
        contents.select("key", "host", "marked", F.col("at.path").alias("path"), F.col("at.page_id").alias("page_id")),
        ["host", "path", "page_id", "key"], "place",
    ).select("place", "host", "path", "marked", "key")
    lines = contents.select("key", "lines")

    def neighbour(step: int, name: str) -> DataFrame:
        return ordered.select(
            (F.col("place") + step).alias("place"), "host", F.col("path").alias(f"{name}_path"), F.col("key").alias(name)
        )

    def alike(other: str) -> Column:
        """Length of the path that is common, -1 without a neighbour."""
        pairs = F.zip_with(F.split("path", "/"), F.split(other, "/"), lambda a, b: F.coalesce(a == b, F.lit(False)))
        first = F.array_position(pairs, False)
        return F.when(F.col(other).isNull(), -1).otherwise(F.when(first == 0, F.size(pairs)).otherwise(first))

    def compared(pairs: DataFrame) -> DataFrame:
        """Links of pairs (place, key, other_key)."""
        both = pairs.join(lines, "key").join(lines.select(F.col("key").alias("other_key"), F.col("lines").alias("other")), "other_key")
        return both.select("place", "lines", "other").mapInArrow(_links, "place bigint, shared array<int>, other_shared array<int>, near boolean")

    later_wins = alike("later_path") > alike("earlier_path")
    links = stage_table(
        compared(ordered.join(neighbour(1, "earlier"), ["place", "host"]).select("place", "key", F.col("earlier").alias("other_key"))), "page-links"
    )
    before = links.select("place", F.col("shared").alias("earlier_shared"), F.col("near").alias("earlier_near"))
    after = links.select((F.col("place") - 1).alias("place"), F.col("other_shared").alias("later_shared"), F.col("near").alias("later_near"))
    decided = (
        ordered.join(neighbour(1, "earlier"), ["place", "host"], "left").join(neighbour(-1, "later"), ["place", "host"], "left")
        .join(before, "place", "left").join(after, "place", "left")
        .where("not coalesce(earlier_near, false) and not coalesce(later_near, false)")
        .select("key", F.when(later_wins, F.col("later_shared")).otherwise(F.col("earlier_shared")).alias("shared"))
    )
    # a run starts wherever a page is no near copy of the one before; only its bounds are compared with other pages
    starts = add_dense_key(ordered.join(links.where("near"), "place", "left_anti").select("place"), ["place"], "run")
    runs = (
        starts.withColumnRenamed("place", "start")
        .join(starts.select((F.col("run") - 1).alias("run"), F.col("place").alias("next")), "run", "left")
        .join(ordered.agg(F.max("place").alias("last")).hint("broadcast"))
        .select("start", (F.coalesce("next", F.col("last") + 1) - 1).alias("stop")).where("stop > start")
    )
    bounded = (
        runs.join(ordered.select(F.col("place").alias("start"), "host"), "start")
        .join(neighbour(1, "earlier").withColumnRenamed("place", "start"), ["start", "host"], "left")
        .join(neighbour(-1, "later").withColumnRenamed("place", "stop"), ["stop", "host"], "left")
        .where("earlier is not null or later is not null")
    )
    chunk = 65_536
    members = (
        bounded.select("*", F.explode(F.sequence("start", "stop", F.lit(chunk))).alias("first"))
        .select("*", F.explode(F.sequence("first", F.least("stop", F.col("first") + chunk - 1))).alias("place"))
        .select("place", "earlier", "earlier_path", "later", "later_path")
    )
    outside = (
        ordered.where("not marked").join(members, "place")
        .select("place", "key", F.when(later_wins, F.col("later")).otherwise(F.col("earlier")).alias("other_key"))
    )
    beyond = compared(outside).where("not near").join(ordered, "place").select("key", "shared")
    parsed = keyed.select("page", "row", "host", "page_id", "url").mapInArrow(
        _lines, "lines array<struct<place:int,text:string>>, key binary, page_id bigint, url string"
    )
    return (
        parsed.join(decided.unionByName(beyond), "key", "left").select("page_id", "url", "lines", "shared")
        .mapInArrow(_texts, "page_id bigint, url string, text string")
    )
