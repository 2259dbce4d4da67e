"""Main text of web pages: the article, and differencing with the nearest URL.

A page is cut into blocks (text lines) at block tags. Elements that declare
themselves furniture (navigation, header, footer, aside, forms, scripts, or such
a class, id or role) go with all they hold. Every page is held against the page
with the nearest URL path on its host: both neighbours in path order are looked at,
the one with the longer common path wins (the earlier if equal), lines are aligned
by longest common subsequence, and shared lines go.

A declared article guards its lines, since pages may share an article or a sentence:
lines in an ``article`` element stay though shared, and so do those in a ``main`` of
a page without one. What lies outside both goes where either is declared. A
neighbour with the same guarded lines is a copy and shows no furniture.

Pages are ordered by a range partitioning on host and path, so a large host spreads
over tasks; neighbours meet by their number in that order. Only 64-bit hashes of
lines travel for that. Lists of the lines to drop then go back to the pages that have
any; a page's html moves only when those lists are too many to broadcast.

Defined results: null or empty html gives an empty text; a null url has an empty
host and path; repeated rows each get a row (and differ with one another where no
article is declared); an empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from zoneferry.llm.common import batch_of, map_slices, slices
from zoneferry.session import stage

# HTML element names by role, and words that mark furniture.
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript", "template"}
FURNITURE = RAW | {"head", "nav", "header", "footer", "aside", "form", "button", "select", "menu", "dialog", "svg", "canvas", "object", "audio", "video"}
MAIN = {"article", "main"}
#: Where a block is: in neither, in a main element only, in an article element.
OUTSIDE, MAIN_PART, ARTICLE = 0, 1, 2
BLOCKS = set(
    "address article blockquote body caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6"
    " hr html legend li main ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
CLOSED_BY_NEXT = {"p", "li", "dt", "dd", "tr", "td", "th"}
MARKS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo banner nav navbar navigation menu breadcrumb"
    " breadcrumbs sidebar footer header masthead cookie cookies consent notice notices alert popup modal newsletter"
    " subscribe share sharing social related comment comments disqus respond reply replies login signup".split()
)
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu", "menubar"}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[A-Za-z/!?](?:[^>\"']|\"[^\"]*\"|'[^']*')*>|<[A-Za-z/!?][^>]*(?:>|\Z)", re.S)
_NAME = re.compile(r"</?([A-Za-z][^\s/>]*)")
_HINT = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PARTS = re.compile(r"[^a-z]+")
_DECLARES = re.compile(r"<(?:article|main)[\s>/]", re.I)


def _furniture(name: str, tag: str) -> bool:
    if name in FURNITURE:
        return True
    if "=" in tag and name not in MAIN and name not in ("body", "html"):
        for key, *values in _HINT.findall(tag):
            value = "".join(values).lower()
            if value in ROLES if key.lower() == "role" else not MARKS.isdisjoint(_PARTS.split(value)):
                return True
    return False


def blocks_of(html: str) -> list[tuple[str, int]]:
    """(text, place) of the blocks that are not furniture; see ``OUTSIDE``."""
    out: list[tuple[str, int]] = []
    pieces: list[str] = []
    opened: list[str] = []
    at, end = 0, len(html)

    def close() -> None:
        text = " ".join(unescape("".join(pieces)).split())
        pieces.clear()
        if text:
            out.append((text, ARTICLE if "article" in opened else MAIN_PART if opened else OUTSIDE))

    skipping, depth = "", 0
    while at < end:
        if skipping in RAW and depth:
            stop = re.compile(rf"</{skipping}[\s/>]", re.I).search(html, at)
            if stop is None:
                break
            at = stop.start()
        token = _TOKEN.search(html, at)
        if not depth:
            pieces.append(html[at : token.start() if token else end])
        if token is None:
            break
        at, tag = token.end(), token.group()
        named = _NAME.match(tag)
        if named is None:
            continue
        name, closing = named.group(1).lower(), tag[1] == "/"
        if depth:
            if skipping in CLOSED_BY_NEXT and name != skipping and name in BLOCKS | MAIN and not (closing and name not in MAIN):
                depth = 0
            elif name == skipping:
                depth += -1 if closing else 0 if skipping in CLOSED_BY_NEXT else not tag.endswith("/>")
                if depth or closing:
                    continue
            else:
                continue
        if name in MAIN:
            close()
            if not closing:
                opened.append(name)
            elif opened:
                opened.pop()
        elif not closing and name not in VOID and _furniture(name, tag):
            close()
            if not tag.endswith("/>"):
                skipping, depth = name, 1
        elif name == "br":
            pieces.append(" ")
        elif name in BLOCKS:
            close()
    close()
    return out


def guarded(places: list[int]) -> list[bool]:
    """Whether a block stays though it is shared."""
    least = ARTICLE if ARTICLE in places else MAIN_PART
    return [p >= least for p in places]


def common_lines(a: list, b: list) -> set[int]:
    """Indices in ``a`` of a longest common subsequence with ``b``."""
    places: dict[object, list[int]] = {}
    for j in range(len(b) - 1, -1, -1):
        places.setdefault(b[j], []).append(j)
    ends: list[int] = []
    chain: list[tuple[int, tuple | None]] = []
    for i, line in enumerate(a):
        for j in places.get(line, ()):
            k = bisect_left(ends, j)
            link = (i, chain[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                chain.append(link)
            else:
                ends[k], chain[k] = j, link
    found, node = set(), chain[-1] if chain else None
    while node:
        found.add(node[0])
        node = node[1]
    return found


def _shared_prefix(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def shared_lines(page: dict, others: list[dict | None]) -> list[int]:
    """Indices of the unguarded lines that the nearest page of the host shares."""

    def kept(of: dict) -> list[int]:
        return [line for line, stays in zip(of["lines"], of["stays"]) if stays]

    own = kept(page)
    near = [o for o in others if o is not None and o["host"] == page["host"] and not (own and kept(o) == own)]
    if not near:
        return []
    nearest = max(near, key=lambda o: _shared_prefix(page["path"], o["path"]))
    return sorted(i for i in common_lines(page["lines"], nearest["lines"]) if not page["stays"][i])


_TEXT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])
_TEXT_SQL = "page_id bigint, url string, text string"
_KEY = [("page_id", pa.int64()), ("url", pa.string()), ("th", pa.binary())]
_KEY_SQL = "page_id bigint, url string, th binary"
_LINES = pa.schema([*_KEY, ("host", pa.string()), ("path", pa.string()), ("lines", pa.list_(pa.int64())), ("stays", pa.list_(pa.bool_()))])
_LINES_SQL = f"{_KEY_SQL}, host string, path string, lines array<bigint>, stays array<boolean>"
_DROPPED = pa.schema([*_KEY, ("dropped", pa.list_(pa.int32()))])
_URL = re.compile(r"^(?:[A-Za-z][\w+.-]*:)?//([^/?#]*)([^?#]*)")


def _hashed(batch: pa.RecordBatch) -> pa.RecordBatch:
    out: list[list] = [[] for _ in _LINES]
    for page_id, url, th, html in zip(*(c.to_pylist() for c in batch.columns)):
        host, path = (m.groups() if (m := _URL.match(url or "")) else ("", url or ""))
        blocks = blocks_of(html)
        lines = [xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass")) - (1 << 63) for t, _ in blocks]
        for column, value in zip(out, (page_id, url, th, host.lower(), path, lines, guarded([p for _, p in blocks]))):
            column.append(value)
    return batch_of(_LINES, out)


def _numbered(batches):
    schema = pa.schema([*_LINES, ("copies", pa.int64()), ("place", pa.int64())])
    n = 0
    for batch in slices(batches):
        yield batch_of(schema, [*batch.columns, list(range(n, n + batch.num_rows))])
        n += batch.num_rows


def _differenced(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The lines to drop of the pages that have any; of repeated rows one is the other's neighbour."""
    out: list[list] = [[] for _ in _DROPPED]
    for row in batch.to_pylist():
        near = [row] if row["copies"] > 1 else [row["previous"], row["next"]]
        if dropped := shared_lines(row, near):
            for column, value in zip(out, (row["page_id"], row["url"], row["th"], dropped)):
                column.append(value)
    return batch_of(_DROPPED, out)


def _texts(batch: pa.RecordBatch) -> pa.RecordBatch:
    page_id, url, html, dropped = batch.columns
    found = []
    for page, gone in zip(html.to_pylist(), dropped.to_pylist()):
        least = MAIN_PART if _DECLARES.search(page) else OUTSIDE
        gone = set(gone or ())
        found.append("\n\n".join(t for i, (t, place) in enumerate(blocks_of(page)) if place >= least and i not in gone))
    return batch_of(_TEXT, [page_id, url, found])


def _shared(pages: DataFrame) -> DataFrame:
    """(page_id, url, th, dropped) of the pages that share unguarded lines with the nearest one, staged."""
    rows = map_slices(pages.select("page_id", "url", "th", "html"), _hashed, _LINES_SQL, 64)
    rows = rows.groupBy("host", "path", "page_id", "url", "th").agg(
        F.first("lines").alias("lines"), F.first("stays").alias("stays"), F.count(F.lit(1)).alias("copies")
    )
    rows = rows.select(*_LINES.names, "copies")
    order = ("host", "path", "page_id", "th")
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = ordered.mapInArrow(_numbered, f"{_LINES_SQL}, copies bigint, place bigint").withColumn("part", F.spark_partition_id())
    numbered = stage(numbered, "pages-ordered")
    sizes = numbered.groupBy("part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    placed = numbered.join(sizes, "part").withColumn("at", F.col("place") + F.col("before"))
    placed = stage(placed.drop("part", "place", "before"), "pages-placed")

    def neighbour(step: int, name: str) -> DataFrame:
        return placed.select((F.col("at") - step).alias("at"), F.struct("host", "path", "lines", "stays").alias(name))

    beside = placed.join(neighbour(-1, "previous"), "at", "left").join(neighbour(1, "next"), "at", "left")
    return stage(map_slices(beside, _differenced, f"{_KEY_SQL}, dropped array<int>", 64), "pages-shared")


def main_text(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text."""
    pages = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.coalesce("html", F.lit("")).alias("html"))
    pages = pages.withColumn("th", F.unhex(F.md5("html")))
    shared = _shared(pages).toDF("page_id_2", "url_2", "th_2", "dropped")
    same = (F.col("th") == F.col("th_2")) & F.col("page_id").eqNullSafe(F.col("page_id_2")) & F.col("url").eqNullSafe(F.col("url_2"))
    rows = pages.join(shared, same, "left").select("page_id", "url", "html", "dropped")
    return map_slices(rows, _texts, _TEXT_SQL, 64)
