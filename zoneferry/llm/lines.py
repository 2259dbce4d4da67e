"""Removal of lines that repeat, exactly or within a few edits, by a segment join.

A line of ``MIN_CHARS`` code points or more is dropped when an equal line, or one
within ``EDITS`` edits, starts earlier in the corpus (smaller doc_id, then line
number). Shorter lines are left alone: they say too little to be told apart.

1. Equal lines are one distinct line with its first place.
2. Every distinct line is cut into EDITS + 1 segments. Of two lines within EDITS
   edits, the longer one has a segment of the shorter near its own place. Segments
   are indexed by line length, number and content; the longer line probes the
   lengths it can match, at the starts that the number of edits on either side
   allows. Its own segments are in the index, which tells by itself which of
   them several lines have, so they are no probes.
3. Only lines that share a key with a different line go on with their text, and
   only under the keys they share. There a semi join on the keys verifies by edit
   distance within the band, so a line needs one earlier neighbour and no pairs are
   listed.

All of it is DataFrame functions. Frequent lines are combined before they shuffle.

Defined results: a null text stays null and has no lines; an empty one has one
empty line; repeated rows of one id and text are one document, so they do not
repeat each other; a null id counts as smaller than any other; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from zoneferry.session import stage

EDITS = 2
MIN_CHARS = 20
NULL_ID = -(1 << 63)
#: What is broadcast to spare rows a shuffle has this many rows at most, at any size.
SLOTS = 1 << 20


def _keys(lines: DataFrame, places: list[tuple[int, int, int]], edits: int) -> DataFrame:
    """(key, line_id), a row per line and place (segment, how much shorter a line, shift).

    Segment ``i`` of a line of the shorter length, looked for ``shift`` characters further;
    the last segments of a length are longer. One expression in a loop over the places: all
    of them side by side make a method too long for the JVM to compile. Characters of one
    byte each are cut by bytes, which need no counting from the start of the line; the
    key is that of the same characters.
    """
    lines = lines.withColumn("bytes", F.col("line").cast("binary"))
    each = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(less).alias("less"), F.lit(shift).alias("shift")) for i, less, shift in places])
    each = each.cast("array<struct<i:int,less:int,shift:int>>")
    rows = lines.select("line", "bytes", "chars", "line_id", F.explode(each).alias("place"))
    i, length, parts = F.col("place.i"), F.col("chars") - F.col("place.less"), edits + 1
    base = F.floor(length / parts).cast("int")
    start = base * i + F.greatest(F.lit(0), i - (parts - length % parts))
    size = base + F.when(i >= parts - length % parts, 1).otherwise(0)
    at = start + 1 + F.col("place.shift")
    plain = F.length("bytes") == F.col("chars")
    segment = F.when(plain, F.substr("bytes", at, size)).otherwise(F.substr("line", at, size).cast("binary"))
    return rows.select(F.xxhash64(i, length, segment).alias("key"), "line_id")


def index_keys(lines: DataFrame, edits: int) -> DataFrame:
    return _keys(lines, [(i, 0, 0) for i in range(edits + 1)], edits)


def probe_keys(lines: DataFrame, edits: int) -> DataFrame:
    """Keys of the segments a line of equal or lower length would have in this one, but for its own."""
    places = [
        (i, less, shift)
        for less in range(edits + 1)
        for i in range(edits + 1)
        for shift in range(max(-i, less - (edits - i)), min(i, less + (edits - i)) + 1)
        if less or shift
    ]
    return _keys(lines, places, edits)


def _identified(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NULL_ID)).alias("id"), F.xxhash64(text).alias("th"), text.alias("text")
    )


def _among(rows: DataFrame, wanted: DataFrame, on: str) -> DataFrame:
    """Rows whose hash ``on`` may be among the wanted: those of an equal residue.

    A join by the hash itself still has to follow. Only residues are broadcast, so
    the bound is SLOTS rows; the more hashes are wanted, the fewer rows this spares.
    """
    slots = wanted.select(F.pmod(on, F.lit(SLOTS)).alias("slot")).distinct()
    return rows.join(F.broadcast(slots), F.pmod(rows[on], F.lit(SLOTS)) == slots["slot"], "left_semi")


def _late_lines(lines: DataFrame, distinct: DataFrame, edits: int) -> DataFrame:
    """(line_id) of the distinct lines that have an earlier neighbour within the edits."""
    index = index_keys(lines, edits).groupBy("key").agg(F.min("line_id").alias("lo"), F.max("line_id").alias("hi"))
    met = probe_keys(lines, edits).join(index, "key").where((F.col("lo") != F.col("line_id")) | (F.col("hi") != F.col("line_id")))
    shared = index.where("lo != hi").select("key", F.lit(None).cast("bigint").alias("line_id"))
    met = stage(met.select("key", "line_id").distinct().union(shared.hint("rebalance")), "line-met")

    own = _among(index_keys(lines, edits), met, "key").join(met.select("key").distinct(), "key", "left_semi")
    own = stage(own.distinct(), "line-own")
    met = met.where("line_id is not null")
    wanted = stage(met.select("line_id").union(own.select("line_id")).distinct(), "line-wanted")
    texts = _among(lines, wanted, "line_id").join(wanted, "line_id", "left_semi").groupBy("line_id").agg(F.first("line").alias("line"))
    texts = stage(texts.join(distinct.select("line_id", "first"), "line_id"), "line-texts")
    indexed, probing = own.join(texts, "line_id"), met.join(texts, "line_id")

    def late(these: DataFrame, others: DataFrame) -> DataFrame:
        these = these.select("key", "line_id", "line", "first")
        others = others.select(*these.columns).toDF("key", "line_id_2", "line_2", "first_2")
        near = F.levenshtein("line", "line_2", edits) >= 0
        earlier = (these["key"] == others["key"]) & (F.col("line_id") != F.col("line_id_2")) & (F.col("first_2") < F.col("first"))
        return these.join(others, earlier & near, "left_semi").select("line_id")

    every = indexed.unionByName(probing)
    return stage(late(probing, indexed).union(late(indexed, every)).distinct(), "line-late")


def dropped_lines(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """(id, th, dropped): numbers from 0 of the lines to drop, for documents that have any."""
    split = F.posexplode(F.split("text", "\n")).alias("at", "line")
    lines = _identified(docs).select("id", "th", split).withColumn("chars", F.length("line")).where(f"chars >= {MIN_CHARS}")
    lines = lines.withColumn("line_id", F.xxhash64("line", F.length("line"), F.crc32(F.col("line").cast("binary"))))
    grouped = lines.groupBy("line_id").agg(F.min(F.struct("id", "at")).alias("first"), F.count("*").alias("rows"))
    distinct = stage(grouped, "line-distinct")
    late = _late_lines(lines.select("line_id", "line", "chars"), distinct, edits).withColumn("late", F.lit(True))
    judged = distinct.join(late, "line_id", "left").where("late or rows > 1").select("line_id", "first", "late")
    judged = stage(judged, "line-judged")
    placed = _among(lines.select("id", "th", "at", "line_id"), judged, "line_id").join(judged, "line_id")
    gone = placed.where(F.col("late").isNotNull() | (F.struct("id", "at") > F.col("first")))
    return gone.groupBy("id", "th").agg(F.array_sort(F.collect_set("at")).alias("dropped"))


def report(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """Per document: doc_id, n_lines, n_dropped, dropped (line numbers from 0)."""
    counted = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NULL_ID)).alias("id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))).cast("bigint").alias("n_lines"),
    )
    out = counted.join(dropped_lines(docs, edits), ["id", "th"], "left")
    dropped = F.coalesce("dropped", F.array().cast("array<int>"))
    return out.select("doc_id", "n_lines", F.size(dropped).cast("bigint").alias("n_dropped"), dropped.alias("dropped"))


def drop_lines(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """The documents without the dropped lines; all other columns stay, whatever their names."""
    own = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NULL_ID)).alias("id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"),
    )
    joined = own.join(stage(dropped_lines(docs, edits), "line-dropped"), ["id", "th"], "left")
    kept = F.filter(F.split("row.text", "\n"), lambda _, i: ~F.array_contains(F.col("dropped"), i))
    text = F.when(F.col("dropped").isNull(), F.col("row.text")).otherwise(F.array_join(kept, "\n"))
    return joined.select(*[text.alias(c) if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])
