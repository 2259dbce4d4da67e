"""Removal of passages that repeat across or within documents, by seed and extend.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. A passage repeats when a window of
20 of its words also starts earlier (smaller doc_id, or earlier in the same
document); every word of the later one goes.

1. Copies of one text are settled first: all but the one with the smallest id
   lose every word if they have 20 or more.
2. Seeds: a window's anchor is the smallest fingerprint of its six-word runs
   (winnowing), so equal windows have equal anchors at equal places. Anchors that
   occur at one place of one text, copies aside, seed nothing.
3. Extension: around each repeated anchor, every window it anchors, to both sides,
   is compared with those of the equal anchors by a fingerprint of 128 bits, as a
   digest of its words; all but the first are marked. Marks of neighbouring anchors join
   to maximal repeats.

An anchor's rows meet in one task only up to ``GROUP`` of them; those of a more
frequent one are dealt over several tasks, whose first windows are then compared.
Pairs of documents are never formed.

Defined results: null, empty and short texts keep all words; repeated rows of one
id and text are one document; of rows with one id and different texts, windows at
the same start are both first; a null id counts as smaller than any other; an
empty table gives an empty result.
"""

from __future__ import annotations

from contextlib import ExitStack

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from zoneferry.llm.common import batch_of, map_slices, rolling
from zoneferry.session import stage, staged

WORDS, SEED = 20, 6
#: Rows of one anchor that one task compares.
GROUP = 20_000
NULL_ID = -(1 << 63)


def _hashes(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The two halves of a 128-bit hash of every word."""
    both = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), np.uint64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def anchors(hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of all seeds, and the place of each window's anchor."""
    seeds = rolling(hashes, SEED, 11)
    width = window - SEED + 1
    if len(seeds) < width:
        return seeds, np.empty(0, np.int64)
    chosen = np.empty(len(seeds) - width + 1, np.int64)
    for i in range(0, len(chosen), 4096):
        view = np.lib.stride_tricks.sliding_window_view(seeds[i : i + 4096 + width - 1], width)
        chosen[i : i + 4096] = view.argmin(axis=1) + np.arange(i, i + len(view))
    return seeds, chosen


_ANCHORS = pa.schema([("id", pa.int64()), ("th", pa.binary()), ("h", pa.list_(pa.int64())), ("pos", pa.list_(pa.int32()))])


def _anchor_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    hs, ps = [], []
    for text in batch.column("text").to_pylist():
        seeds, chosen = anchors(_hashes(text.encode().split())[0], WORDS)
        pos = np.unique(chosen)
        hs.append(seeds[pos].view(np.int64))
        ps.append(pos.astype(np.int32))
    ends = pa.array(np.concatenate([[0], np.cumsum([len(p) for p in ps])]).astype(np.int32))
    lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x))) for x in (hs, ps)]
    return batch_of(_ANCHORS, [batch.column("id"), batch.column("th"), *lists])


_WINDOWS = pa.schema(
    [
        ("h", pa.int64()),
        ("n", pa.int64()),
        ("id", pa.int64()),
        ("th", pa.binary()),
        ("first", pa.int32()),
        ("wins", pa.list_(pa.int64())),
        ("wins_2", pa.list_(pa.int64())),
    ]
)


def _window_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    out: list[list] = [[], [], [], [], [], [], []]
    for text, marks, id_, th in zip(*(batch.column(c).to_pylist() for c in ("text", "marks", "id", "th"))):
        hashes, more = _hashes(text.encode().split())
        seeds, chosen = anchors(hashes, WORDS)
        wins, wins_2 = rolling(hashes, WORDS, 13).view(np.int64), rolling(more, WORDS, 19).view(np.int64)
        for pos, n in {(m["pos"], m["n"]) for m in marks}:
            a, b = np.searchsorted(chosen, [pos, pos + 1])
            if b > a:
                for column, value in zip(out, (seeds[pos : pos + 1].view(np.int64)[0], n, id_, th, a, wins[a:b], wins_2[a:b])):
                    column.append(value)
    return batch_of(_WINDOWS, out)


_KEPT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())])


def _kept_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    n_words, n_removed, kept_text = [], [], []
    for text, marks in zip(batch.column("text").to_pylist(), batch.column("marks").to_pylist()):
        words = text.encode().split()
        if marks and len(words) >= WORDS:
            gone = np.zeros(len(words) + 1, np.int64)
            for m in marks:
                if m["mask"] < 0:
                    gone[0] += 1
                    continue
                for i in range(WORDS - SEED + 1):
                    if m["mask"] >> i & 1:
                        gone[m["first"] + i] += 1
                        gone[m["first"] + i + WORDS] -= 1
            kept = np.cumsum(gone[:-1]) == 0
            left = [w for w, k in zip(words, kept.tolist()) if k]
        else:
            left = words
        n_words.append(len(words))
        n_removed.append(len(words) - len(left))
        kept_text.append(b" ".join(left).decode())
    return batch_of(_KEPT, [batch.column("doc_id"), n_words, n_removed, kept_text])


def _masks(docs: DataFrame, done: ExitStack) -> DataFrame:
    """(id, th, marks) of the documents (id, th, text) that lose words, staged.

    ``done`` removes the staged copies that led there.
    """
    same = docs.select("id", "th").groupBy("th").agg(F.min("id").alias("rep"), F.count("*").alias("rows")).where("rows > 1")
    same = done.enter_context(staged(same.select("th", "rep"), "repeat-copies"))
    copies = docs.select("id", "th").join(same, "th").where("id > rep")

    anchored = map_slices(docs.select("id", "th", "text"), _anchor_rows, "id bigint, th binary, h array<bigint>, pos array<int>")
    with staged(anchored, "repeat-anchors") as found:
        seeds = found.select("id", "th", F.explode(F.arrays_zip("h", "pos")).alias("s")).select("id", "th", "s.h", "s.pos")
        place = F.xxhash64("th", "pos")  # of copies of one text the same
        often = seeds.groupBy("h").agg(F.count("*").alias("n"), F.min(place).alias("a"), F.max(place).alias("b")).where("a != b")
        marks = seeds.select("id", "h", "pos").join(often.select("h", "n"), "h").groupBy("id").agg(F.collect_list(F.struct("pos", "n")).alias("marks"))

        first_texts = found.select("id", "th").distinct().join(same, "th", "left").where("rep is null or id = rep")
        marks = done.enter_context(staged(marks.join(first_texts.select("id", "th"), "id"), "repeat-marks"))
    sources = docs.select("id", "th", "text").join(marks, ["id", "th"])
    copied = done.enter_context(staged(copies.distinct(), "repeat-copied"))
    windows = map_slices(sources, _window_rows, "h bigint, n bigint, id bigint, th binary, first int, wins array<bigint>, wins_2 array<bigint>")

    salt = F.pmod(F.hash("id"), F.ceil(F.col("n") / GROUP).cast("int"))
    dealt = windows.withColumn("salt", salt).repartition("h", "salt")
    each = dealt.select("h", "n", "salt", "id", "th", "first", F.posexplode(F.arrays_zip("wins", "wins_2")).alias("at", "win"))
    each = each.withColumn("start", F.struct("id", (F.col("first") + F.col("at")).alias("place")))
    each = each.withColumn("least", F.min("start").over(Window.partitionBy("h", "salt", "win")))
    bit = F.expr("shiftleft(1, at)")
    by_anchor = each.groupBy("h", "salt", "n", "id", "th", "first").agg(
        F.bit_or(F.when(F.col("start") > F.col("least"), bit).otherwise(0)).alias("mask"),
        F.collect_list(F.when((F.col("n") > GROUP) & (F.col("start") == F.col("least")), F.struct("at", "win"))).alias("open"),
    )
    marked = done.enter_context(staged(by_anchor.where("mask != 0 or size(open) > 0"), "repeat-marked"))

    dealt_firsts = marked.where(F.size("open") > 0).select("h", "id", "th", "first", F.explode("open").alias("o"))
    dealt_firsts = dealt_firsts.select("h", "id", "th", "first", "o.at", "o.win")
    dealt_firsts = dealt_firsts.withColumn("start", F.struct("id", (F.col("first") + F.col("at")).alias("place")))
    least = F.min("start").over(Window.partitionBy("h", "win"))
    later = dealt_firsts.withColumn("least", least).where(F.col("start") > F.col("least"))

    masks = marked.where("mask != 0").select("id", "th", "first", "mask")
    masks = masks.union(later.select("id", "th", "first", bit.alias("mask")))
    masks = masks.union(copied.select("id", "th", F.lit(-1).alias("first"), F.lit(-1).alias("mask")))
    return stage(masks.groupBy("id", "th").agg(F.collect_list(F.struct("first", "mask")).alias("marks")), "repeat-masks")


def without_repeats(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_text (kept words, one space between)."""
    docs = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.select("doc_id", F.coalesce("doc_id", F.lit(NULL_ID)).alias("id"), F.unhex(F.md5("text")).alias("th"), "text")
    with ExitStack() as done:
        masks = _masks(docs, done)
    judged = docs.join(masks, ["id", "th"], "left").select("doc_id", "text", "marks")
    return map_slices(judged, _kept_rows, "doc_id bigint, n_words bigint, n_removed bigint, kept_text string")
