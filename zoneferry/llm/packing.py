"""Packing of tokenised documents into windows of 2048 by non-negative least squares.

Every document is cut into full windows and a rest. The histogram of rest lengths
is covered by shallow combinations: pairs of lengths and triples (two lengths and
what is left) that fill a window exactly. Non-negative least squares solves how
often to repeat each one, the counts are rounded down to what the histogram
holds, and the residual rests are packed greedily: laid end to end and cut at
window ends, so only the last window of all can need padding.

The histogram and the combinations (at most 2047 lengths, some four thousand
combinations) are all the driver sees. Rests get their place from their rank
among rests of their length: a rank inside the task that counted them plus the
tasks before it.

Defined results: a null or empty text is the end-of-document id alone; repeated
rows are packed once each; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from zoneferry.llm.common import batch_of, map_slices, slices
from zoneferry.session import stage

WINDOW = 2048
END_ID = 1
#: Words whose ids a task remembers; beyond it starts afresh.
REMEMBERED = 400_000

# Fixed value: white space as the tokenizer's pattern understands it.
_NOT_SPACE = r"[^\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"


# Letters, numbers and white space among the first 256 code points.
_L = rb"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
_N = rb"0-9\xb2\xb3\xb9\xbc-\xbe"
_S = rb"\t-\r \x85\xa0"
_SMALL = bytes(c + 32 if 0x41 <= c <= 0x5A or 0xC0 <= c <= 0xDE and c != 0xD7 else c for c in range(256))
_SPECIAL = ("<|startoftext|>", "<|endoftext|>")
#: Closes a word; never part of UTF-8.
_CLOSE = b"\xff"


def _byte_of() -> dict[str, int]:
    """The printable stand-ins of bytes in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoder:
    """Ids of a text as little-endian 32-bit words.

    Texts of the first 256 code points are cut into the tokenizer's pieces here;
    a piece is merged once by rank (in the vocabulary of word ends, a mark that
    closes the word stands for the end) and remembered. For any other text the
    tokenizer itself encodes each word between white space once.
    """

    def __init__(self, path: str):
        import os
        import re

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words_of = re.compile(_NOT_SPACE).findall
        letters, numbers, others = b"[%s]+" % _L, b"[%s]" % _N, b"[^%s%s%s]+" % (_L, _N, _S)
        self.pieces_of = re.compile(b"'s|'t|'re|'ve|'m|'ll|'d|" + b"|".join((letters, numbers, others))).findall
        byte_of, ranks = _byte_of(), {}
        for token, number in self.tokenizer.get_vocab(with_added_tokens=False).items():
            body = token.removesuffix("</w>")
            if all(c in byte_of for c in body) and number < 49406:
                ranks[bytes(byte_of[c] for c in body) + _CLOSE * (body != token)] = number
        ranks.setdefault(_CLOSE, 1 << 30)
        self.merged = tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._encode_single_piece
        self.known: dict[bytes | str, bytes] = {}

    def __call__(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        return [self._encode(t) for t in texts]

    def _encode(self, text: str) -> bytes:
        known = self.known
        try:
            plain = text.encode("latin-1")
        except UnicodeEncodeError:
            plain = None
        if plain is None or any(s in text for s in _SPECIAL):
            words = self.words_of(text)
            new = [w for w in set(words) if w not in known]
            for word, e in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False)):
                known[word] = np.array(e.ids, "<u4").tobytes()
            return b"".join(map(known.__getitem__, words))
        pieces = self.pieces_of(plain.translate(_SMALL))
        for piece in set(pieces).difference(known):
            ids = self.merged(piece.decode("latin-1").encode() + _CLOSE)
            known[piece] = np.array(ids, "<u4").tobytes()
        return b"".join(map(known.__getitem__, pieces))


_END = np.array([END_ID], "<u4").tobytes()


@dataclass(frozen=True)
class Plan:
    """Where the n-th rest of each length goes.

    ``slots[length]`` has (first rank, rank step, first window, offset); ranks
    from ``taken[length]`` on are residual and start at ``base[length]``.
    """

    slots: dict[int, list[tuple[int, int, int]]]
    taken: dict[int, int]
    base: dict[int, int]
    windows: int


def combinations(lengths: np.ndarray, counts: np.ndarray) -> list[tuple[int, ...]]:
    """Pairs and triples of present lengths that fill a window."""
    present = set(lengths.tolist())
    out = {(a, WINDOW - a) for a in present if a <= WINDOW - a and WINDOW - a in present}
    often = lengths[np.argsort(-counts, kind="stable")][:128].tolist()
    for i, a in enumerate(often):
        for b in often[i:]:
            c = WINDOW - a - b
            if c > 0 and c in present:
                out.add(tuple(sorted((a, b, c))))
    return sorted(out)


def non_negative_least_squares(uses: list[tuple[int, ...]], lengths: np.ndarray, counts: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """Repeats x >= 0 of the combinations, by coordinate descent on |A x - h|^2."""
    at = {int(v): i for i, v in enumerate(lengths)}
    columns = []
    for use in uses:
        index, times = np.unique([at[v] for v in use], return_counts=True)
        columns.append((index, times.astype(float), float((times**2).sum())))
    x, rest = np.zeros(len(uses)), counts.astype(float).copy()
    for _ in range(sweeps):
        moved = 0.0
        for k, (index, times, norm) in enumerate(columns):
            new = max(0.0, x[k] + float(rest[index] @ times) / norm)
            if new != x[k]:
                rest[index] -= times * (new - x[k])
                moved = max(moved, abs(new - x[k]))
                x[k] = new
        if moved < 0.01:
            break
    return x


def plan_rests(histogram: dict[int, int], first_window: int) -> Plan:
    lengths = np.array(sorted(histogram), np.int64)
    counts = np.array([histogram[v] for v in lengths.tolist()], np.int64)
    uses = combinations(lengths, counts)
    repeats = non_negative_least_squares(uses, lengths, counts)
    left = dict(histogram)
    slots: dict[int, list] = {v: [] for v in histogram}
    window = first_window
    for k in np.argsort(-repeats, kind="stable").tolist():
        use = uses[k]
        times = min(round(float(repeats[k])), *(left[v] // use.count(v) for v in use))
        if times < 1:
            continue
        offset = 0
        for v in use:
            slots[v].append((histogram[v] - left[v], window, offset))
            left[v] -= times
            offset += v
        window += times
    taken, base, at = {}, {}, 0
    for v in lengths.tolist():
        taken[v], base[v] = histogram[v] - left[v], at
        at += left[v] * v
    return Plan(slots, taken, base, window)


def place(plan: Plan, length: int, rank: int) -> list[tuple[int, int, int, int]]:
    """Pieces (start in the rest, length, window, offset) of a rest."""
    if rank < plan.taken[length]:
        slots = plan.slots[length]
        first, window, offset = slots[bisect_right(slots, rank, key=lambda s: s[0]) - 1]
        return [(0, length, window + rank - first, offset)]
    at = plan.base[length] + (rank - plan.taken[length]) * length
    head = min(length, WINDOW - at % WINDOW)
    pieces = [(0, head, plan.windows + at // WINDOW, at % WINDOW)]
    if head < length:
        pieces.append((head, length - head, plan.windows + at // WINDOW + 1, 0))
    return pieces


_CUT = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("rank", pa.int64())]
)
_CUT_SQL = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, rank bigint"


def _cut(path: str):
    """Pieces of a task's documents, each ranked among the task's pieces of its length."""

    def run(batches):
        encode, seen = Encoder(path), {}
        for batch in slices(batches):
            out: list[list] = [[] for _ in _CUT]
            encoded = encode([t or "" for t in batch.column("text").to_pylist()])
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoded):
                ids += _END
                n = len(ids) // 4
                for start in range(0, n, WINDOW):
                    length = min(WINDOW, n - start)
                    rank = seen[length] = seen.get(length, -1) + 1
                    crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                    for column, value in zip(out, (doc_id, start, length, crc, n, rank)):
                        column.append(value)
            yield batch_of(_CUT, out)

    return run


_SUB = pa.schema([("doc_id", pa.int64()), ("doc_tokens", pa.int64()), ("rest_crc32", pa.int64()), ("head", pa.int64()), ("head_crc32", pa.int64()), ("tail_crc32", pa.int64())])
_SUB_SQL = "doc_id bigint, doc_tokens bigint, rest_crc32 bigint, head bigint, head_crc32 bigint, tail_crc32 bigint"


def _recut(path: str):
    """Checksums of both parts of rests that a window end divides."""

    def run(batches):
        encode = Encoder(path)
        for batch in slices(batches):
            out: list[list] = [[] for _ in _SUB]
            encoded = encode([t or "" for t in batch.column("text").to_pylist()])
            for doc_id, ids, cuts in zip(batch.column("doc_id").to_pylist(), encoded, batch.column("cuts").to_pylist()):
                ids += _END
                n = len(ids) // 4
                rest = ids[4 * (n - 1 - (n - 1) % WINDOW) :]
                for head in {c["head"] for c in cuts if c["doc_tokens"] == n}:
                    row = (doc_id, n, zlib.crc32(rest), head, zlib.crc32(rest[: 4 * head]), zlib.crc32(rest[4 * head :]))
                    for column, value in zip(out, row):
                        column.append(value)
            yield batch_of(_SUB, out)

    return run


def pack(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    docs = docs.select(F.col("doc_id").cast("bigint"), "text")
    cut = docs.mapInArrow(_cut(tokenizer), _CUT_SQL).withColumn("part", F.spark_partition_id())
    cut = stage(cut, "pack-cut")

    counts = stage(cut.groupBy("length", "part").agg(F.count("*").alias("n")), "pack-counts")
    histogram = dict(counts.groupBy("length").agg(F.sum("n")).collect())
    full = histogram.pop(WINDOW, 0)
    plan = plan_rests(histogram, full)
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("length", "part", F.coalesce(before, F.lit(0)).alias("before"))
    ranked = cut.join(offsets, ["length", "part"]).withColumn("rank", F.col("rank") + F.col("before")).drop("before", "part")

    schema = pa.schema([*_CUT][:5] + [("sequence_id", pa.int64()), ("offset", pa.int64()), ("head", pa.int64()), ("rest_crc32", pa.int64())])

    def placed(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[list] = [[] for _ in schema]
        for doc_id, start, length, crc, n, rank in zip(*(batch.column(f.name).to_pylist() for f in _CUT)):
            pieces = [(0, length, rank, 0)] if length == WINDOW else place(plan, length, rank)
            for skip, size, window, offset in pieces:
                own = crc if len(pieces) == 1 else None
                head = None if len(pieces) == 1 else pieces[0][1]
                for column, value in zip(out, (doc_id, start + skip, size, own, n, window, offset, head, crc)):
                    column.append(value)
        return batch_of(schema, out)

    sql = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, head bigint, rest_crc32 bigint"
    pieces = stage(map_slices(ranked.select(*[f.name for f in _CUT]), placed, sql, 4096), "pack-pieces")

    divided = pieces.where("head is not null")
    cuts = divided.groupBy("doc_id").agg(F.collect_set(F.struct("doc_tokens", "head")).alias("cuts"))
    cuts = stage(cuts, "pack-divided").withColumnRenamed("doc_id", "_id")
    sources = docs.join(cuts, F.col("doc_id").eqNullSafe(F.col("_id"))).select("doc_id", "text", "cuts")
    sums = sources.mapInArrow(_recut(tokenizer), _SUB_SQL).distinct().withColumnRenamed("doc_id", "_id")
    keys = ["doc_tokens", "rest_crc32", "head"]
    sums = sums.select("_id", *[F.col(k).alias(f"_{k}") for k in keys], "head_crc32", "tail_crc32")
    same = F.col("doc_id").eqNullSafe(F.col("_id"))
    for k in keys:
        same = same & (F.col(k) == F.col(f"_{k}"))
    at_head = (F.col("start") % WINDOW) == 0
    whole = divided.drop("ids_crc32").join(sums, same)
    whole = whole.withColumn("ids_crc32", F.when(at_head, F.col("head_crc32")).otherwise(F.col("tail_crc32")))
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return pieces.where("head is null").select(*columns).union(whole.select(*columns))
