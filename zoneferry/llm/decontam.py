"""Benchmark decontamination by an FM-index of every shard of the corpus.

A window is ten consecutive words of a benchmark item (a shorter item is one
window). Words are maximal runs of ASCII digits, letters and non-ASCII
characters, A-Z lower-cased. A shard is a slice of documents inside one task.
Only words of the benchmark can lie in an occurrence, so a shard indexes its
maximal runs of such words that are as long as the shortest window. Over them it
builds the suffix array, the Burrows-Wheeler transform, a wavelet matrix for
ranks and a sampled suffix array, searches all windows backwards at once,
locates their occurrences by stepping to sampled positions, and merges the hit
words into spans.

The benchmark goes to the tasks in blocks of bounded size; a larger benchmark
takes more blocks, which are chained in one pass over the documents. Documents
are never shuffled.

Defined results: a null or empty text has no words; an item without words has no
window; an item without an id marks words but is not listed; repeated documents
and items are each handled, an id listed once; an empty benchmark hits nothing.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from zoneferry.llm.common import batch_of, map_slices

WINDOW = 10
#: Characters of benchmark text sent to the tasks at a time.
BLOCK_CHARS = 8_000_000
SAMPLE = 8
#: Documents to a shard; also bounded by the bytes of an Arrow batch.
SHARD_ROWS = 2048


def _letters() -> bytes:
    keep = bytearray(b" " * 256)
    for b in [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]:
        keep[b] = b
    for b in range(0x41, 0x5B):
        keep[b] = b + 32
    return bytes(keep)


LETTERS = _letters()


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(LETTERS).split()


class WaveletMatrix:
    """Ranks of any symbol in a sequence, by one bit vector per level."""

    def __init__(self, seq: np.ndarray, sigma: int):
        self.bits = max(1, int(sigma - 1).bit_length())
        self.ones, self.zeros = [], []
        for level in range(self.bits - 1, -1, -1):
            bit = (seq >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]).astype(np.int32))
            self.zeros.append(int(len(seq) - bit.sum()))
            seq = np.concatenate([seq[bit == 0], seq[bit == 1]])

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each end."""
        start = np.zeros_like(end)
        for k, level in enumerate(range(self.bits - 1, -1, -1)):
            ones, bit = self.ones[k], ((symbol >> level) & 1).astype(bool)
            s, e = ones[start], ones[end]
            start = np.where(bit, self.zeros[k] + s, start - s)
            end = np.where(bit, self.zeros[k] + e, end - e)
        return end - start


def suffix_array(seq: np.ndarray) -> np.ndarray:
    """By doubling the length that is sorted; the end sorts first."""
    n, k = len(seq), 1
    rank = np.unique(seq, return_inverse=True)[1].astype(np.int64)
    while True:
        after = np.zeros(n, np.int64)
        after[: n - k] = rank[k:] + 1
        order = np.argsort(rank * (n + 2) + after, kind="stable")
        key = (rank * (n + 2) + after)[order]
        new = np.empty(n, np.int64)
        new[order] = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        rank = new
        if rank.max(initial=0) == n - 1 or k >= n:
            return order
        k *= 2


class FMIndex:
    """Over symbols from 1; 0 separates and is never searched for.

    Inside, symbols are one higher: an end of its own keeps the steps exact.
    """

    def __init__(self, seq: np.ndarray, sigma: int):
        seq, sigma = np.append(seq + 1, 0), sigma + 1
        sa = suffix_array(seq)
        self.last = seq[sa - 1]
        self.before = np.concatenate([[0], np.cumsum(np.bincount(seq, minlength=sigma))]).astype(np.int64)
        self.tree = WaveletMatrix(self.last, sigma)
        self.sampled = sa % SAMPLE == 0
        self.sample_no = np.cumsum(self.sampled) - 1
        self.samples = sa[self.sampled]
        self.n = len(seq)

    def search(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of windows of one length, all stepped together."""
        lo = np.zeros(len(windows), np.int64)
        hi = np.full(len(windows), self.n, np.int64)
        for j in range(windows.shape[1] - 1, -1, -1):
            c = windows[:, j] + 1
            lo, hi = self.before[c] + self.tree.rank(c, lo), self.before[c] + self.tree.rank(c, hi)
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        at, steps = rows.copy(), np.zeros(len(rows), np.int64)
        open_ = np.flatnonzero(~self.sampled[at])
        while len(open_):
            c = self.last[at[open_]]
            at[open_] = self.before[c] + self.tree.rank(c, at[open_])
            steps[open_] += 1
            open_ = open_[~self.sampled[at[open_]]]
        return self.samples[self.sample_no[at]] + steps


class Phrases:
    """The windows of a block of items, as numbers of words."""

    def __init__(self, items: list[tuple[str | None, str]], window: int = WINDOW):
        self.vocab: dict[bytes, int] = {}
        owners: dict[tuple, set] = defaultdict(set)
        for item_id, text in items:
            words = [self.vocab.setdefault(w, len(self.vocab) + 1) for w in words_of(text)]
            for i in range(max(1, len(words) - window + 1) if words else 0):
                owners[tuple(words[i : i + window])].update([] if item_id is None else [item_id])
        by_length = defaultdict(list)
        for w in owners:
            by_length[len(w)].append(w)
        self.by_length = {n: np.array(ws, np.int64) for n, ws in by_length.items()}
        self.owners = {n: [sorted(owners[w]) for w in ws] for n, ws in by_length.items()}
        self.shortest = min(by_length, default=0)

    def hits(self, documents: list[list[bytes]]) -> tuple[list[np.ndarray | None], list[set]]:
        """For each document of a shard its hit words (None: none) and its items."""
        masks: list = [None] * len(documents)
        items: list[set] = [set() for _ in documents]
        if not self.shortest:
            return masks, items
        runs, owner, first = [], [], []
        for d, words in enumerate(documents):
            ids = np.fromiter(map(self.vocab.get, words, _ZEROS), np.int64, len(words))
            edge = np.flatnonzero(np.diff(np.concatenate([[0], ids > 0, [0]])))
            for a, b in zip(edge[::2], edge[1::2]):
                if b - a >= self.shortest:
                    runs.append(ids[a:b])
                    owner.append(d)
                    first.append(a)
        if not runs:
            return masks, items
        lengths = np.array([len(r) + 1 for r in runs])
        starts = np.cumsum(lengths) - lengths
        index = FMIndex(np.concatenate([np.append(r, 0) for r in runs]), len(self.vocab) + 1)
        for n, windows in self.by_length.items():
            lo, hi = index.search(windows)
            found = np.flatnonzero(hi > lo)
            if not len(found):
                continue
            many = (hi - lo)[found]
            rows = np.repeat(lo[found] - (np.cumsum(many) - many), many) + np.arange(many.sum())
            at, which = index.locate(rows), np.repeat(found, many)
            run = np.searchsorted(starts, at, side="right") - 1
            docs, where = np.array(owner)[run], np.array(first)[run] + at - starts[run]
            for d, p in zip(docs.tolist(), where.tolist()):
                if masks[d] is None:
                    masks[d] = np.zeros(len(documents[d]), bool)
                masks[d][p : p + n] = True
            for d, w in {*zip(docs.tolist(), which.tolist())}:
                items[d].update(self.owners[n][w])
        return masks, items


class _Forever:
    def __iter__(self):
        return self

    def __next__(self):
        return 0


_ZEROS = _Forever()


def phrase_blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> list:
    """Broadcasts of at most about ``block_chars`` characters of items each."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("id"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    n = max(1, -(-chars // block_chars))
    block = F.pmod(F.xxhash64("id", "text"), F.lit(n))
    return [
        spark.sparkContext.broadcast([(r.id, r.text) for r in items.where(block == b).collect()])
        for b in range(n)
    ]


def _hits_of(blocks: list, ready: dict, documents: list[list[bytes]]):
    """``ready`` keeps the phrases of a block for the rest of the task."""
    masks: list = [None] * len(documents)
    items: list[set] = [set() for _ in documents]
    for i, block in enumerate(blocks):
        if i not in ready:
            ready[i] = Phrases(block.value)
        more, owners = ready[i].hits(documents)
        for d, (m, o) in enumerate(zip(more, owners)):
            masks[d] = m if masks[d] is None else masks[d] if m is None else masks[d] | m
            items[d] |= o
    return masks, items


def spans_of(text: str, mask: np.ndarray) -> list[tuple[int, int]]:
    """Byte spans from the first to the last word of each run of hit words."""
    letters = np.frombuffer(text.encode().translate(LETTERS), np.uint8) != 32
    edge = np.flatnonzero(np.diff(np.concatenate([[0], letters, [0]])))
    run = np.flatnonzero(np.diff(np.concatenate([[0], mask, [0]])))
    return [(int(edge[2 * a]), int(edge[2 * b - 1])) for a, b in zip(run[::2], run[1::2])]


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    data, out, at = text.encode(), [], 0
    for a, b in spans:
        out.append(data[at:a])
        at = b
    return b"".join([*out, data[at:]]).decode()


_REPORT = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()), ("items_sha256", pa.string()), ("contaminated", pa.bool_())]
)


def report(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Per document: its words, those hit, and the items found in it."""
    blocks, ready = phrase_blocks(benchmark, block_chars), {}

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        documents = [words_of(t or "") for t in batch.column("text").to_pylist()]
        masks, items = _hits_of(blocks, ready, documents)
        hit = [0 if m is None else int(m.sum()) for m in masks]
        sha = [hashlib.sha256(",".join(sorted(i)).encode()).hexdigest() for i in items]
        return batch_of(
            _REPORT,
            [batch.column("doc_id"), [len(d) for d in documents], hit, [len(i) for i in items], sha, [h > 0 for h in hit]],
        )

    return map_slices(
        docs.select(F.col("doc_id").cast("bigint"), "text"),
        rows,
        "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean",
        SHARD_ROWS,
    )


def remove_passages(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents with the hit spans cut out; other texts stay as they are."""
    blocks, ready = phrase_blocks(benchmark, block_chars), {}

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").to_pylist()
        masks, _ = _hits_of(blocks, ready, [words_of(t or "") for t in texts])
        if any(m is not None for m in masks):
            texts = [t if m is None else without_spans(t, spans_of(t, m)) for t, m in zip(texts, masks)]
            at = batch.schema.get_field_index("text")
            batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
        return batch

    return map_slices(docs, rows, docs.schema, SHARD_ROWS)
