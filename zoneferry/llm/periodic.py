"""Periodic runs of words in each text, by maximal-pair enumeration.

Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0. A run is a stretch of consecutive
words with smallest period ``q`` and a length of at least ``max(24, 3 * q)`` that no
neighbouring word extends keeping the period.

A run of length ``n`` is a maximal pair: its words from the start and from ``q`` later
agree for ``m = n - q`` words, differ after those, and differ before the start. As
``m >= 2 * q`` and ``m + q >= 24``, no pair under 16 common words matters.

1. Words become ranks; ranks of stretches of 1, 2, 4, ... words come from pairs of the
   ranks before. Stretches of 16 words that occur once end there: most texts are done.
2. The suffixes that share 16 words with another are sorted by the last ranks; the ranks of
   all lengths give the common words of neighbours (LCP).
3. The LCP-interval tree is built bottom-up on a stack. Each interval lists its suffixes
   by place, each with its class, the word to its left. When a child joins its
   parent, the smaller list is held against the larger: of two suffixes from
   different children the common words are exactly the parent's, and with different
   classes they are a maximal pair. A pair whose distance meets the length
   constraints is a run as it stands; nothing is extended.
   Only the next place on either side is looked at: a suffix between the two would
   give the stretch a smaller period, under which it is found.
4. A stretch found with several periods has the smallest.

Lists are joined smaller into larger, so a text of ``n`` words takes ``n log n`` steps of
a list insertion each, also if it is one word ``n`` times. Ranks take 4 bytes a word
and length. Texts are independent: nothing is shuffled.

Defined results: a null, empty or blank text has no words and no run; repeated rows get
equal results each; other columns are not read; an empty table gives no row.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from zoneferry.llm.common import batch_of, map_slices, rolling

LEAST, REPEATS = 24, 3
#: Fewest words that the two ends of a run's pair share.
SHARED = LEAST - LEAST // REPEATS
#: Most places in one piece of a list.
PIECE = 1024

Run = tuple[int, int, int]


class Places:
    """Places in ascending order, in pieces, so that an insertion moves few of them."""

    def __init__(self, place: int):
        self.pieces = [[place]]
        self.firsts = [place]
        self.size = 1

    def __iter__(self) -> Iterator[int]:
        for piece in self.pieces:
            yield from piece

    def around(self, place: int) -> tuple[int, int]:
        """The next places before and after one that is not listed; -1 where there is none."""
        k = bisect_left(self.firsts, place)
        if k == 0:
            return -1, self.firsts[0]
        piece = self.pieces[k - 1]
        at = bisect_left(piece, place)
        if at < len(piece):
            return piece[at - 1], piece[at]
        return piece[-1], self.firsts[k] if k < len(self.firsts) else -1

    def add(self, place: int) -> None:
        k = max(bisect_left(self.firsts, place) - 1, 0)
        piece = self.pieces[k]
        piece.insert(bisect_left(piece, place), place)
        self.firsts[k] = piece[0]
        self.size += 1
        if len(piece) > PIECE:
            half = len(piece) // 2
            self.pieces.insert(k + 1, piece[half:])
            self.firsts.insert(k + 1, piece[half])
            del piece[half:]


def _ranks(keys: np.ndarray) -> tuple[np.ndarray, int]:
    """Ranks from 1 of keys, in order, and how many there are."""
    order = np.argsort(keys, kind="stable")
    new = np.ones(len(keys), np.int32)
    new[1:] = keys[order[1:]] != keys[order[:-1]]
    ranks = np.empty(len(keys), np.int32)
    ranks[order] = np.cumsum(new, dtype=np.int32)
    return ranks, int(ranks[order[-1]])


def _doubled(words: np.ndarray) -> list[np.ndarray]:
    """Ranks of the stretches of 1, 2, 4, ... words from each place, until all differ."""
    ranks, count = _ranks(words)
    levels = [ranks]
    n, width = len(words), 1
    while count < n and width < n:
        after = np.zeros(n, np.int64)
        after[: n - width] = ranks[width:]
        ranks, count = _ranks(ranks.astype(np.int64) * (n + 1) + after)
        levels.append(ranks)
        width *= 2
    return levels


def _common(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words the suffixes from ``a`` and from ``b`` share, place by place."""
    n = len(levels[0])
    a, b = a.copy(), b.copy()
    shared = np.zeros(len(a), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        width, ranks = 1 << level, levels[level]
        inside = np.maximum(a, b) + width <= n
        same = inside & (ranks[np.minimum(a, n - 1)] == ranks[np.minimum(b, n - 1)])
        step = np.where(same, width, 0)
        a, b, shared = a + step, b + step, shared + step
    return shared


def _paired(a: Places, b: Places, shared: int, left: list[int], found: dict[tuple[int, int], int]) -> Places:
    """Two children of an interval as one list; the runs between them go to ``found``."""
    if a.size < b.size:
        a, b = b, a
    most = shared // (REPEATS - 1)
    least = LEAST - shared
    for place in b:
        for other in a.around(place):
            period = abs(other - place)
            if other >= 0 and least <= period <= most and left[other] != left[place]:
                key = (min(other, place), shared + period)
                found[key] = min(period, found.get(key, period))
    for place in b:
        a.add(place)
    return a


def runs(words: np.ndarray) -> list[Run]:
    """All runs (start, length, period) of word numbers, by start, then period."""
    n = len(words)
    if n < LEAST:
        return []
    gram = np.sort(rolling(words.astype(np.uint64), SHARED, 17))
    if (gram[1:] != gram[:-1]).all():  # equal stretches have equal fingerprints
        return []
    levels = _doubled(words)
    suffixes = np.empty(n, np.int64)
    suffixes[levels[-1] - 1] = np.arange(n)
    shared = _common(levels, suffixes[:-1], suffixes[1:])
    left = [-1, *levels[0][:-1].tolist()]
    found: dict[tuple[int, int], int] = {}
    close = np.flatnonzero(shared >= SHARED)
    if len(close) == 0:
        return []
    for group in np.split(close, np.flatnonzero(np.diff(close) > 1) + 1):
        open_: list[tuple[int, Places]] = []
        places = suffixes[group[0] : group[-1] + 2].tolist()
        for place, depth in zip(places, [*shared[group].tolist(), 0]):
            child = Places(place)
            while open_ and open_[-1][0] > depth:
                above, held = open_.pop()
                child = _paired(held, child, above, left, found)
            if open_ and open_[-1][0] == depth:
                above, held = open_.pop()
                child = _paired(held, child, above, left, found)
            open_.append((depth, child))
    return sorted(((start, length, period) for (start, length), period in found.items()), key=lambda r: (r[0], r[2]))


def kept(n: int, found: list[Run]) -> np.ndarray:
    """Which of ``n`` words stay when each run keeps its first period only."""
    gone = np.zeros(n + 1, np.int64)
    for start, length, period in found:
        gone[start + period] += 1
        gone[start + length] -= 1
    return np.cumsum(gone[:-1]) == 0


def strongest(found: list[Run]) -> Run | None:
    """The run of the greatest exponent; the first, then the shortest period, of equal ones."""
    best = None
    for run in found:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


_FOUND = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
        ("strongest", pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])),
        ("collapsed", pa.string()),
    ]
)
_RUN = "start: bigint, length: bigint, period: bigint"


def find(docs: DataFrame, changed: Callable[[int | None, list], list] | None = None) -> DataFrame:
    """Per document: doc_id, n_words, runs, strongest, collapsed (the kept words, one space between).

    ``changed``, where given, makes other words of a document's id and words first.
    """

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = batch.column("doc_id").to_pylist()
        out: list[list] = [[], [], [], []]
        for doc_id, text in zip(ids, batch.column("text").to_pylist()):
            words = (text or "").encode().split()
            if changed is not None:
                words = changed(doc_id, words)
            found = runs(pd.factorize(np.array(words, object))[0] + 1) if len(words) >= LEAST else []
            if found:
                stay = kept(len(words), found).tolist()
                left = [w for w, k in zip(words, stay) if k]
            else:
                left = words
            named = [dict(zip(("start", "length", "period"), r)) for r in found]
            best = strongest(found)
            values = (len(words), named, best and dict(zip(("start", "length", "period"), best)), b" ".join(left).decode())
            for column, value in zip(out, values):
                column.append(value)
        return batch_of(_FOUND, [batch.column("doc_id"), *out])

    schema = f"doc_id bigint, n_words bigint, runs array<struct<{_RUN}>>, strongest struct<{_RUN}>, collapsed string"
    return map_slices(docs.select(F.col("doc_id").cast("bigint"), "text"), rows, schema)
