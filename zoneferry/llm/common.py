"""Small helpers the corpus operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Texts turned into Python strings at a time, so that long ones do not add up.
ROWS_AT_ONCE = 256
#: Tasks that ``spread`` makes at most.
MOST_TASKS = 20_000


def table(spark: SparkSession, sf_dir: str, which: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{which}.parquet")


def tokenizer_path(which: str) -> str:
    """A public tokenizer's file, which every node has installed."""
    import public_tokenizers

    return public_tokenizers.path(which)


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def map_slices(
    df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema, rows: int = ROWS_AT_ONCE
) -> DataFrame:
    """``fn`` over a few hundred rows at a time; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, rows):
            made = fn(part)
            if made is not None and made.num_rows:
                yield made

    return df.mapInArrow(run, schema)


def texts(batch: pa.RecordBatch, which: str) -> list[str]:
    """A text column; null is empty."""
    return [x or "" for x in batch.column(which).to_pylist()]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words with well-mixed bits."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def odd_words(n: int, seed: int) -> np.ndarray:
    """``n`` odd 64-bit multipliers, the same in every task."""
    return mixed(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed) * np.uint64(1 << 32)) | np.uint64(1)


def rolling(hashes: np.ndarray, k: int, seed: int) -> np.ndarray:
    """A 64-bit fingerprint of every run of ``k`` consecutive word hashes."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i, by in enumerate(odd_words(k, seed)):
        total += hashes[i : i + n] * by
    return mixed(total)


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)],
        schema=schema,
    )


def spread(df: DataFrame) -> DataFrame:
    """A small staged table of large pieces of work, dealt over as many tasks as it has rows.

    The number is given: adaptive execution would merge rows as short as these into
    one task. Beyond ``MOST_TASKS`` a task gets several rows in turn.
    """
    return df.repartition(max(1, min(df.count(), MOST_TASKS)))


def without_columns(df: DataFrame, *used: str) -> DataFrame:
    """Only the columns an operator reads, so that others cannot clash with its own."""
    return df.select(*[F.col(f"`{c}`") for c in used])
