"""Reconciliation by drilling down: checksums first, rows only where they differ.

Every row falls into a bucket and a sub-bucket by the hash of its key. One pass over
each zone gives the row count and two checksums of every sub-bucket; a bucket's are
those of its sub-buckets together. Buckets that agree are left alone. Of the others the
sub-buckets that differ are found, and only their rows are compared, key by key.

A zone that is kept partitioned by its bucket (``with_bucket``) is pruned to the
partitions of the buckets that differ; any other is filtered before its shuffle.
Zones should agree on their types: equal values of two types have different checksums,
so all such rows are compared, after a cast of the access side.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from zoneferry.functions.columns import name
from zoneferry.operators.joins import require_keys

BUCKET, SUB = "zf_bucket", "zf_sub"
BUCKETS, SUBS = 256, 256
MISSING, EXTRA, CHANGED = "missing", "extra", "changed"
SIDES = ("raw", "access")


@dataclass(frozen=True)
class Zone:
    """A zone's rows; ``bucket`` names the column that holds the bucket, if one does."""

    rows: DataFrame
    bucket: str | None = None


def _key_hash(keys: Sequence[str]) -> Column:
    # Casting to text lets zones disagree on the width of a key's type.
    return F.xxhash64(*[name(k).cast("string") for k in keys])


def with_bucket(df: DataFrame, keys: Sequence[str], buckets: int = BUCKETS, column: str = BUCKET) -> DataFrame:
    """The rows with their bucket, to be written partitioned by it."""
    require_keys(keys)
    return df.withColumn(column, F.pmod(_key_hash(keys), F.lit(buckets)).cast("int"))


def _placed(zone: Zone, keys: Sequence[str], columns: Sequence[str], buckets: int, subs: int) -> DataFrame:
    """Keys and compared columns, bucket and sub-bucket."""
    own = name(zone.bucket) if zone.bucket else F.pmod(_key_hash(keys), F.lit(buckets))
    sub = F.pmod(F.shiftrightunsigned(_key_hash(keys), 20), F.lit(subs))
    wanted = [name(c) for c in dict.fromkeys([*keys, *columns])]
    return zone.rows.select(*wanted, own.cast("int").alias(BUCKET), sub.cast("int").alias(SUB))


def _prints(columns: Sequence[str]) -> tuple[Column, Column]:
    values = [name(c) for c in columns]
    return F.xxhash64(*values), F.xxhash64(F.lit("zf"), *values)


def _sums(first: Column, second: Column, mine: Column | None = None) -> list[Column]:
    """Row count and two checksums that do not depend on the rows' order."""
    if mine is not None:
        first, second = F.when(mine, first), F.when(mine, second)
    total = F.sum(second.cast("decimal(38,0)"))
    return [F.count(first), F.coalesce(F.bit_xor(first), F.lit(0)), F.coalesce(total, F.lit(0))]


def checksums(zone: Zone, keys: Sequence[str], columns: Sequence[str], buckets: int = BUCKETS, subs: int = SUBS) -> DataFrame:
    """One row per sub-bucket: bucket, sub-bucket, rows, bits, total.

    Rows are combined before the shuffle, so that one receives at most
    ``buckets * subs`` rows from a task. The result can be kept beside a zone, and
    checksums of parts added up to those of the whole.
    """
    rows = _placed(zone, keys, columns, buckets, subs)
    n, bits, total = _sums(*_prints(dict.fromkeys([*keys, *columns])))
    return rows.groupBy(BUCKET, SUB).agg(n.alias("rows"), bits.alias("bits"), total.alias("total"))


def differing(raw: DataFrame, access: DataFrame) -> DataFrame:
    """The sub-buckets (bucket, sub-bucket) whose checksums are not the same."""
    signed = raw.withColumn("raw", F.lit(True)).unionByName(access.withColumn("raw", F.lit(False)))
    sides = [F.struct(*[F.max(F.when(mine, F.col(c))).alias(c) for c in ("rows", "bits", "total")]) for mine in (F.col("raw"), ~F.col("raw"))]
    both = signed.groupBy(BUCKET, SUB).agg(*[s.alias(side) for s, side in zip(sides, SIDES)])
    return both.where(~F.col("raw").eqNullSafe(F.col("access"))).select(BUCKET, SUB)


def drill_down(
    raw: Zone,
    access: Zone,
    keys: Sequence[str],
    columns: Sequence[str],
    buckets: int = BUCKETS,
    subs: int = SUBS,
    kept: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """The keys whose rows differ: keys, status, raw_rows, access_rows, columns.

    ``status`` is missing (from the access zone), extra (there only) or changed, and
    ``columns`` lists those of the compared columns that differ. Null keys are keys, and a key
    with several rows differs when they do as a whole. ``kept`` takes checksums
    that were stored for both zones instead of reading them. The driver receives
    the numbers of the buckets that differ.
    """
    require_keys(keys)
    columns = [c for c in dict.fromkeys(columns) if c not in keys]
    known = kept or tuple(checksums(z, keys, columns, buckets, subs) for z in (raw, access))
    found = differing(*known).groupBy(BUCKET).agg(F.collect_list(SUB).alias(SUB)).collect()
    open_ = {r[BUCKET]: r[SUB] for r in found}
    sides = []
    for zone, side in zip((raw, access), SIDES):
        rows = _placed(zone, keys, columns, buckets, subs)
        sides.append(rows.where(_within(open_, buckets, subs)).drop(BUCKET, SUB).withColumn("zf_raw", F.lit(side == "raw")))
    both = sides[0].unionByName(_as_typed(sides[1], sides[0]))
    return _compared(both, keys, columns)


def _as_typed(df: DataFrame, like: DataFrame) -> DataFrame:
    """Columns widened to one type, so that equal values of two types are equal."""
    kinds = {f.name: f.dataType for f in like.schema.fields}
    return df.select(*[name(f.name) if f.dataType == kinds[f.name] else name(f.name).cast(kinds[f.name]).alias(f.name) for f in df.schema.fields])


def _within(open_: dict[int, list[int]], buckets: int, subs: int) -> Column:
    """Rows of the differing sub-buckets: buckets as a list of values, which prunes
    partitions, and the sub-buckets of each as a string of bits."""
    if not open_:
        return F.lit(False)
    held = [set(open_.get(b, ())) for b in range(buckets)]
    bits = F.array(*[F.lit("".join("1" if s in h else "0" for s in range(subs)) if h else "") for h in held])
    mine = F.substr(F.get(bits, F.col(BUCKET)), F.col(SUB) + 1, F.lit(1))
    return F.col(BUCKET).isin(sorted(open_)) & (mine == "1")


def _compared(both: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per key whose rows are not the same on both sides; no join, one shuffle."""
    aggregates, different = [], []
    for side, mine in zip(SIDES, (F.col("zf_raw"), ~F.col("zf_raw"))):
        aggregates.append(F.count_if(mine).alias(f"{side}_rows"))
        for i, group in enumerate([columns, *[[c] for c in columns]]):
            _, bits, total = _sums(*_prints([*keys, *group]), mine)
            aggregates.append(F.struct(bits.alias("bits"), total.alias("total")).alias(f"{side}_{i}"))
    for i, column in enumerate(columns, start=1):
        different.append(F.when(F.col(f"raw_{i}") != F.col(f"access_{i}"), F.lit(column)))
    found = both.groupBy(*[name(k) for k in keys]).agg(*aggregates)
    status = (
        F.when(F.col("access_rows") == 0, MISSING)
        .when(F.col("raw_rows") == 0, EXTRA)
        .when((F.col("raw_rows") != F.col("access_rows")) | (F.col("raw_0") != F.col("access_0")), CHANGED)
    )
    listed = F.array_compact(F.array(*different)) if columns else F.array().cast("array<string>")
    return (
        found.withColumns({"status": status, "columns": F.when(status == CHANGED, listed).otherwise(F.array().cast("array<string>"))})
        .where("status IS NOT NULL")
        .select(*[name(k) for k in keys], "status", "raw_rows", "access_rows", "columns")
    )
