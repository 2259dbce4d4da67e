"""Joins that keep their parallelism when one key holds a large share of rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from zoneferry.functions.columns import name, quoted

HIT = "zf_hit"
ITEM, SALT, SALTS = "zf_item", "zf_salt", "zf_salts"

#: Rows a key must have before it is split.
HOT_ROWS = 10_000

#: Types of keys whose text is the same exactly where the keys are equal.
_EXACT = (
    T.IntegralType,
    T.StringType,
    T.BooleanType,
    T.DateType,
    T.DecimalType,
    T.TimestampNTZType,
)


def require_keys(keys: Sequence[str]) -> None:
    """Refuse a join or a grouping that names no key: it would pair or merge all rows."""
    if not keys:
        raise ValueError("no key columns given")


def left_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    unique_left: bool = False,
    unique_right: bool = False,
) -> DataFrame:
    """``left r LEFT JOIN right a`` on equal keys; columns stay ``r.*`` and ``a.*``.

    AQE splits hot keys of the left side but not of the right side of an outer
    join. Unless that side is unique by key, its hot keys are found by a sketch over
    its key columns alone; only their rows are dealt by salt, and only the left rows
    of these keys are repeated, once per salt. A hot key is in the right side, so a
    repeated row without a partner is one whose partners have other salts, and goes.
    Rows equal in all columns share a salt. The right side must be the same each
    time it is read. A side said to be unique has one row per key, as after a
    grouping by it.

    Where the text of a key does not stand for the key (floating point, instants,
    sides of different types), the join is made of an inner join, which AQE splits on
    both sides, and the left rows without a match; both sides are then read twice.
    """
    require_keys(keys)
    if unique_right:
        return _plain_join(left, right, keys, "left", split=not unique_left)
    if not _exact(left, right, keys):
        matched = _plain_join(left, right, keys, "inner", split=True)
        nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields]
        missing = anti_join(left, right, keys)
        return matched.union(missing.select(*[name(c) for c in left.columns], *nulls))
    hot = hot_keys(right, keys)
    if hot is None:
        return _plain_join(left, right, keys, "left", split=True)
    ours = left.withColumn(ITEM, _item(keys)).join(hot, ITEM, "left")
    every = F.sequence(F.lit(0), F.coalesce(SALTS, F.lit(1)) - 1)
    ours = ours.withColumn(SALT, F.explode(every)).drop(ITEM)
    dealt = F.pmod(F.xxhash64(*_hashable(right)), F.coalesce(SALTS, F.lit(1))).cast("int")
    theirs = right.withColumn(ITEM, _item(keys)).join(hot, ITEM, "left")
    theirs = theirs.withColumns({SALT: dealt, HIT: F.lit(1)}).drop(ITEM, SALTS)
    joined = _plain_join(ours, theirs, [*keys, SALT], "left", split=True)
    met = F.col(f"r.{SALTS}").isNull() | F.col(f"a.{HIT}").isNotNull()
    return joined.where(met).drop(SALT, SALTS, HIT)


def _exact(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> bool:
    """Whether the keys are of types that ``_item`` tells apart, the same on both sides."""
    kinds = [{f.name.lower(): f.dataType for f in df.schema.fields} for df in (left, right)]
    pairs = [(kinds[0].get(k.lower()), kinds[1].get(k.lower())) for k in keys]
    return all(a == b and isinstance(a, _EXACT) for a, b in pairs)


def _item(keys: Sequence[str]) -> Column:
    """All key columns as one text; a null key is left out of it."""
    return F.to_json(F.struct(*[name(k).cast("string").alias(f"k{i}") for i, k in enumerate(keys)]))


def _hashable(df: DataFrame) -> list[Column]:
    """The columns without maps, which have no hash."""
    return [name(f.name) for f in df.schema.fields if "map<" not in f.dataType.simpleString()]


def hot_keys(df: DataFrame, keys: Sequence[str], least: int = HOT_ROWS) -> DataFrame | None:
    """Keys with more rows than a shuffle partition has on average, and salts for them.

    A key of fewer than ``least`` rows is not worth repeating rows for.

    One pass over the key columns keeps a sketch of the most frequent keys, four
    times as many as there are partitions; its error is below one partition's share, so
    no hot key is missed. There are fewer hot keys than partitions, which bounds what
    the driver receives and broadcasts: the key's text ``ITEM``, and ``SALTS``, which
    deals its rows over as many mean partitions as they fill. None when no key is hot.
    """
    conf = df.sparkSession.conf
    initial = conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    partitions = int(initial or conf.get("spark.sql.shuffle.partitions"))
    tracked = min(max(4 * partitions, 1024), 1_000_000)
    known = F.lit(True)
    for k in keys:
        known = known & name(k).isNotNull()
    items = df.where(known).select(_item(keys).alias(ITEM))
    found = items.agg(
        F.expr(f"approx_top_k({ITEM}, {min(partitions, tracked)}, {tracked})").alias("top"),
        F.count(F.lit(1)).alias("rows"),
    )
    mean = F.greatest(F.col("rows") / partitions, F.lit(least))
    top = found.select(mean.alias("mean"), F.inline("top")).where(F.col("count") > F.col("mean"))
    hot = [(r["item"], math.ceil(r["count"] / r["mean"])) for r in top.collect()]
    if not hot:
        return None
    return F.broadcast(df.sparkSession.createDataFrame(hot, f"{ITEM} string, {SALTS} int"))


def _same_keys(keys: Sequence[str]) -> list[Column]:
    return [F.col(f"r.{quoted(k)}") == F.col(f"a.{quoted(k)}") for k in keys]


def _plain_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, split: bool
) -> DataFrame:
    """The join alone; ``split`` keeps it open to AQE's splitting of hot keys.

    AQE splits only where both inputs are shuffled for the join itself. A side
    grouped or joined by the key would not be; joining on a fingerprint as well
    makes it so.
    """
    same = _same_keys(keys)
    if split:
        prints = [F.xxhash64(*[F.col(f"{side}.{quoted(k)}") for k in keys]) for side in "ra"]
        same.append(prints[0] == prints[1])
    return left.alias("r").join(right.alias("a"), on=same, how=how)


def anti_join(
    left: DataFrame,
    keys: DataFrame,
    on: Sequence[str],
    null_safe: bool | Sequence[str] = False,
    unique_keys: bool = False,
) -> DataFrame:
    """The rows of ``left`` whose key is not in ``keys``.

    A null key never matches unless ``null_safe``, for all columns or those it
    names. The keys are made unique
    before they are joined, unless ``unique_keys`` says that they are: a written
    list of unique keys, small by its file size, is then broadcast and ``left``
    is not shuffled at all.
    """
    require_keys(on)
    unique = keys.select(*[name(k) for k in on]) if unique_keys else _unique_keys(keys, on)
    if not null_safe:
        return left.join(unique, on=list(on), how="left_anti")
    same: Column = F.lit(True)
    safe = set(on) if null_safe is True else set(null_safe)
    for k in on:
        ours, theirs = F.col(f"l.{quoted(k)}"), F.col(f"k.{quoted(k)}")
        same = same & (ours.eqNullSafe(theirs) if k in safe else ours == theirs)
    return left.alias("l").join(unique.alias("k"), on=same, how="left_anti")


def _unique_keys(keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Distinct keys, grouped on a fingerprint beside the key columns.

    The extra grouping column makes the join shuffle the distinct keys itself.
    Only then are both inputs of the join plain shuffles, the form in which AQE
    splits a hot key of the other side.
    """
    columns = [name(k) for k in on]
    return (
        keys.select(*columns)
        .groupBy(*columns, F.xxhash64(*columns).alias("zf_fingerprint"))
        .agg(F.lit(1).alias(HIT))
        .select(*columns)
    )
