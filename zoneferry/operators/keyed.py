"""Deletes, upserts, refreshes and rebuilds as DataFrame algebra.

Each function returns the table as it is to be; ``writes`` puts it in place.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from zoneferry.functions.columns import name, quoted, where_not
from zoneferry.operators.joins import anti_join, require_keys
from zoneferry.sources.files import conform


def typed_keys(keys: DataFrame, target: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keys cast to the types the target gives them, so that text keys match."""
    kinds = {f.name: f.dataType for f in target.schema.fields}
    return keys.select(*[name(c).cast(kinds[c]).alias(c) for c in on])


def delete_by_keys(
    target: DataFrame,
    keys: DataFrame,
    on: Sequence[str],
    null_safe: bool = False,
    unique_keys: bool = False,
) -> DataFrame:
    """The target without the rows whose key is listed. No keys, no deletes."""
    return anti_join(target, typed_keys(keys, target, on), on, null_safe, unique_keys)


def upsert(
    target: DataFrame,
    rows: DataFrame,
    on: Sequence[str],
    keys: DataFrame | None = None,
    null_safe: bool = False,
    unique_keys: bool = False,
) -> DataFrame:
    """Delete the changed keys from the target, then add the rows.

    The keys are those of the rows unless a list of changed keys is given. All
    rows are added, also several for one key; gate them with ``require_unique``
    where that must not happen. Rows that are costly, or not the same each time
    they are computed, should be staged first: they are read twice.
    """
    changed = rows if keys is None else keys
    kept = delete_by_keys(target, changed, on, null_safe, unique_keys)
    return kept.unionByName(conform(rows, target.schema))


def refresh(
    target: DataFrame, rows: DataFrame, delete_where: Column | str | None = None
) -> DataFrame:
    """Delete what ``delete_where`` selects, or everything, and add the rows."""
    new = conform(rows, target.schema)
    if delete_where is None:
        return new
    return target.where(where_not(delete_where)).unionByName(new)


def refresh_batch(target: DataFrame, rows: DataFrame, batch: str, batch_id: Any) -> DataFrame:
    """Replace the rows of one batch."""
    return refresh(target, rows, name(batch) == F.lit(batch_id))


def rebuild(changed: DataFrame, unchanged: DataFrame) -> DataFrame:
    """One table from its changed and its unchanged rows, matched by column name."""
    return changed.unionByName(unchanged)


NEW, CHANGED, SAME, GONE = "new", "changed", "same", "gone"


def fingerprint(df: DataFrame, columns: Sequence[str]) -> Column:
    """128 bits of a row's columns; equal for equal rows."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    values = [F.to_json(name(c)) if "map<" in kinds[c].simpleString() else name(c) for c in columns]
    return F.struct(F.xxhash64(*values).alias("a"), F.xxhash64(F.lit("zf"), *values).alias("b"))


def change_classes(
    current: DataFrame, state: DataFrame, on: Sequence[str], carry: Sequence[str] = ()
) -> DataFrame:
    """Every key of either side with its class: keys, ``class``, and ``carry`` of both sides.

    A key is new, changed, the same or gone in ``state`` against ``current``, by a
    fingerprint of all columns of ``current``. Only keys, fingerprints and the carried
    columns, as structs ``before`` and ``after``, are joined. Null keys match each
    other. Both sides have one row per key.
    """
    require_keys(on)
    state = conform(state, current.schema)
    sides = []
    for df, side in ((current, "before"), (state, "after")):
        held = F.struct(F.lit(True).alias("zf_held"), *[name(c) for c in carry])
        print_ = fingerprint(df, current.columns).alias(f"{side}_print")
        sides.append(df.select(*[name(k) for k in on], held.alias(side), print_).alias(side[0]))
    same: Column = F.lit(True)
    for k in on:
        same = same & F.col(f"b.{quoted(k)}").eqNullSafe(F.col(f"a.{quoted(k)}"))
    joined = sides[0].join(sides[1], on=same, how="full_outer")
    found = (
        F.when(F.col("before").isNull(), NEW)
        .when(F.col("after").isNull(), GONE)
        .when(F.col("before_print") == F.col("after_print"), SAME)
        .otherwise(CHANGED)
    )
    keys = []
    for k in on:
        ours, theirs = F.col(f"a.{quoted(k)}"), F.col(f"b.{quoted(k)}")
        keys.append(F.when(F.col("after").isNull(), theirs).otherwise(ours).alias(k))
    return joined.select(*keys, found.alias("class"), "before", "after")
