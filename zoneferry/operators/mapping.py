"""Raw to curated shape: view chains, batch filters, packing and collecting."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from zoneferry.functions.columns import name
from zoneferry.operators.joins import require_keys
from zoneferry.session import stage
from zoneferry.sources.catalog import run_sql


def view_chain(
    spark: SparkSession,
    views: Mapping[str, str],
    names: Mapping[str, str] | None = None,
    values: Mapping[str, Any] | None = None,
    stage_views: Collection[str] = (),
) -> DataFrame:
    """Register each query as a view under its own name; returns the last one.

    Later queries may read earlier views. Views are plans, not data: Catalyst
    optimises across the chain. A costly view that several others read can be
    listed in ``stage_views``; it is then computed once and written.
    """
    if not views:
        raise ValueError("a view chain needs at least one query")
    for view, text in views.items():
        df = run_sql(spark, text, names, values)
        if view in stage_views:
            df = stage(df, view)
        df.createOrReplaceTempView(view)
    return df


def mapped_view(
    spark: SparkSession,
    text: str,
    view: str,
    names: Mapping[str, str] | None = None,
    values: Mapping[str, Any] | None = None,
    preview: int = 0,
) -> DataFrame:
    """The mapping query, published as ``view`` for the writes that follow."""
    df = run_sql(spark, text, names, values)
    df.createOrReplaceTempView(view)
    if preview:
        df.show(preview)
    return df


def batch_rows(df: DataFrame, column: str, batch_id: Any | None) -> DataFrame:
    """The rows of one batch, or all rows when no batch is given."""
    return df if batch_id is None else df.where(name(column) == F.lit(batch_id))


def pack_payload(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Keep the first column and pack all others into one struct column."""
    first, *rest = df.columns
    if not rest:
        raise ValueError("nothing to pack: the input has one column")
    if payload in df.columns:
        raise ValueError(f"the input already has a column {payload}")
    return df.select(name(first), F.struct(*[name(c) for c in rest]).alias(payload))


def collect_distinct(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """One sorted array of the distinct non-null values of ``column`` per key.

    Values are made unique before they are gathered, in a step that spreads one
    key over many tasks; only what the array itself will hold meets in one row.
    A key with nulls only gets an empty array.
    """
    require_keys(keys)
    columns = [name(k) for k in keys]
    pairs = df.select(*columns, name(column)).distinct()
    return pairs.groupBy(*columns).agg(F.array_sort(F.collect_list(name(column))).alias(column))
