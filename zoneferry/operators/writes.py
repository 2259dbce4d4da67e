"""Putting rows into tables of the session catalog."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from contextlib import nullcontext
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from zoneferry.functions.columns import as_column, name, quoted
from zoneferry.operators import keyed
from zoneferry.operators.joins import anti_join
from zoneferry.session import delete_path, setting, staged
from zoneferry.sources.catalog import run_sql
from zoneferry.sources.files import conform

MODE = "spark.sql.sources.partitionOverwriteMode"
DYNAMIC = (MODE, "dynamic")
ROWS = "zf_rows"


def run_statement(
    spark: SparkSession,
    sql: str,
    names: Mapping[str, str] | None = None,
    values: Mapping[str, Any] | None = None,
    mode: str = "dynamic",
) -> DataFrame:
    """Run a caller's statement; an INSERT OVERWRITE replaces the partitions it writes.

    With ``mode="static"`` it replaces all that its PARTITION clause covers.
    """
    with setting(spark, MODE, mode):
        return run_sql(spark, sql, names, values)


def table_name(table: str) -> str:
    return ".".join(quoted(part) for part in table.split("."))


def _text(value: str) -> str:
    """A string literal of SQL."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """Count rows in the stage that writes them.

    The count sits directly below the writer: there Spark takes one result per
    task, whatever was retried. Below a shuffle a rerun could count twice.
    """
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def _conformed(df: DataFrame, table: str) -> DataFrame:
    """Columns of ``df`` in the table's order and types, matched by name."""
    return conform(df, df.sparkSession.table(table).schema)


def _by_partition(df: DataFrame, table: str) -> DataFrame:
    """Rows of a partition brought together, so that it gets few files.

    Rebalancing splits a partition that holds much of the data and merges small
    ones, both by size.
    """
    columns = partition_columns(df.sparkSession, table)
    return df.hint("rebalance", *[name(c) for c in columns]) if columns else df


def append(df: DataFrame, table: str, rebalance: bool = True) -> int:
    """Append rows by column name; returns how many were written.

    Rows that all go to one partition, or lie together by partition already,
    need no rebalancing.
    """
    rows = _conformed(df, table)
    rows, seen = _counted(_by_partition(rows, table) if rebalance else rows)
    rows.write.insertInto(table)
    return seen.get["rows"]


def append_with_record(df: DataFrame, table: str, record: str, **binding: Any) -> int:
    """Append rows, then run the record statement unless there were none."""
    rows = append(df, table)
    if rows > 0:
        run_statement(df.sparkSession, record, **binding)
    return rows


def fan_out(
    mapped: DataFrame,
    view: str,
    statements: Sequence[str],
    names: Mapping[str, str] | None = None,
    values: Mapping[str, Any] | None = None,
) -> None:
    """Run write statements in order, all reading ``view``.

    With several statements the mapped rows are computed once and written, and
    the view reads the copy; each statement then scans only what it needs of it.
    """
    spark = mapped.sparkSession
    several = len(statements) > 1
    try:
        with staged(mapped, view) if several else nullcontext(mapped) as rows:
            rows.createOrReplaceTempView(view)
            for statement in statements:
                run_statement(spark, statement, names, values)
    finally:
        mapped.createOrReplaceTempView(view)


SINK = "zf_sink"


def route(
    df: DataFrame, sinks: Mapping[str, Column | str], partition: Mapping[str, Any], base: str
) -> dict[str, int]:
    """Deal rows to several tables in one write, then attach what each one got.

    ``sinks`` names a condition per table; a row goes to every table whose condition
    holds, to none where all are false or null. The tables have the same columns and are
    partitioned by those of ``partition``. The rows are computed once, without a
    shuffle, and written once, below a new directory of ``base``, by table; each table
    then gets its directory as a partition in the catalog, which moves no file. A table that
    has the partition already is refused before anything is written. If attaching fails,
    what was attached is detached again. A table that gets no rows gets no partition.
    Returns the rows of each table.
    """
    spark = df.sparkSession
    tables = list(sinks)
    spec = ", ".join(f"{quoted(c)} = {_literal(v)}" for c, v in partition.items())
    schema = _shared_schema(spark, tables, list(partition))
    for table in tables:
        if not spark.sql(f"SHOW PARTITIONS {table_name(table)} PARTITION ({spec})").isEmpty():
            raise ValueError(f"{table} already holds the partition ({spec})")
    goes = [F.when(as_column(condition), F.lit(i)) for i, condition in enumerate(sinks.values())]
    dealt = df.select("*", F.explode(F.array_compact(F.array(*goes))).alias(SINK))
    rows = conform(dealt, T.StructType([*schema.fields, T.StructField(SINK, T.IntegerType())]))
    seen = Observation()
    counts = [F.count_if(F.col(SINK) == i).alias(f"n{i}") for i in range(len(tables))]
    path = f"{base.rstrip('/')}/route-{uuid.uuid4().hex}"
    rows.observe(seen, *counts).write.partitionBy(SINK).parquet(path)
    taken = {table: seen.get[f"n{i}"] for i, table in enumerate(tables)}
    attached: list[str] = []
    try:
        for i, table in enumerate(tables):
            if taken[table]:
                place = _text(f"{path}/{SINK}={i}")
                spark.sql(f"ALTER TABLE {table_name(table)} ADD PARTITION ({spec}) LOCATION {place}")
                attached.append(table)
    except Exception:
        for table in attached:
            spark.sql(f"ALTER TABLE {table_name(table)} DROP IF EXISTS PARTITION ({spec})")
        raise
    return taken


def _literal(value: Any) -> str:
    return str(value) if isinstance(value, int) else _text(str(value))


def _shared_schema(spark: SparkSession, tables: Sequence[str], partition: Sequence[str]) -> T.StructType:
    """The columns, beside those of the partition, that all tables have alike."""
    shared: T.StructType | None = None
    for table in tables:
        if partition_columns(spark, table) != list(partition):
            raise ValueError(f"{table} is not partitioned by ({', '.join(partition)})")
        fields = [f for f in spark.table(table).schema.fields if f.name not in partition]
        if shared is not None and [(f.name, f.dataType) for f in shared] != [(f.name, f.dataType) for f in fields]:
            raise ValueError(f"{table} has other columns than {tables[0]}")
        shared = T.StructType(fields)
    if shared is None:
        raise ValueError("no tables given")
    return shared


def archive(df: DataFrame, table: str, column: str, snapshot: Any) -> int:
    """Append rows to a history table, marked with their snapshot."""
    marked = df.withColumn(column, F.lit(snapshot))
    return append(marked, table, rebalance=partition_columns(df.sparkSession, table) != [column])


def overwrite_partitions(df: DataFrame, table: str) -> int:
    """Replace the partitions that occur in ``df`` and leave all others."""
    rows, seen = _counted(_by_partition(_conformed(df, table), table))
    with setting(df.sparkSession, *DYNAMIC):
        rows.write.insertInto(table, overwrite=True)
    return seen.get["rows"]


def upsert_partitions(rows: DataFrame, table: str, on: Sequence[str]) -> int:
    """Upsert into a partitioned table, rewriting only the partitions touched.

    The partition columns must be part of the key: a key then lives in one
    partition, and no other partition can hold an old row of it. The rows are
    written once first: the partitions found touched and the partitions replaced
    must come from the same rows.
    """
    spark = rows.sparkSession
    columns = partition_columns(spark, table)
    if not columns or not set(columns) <= set(on):
        raise ValueError(f"the key must contain the partition columns of {table}")
    stored = _conformed(rows, table)
    for c in columns:
        stored = stored.withColumn(c, _stored_value(stored, c))
    with staged(stored, "upsert") as new:
        listed = new.groupBy(*[name(c) for c in columns]).agg(F.count(F.lit(1)).alias(ROWS))
        with staged(listed, "touched") as touched:
            current = _in_partitions(spark.table(table), touched, columns)
            kept = anti_join(current, new, on, null_safe=columns)
            return overwrite_partitions(kept.unionByName(new), table)


def _stored_value(df: DataFrame, column: str) -> Column:
    """A partition value as a directory keeps it: an empty text is stored as null."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return F.nullif(name(column), F.lit(""))
    return name(column)


def _in_partitions(df: DataFrame, touched: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows of ``df`` in the touched partitions, a written list with their rows.

    Known values are joined by plain equality against a filtered list, the form
    that prunes partitions at run time, whatever their number. Partitions with a
    null value are few and form a branch of their own.
    """
    known, unknown = F.lit(True), F.lit(False)
    for c in columns:
        known, unknown = known & name(c).isNotNull(), unknown | name(c).isNull()
    listed = touched.where(F.col(ROWS) >= 1)
    plain = df.where(known).join(
        listed.where(known).select(*[name(c) for c in columns]), on=list(columns), how="left_semi"
    )
    same = F.lit(True)
    for c in columns:
        same = same & F.col(f"l.{quoted(c)}").eqNullSafe(F.col(f"t.{quoted(c)}"))
    nulls = df.where(unknown).alias("l").join(listed.where(unknown).alias("t"), on=same, how="left_semi")
    return plain.select(*[name(c) for c in df.columns]).unionByName(nulls)


def sync_partitions(state: DataFrame, table: str, on: Sequence[str]) -> dict[str, int]:
    """Bring a partitioned table to a new state; only partitions with a change are rewritten.

    One full outer join of keys and row fingerprints tells new, changed, same and gone
    rows. A changed row may move to another partition: both are rewritten.
    Partitions that no row is left in are dropped. Key and state have one row per key.
    Returns the number of rows of each class.
    """
    spark = state.sparkSession
    columns = partition_columns(spark, table)
    if not columns:
        raise ValueError(f"{table} has no partitions")
    stored = _conformed(state, table)
    for c in columns:
        stored = stored.withColumn(c, _stored_value(stored, c))
    with staged(stored, "state") as new:
        both = keyed.change_classes(spark.table(table), new, on, columns)
        pruned = both.groupBy("class", "before", "after").agg(F.count(F.lit(1)).alias(ROWS))
        with staged(pruned, "classes") as classes:
            counts = {r["class"]: r[ROWS] for r in classes.groupBy("class").agg(F.sum(ROWS).alias(ROWS)).collect()}
            moved = classes.where(F.col("class") != keyed.SAME)
            values = [F.col(f"side.{quoted(c)}") for c in columns]
            ends = moved.select("before", "after", F.explode(F.array("before", "after")).alias("side"))
            listed = ends.where(F.col("side").isNotNull()).groupBy(*values).agg(F.count(F.lit(1)).alias(ROWS))
            with staged(listed, "touched") as touched:
                if not touched.isEmpty():
                    overwrite_partitions(_in_partitions(new, touched, columns), table)
                _drop_partitions(spark, table, _emptied(classes, columns), columns)
    return {kind: counts.get(kind, 0) for kind in (keyed.NEW, keyed.CHANGED, keyed.SAME, keyed.GONE)}


def _emptied(classes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The partitions that rows left and that no row of the new state is in."""
    old, new = (F.struct(F.lit(now).alias("now"), F.col(c).alias("at")) for now, c in ((False, "before"), (True, "after")))
    sides = F.explode(F.array(old, new))
    ends = classes.select(sides.alias("end")).where(F.col("end.at").isNotNull())
    values = [F.col(f"end.at.{quoted(c)}") for c in columns]
    return ends.groupBy(*values).agg(F.max("end.now").alias("now")).where(~F.col("now")).drop("now")


def _drop_partitions(spark: SparkSession, table: str, gone: DataFrame, columns: Sequence[str]) -> None:
    """Drop partitions from the catalog and their directories."""
    kinds = {f.name: f.dataType for f in gone.schema.fields}
    for row in gone.collect():
        spec = ", ".join(
            f"{quoted(c)} = {'null' if row[c] is None else _partition_literal(row[c], kinds[c])}" for c in columns
        )
        path = spark.sql(f"DESCRIBE TABLE EXTENDED {table_name(table)} PARTITION ({spec})")
        path = path.where("col_name = 'Location'").first()["data_type"]
        spark.sql(f"ALTER TABLE {table_name(table)} DROP IF EXISTS PARTITION ({spec})")
        delete_path(spark, path)


def _partition_literal(value: Any, kind: T.DataType) -> str:
    if isinstance(kind, T.StringType):
        return _text(value)
    return _text(str(value)) if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)) else str(value)


def replace_table(df: DataFrame, table: str, base: str, run_id: str) -> str:
    """Write the new content to ``base/run_id`` and make it the table.

    Readers see the old files until the catalog changes, also when the write
    fails, and ``df`` may read the table it replaces. A failed run can be
    repeated under its id; one that succeeded cannot. The name of a partitioned
    table is absent for a moment; ``restore`` mends a run that ended just then.
    Returns the directory.
    """
    spark = df.sparkSession
    restore(spark, table)
    path = f"{base.rstrip('/')}/{run_id}"
    if location(spark, table).endswith(f"/{run_id}"):
        raise ValueError(f"{table} already holds run {run_id}")
    columns = partition_columns(spark, table)
    rows = _by_partition(_conformed(df, table), table)
    rows.write.mode("overwrite").partitionBy(*columns).parquet(path)
    if columns:
        _swap_partitioned(spark, table, path, run_id)
    else:
        spark.sql(f"ALTER TABLE {table_name(table)} SET LOCATION {_text(path)}")
    spark.catalog.refreshTable(table)
    return path


def _swap_partitioned(spark: SparkSession, table: str, path: str, run_id: str) -> None:
    """Swap in a table over ``path``, its partitions found before the swap.

    Partitions carry locations of their own, so moving the table's location
    would leave them behind.
    """
    if spark.catalog.getTable(table).tableType != "EXTERNAL":
        raise ValueError(f"{table} must be external: a managed table moves when renamed")
    suffix = re.sub(r"\W", "_", run_id)
    new, old = f"{table}_zf_new_{suffix}", f"{table}_zf_old_{suffix}"
    spark.sql(f"DROP TABLE IF EXISTS {table_name(new)}")
    spark.sql(f"CREATE TABLE {table_name(new)} LIKE {table_name(table)} LOCATION {_text(path)}")
    repair(spark, new)
    spark.sql(f"ALTER TABLE {table_name(table)} RENAME TO {table_name(old)}")
    spark.sql(f"ALTER TABLE {table_name(new)} RENAME TO {table_name(table)}")
    spark.sql(f"DROP TABLE {table_name(old)}")


def restore(spark: SparkSession, table: str) -> None:
    """Undo a swap that broke off between its renames, or clean up after one.

    The old table gets its name back if no table bears it, and leaves the catalog
    otherwise. Files stay. Must not run beside a swap of the same table.
    """
    database, dot, short = table.rpartition(".")
    prefix = f"{short}_zf_old_".lower()
    inside = f" IN {table_name(database)}" if dot else ""
    for row in spark.sql(f"SHOW TABLES{inside} LIKE {_text(prefix + '*')}").collect():
        old = f"{database}{dot}{row.tableName}"
        if row.isTemporary or not row.tableName.lower().startswith(prefix):
            continue
        if spark.catalog.tableExists(table):
            spark.sql(f"DROP TABLE {table_name(old)}")
        else:
            spark.sql(f"ALTER TABLE {table_name(old)} RENAME TO {table_name(table)}")


def location(spark: SparkSession, table: str) -> str:
    """The directory a table reads."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table_name(table)}")
    return rows.where("col_name = 'Location'").first()["data_type"]


def repair(spark: SparkSession, table: str) -> None:
    """Add partitions that exist as directories but not in the catalog."""
    spark.sql(f"MSCK REPAIR TABLE {table_name(table)}")


def batch_record(df: DataFrame, batch: str, latest: str) -> DataFrame:
    """One row per batch: its rows and its latest time."""
    return df.groupBy(name(batch).cast("string").alias("batch_id")).agg(
        F.count(F.lit(1)).alias("rows"), F.max(name(latest)).alias("max_ts")
    )
