"""Files for people and other programs: reports, manifests, key lists, results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from zoneferry.functions.columns import name
from zoneferry.operators.writes import run_statement
from zoneferry.session import setting
from zoneferry.sources.catalog import run_sql
from zoneferry.sources.files import KEY_CSV, key_text

# Inner quotes doubled and blanks kept, so that values read back as they were.
RESULT_CSV = {
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}

# Every value quoted and no header line: files written side by side read as one
# report.
REPORT_CSV = {**RESULT_CSV, "quoteAll": True}

# How much data one report file holds, and the setting that governs it.
FILE_BYTES = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")


@dataclass(frozen=True)
class Report:
    """A query and the name of the directory its report goes to."""

    file_name: str
    sql: str
    order_by: Sequence[str] = ()


def write_report(df: DataFrame, path: str, order_by: Sequence[str] = ()) -> int:
    """Write a CSV report in as few files as its size allows; returns its rows.

    A small report is one file. A large one is several, written in parallel;
    with ``order_by`` their names follow the order of the rows.
    """
    with setting(df.sparkSession, *FILE_BYTES):
        shaped = _ordered(df, order_by) if order_by else df.hint("rebalance")
        seen = Observation()
        counted = shaped.observe(seen, F.count(F.lit(1)).alias("rows"))
        counted.write.mode("overwrite").options(**REPORT_CSV).csv(path)
    return seen.get["rows"]


def _ordered(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """``df`` in order, rows that tie spread over as many sort tasks as they fill.

    Ties go by row and input partition, which are the same when a task reruns.
    """
    tie = df.withColumn("zf_row", F.xxhash64(*[name(c) for c in df.columns])).withColumn(
        "zf_part", F.spark_partition_id()
    )
    return tie.orderBy(*[name(c) for c in order_by], "zf_row", "zf_part").drop("zf_row", "zf_part")


def require_distinct(given: Sequence[str], what: str) -> None:
    """Refuse names that would overwrite each other's output."""
    twice = sorted({n for n in given if given.count(n) > 1})
    if twice:
        raise ValueError(f"repeated {what}: {twice}")


def write_reports(
    spark: SparkSession,
    reports: Sequence[Report],
    folder: str,
    names: Mapping[str, str] | None = None,
    values: Mapping[str, Any] | None = None,
) -> list[tuple[str, int]]:
    """Write each report to ``folder/file_name``; returns names and rows in order."""
    require_distinct([r.file_name for r in reports], "report file names")
    written = []
    for report in reports:
        df = run_sql(spark, report.sql, names, values)
        rows = write_report(df, f"{folder.rstrip('/')}/{report.file_name}", report.order_by)
        written.append((report.file_name, rows))
    return written


def manifest(
    spark: SparkSession, written: Sequence[tuple[str, int]], start: Column, end: Column
) -> DataFrame:
    """One row per report, in order, with the period all of them cover."""
    rows = [(position, *entry) for position, entry in enumerate(written, start=1)]
    return spark.createDataFrame(rows, "position int, report string, rows bigint").select(
        "report", "position", "rows", start.alias("start_date"), end.alias("end_date")
    )


def control_text(entries: DataFrame) -> DataFrame:
    """The manifest as the three lines of a control file."""
    ordered = F.array_sort(F.collect_list(F.struct("position", "report")))
    listed = F.array_join(F.transform(ordered, lambda e: e["report"]), ",")
    # The labels of the control file.
    lines = F.array(
        F.concat(F.lit("file_names: "), listed),
        F.concat(F.lit("strt_date: "), F.max(F.col("start_date").cast("string"))),
        F.concat(F.lit("end_date: "), F.max(F.col("end_date").cast("string"))),
    )
    return entries.agg(F.array_join(lines, "\n").alias("value"))


def export_keys(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write the changed keys, each once. CSV is for readers that need text."""
    keys = df.distinct()
    if fmt == "parquet":
        keys.write.mode("overwrite").parquet(path)
    else:
        lines = keys.select(*[key_text(name(c)).alias(c) for c in keys.columns])
        lines.write.mode("overwrite").options(**KEY_CSV).csv(path)


def adhoc_query(
    spark: SparkSession,
    sql: str,
    folder: str,
    run_id: str,
    names: Mapping[str, str] | None = None,
    values: Mapping[str, Any] | None = None,
) -> str | None:
    """Run a statement and write its result as CSV to ``folder/run_id``.

    Statements without output columns have run by then and write nothing. A
    result that already exists is not overwritten. Returns the path written.
    """
    df = run_statement(spark, sql, names, values)
    if not df.columns:
        return None
    path = f"{folder.rstrip('/')}/{run_id}"
    df.write.mode("errorifexists").options(**RESULT_CSV).csv(path)
    return path
