"""Catalog tables for one run, all of them below a fresh shared directory."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from zoneferry.session import fresh_dir


@dataclass(frozen=True)
class Scratch:
    """A database whose tables are external, so their files outlive it."""

    spark: SparkSession
    db: str
    root: str

    def source(self, sf_dir: str, table: str) -> str:
        """One of the given tables, in the catalog."""
        path = f"{sf_dir}/{table}.parquet"
        return self._create(table, f"USING parquet LOCATION '{path}'")

    def sink(self, table: str, columns: str, partitioned_by: str = "") -> str:
        """An empty table to write to."""
        parts = f"PARTITIONED BY ({partitioned_by})" if partitioned_by else ""
        return self._create(
            table, f"({columns}) USING parquet {parts} LOCATION '{self.path(table)}'"
        )

    def _create(self, table: str, definition: str) -> str:
        self.spark.sql(f"CREATE TABLE {self.db}.{table} {definition}")
        return f"{self.db}.{table}"

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def rows(self, table: str) -> DataFrame:
        """What the files of a sink hold, independent of the catalog entry."""
        schema = self.spark.table(f"{self.db}.{table}").schema
        return self.spark.read.schema(schema).parquet(self.path(table))


@contextmanager
def scratch(spark: SparkSession, label: str) -> Iterator[Scratch]:
    db = f"zf_{uuid.uuid4().hex[:12]}"
    root = fresh_dir(spark, label)
    spark.sql(f"CREATE DATABASE {db} LOCATION '{root}/db'")
    try:
        yield Scratch(spark, db, root)
    finally:
        spark.sql(f"DROP DATABASE {db} CASCADE")
