"""Where intermediate and versioned data lives.

Everything a job hands from one step to the next is a written table in a
folder every executor can reach, so a lost executor costs a task retry and
nothing else.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from zoneferry.functions.columns import name

CHECKPOINT_DIR = "spark.checkpoint.dir"

_local_base: str | None = None


def is_single_process(spark: SparkSession) -> bool:
    """Whether driver and executors are one process."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a single-machine session that names none gets a temporary folder; on a
    cluster a missing setting is an error, because executors cannot see each
    other's disks.
    """
    global _local_base
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        return named.rstrip("/")
    if not is_single_process(spark):
        raise RuntimeError(f"{CHECKPOINT_DIR} must name a folder all executors share")
    if _local_base is None:
        _local_base = tempfile.mkdtemp(prefix="zoneferry-")
    return _local_base


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing has used yet.

    One application's paths lie together, so that they can be removed together.
    """
    run = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/zoneferry/{run}/{label}-{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a path through the Hadoop file system it belongs to."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsc.hadoopConfiguration()
    hadoop_path.getFileSystem(conf).delete(hadoop_path, True)


def remove_scratch(spark: SparkSession) -> None:
    """Remove all paths of this application below the shared folder.

    For when every result has been consumed: results that are not written
    elsewhere still read their staged copies.
    """
    delete_path(spark, f"{shared_dir(spark)}/zoneferry/{spark.sparkContext.applicationId}")


def _write_copy(df: DataFrame, label: str) -> tuple[str, DataFrame]:
    """Write ``df`` below the shared folder; returns the path and the copy.

    A column of untyped nulls cannot be stored and becomes text.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    for field in df.schema.fields:
        if isinstance(field.dataType, T.NullType):
            df = df.withColumn(field.name, name(field.name).cast("string"))
    df.write.parquet(path)
    return path, spark.read.schema(df.schema).parquet(path)


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once and return the written copy.

    Cuts the lineage, lets several consumers share one computation and, unlike
    a cached DataFrame, is not lost with an executor.
    """
    return _write_copy(df, label)[1]


@contextmanager
def staged(df: DataFrame, label: str = "stage") -> Iterator[DataFrame]:
    """``stage`` for a copy that is only needed inside the ``with`` block."""
    path, copy = _write_copy(df, label)
    try:
        yield copy
    finally:
        delete_path(df.sparkSession, path)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Set a SQL configuration for the block and put the old value back."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
