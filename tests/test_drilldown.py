"""Drilling down to differing rows: whole results, and equal buckets left unread."""

import random
import re

import pytest
from pyspark.sql import functions as F

from zoneferry.operators import drilldown
from zoneferry.operators.drilldown import Zone, drill_down


def plain(raw, access, n_keys):
    """Keys whose rows differ, with the columns that do."""
    out = []
    for key in {r[:n_keys] for r in raw + access}:
        ours, theirs = ([r for r in side if r[:n_keys] == key] for side in (raw, access))
        if sorted(ours, key=repr) == sorted(theirs, key=repr):
            continue
        status = "missing" if not theirs else "extra" if not ours else "changed"
        columns = []
        if status == "changed":
            names = ["v", "w"]
            columns = [c for i, c in enumerate(names, n_keys) if sorted((r[i] for r in ours), key=repr) != sorted((r[i] for r in theirs), key=repr)]
        out.append((*key, status, len(ours), len(theirs), columns))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("buckets, subs", [(1, 1), (4, 8), (256, 256)])
def test_equals_the_plain_comparison(spark, seed, buckets, subs):
    chance = random.Random(seed)

    def row():
        return (chance.choice([None, *range(30)]), chance.choice([None, "", "a"]), chance.choice([None, 1.5, -0.5]), chance.choice([None, "x", "y"]))

    raw = [row() for _ in range(120)]
    access = [r for r in raw if chance.random() > 0.1] + [row() for _ in range(8)]
    access = [(*r[:3], "z") if chance.random() < 0.1 else r for r in access]
    schema = "k int, t string, v double, w string"
    zones = [Zone(spark.createDataFrame(rows, schema)) for rows in (raw, access)]
    got = drill_down(*zones, ["k", "t"], ["v", "w"], buckets, subs)
    assert sorted(map(tuple, got.collect()), key=repr) == plain(raw, access, 2)


def test_equal_and_empty_zones(spark):
    df = spark.range(50).withColumn("v", F.col("id") % 3)
    assert drill_down(Zone(df), Zone(df.repartition(5)), ["id"], ["v"]).count() == 0
    empty = drill_down(Zone(df), Zone(df.limit(0)), ["id"], ["v"])
    assert {(r.status, r.raw_rows, r.access_rows) for r in empty.collect()} == {("missing", 1, 0)} and empty.count() == 50
    assert drill_down(Zone(df.limit(0)), Zone(df.limit(0)), ["id"], ["v"]).count() == 0
    with pytest.raises(ValueError):
        drill_down(Zone(df), Zone(df), [], ["v"])


def test_only_differing_partitions_are_read(spark, tmp_path):
    """Two of many buckets differ; the scans of the rows list these alone."""
    raw = spark.range(4_000).withColumn("v", F.col("id") % 7)
    access = raw.withColumn("v", F.when(F.col("id").isin(17, 2_900), -1).otherwise(F.col("v")))
    zones = []
    for label, df in (("raw", raw), ("access", access)):
        drilldown.with_bucket(df, ["id"], 64).write.partitionBy(drilldown.BUCKET).parquet(str(tmp_path / label))
        zones.append(Zone(spark.read.parquet(str(tmp_path / label)), drilldown.BUCKET))
    found = drill_down(*zones, ["id"], ["v"], buckets=64)
    assert sorted(map(tuple, found.collect())) == [(17, "changed", 1, 1, ["v"]), (2900, "changed", 1, 1, ["v"])]
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    touched = drilldown.with_bucket(raw, ["id"], 64).where("id IN (17, 2900)").select(drilldown.BUCKET).distinct()
    listed = ",".join(str(r[0]) for r in touched.orderBy(drilldown.BUCKET).collect())
    assert len(re.findall(rf"PartitionFilters: \[[^]]*IN \({listed}\)", plan)) == 2


def test_kept_checksums_spare_the_first_pass(spark):
    raw = spark.range(1_000).withColumn("v", F.col("id") % 7)
    parts = [drilldown.checksums(Zone(raw.where(c)), ["id"], ["v"]) for c in ("id < 400", "id >= 400")]
    whole = parts[0].unionByName(parts[1]).groupBy(drilldown.BUCKET, drilldown.SUB)
    whole = whole.agg(F.sum("rows").alias("rows"), F.bit_xor("bits").alias("bits"), F.sum("total").cast("decimal(38,0)").alias("total"))
    assert drilldown.differing(whole, drilldown.checksums(Zone(raw), ["id"], ["v"])).isEmpty()
    changed = raw.withColumn("v", F.when(F.col("id") == 3, 9).otherwise(F.col("v")))
    kept = (whole, drilldown.checksums(Zone(changed), ["id"], ["v"]))
    found = drill_down(Zone(raw), Zone(changed), ["id"], ["v"], kept=kept)
    assert [r.id for r in found.collect()] == [3]
