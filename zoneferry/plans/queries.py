"""The registered queries: every operator over the given tables, whole.

Queries that write do so below the shared folder and return what they read
back, so that the sink is part of what is checked.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from zoneferry.operators import drilldown, keyed, loaded, mapping, quality, recon, reports, writes
from zoneferry.operators.quality import Limit
from zoneferry.plans import jobs
from zoneferry.plans.scratch import scratch
from zoneferry.session import fresh_dir, is_single_process, stage
from zoneferry.sources import files, jdbc
from zoneferry.sources.catalog import run_sql

Query = Callable[[SparkSession, str], DataFrame]

RUN_TS = "2024-01-31 06:00:00"
RUN_ID = "run-1"
BATCH_YEAR = 1996

ORDER_COLUMNS = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string"
)

QUERIES: dict[str, Query] = {}


def registered(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(column: str) -> Column:
    """Exact sums: money is added up as a decimal."""
    return F.col(column).cast("decimal(18,2)")


def tags(rule: str) -> recon.Tags:
    return recon.Tags("daily_load", rule, "sales", RUN_TS, RUN_ID)


# --- mapping -----------------------------------------------------------------


@registered
def mapping_view_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    with scratch(spark, "chain") as s:
        for source in ("lineitem", "orders", "customer"):
            s.source(sf_dir, source)
        mapping.view_chain(
            spark,
            {
                "zf_order_lines": """
                    SELECT o_custkey, o_orderkey, o_orderstatus,
                           CAST(l_extendedprice AS DECIMAL(18,2)) AS price
                    FROM {raw}.lineitem JOIN {raw}.orders ON l_orderkey = o_orderkey""",
                "zf_customer_lines": """
                    SELECT o_custkey, count(*) AS n_lines,
                           count_if(o_orderstatus = 'O') AS n_open, sum(price) AS total
                    FROM zf_order_lines GROUP BY o_custkey""",
            },
            names={"raw": s.db},
        )
        return mapping.mapped_view(
            spark,
            """SELECT c_custkey, c_mktsegment, n_lines, n_open,
                      CAST(total AS DOUBLE) AS total_price
               FROM zf_customer_lines JOIN {raw}.customer ON o_custkey = c_custkey""",
            "zf_chain_output",
            names={"raw": s.db},
        )


@registered
def parameterised_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    with scratch(spark, "bound") as s:
        s.source(sf_dir, "orders")
        mapped = run_sql(
            spark,
            """SELECT o_orderkey, o_custkey, o_totalprice, year(o_orderdate) AS batch,
                      :source AS src_sys_abbr
               FROM {raw_db}.orders""",
            names={"raw_db": s.db},
            values={"source": "sales"},
        )
        return mapping.batch_rows(mapped, "batch", BATCH_YEAR)


@registered
def collect_set_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    gathered = mapping.collect_distinct(table(spark, sf_dir, "events"), ["user_id"], "event_type")
    return gathered.select("user_id", F.array_join("event_type", ",").alias("event_types"))


@registered
def payload_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping.pack_payload(table(spark, sf_dir, "orders")).select("o_orderkey", "payload.*")


@registered
def association_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    with scratch(spark, "associations") as s:
        s.source(sf_dir, "events")
        s.sink(
            "activity",
            "crm_object_id bigint, payload struct<associations: array<string>, "
            "n_events: bigint, last_event: timestamp_ntz>",
        )
        jobs.map_zone(
            spark,
            """SELECT e.crm_object_id, a.associations, e.n_events, e.last_event
               FROM (SELECT crm_object_id, count(*) AS n_events, max(ts) AS last_event
                     FROM zf_activity GROUP BY crm_object_id) e
               JOIN mappedAssociationsTable a ON e.crm_object_id = a.crm_object_id""",
            ["INSERT INTO {curated}.activity SELECT * FROM mappedOutputTable"],
            views={
                "zf_activity": "SELECT user_id AS crm_object_id, "
                "event_type AS associations, ts FROM {raw}.events"
            },
            associations=True,
            binding=jobs.Binding({"raw": s.db, "curated": s.db}),
        )
        return s.rows("activity").select(
            "crm_object_id",
            F.array_join("payload.associations", ",").alias("associations"),
            "payload.n_events",
            "payload.last_event",
        )


@registered
def conform_nullable_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    old, new = fresh_dir(spark, "old"), fresh_dir(spark, "new")
    is_old = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    orders.where(is_old).drop("o_orderpriority").write.parquet(old)
    orders.where(~is_old).write.parquet(new)
    declared = T.StructType([T.StructField(f.name, f.dataType, False) for f in orders.schema])
    return files.read_conformed(spark, [old, new], declared)


# --- quality -----------------------------------------------------------------


@registered
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return quality.duplicate_keys(lines, ["l_orderkey", "l_linenumber"], count="n_rows")


@registered
def keys_already_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    numbered = F.col("l_linenumber") + F.lit(3)
    delta = lines.where("l_returnflag = 'R'").select("l_orderkey", numbered.alias("l_linenumber"))
    return loaded.already_loaded(delta, lines, ["l_orderkey", "l_linenumber"])


@registered
def length_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = quality.length_validation(
        table(spark, sf_dir, "lineitem"),
        [
            Limit("l_orderkey", precision=5),
            Limit("l_quantity", precision=4, scale=2),
            Limit("l_extendedprice", precision=7, scale=2),
            Limit("l_discount", precision=2, scale=2),
            Limit("l_returnflag", characters=1),
        ],
    )
    texts = quality.length_validation(
        table(spark, sf_dir, "documents"),
        [
            Limit("text", characters=4_000),
            Limit("source", characters=40),
            Limit("lang", characters=1),
        ],
    )
    return lines.unionByName(texts)


# --- reconciliation ----------------------------------------------------------


def per_customer(orders: DataFrame) -> DataFrame:
    return orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum(money("o_totalprice")).alias("total")
    )


@registered
def recon_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return recon.compare_fields(
        per_customer(orders),
        per_customer(orders.where("o_orderstatus <> 'P'")),
        ["o_custkey"],
        tags("orders_per_customer"),
        [
            ("customer", "r.o_custkey"),
            ("raw_orders", "r.n"),
            ("access_orders", "a.n"),
            ("raw_total", "r.total"),
            ("access_total", "a.total"),
        ],
        unique_raw=True,
        unique_access=True,
    )


@registered
def recon_left_join_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "orderkey")
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "orderkey")
    return recon.compare_fields(
        orders,
        lines,
        ["orderkey"],
        tags("lines_of_order"),
        [
            ("order", "r.orderkey"),
            ("status", "r.o_orderstatus"),
            ("line", "a.l_linenumber"),
            ("price", "CAST(a.l_extendedprice AS DECIMAL(18,2))"),
        ],
    )


@registered
def recon_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return recon.compare_counts(
        orders.agg(F.count(F.lit(1)).alias("access_count")),
        orders.where("o_orderstatus <> 'P'").agg(F.count(F.lit(1)).alias("serving_count")),
        tags("orders_count"),
    )


def per_priority(orders: DataFrame) -> DataFrame:
    return orders.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.max("o_orderdate").alias("latest")
    )


@registered
def recon_single_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recon.record_side(
        per_priority(table(spark, sf_dir, "orders")),
        tags("orders_per_priority"),
        [
            ("priority", "o_orderpriority"),
            ("orders", "n"),
            ("latest", "date_format(latest, 'yyyy-MM-dd')"),
        ],
    )


RECON_COLUMNS = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in recon.RECORD)


@registered
def recon_rule_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = jobs.ReconJob("daily_load", "sales", RUN_TS, RUN_ID)
    with scratch(spark, "rules") as s:
        for source in ("orders", "customer"):
            s.source(sf_dir, source)
        audit = s.sink("audit", RECON_COLUMNS)
        bound = jobs.ReconJob(
            job.job, job.source, job.run_ts, job.run_id, jobs.Binding({"db": s.db})
        )
        failures = jobs.reconcile(
            spark,
            [
                bound.fields_rule(
                    "customer_orders",
                    "SELECT c_custkey AS custkey, c_mktsegment FROM {db}.customer",
                    """SELECT o_custkey AS custkey, count(*) AS n FROM {db}.orders
                       WHERE o_orderstatus = 'F' GROUP BY o_custkey""",
                    ["custkey"],
                    [("customer", "r.custkey"), ("finished", "a.n")],
                    unique_raw=True,
                    unique_access=True,
                ),
                bound.counts_rule(
                    "broken_rule",
                    "SELECT count(no_such_column) FROM {db}.orders",
                    lambda spark: spark.table(f"{s.db}.orders").agg(F.count(F.lit(1))),
                ),
                bound.counts_rule(
                    "order_counts",
                    "SELECT count(*) AS access_count FROM {db}.orders",
                    lambda spark: spark.table(f"{s.db}.orders").agg(F.count(F.lit(1))),
                ),
                bound.side_rule(
                    "priorities",
                    lambda spark: per_priority(spark.table(f"{s.db}.orders")),
                    [("priority", "o_orderpriority"), ("orders", "n")],
                ),
            ],
            audit,
        )
        records = s.rows("audit").select(
            "rule_name", "f1_name", "f1_value", "f2_name", "f2_value", F.lit("").alias("error")
        )
        failed = failures.select(
            "rule_name", *[F.lit("").alias(c) for c in records.columns[1:-1]], "error"
        )
        return records.unionByName(failed)


@registered
def recon_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    with scratch(spark, "json") as s:
        folder = s.path("lines")
        jobs.reconcile(
            spark,
            [recon.Rule("orders_per_customer", lambda spark: recon_left_join(spark, sf_dir))],
            s.sink("audit", RECON_COLUMNS),
            json_folder=folder,
        )
        lines = spark.read.text(f"{folder}/orders_per_customer")
        parsed = lines.select(F.from_json("value", recon.RECORD).alias("record"))
        return parsed.select("record.*")


def drifted(orders: DataFrame) -> DataFrame:
    """A curated copy that has drifted: rows missing, changed, and added."""
    price = F.when(F.col("o_orderkey") % 97 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    status = F.when(F.col("o_orderkey") % 194 == 0, F.lit("X")).otherwise(F.col("o_orderstatus"))
    kept = orders.where("o_orderkey % 89 <> 0").withColumns({"o_totalprice": price, "o_orderstatus": status})
    added = orders.where("o_orderkey % 101 = 0").withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    return kept.unionByName(added)


@registered
def recon_drill_down(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    compared = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    found = drilldown.drill_down(
        drilldown.Zone(orders), drilldown.Zone(drifted(orders)), ["o_orderkey"], compared
    )
    return found.withColumn("columns", F.array_join("columns", ","))


# --- keyed changes -----------------------------------------------------------


def written_keys(keys: DataFrame, fmt: str = "parquet") -> DataFrame:
    """Keys handed over the way two jobs do it: as a written list."""
    path = fresh_dir(keys.sparkSession, "keys")
    reports.export_keys(keys, path, fmt)
    return files.read_keys(keys.sparkSession, path, keys.columns, fmt)


@registered
def delete_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    keys = written_keys(orders.where("o_orderstatus = 'F'").select("o_orderkey"), "csv")
    return keyed.delete_by_keys(orders, keys, ["o_orderkey"], unique_keys=True)


@registered
def delete_by_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    on = ["l_orderkey", "l_linenumber"]
    keys = written_keys(lines.where("l_returnflag = 'R'").select(*on))
    return keyed.delete_by_keys(lines, keys, on, unique_keys=True)


def late_orders(orders: DataFrame) -> DataFrame:
    """Changed rows: late orders at a new price, and as many orders with new keys."""
    late = orders.where(F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz"))
    both = late.withColumn("is_new", F.explode(F.array(F.lit(False), F.lit(True))))
    return both.withColumns(
        {
            "o_orderkey": F.when(F.col("is_new"), -F.col("o_orderkey")).otherwise(F.col("o_orderkey")),
            "o_totalprice": F.col("o_totalprice") * F.when(F.col("is_new"), 1).otherwise(2),
        }
    ).drop("is_new")


@registered
def upsert_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    rows = late_orders(orders)
    keys = written_keys(rows.select("o_orderkey"))
    return keyed.upsert(orders, rows, ["o_orderkey"], keys, unique_keys=True)


@registered
def full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return keyed.refresh(orders, late_orders(orders), "o_orderstatus IN ('F', 'O')")


@registered
def batch_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    batches = table(spark, sf_dir, "orders").withColumn("batch", F.year("o_orderdate"))
    rows = batches.where(F.col("batch") == BATCH_YEAR).withColumn("o_orderstatus", F.lit("R"))
    return keyed.refresh_batch(batches, rows, "batch", BATCH_YEAR)


@registered
def rebuild_changed_unchanged(spark: SparkSession, sf_dir: str) -> DataFrame:
    with scratch(spark, "rebuild") as s:
        s.source(sf_dir, "orders")
        contracts = s.sink("contracts", ORDER_COLUMNS)
        writes.append(spark.table(f"{s.db}.orders"), contracts)
        columns = "o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority"
        due = "o_orderstatus = 'P' AND o_orderdate < TIMESTAMP_NTZ '1998-01-01 00:00:00'"
        path = jobs.rebuild_zone(
            spark,
            f"SELECT {columns}, 'F' AS o_orderstatus FROM {{curated}}.contracts WHERE {due}",
            f"SELECT {columns}, o_orderstatus FROM {{curated}}.contracts WHERE NOT ({due})",
            contracts,
            s.path("versions"),
            RUN_ID,
            jobs.Binding({"curated": s.db}),
        )
        return spark.read.schema(ORDER_COLUMNS).parquet(path)


@registered
def sync_changed_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that change, move to another year, come and go; then the table and the counts."""
    orders = orders_by_year(table(spark, sf_dir, "orders"))
    with scratch(spark, "sync") as s:
        by_year = s.sink("by_year", f"{ORDER_COLUMNS}, o_year int", "o_year")
        writes.overwrite_partitions(orders, by_year)
        counts = jobs.sync_zone(
            spark,
            """SELECT CASE WHEN o_orderkey % 50 = 0 AND o_year = 1997 THEN -o_orderkey ELSE o_orderkey END AS o_orderkey,
                      o_custkey, CASE WHEN o_year = 1996 AND o_orderstatus = 'P' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
                      o_totalprice, o_orderdate, o_orderpriority,
                      CASE WHEN o_orderkey % 1000 = 1 AND o_year = 1996 THEN 1995 ELSE o_year END AS o_year
               FROM {db}.by_year WHERE o_year <> 1993""",
            by_year,
            ["o_orderkey"],
            jobs.Binding({"db": s.db}),
        )
        found = s.rows("by_year").groupBy(F.concat(F.lit("year "), "o_year").alias("part"))
        found = found.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("o_orderkey").alias("keys"))
        listed = spark.createDataFrame([(k, n, 0) for k, n in counts.items()], found.schema)
        return found.unionByName(listed)


@registered
def upsert_zone_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changed rows mapped, their keys exported, deleted and appended in one job."""
    with scratch(spark, "upsert") as s:
        s.source(sf_dir, "orders")
        curated = s.sink("curated", ORDER_COLUMNS)
        writes.append(spark.table(f"{s.db}.orders"), curated)
        jobs.upsert_zone(
            spark,
            """SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
               FROM {db}.orders WHERE o_orderstatus = 'P'
               UNION ALL SELECT -o_orderkey, o_custkey, 'N', o_totalprice, o_orderdate, o_orderpriority
               FROM {db}.orders WHERE o_orderkey % 100 = 3""",
            curated,
            ["o_orderkey"],
            keys_path=s.path("keys"),
            base=s.path("versions"),
            run_id=RUN_ID,
            binding=jobs.Binding({"db": s.db}),
        )
        keys = files.read_keys(spark, s.path("keys"), ["o_orderkey"]).withColumn("exported", F.lit(True))
        state = spark.read.schema(ORDER_COLUMNS).parquet(f"{s.path('versions')}/{RUN_ID}")
        return state.join(keys, "o_orderkey", "left").withColumn("exported", F.coalesce("exported", F.lit(False)))


# --- tables ------------------------------------------------------------------


@registered
def table_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    with scratch(spark, "append") as s:
        s.source(sf_dir, "orders")
        curated = s.sink("curated", ORDER_COLUMNS)
        writes.append(spark.table(f"{s.db}.orders"), curated)
        run_sql(
            spark,
            "INSERT INTO {db}.curated SELECT * FROM {db}.orders WHERE o_orderstatus = :status",
            names={"db": s.db},
            values={"status": "O"},
        )
        return s.rows("curated")


@registered
def fanout_sinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    with scratch(spark, "fanout") as s:
        for source in ("orders", "lineitem"):
            s.source(sf_dir, source)
        columns = "orderkey bigint, n_lines bigint, total double"
        sinks = ("all_orders", "large_orders", "empty_orders")
        for sink in sinks:
            s.sink(sink, columns)
        insert = "INSERT INTO {db}.%s SELECT * FROM mappedOutputTable"
        jobs.map_zone(
            spark,
            """SELECT o_orderkey AS orderkey, coalesce(n_lines, 0) AS n_lines,
                      CAST(total AS DOUBLE) AS total
               FROM {db}.orders LEFT JOIN (
                   SELECT l_orderkey, count(*) AS n_lines,
                          sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS total
                   FROM {db}.lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey""",
            [
                insert % "all_orders",
                insert % "large_orders" + " WHERE n_lines > 5",
                insert % "empty_orders" + " WHERE n_lines = 0",
            ],
            binding=jobs.Binding({"db": s.db}),
        )
        read = [s.rows(sink).withColumn("sink", F.lit(sink)) for sink in sinks]
        return read[0].unionByName(read[1]).unionByName(read[2])


@registered
def routed_sinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    with scratch(spark, "routed") as s:
        conditions = {
            "shipped": "l_linestatus = 'F'",
            "returned": "l_returnflag = 'R'",
            "bulk": "l_quantity > 40",
        }
        columns = "l_orderkey bigint, l_linenumber int, l_quantity double, load int"
        sinks = {s.sink(sink, columns, "load"): condition for sink, condition in conditions.items()}
        writes.route(table(spark, sf_dir, "lineitem"), sinks, {"load": 1}, s.path("routed"))
        read = [spark.table(sink).withColumn("sink", F.lit(sink.rpartition(".")[2])) for sink in sinks]
        return stage(read[0].unionByName(read[1]).unionByName(read[2]), "routed-rows")


@registered
def archive_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    with scratch(spark, "history") as s:
        history = s.sink("history", f"{ORDER_COLUMNS}, snapshot string", "snapshot")
        writes.archive(orders.where("o_orderstatus <> 'P'"), history, "snapshot", "2024-01-30")
        writes.archive(orders, history, "snapshot", "2024-01-31")
        return s.rows("history")


@registered
def conditional_date_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    with scratch(spark, "record") as s:
        s.source(sf_dir, "orders")
        curated = s.sink("curated", ORDER_COLUMNS)
        s.sink("loads", "status string, max_ts timestamp_ntz")
        for status in ("F", "none", "P"):
            jobs.append_zone(
                spark,
                "SELECT * FROM {db}.orders WHERE o_orderstatus = :status",
                curated,
                """INSERT INTO {db}.loads
                   SELECT :status, max(o_orderdate) FROM {db}.curated
                   WHERE o_orderstatus = :status""",
                binding=jobs.Binding({"db": s.db}, {"status": status}),
            )
        loaded = s.rows("curated").groupBy(F.col("o_orderstatus").alias("status")).count()
        return s.rows("loads").join(loaded, "status").withColumnRenamed("count", "n_rows")


def orders_by_year(orders: DataFrame) -> DataFrame:
    return orders.withColumn("o_year", F.year("o_orderdate"))


@registered
def dynamic_partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = orders_by_year(table(spark, sf_dir, "orders"))
    with scratch(spark, "dynamic") as s:
        by_year = s.sink("by_year", f"{ORDER_COLUMNS}, o_year int", "o_year")
        writes.overwrite_partitions(orders, by_year)
        one_year = orders.where(F.col("o_year") == BATCH_YEAR)
        writes.overwrite_partitions(one_year.where("o_orderstatus = 'F'"), by_year)
        return s.rows("by_year")


@registered
def upsert_touched_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = orders_by_year(table(spark, sf_dir, "orders"))
    with scratch(spark, "touched") as s:
        by_year = s.sink("by_year", f"{ORDER_COLUMNS}, o_year int", "o_year")
        writes.overwrite_partitions(orders, by_year)
        rows = orders_by_year(late_orders(table(spark, sf_dir, "orders")))
        writes.upsert_partitions(rows, by_year, ["o_orderkey", "o_year"])
        return s.rows("by_year")


@registered
def partition_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = orders_by_year(table(spark, sf_dir, "orders"))
    with scratch(spark, "repair") as s:
        orders.hint("rebalance", "o_year").write.partitionBy("o_year").parquet(s.path("by_year"))
        by_year = s.sink("by_year", f"{ORDER_COLUMNS}, o_year int", "o_year")
        writes.repair(spark, by_year)
        found = spark.sql(f"SHOW PARTITIONS {by_year}").select(
            F.split("partition", "=")[1].cast("int").alias("o_year")
        )
        rows = s.rows("by_year").groupBy("o_year").agg(F.count(F.lit(1)).alias("n_rows"))
        return found.join(rows, "o_year")


@registered
def batch_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = orders_by_year(table(spark, sf_dir, "orders"))
    with scratch(spark, "batches") as s:
        orders.hint("rebalance", "o_year").write.partitionBy("o_year").parquet(s.path("by_year"))
        by_year = s.sink("by_year", f"{ORDER_COLUMNS}, o_year int", "o_year")
        s.sink("batches", "batch_id string, n_rows bigint, max_ts timestamp_ntz")
        jobs.complete_batch(
            spark,
            by_year,
            """SELECT CAST(o_year AS STRING) AS batch_id, count(*) AS n_rows,
                      max(o_orderdate) AS max_ts
               FROM {raw}.by_year GROUP BY o_year""",
            "INSERT INTO {raw}.batches SELECT * FROM batchOutputTable",
            jobs.Binding({"raw": s.db}),
        )
        return s.rows("batches")


# --- serving database --------------------------------------------------------


def serving_database(spark: SparkSession) -> jdbc.Database:
    """The database the session names, or an embedded one.

    The embedded one lives in the driver's process: it serves a local session
    only. On a cluster set the two ``spark.zoneferry.jdbc`` options.
    """
    url = spark.conf.get("spark.zoneferry.jdbc.url", None)
    if url:
        return jdbc.Database(url, spark.conf.get("spark.zoneferry.jdbc.driver"))
    if not is_single_process(spark):
        raise RuntimeError("executors cannot reach an embedded database: set spark.zoneferry.jdbc.url")
    spark._jvm.java.lang.System.setProperty("derby.stream.error.field", "java.lang.System.err")
    return jdbc.Database(
        "jdbc:derby:memory:zoneferry;create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    )


def serving_table(spark: SparkSession, db: jdbc.Database) -> str:
    """An empty customer table under a new name."""
    created = f"zf_customer_{uuid.uuid4().hex[:12]}"
    jdbc.execute(
        spark,
        db,
        [
            f'CREATE TABLE {created} ("c_custkey" BIGINT, "c_name" VARCHAR(40), '
            '"c_nationkey" INT, "c_acctbal" DOUBLE PRECISION, "c_mktsegment" VARCHAR(20))'
        ],
    )
    return created


@registered
def jdbc_append_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = serving_database(spark)
    serving = serving_table(spark, db)
    jdbc.append(table(spark, sf_dir, "customer"), db, serving)
    return jdbc.scan(spark, db, f"SELECT * FROM {serving}", split_on='"c_custkey"')


@registered
def jdbc_query_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = serving_database(spark)
    serving = serving_table(spark, db)
    customers = table(spark, sf_dir, "customer")
    jdbc.append(customers, db, serving)
    served = jdbc.scan(
        spark, db, f'SELECT count(*) AS "n" FROM {serving} WHERE "c_acctbal" > 0'
    )
    held = customers.agg(F.count(F.lit(1)).alias("n"))
    return recon.compare_counts(held, served, tags("customer_counts"))


@registered
def jdbc_keyed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = serving_database(spark)
    serving = serving_table(spark, db)
    customers = table(spark, sf_dir, "customer")
    jdbc.append(customers, db, serving)
    rows = customers.where("c_acctbal < 0").withColumn("c_acctbal", -F.col("c_acctbal"))
    jdbc.upsert(rows, rows.select("c_custkey"), db, serving)
    return jdbc.scan(spark, db, f"SELECT * FROM {serving}", split_on='"c_custkey"')


@registered
def jdbc_serving_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = serving_database(spark)
    serving = serving_table(spark, db)
    batches = f"{serving}_b"
    jdbc.execute(
        spark, db, [f'CREATE TABLE {batches} ("batch_id" VARCHAR(20), "n_rows" BIGINT)']
    )
    jdbc.append(table(spark, sf_dir, "customer"), db, serving)
    with scratch(spark, "serving") as s:
        s.source(sf_dir, "customer")
        jobs.load_serving(
            spark,
            db,
            jobs.Load(
                """SELECT c_custkey, c_name, c_nationkey, 0.0D AS c_acctbal, c_mktsegment
                   FROM {db}.customer WHERE c_acctbal < 0""",
                serving,
                primary_key=["c_custkey"],
                delete_where='"c_acctbal" < 0',
                batch_sql="""SELECT :batch AS batch_id, count(*) AS n_rows
                             FROM {db}.customer WHERE c_acctbal < 0""",
                batch_table=batches,
                batch_delete_where="\"batch_id\" = 'b1'",
            ),
            jobs.Binding({"db": s.db}, {"batch": "b1"}),
        )
    served = jdbc.scan(spark, db, f"SELECT * FROM {serving}", split_on='"c_custkey"')
    per_segment = served.groupBy(F.col("c_mktsegment").alias("name")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(money("c_acctbal")).cast("double").alias("balance"),
    )
    recorded = jdbc.scan(spark, db, f"SELECT * FROM {batches}")
    return per_segment.unionByName(
        recorded.select(F.col("batch_id").alias("name"), "n_rows", F.lit(0.0).alias("balance"))
    )


@registered
def declared_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers held against the limits that the serving database declares."""
    db = serving_database(spark)
    created = f"ZF_LIMITS_{uuid.uuid4().hex[:12].upper()}"
    jdbc.execute(
        spark,
        db,
        [
            f'CREATE TABLE {created} ("c_custkey" DECIMAL(2,0), "c_name" VARCHAR(40), "c_nationkey" INT, '
            '"c_acctbal" DECIMAL(6,2), "c_mktsegment" VARCHAR(8))'
        ],
    )
    limits = jdbc.declared_columns(spark, db, created)
    return quality.declared_validation(table(spark, sf_dir, "customer"), limits)


@registered
def jdbc_large_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts, in a column type that the database cannot compare, and keys replaced."""
    db = serving_database(spark)
    created = f"zf_customer_{uuid.uuid4().hex[:12]}"
    jdbc.execute(spark, db, [f'CREATE TABLE {created} ("doc_id" BIGINT, "text" CLOB, "lang" VARCHAR(10))'])
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    jdbc.append(docs, db, created)
    rows = docs.where("lang = 'en'").withColumn("text", F.upper(F.substring("text", 1, 50)))
    jdbc.upsert(rows, rows.select("doc_id"), db, created)
    return jdbc.scan(spark, db, f"SELECT * FROM {created}", split_on='"doc_id"')


# --- files -------------------------------------------------------------------


@registered
def changed_key_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    keys = written_keys(lines.where("l_linestatus = 'O'").select("l_orderkey", "l_linenumber"), "csv")
    return keys.select(*[F.col(c).cast("bigint").alias(c) for c in keys.columns])


@registered
def report_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "report")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    reports.write_report(documents, path, order_by=["doc_id"])
    columns = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    return spark.read.schema(columns).options(**reports.REPORT_CSV, multiLine=True).csv(path)


@registered
def report_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_dir(spark, "bundle")
    with scratch(spark, "reports") as s:
        for source in ("orders", "customer"):
            s.source(sf_dir, source)
        entries = jobs.burst_reports(
            spark,
            [
                reports.Report("open_orders.csv", "SELECT * FROM {db}.orders WHERE o_orderstatus = 'O'"),
                reports.Report("no_orders.csv", "SELECT * FROM {db}.orders WHERE o_orderstatus = 'X'"),
                reports.Report(
                    "segments.csv",
                    "SELECT c_mktsegment, count(*) AS n FROM {db}.customer GROUP BY c_mktsegment",
                    order_by=("c_mktsegment",),
                ),
            ],
            folder,
            control_file="control.txt",
            start=F.expr("date_sub(DATE '2024-01-31', 30)"),
            end=F.expr("DATE '2024-01-31'"),
            binding=jobs.Binding({"db": s.db}),
        )
    return entries.withColumn("control_lines", F.lit(spark.read.text(f"{folder}/control.txt").count()))


@registered
def adhoc_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    with scratch(spark, "adhoc") as s:
        s.source(sf_dir, "events")
        path = reports.adhoc_query(
            spark,
            """SELECT user_id, event_type, count(*) AS n_events, max(event_id) AS last_id
               FROM {db}.events GROUP BY user_id, event_type""",
            s.path("results"),
            RUN_ID,
            names={"db": s.db},
        )
    columns = "user_id bigint, event_type string, n_events bigint, last_id bigint"
    return spark.read.schema(columns).csv(path)
