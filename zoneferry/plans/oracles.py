"""The registered queries once more, as SQL over the given tables for DuckDB."""

from __future__ import annotations

TAGS = "'daily_load' AS job_name, '{rule}' AS rule_name, 'sales' AS src_sys_abbr"
RUN = "TIMESTAMP '2024-01-31 06:00:00' AS recon_ts, 'run-1' AS run_id"

LATE = "o_orderdate >= TIMESTAMP '2000-01-01'"
ORDERS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
LATE_ROWS = f"""
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice * 2 AS o_totalprice,
           o_orderdate, o_orderpriority FROM orders WHERE {LATE}
    UNION ALL
    SELECT -o_orderkey, o_custkey, o_orderstatus, o_totalprice,
           o_orderdate, o_orderpriority FROM orders WHERE {LATE}
"""


def record(rule: str, source: str, *fields: tuple[str, str]) -> str:
    """An audit record: its fields as text, blanks in the slots left over."""
    filled = [*fields, *[("", "''")] * (5 - len(fields))]
    slots = ", ".join(
        f"'{label}' AS f{i}_name, CAST({value} AS VARCHAR) AS f{i}_value"
        for i, (label, value) in enumerate(filled, start=1)
    )
    return f"SELECT {TAGS.format(rule=rule)}, {slots}, {RUN} FROM {source}"


def longest_digits(table: str, column: str, scale: int, allowed: int) -> str:
    text = f"CAST(abs(CAST({column} AS DECIMAL(38,{scale}))) AS VARCHAR)"
    measured = f"max(length(replace(ltrim({text}, '0'), '.', '')))"
    return _limit(table, column, measured, allowed)


def longest_text(table: str, column: str, allowed: int) -> str:
    return _limit(table, column, f"max(length({column}))", allowed)


def _limit(table: str, column: str, measured: str, allowed: int) -> str:
    return (
        f"SELECT '{column}' AS column_name, CAST({allowed} AS BIGINT) AS allowed, "
        f"CAST({measured} AS BIGINT) AS measured, {measured} <= {allowed} AS valid FROM {table}"
    )


NOT_PENDING = "WHERE o_orderstatus <> 'P'"
PER_CUSTOMER = (
    "SELECT o_custkey, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total "
    "FROM orders {where} GROUP BY o_custkey"
)

LEFT_JOIN = record(
    "orders_per_customer",
    f"({PER_CUSTOMER.format(where='')}) r LEFT JOIN "
    f"({PER_CUSTOMER.format(where=NOT_PENDING)}) a "
    "ON r.o_custkey = a.o_custkey",
    ("customer", "r.o_custkey"),
    ("raw_orders", "r.n"),
    ("access_orders", "a.n"),
    ("raw_total", "r.total"),
    ("access_total", "a.total"),
)

ORACLES: dict[str, str] = {
    "mapping_view_chain": """
        WITH order_lines AS (
            SELECT o_custkey, o_orderstatus, CAST(l_extendedprice AS DECIMAL(18,2)) AS price
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
        customer_lines AS (
            SELECT o_custkey, count(*) AS n_lines,
                   count(*) FILTER (WHERE o_orderstatus = 'O') AS n_open, sum(price) AS total
            FROM order_lines GROUP BY o_custkey)
        SELECT c_custkey, c_mktsegment, n_lines, n_open, CAST(total AS DOUBLE) AS total_price
        FROM customer_lines JOIN customer ON o_custkey = c_custkey""",
    "parameterised_mapping": """
        SELECT o_orderkey, o_custkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS batch,
               'sales' AS src_sys_abbr
        FROM orders WHERE year(o_orderdate) = 1996""",
    "collect_set_by_key": """
        SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS event_types
        FROM events GROUP BY user_id""",
    "payload_struct": f"SELECT {ORDERS} FROM orders",
    "association_payload": """
        SELECT user_id AS crm_object_id,
               string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS associations,
               count(*) AS n_events, max(ts) AS last_event
        FROM events GROUP BY user_id""",
    "conform_nullable_schema": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
               CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_orderpriority END
                   AS o_orderpriority
        FROM orders""",
    "duplicate_keys": """
        SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "keys_already_loaded": """
        WITH delta AS (
            SELECT l_orderkey, l_linenumber + 3 AS l_linenumber, count(*) AS rows
            FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL),
        held AS (SELECT l_orderkey, l_linenumber, count(*) AS loaded FROM lineitem GROUP BY ALL)
        SELECT l_orderkey, l_linenumber, rows, loaded
        FROM delta JOIN held USING (l_orderkey, l_linenumber)""",
    "length_validation": " UNION ALL ".join(
        [
            longest_digits("lineitem", "l_orderkey", 0, 5),
            longest_digits("lineitem", "l_quantity", 2, 4),
            longest_digits("lineitem", "l_extendedprice", 2, 7),
            longest_digits("lineitem", "l_discount", 2, 2),
            longest_text("lineitem", "l_returnflag", 1),
            longest_text("documents", "text", 4000),
            longest_text("documents", "source", 40),
            longest_text("documents", "lang", 1),
        ]
    ),
    "recon_drill_down": """
        WITH access AS (
            SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 194 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
                   CASE WHEN o_orderkey % 97 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
                   o_orderdate, o_orderpriority
            FROM orders WHERE o_orderkey % 89 <> 0
            UNION ALL
            SELECT -o_orderkey - 1, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
            FROM orders WHERE o_orderkey % 101 = 0)
        SELECT coalesce(r.o_orderkey, a.o_orderkey) AS o_orderkey,
               CASE WHEN a.o_orderkey IS NULL THEN 'missing' WHEN r.o_orderkey IS NULL THEN 'extra' ELSE 'changed' END AS status,
               CAST(r.o_orderkey IS NOT NULL AS BIGINT) AS raw_rows, CAST(a.o_orderkey IS NOT NULL AS BIGINT) AS access_rows,
               CASE WHEN r.o_orderkey IS NULL OR a.o_orderkey IS NULL THEN '' ELSE concat_ws(',',
                   CASE WHEN r.o_orderstatus <> a.o_orderstatus THEN 'o_orderstatus' END,
                   CASE WHEN r.o_totalprice <> a.o_totalprice THEN 'o_totalprice' END) END AS columns
        FROM orders r FULL JOIN access a ON r.o_orderkey = a.o_orderkey
        WHERE r.o_orderkey IS NULL OR a.o_orderkey IS NULL
           OR r.o_orderstatus <> a.o_orderstatus OR r.o_totalprice <> a.o_totalprice""",
    "sync_changed_partitions": """
        WITH before AS (SELECT *, year(o_orderdate) AS y FROM orders),
        after AS (
            SELECT CASE WHEN o_orderkey % 50 = 0 AND y = 1997 THEN -o_orderkey ELSE o_orderkey END AS k, o_orderkey,
                   CASE WHEN y = 1996 AND o_orderstatus = 'P' THEN 'F' ELSE o_orderstatus END AS s, o_orderstatus, y,
                   CASE WHEN o_orderkey % 1000 = 1 AND y = 1996 THEN 1995 ELSE y END AS part
            FROM before WHERE y <> 1993),
        counts AS (
            SELECT count(*) FILTER (WHERE k <> o_orderkey) AS added,
                   count(*) FILTER (WHERE k = o_orderkey AND (s <> o_orderstatus OR part <> y)) AS changed,
                   count(*) FILTER (WHERE k = o_orderkey AND s = o_orderstatus AND part = y) AS same FROM after)
        SELECT 'year ' || part AS part, count(*) AS n_rows, CAST(sum(k) AS BIGINT) AS keys FROM after GROUP BY 1
        UNION ALL SELECT 'new', added, 0 FROM counts
        UNION ALL SELECT 'changed', changed, 0 FROM counts
        UNION ALL SELECT 'same', same, 0 FROM counts
        UNION ALL SELECT 'gone', (SELECT count(*) FROM before) - changed - same, 0 FROM counts""",
    "upsert_zone_job": f"""
        SELECT {ORDERS}, false AS exported FROM orders WHERE o_orderstatus <> 'P'
        UNION ALL SELECT o_orderkey, o_custkey, 'U', o_totalprice, o_orderdate, o_orderpriority, true
        FROM orders WHERE o_orderstatus = 'P'
        UNION ALL SELECT -o_orderkey, o_custkey, 'N', o_totalprice, o_orderdate, o_orderpriority, true
        FROM orders WHERE o_orderkey % 100 = 3""",
    "recon_left_join": LEFT_JOIN,
    "recon_json": LEFT_JOIN,
    "recon_left_join_rows": record(
        "lines_of_order",
        "orders r LEFT JOIN lineitem a ON r.o_orderkey = a.l_orderkey",
        ("order", "r.o_orderkey"),
        ("status", "r.o_orderstatus"),
        ("line", "a.l_linenumber"),
        ("price", "CAST(a.l_extendedprice AS DECIMAL(18,2))"),
    ),
    "recon_counts": record(
        "orders_count",
        "(SELECT count(*) AS n, count(*) FILTER (WHERE o_orderstatus <> 'P') AS m FROM orders)",
        ("access_count", "n"),
        ("serving_count", "m"),
        ("difference", "n - m"),
    ),
    "recon_single_side": record(
        "orders_per_priority",
        "(SELECT o_orderpriority, count(*) AS n, max(o_orderdate) AS latest FROM orders "
        "GROUP BY o_orderpriority)",
        ("priority", "o_orderpriority"),
        ("orders", "n"),
        ("latest", "strftime(latest, '%Y-%m-%d')"),
    ),
    "recon_rule_set": """
        SELECT 'customer_orders' AS rule_name, 'customer' AS f1_name,
               CAST(c_custkey AS VARCHAR) AS f1_value, 'finished' AS f2_name,
               CAST(n AS VARCHAR) AS f2_value, '' AS error
        FROM customer LEFT JOIN (
            SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'F'
            GROUP BY o_custkey) ON c_custkey = o_custkey
        UNION ALL
        SELECT 'order_counts', 'access_count', CAST(count(*) AS VARCHAR), 'serving_count',
               CAST(count(*) AS VARCHAR), '' FROM orders
        UNION ALL
        SELECT 'priorities', 'priority', o_orderpriority, 'orders', CAST(count(*) AS VARCHAR), ''
        FROM orders GROUP BY o_orderpriority
        UNION ALL
        SELECT 'broken_rule', '', '', '', '', 'AnalysisException'""",
    "delete_by_key": """
        SELECT * FROM orders t WHERE NOT EXISTS (
            SELECT 1 FROM orders k WHERE k.o_orderstatus = 'F' AND k.o_orderkey = t.o_orderkey)""",
    "delete_by_two_keys": """
        SELECT * FROM lineitem t WHERE NOT EXISTS (
            SELECT 1 FROM lineitem k WHERE k.l_returnflag = 'R'
              AND k.l_orderkey = t.l_orderkey AND k.l_linenumber = t.l_linenumber)""",
    "upsert_by_key": f"""
        WITH changed AS ({LATE_ROWS})
        SELECT {ORDERS} FROM orders t WHERE NOT EXISTS (
            SELECT 1 FROM changed k WHERE k.o_orderkey = t.o_orderkey)
        UNION ALL SELECT {ORDERS} FROM changed""",
    "full_refresh": f"""
        SELECT {ORDERS} FROM orders WHERE o_orderstatus NOT IN ('F', 'O')
        UNION ALL {LATE_ROWS}""",
    "batch_refresh": """
        SELECT o_orderkey, o_custkey,
               CASE WHEN year(o_orderdate) = 1996 THEN 'R' ELSE o_orderstatus END AS o_orderstatus,
               o_totalprice, o_orderdate, o_orderpriority,
               CAST(year(o_orderdate) AS INTEGER) AS batch
        FROM orders""",
    "rebuild_changed_unchanged": """
        SELECT o_orderkey, o_custkey,
               CASE WHEN o_orderstatus = 'P' AND o_orderdate < TIMESTAMP '1998-01-01'
                    THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
               o_totalprice, o_orderdate, o_orderpriority
        FROM orders""",
    "table_append": """
        SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderstatus = 'O'""",
    "fanout_sinks": """
        WITH mapped AS (
            SELECT o_orderkey AS orderkey, count(l_orderkey) AS n_lines,
                   CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total
            FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey)
        SELECT *, 'all_orders' AS sink FROM mapped
        UNION ALL SELECT *, 'large_orders' FROM mapped WHERE n_lines > 5
        UNION ALL SELECT *, 'empty_orders' FROM mapped WHERE n_lines = 0""",
    "routed_sinks": " UNION ALL ".join(
        f"""SELECT l_orderkey, CAST(l_linenumber AS INTEGER) AS l_linenumber,
                   CAST(l_quantity AS DOUBLE) AS l_quantity, 1 AS load, '{sink}' AS sink
            FROM lineitem WHERE {condition}"""
        for sink, condition in (
            ("shipped", "l_linestatus = 'F'"),
            ("returned", "l_returnflag = 'R'"),
            ("bulk", "l_quantity > 40"),
        )
    ),
    "archive_history": """
        SELECT *, '2024-01-30' AS snapshot FROM orders WHERE o_orderstatus <> 'P'
        UNION ALL SELECT *, '2024-01-31' FROM orders""",
    "conditional_date_record": """
        SELECT o_orderstatus AS status, max(o_orderdate) AS max_ts, count(*) AS n_rows
        FROM orders WHERE o_orderstatus IN ('F', 'P') GROUP BY o_orderstatus""",
    "dynamic_partition_overwrite": """
        SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM orders
        WHERE year(o_orderdate) <> 1996 OR o_orderstatus = 'F'""",
    "upsert_touched_partitions": f"""
        WITH changed AS ({LATE_ROWS})
        SELECT {ORDERS}, CAST(year(o_orderdate) AS INTEGER) AS o_year
        FROM orders WHERE NOT ({LATE})
        UNION ALL
        SELECT {ORDERS}, CAST(year(o_orderdate) AS INTEGER) FROM changed""",
    "partition_repair": """
        SELECT CAST(year(o_orderdate) AS INTEGER) AS o_year, count(*) AS n_rows
        FROM orders GROUP BY year(o_orderdate)""",
    "batch_completion": """
        SELECT CAST(year(o_orderdate) AS VARCHAR) AS batch_id, count(*) AS n_rows,
               max(o_orderdate) AS max_ts
        FROM orders GROUP BY year(o_orderdate)""",
    "jdbc_append_roundtrip": "SELECT * FROM customer",
    "declared_lengths": " UNION ALL ".join(
        [
            longest_digits("customer", "c_custkey", 0, 2),
            longest_text("customer", "c_name", 40),
            longest_digits("customer", "c_acctbal", 2, 6),
            longest_text("customer", "c_mktsegment", 8),
        ]
    ),
    "jdbc_large_objects": """
        SELECT doc_id, CASE WHEN lang = 'en' THEN upper(substr(text, 1, 50)) ELSE text END AS text, lang
        FROM documents""",
    "jdbc_query_scan": record(
        "customer_counts",
        "(SELECT count(*) AS n, count(*) FILTER (WHERE c_acctbal > 0) AS m FROM customer)",
        ("access_count", "n"),
        ("serving_count", "m"),
        ("difference", "n - m"),
    ),
    "jdbc_keyed_upsert": """
        SELECT c_custkey, c_name, c_nationkey,
               CASE WHEN c_acctbal < 0 THEN -c_acctbal ELSE c_acctbal END AS c_acctbal,
               c_mktsegment
        FROM customer""",
    "jdbc_serving_load": """
        SELECT c_mktsegment AS name, count(*) AS n_rows,
               CAST(sum(CASE WHEN c_acctbal < 0 THEN 0
                             ELSE CAST(c_acctbal AS DECIMAL(18,2)) END) AS DOUBLE) AS balance
        FROM customer GROUP BY c_mktsegment
        UNION ALL
        SELECT 'b1', count(*), 0.0 FROM customer WHERE c_acctbal < 0""",
    "changed_key_export": """
        SELECT DISTINCT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber
        FROM lineitem WHERE l_linestatus = 'O'""",
    "report_csv": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "report_manifest": """
        SELECT 'open_orders.csv' AS report, 1 AS position, count(*) AS rows,
               DATE '2024-01-01' AS start_date, DATE '2024-01-31' AS end_date, 3 AS control_lines
        FROM orders WHERE o_orderstatus = 'O'
        UNION ALL
        SELECT 'no_orders.csv', 2, count(*), DATE '2024-01-01', DATE '2024-01-31', 3
        FROM orders WHERE o_orderstatus = 'X'
        UNION ALL
        SELECT 'segments.csv', 3, count(DISTINCT c_mktsegment), DATE '2024-01-01',
               DATE '2024-01-31', 3
        FROM customer""",
    "adhoc_query": """
        SELECT user_id, event_type, count(*) AS n_events, max(event_id) AS last_id
        FROM events GROUP BY user_id, event_type""",
}
