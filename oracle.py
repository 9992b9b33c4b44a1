"""DuckDB SQL that gives the same rows as the query of the same name in ``queries.py``."""

from __future__ import annotations


def _check(name, kind, column, failed, severity="error", source="t", passed=None):
    """One result row of a check over ``source``; ``failed`` is an aggregate."""
    return f"""
    SELECT '{name}' AS check_name, '{kind}' AS check_type, '{column}' AS column_name,
           CAST(count(*) AS BIGINT) AS total_rows, CAST({failed} AS BIGINT) AS failed_rows,
           {passed or f'({failed}) = 0'} AS passed, '{severity}' AS severity
    FROM {source}"""


def _results(*rows, with_=""):
    return with_ + " UNION ALL ".join(rows)


def _rows_where(condition):
    return f"count(*) FILTER (WHERE {condition})"


_FAULTY = """
WITH t AS (
    SELECT o_orderkey,
           CASE WHEN o_orderkey % 97 <> 0 THEN o_orderstatus END AS o_orderstatus,
           CASE WHEN o_orderkey % 89 <> 0 THEN o_custkey END AS o_custkey
    FROM orders
)
"""

_UNIQUE = """
    (SELECT {name}, 'unique' AS check_type, '{label}' AS column_name,
           CAST(sum(n) AS BIGINT) AS total_rows,
           CAST(sum(CASE WHEN {is_set} THEN n - 1 ELSE 0 END) AS BIGINT) AS failed_rows,
           sum(CASE WHEN {is_set} THEN n - 1 ELSE 0 END) = 0 AS passed, '{severity}' AS severity
    FROM (SELECT {keys}, count(*) AS n FROM {source} GROUP BY {keys}))
"""


def _unique(keys, source, severity="error"):
    label = ",".join(keys)
    is_set = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    name = f"'unique:{label}' AS check_name"
    return _UNIQUE.format(
        name=name, label=label, is_set=is_set, keys=", ".join(keys), source=source, severity=severity
    )


_CUSTOMER_RULES = {
    "not_null:c_custkey": "c_custkey IS NULL",
    "not_null:c_name": "c_name IS NULL",
    "positive:c_acctbal": "c_acctbal <= 0",
    "range:c_nationkey": "c_nationkey < 0 OR c_nationkey > 20",
    "pattern:c_mktsegment": "NOT regexp_matches(c_mktsegment, '^[A-Z]+$')",
}

_CUSTOMER_RESULTS = " UNION ALL ".join(
    [
        _check(
            name, *name.split(":"), _rows_where(rule),
            "warning" if name.startswith("positive") else "error", "customer",
        )
        for name, rule in _CUSTOMER_RULES.items()
    ]
    + ["SELECT * FROM " + _unique(["c_custkey"], "customer")]
)

_TAGS = ", ".join(f"CASE WHEN {rule} THEN '{name}' END" for name, rule in _CUSTOMER_RULES.items())
_N_TAGS = " + ".join(f"CASE WHEN {rule} THEN 1 ELSE 0 END" for rule in _CUSTOMER_RULES.values())

_CHANGED = """
changed AS (
    SELECT o_orderkey, o_custkey, o_orderstatus,
           CASE WHEN o_orderpriority = '2-HIGH' THEN 2.5 ELSE 1.5 END AS o_totalprice,
           CASE WHEN o_orderpriority = '2-HIGH' THEN o_orderdate + INTERVAL 1 DAY
                ELSE o_orderdate END AS o_orderdate,
           o_orderpriority
    FROM orders WHERE o_orderstatus = 'P'
    UNION ALL
    SELECT -o_orderkey - 1, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
    FROM orders WHERE o_orderpriority = '1-URGENT'
)
"""

ORACLE: dict[str, str] = {
    "src_json_records": """
        SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""",
    "src_file_scan": "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 250000.0",
    "src_open_source": "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer",
    "src_landing_format": "SELECT event_id, user_id, event_type FROM events",
    "src_param_filter": """
        SELECT o_orderkey, o_custkey, o_orderdate FROM orders
        WHERE o_orderpriority = '1-URGENT' AND o_orderdate >= TIMESTAMP '1998-01-01'""",
    "src_parent_feed": """
        SELECT o_orderkey, o_custkey FROM orders
        WHERE EXISTS (SELECT 1 FROM customer
                      WHERE c_custkey = o_custkey AND c_mktsegment = 'BUILDING')""",
    "src_scan_page": """
        SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'O'
        ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""",
    "topk_recent": """
        SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
        ORDER BY o_orderdate DESC, o_orderkey LIMIT 100""",
    "conform_types": """
        SELECT event_id, event_type AS kind,
               TRY_CAST(CASE WHEN event_id % 13 = 0 THEN 'n/a'
                             ELSE json_extract_string(props, '$.k') END AS BIGINT) AS k,
               CAST(ts AS DATE) AS day, CAST(NULL AS VARCHAR) AS note
        FROM events""",
    "conform_rejects": """
        SELECT * FROM (
            SELECT 'good' AS reason, count(*) AS n FROM orders
            WHERE o_orderkey % 97 <> 0 AND o_orderkey % 89 <> 0
            UNION ALL
            SELECT 'o_orderstatus: null', count(*) FROM orders WHERE o_orderkey % 97 = 0
            UNION ALL
            SELECT 'o_custkey: not a valid integer', count(*) FROM orders WHERE o_orderkey % 89 = 0
        ) WHERE n > 0""",
    "alias_columns": """
        SELECT c_custkey AS customer_id, c_name, c_nationkey, c_acctbal AS balance, c_mktsegment
        FROM customer""",
    "naming_case": """
        SELECT c_custkey AS "cCustkey", c_name AS "cName", c_nationkey AS "cNationkey",
               c_acctbal AS "cAcctbal", c_mktsegment AS "cMktsegment"
        FROM customer""",
    "resolve_columns": """
        SELECT s_suppkey AS "S_SuppKey", s_name AS "S_NAME" FROM supplier""",
    "pii_hash": "SELECT c_custkey, sha256(c_name) AS c_name, c_mktsegment FROM customer",
    "pii_mask": """
        SELECT c_custkey, repeat('*', length(c_name) - 4) || right(c_name, 4) AS c_name,
               sha256('pepper' || c_mktsegment) AS c_mktsegment
        FROM customer""",
    "pii_drop": "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer",
    "audit_stamp": """
        SELECT c_custkey, 'load-1' AS _load_id, TIMESTAMP '2024-02-01' AS _extracted_at
        FROM customer""",
    "nested_cursor": """
        SELECT event_id AS id, ts AS published_at FROM events WHERE ts > TIMESTAMP '2024-01-15'""",
    "flatten_structs": """
        SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS props__k,
               event_type AS meta__event_type, user_id AS meta__who__user_id
        FROM events""",
    "explode_children": """
        SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos,
               CAST(unnest(embedding) AS DOUBLE) AS value
        FROM embeddings""",
    "json_value": """
        SELECT event_id,
               CASE WHEN event_id % 11 <> 0
                    THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k,
               CAST(NULL AS VARCHAR) AS absent
        FROM events""",
    "schema_evolve": """
        SELECT o_orderkey, floor(o_totalprice) AS o_totalprice,
               CAST(NULL AS VARCHAR) AS o_orderpriority
        FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
        UNION ALL
        SELECT o_orderkey, o_totalprice, o_orderpriority
        FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'""",
    "incremental_filter": """
        SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '1998-06-30'""",
    "incremental_first_run": """
        SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1998-06-30'""",
    "cursor_advance": """
        SELECT 'orders' AS resource, max(o_orderdate) AS high_water FROM orders
        UNION ALL SELECT 'events', max(ts) FROM events
        UNION ALL SELECT 'events_ahead', TIMESTAMP '2030-01-01'""",
    "backfill_window": """
        SELECT event_id, ts FROM events
        WHERE ts >= TIMESTAMP '2024-01-13' AND ts < TIMESTAMP '2024-01-20'""",
    "full_refresh": "SELECT o_orderkey, o_totalprice FROM orders",
    "retention": """
        SELECT event_id, CASE WHEN event_id % 50 <> 0 THEN ts END AS ts FROM events
        WHERE event_id % 50 = 0 OR ts >= TIMESTAMP '2024-01-24'""",
    "retention_table": "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-23 12:00:00'",
    "write_append": """
        SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag
        FROM lineitem WHERE l_returnflag <> 'R'
        UNION ALL
        SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag
        FROM lineitem WHERE l_returnflag <> 'A'""",
    "write_append_table": """
        SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, CAST(NULL AS VARCHAR) AS batch
        FROM lineitem WHERE l_returnflag <> 'R'
        UNION ALL
        SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, 'second'
        FROM lineitem WHERE l_returnflag <> 'A'""",
    "write_replace": "SELECT * FROM customer WHERE c_acctbal > 0",
    "write_merge": f"""
        WITH {_CHANGED}
        SELECT * FROM orders o
        WHERE NOT EXISTS (SELECT 1 FROM changed c WHERE c.o_orderkey = o.o_orderkey)
        UNION ALL SELECT * FROM changed""",
    "write_merge_table": f"""
        WITH {_CHANGED}
        SELECT * FROM orders o
        WHERE NOT EXISTS (SELECT 1 FROM changed c WHERE c.o_orderkey = o.o_orderkey)
        UNION ALL
        SELECT * REPLACE (CASE WHEN o_orderpriority = '5-LOW' THEN 'X' ELSE o_orderstatus END
                          AS o_orderstatus)
        FROM changed""",
    "write_catalog_table": f"""
        WITH {_CHANGED}
        SELECT * FROM orders o
        WHERE NOT EXISTS (SELECT 1 FROM changed c WHERE c.o_orderkey = o.o_orderkey)
        UNION ALL SELECT * FROM changed""",
    "dedup_latest": """
        SELECT * FROM lineitem
        QUALIFY row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
                     l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
                     l_linestatus DESC) = 1""",
    "write_partitioned": """
        SELECT CAST(ts AS DATE) AS ts_date, count(*) AS n FROM events GROUP BY 1""",
    "write_clustered": """
        SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem
        WHERE l_shipdate BETWEEN TIMESTAMP '1997-03-01' AND TIMESTAMP '1997-03-31'""",
    "write_bounded_files": """
        SELECT CAST(count(*) AS BIGINT) AS row_count, true AS within_bound FROM orders""",
    "compact_table": "SELECT o_orderkey, o_custkey FROM orders",
    "append_once": """
        SELECT event_id, user_id, event_type, 'load-' || event_type AS _load_id FROM events
        WHERE event_type <> 'purchase'
        UNION ALL
        SELECT event_id, user_id, event_type, 'load-' || event_type FROM events
        WHERE event_type = 'purchase'""",
    "src_json_bodies": """
        SELECT 'corrupt' AS outcome, FALSE AS no_id, count(*) AS n FROM events WHERE event_id % 10 = 0
        UNION ALL SELECT 'corrupt', TRUE, count(*) FROM events WHERE event_id % 10 = 1
        UNION ALL SELECT 'good', TRUE, count(*) FROM events WHERE event_id % 10 <> 1
        UNION ALL SELECT 'good', FALSE, count(*) FROM events WHERE event_id % 10 > 1""",
    "load_parent_child": """
        WITH o AS (
            SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 1 ELSE 2 END AS run
            FROM orders WHERE o_orderdate >= TIMESTAMP '1997-06-01'
        ),
        runs AS (SELECT unnest([1, 2]) AS run)
        SELECT 'orders' AS resource, TRUE AS success, count(o_orderkey) AS rows_processed, FALSE AS skipped
        FROM runs LEFT JOIN o USING (run) GROUP BY run
        UNION ALL
        SELECT 'lineitem', TRUE, count(l_orderkey), FALSE
        FROM runs LEFT JOIN (SELECT run, l_orderkey FROM lineitem JOIN o ON o_orderkey = l_orderkey) USING (run) GROUP BY run
        UNION ALL SELECT 'part', FALSE, 0, FALSE FROM runs
        UNION ALL SELECT 'partsupp', FALSE, 0, TRUE FROM runs""",
    "pii_nested_load": """
        SELECT 'rejects' AS place, count(*) AS n, CAST(0 AS BIGINT) AS n_planted, CAST(NULL AS VARCHAR) AS least_mail
        FROM customer WHERE c_custkey % 10 = 0
        UNION ALL
        SELECT 'stored', count(*), 0, min(sha256(c_name || '@planted.example')) FROM customer WHERE c_custkey % 10 <> 0""",
    "merge_evolving_partitioned": """
        SELECT o_orderpriority, count(*) AS n,
               count(*) FILTER (o_orderpriority IN ('1-URGENT', '2-HIGH')) AS n_rush, TRUE AS old_files_kept
        FROM orders GROUP BY o_orderpriority""",
    "stream_merge_batches": """
        SELECT * EXCLUDE (place), TRUE AS several_batches FROM (
            SELECT *, row_number() OVER (
                PARTITION BY user_id
                ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST, event_type DESC NULLS LAST,
                         value DESC NULLS LAST, props DESC NULLS LAST) AS place
            FROM events)
        WHERE place = 1""",
    "stream_metrics_batches": """
        SELECT time_bucket(INTERVAL '15 minutes', ts, TIMESTAMP '2024-01-01') AS window_start,
               time_bucket(INTERVAL '15 minutes', ts, TIMESTAMP '2024-01-01') + INTERVAL '15 minutes' AS window_end,
               count(*) AS row_count, count(*) FILTER (event_type = 'error') AS error_count, TRUE AS several_batches
        FROM events GROUP BY ALL""",
    "stream_quarantine_batches": """
        SELECT event_id, coalesce(value <= 20, TRUE) AS good, TRUE AS several_batches FROM events""",
    "append_torn_replay": """
        SELECT event_id, 'load-1' AS _load_id FROM events
        UNION ALL SELECT event_id, 'load-2' AS _load_id FROM events""",
    "retention_load": "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-24' OR ts IS NULL",
    "incremental_ties_append": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
               CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS o_orderdate
        FROM orders WHERE o_orderdate >= TIMESTAMP '1997-12-01' OR o_orderkey % 2 = 0""",
    "incremental_ties_merge": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
               CASE WHEN o_orderstatus = 'O' AND o_orderdate >= TIMESTAMP '1997-12-01' THEN 0.5
                    ELSE o_totalprice END AS o_totalprice,
               CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS o_orderdate
        FROM orders WHERE o_orderdate >= TIMESTAMP '1997-12-01' OR o_orderkey % 2 = 0""",
    "append_once_table": "SELECT event_id, 'load-1' AS _load_id FROM events",
    "dq_not_null": _results(
        _check("not_null:o_orderkey", "not_null", "o_orderkey", _rows_where("o_orderkey IS NULL")),
        _check(
            "not_null:o_orderstatus", "not_null", "o_orderstatus",
            _rows_where("o_orderstatus IS NULL"),
        ),
        _check("not_null:o_custkey", "not_null", "o_custkey", _rows_where("o_custkey IS NULL")),
        with_=_FAULTY,
    ),
    "dq_unique": f"""
        WITH t AS (
            SELECT *, CASE WHEN l_orderkey % 5 <> 0 THEN l_orderkey END AS nullable_key FROM lineitem
        )
        SELECT * FROM {_unique(["l_orderkey", "l_linenumber"], "t")}
        UNION ALL SELECT * FROM {_unique(["nullable_key", "l_linenumber"], "t", "warning")}""",
    "dq_positive": _results(
        _check("positive:c_acctbal", "positive", "c_acctbal", _rows_where("c_acctbal <= 0"),
               source="customer"),
        _check("positive:c_custkey", "positive", "c_custkey", _rows_where("c_custkey <= 0"),
               source="customer"),
    ),
    "dq_range": _results(
        _check("range:l_discount", "range", "l_discount",
               _rows_where("l_discount < 0.02 OR l_discount > 0.08"), source="lineitem"),
        _check("range:l_quantity", "range", "l_quantity",
               _rows_where("l_quantity > 45"), source="lineitem"),
    ),
    "dq_pattern": """
        WITH t AS (
            SELECT CASE WHEN c_custkey % 31 = 0 THEN 'nobody' WHEN c_custkey % 37 = 0 THEN NULL
                        ELSE c_name END AS c_name
            FROM customer
        )"""
    + _check("pattern:c_name", "pattern", "c_name",
             _rows_where("NOT regexp_matches(c_name, '^Customer#[0-9]+$')")),
    "dq_freshness": _results(
        *[
            _check(name, "freshness", "ts", late, source="events")
            for name, late in [
                ("two_days", "CAST(max(ts) < TIMESTAMP '2024-01-29 12:00:00' AS INTEGER)"),
                ("half_day", "CAST(max(ts) < TIMESTAMP '2024-01-31 00:00:00' AS INTEGER)"),
            ]
        ]
    ),
    "dq_completeness": _results(
        _check(
            "completeness:o_orderstatus,o_custkey", "completeness", "o_orderstatus,o_custkey",
            _rows_where("o_orderstatus IS NULL OR o_custkey IS NULL"),
        ),
        _check(
            "completeness:o_orderkey,o_comment", "completeness", "o_orderkey,o_comment",
            "count(*)", passed="false",
        ),
        with_=_FAULTY,
    ),
    "dq_volume": _results(
        _check("plausible", "volume", "",
               "CAST(count(*) NOT BETWEEN 1 AND 1000000000000 AS INTEGER)", source="events"),
        _check("tiny", "volume", "", "CAST(count(*) > 10 AS INTEGER)", source="events"),
    ),
    "dq_schema": _results(
        *[
            _check(f"schema:{name}", "schema", name, str(failed), source="customer")
            for name, failed in [
                ("c_custkey", 0),
                ("c_name", 0),
                ("c_acctbal", 1),
                ("c_phone", 1),
                ("c_nationkey", 1),
                ("c_mktsegment", 1),
            ]
        ]
    ),
    "dq_gate": f"""
        SELECT *, CASE WHEN passed THEN 'pass' WHEN severity = 'error' THEN 'abort' ELSE 'warn' END
                  AS action
        FROM ({_CUSTOMER_RESULTS})""",
    "dq_score": f"""
        SELECT count(*) AS checks, count(*) FILTER (WHERE passed) AS passed_checks,
               avg(CASE WHEN passed THEN 1.0 ELSE 0.0 END) AS quality_score
        FROM ({_CUSTOMER_RESULTS})""",
    "dq_quarantine": f"""
        SELECT c_custkey, CAST({_N_TAGS} AS INTEGER) AS n_failed,
               concat_ws('|', {_TAGS}) AS failed_checks
        FROM customer""",
    "load_row_counts": """
        WITH t AS (
            SELECT 'customer' AS table_name, count(*) AS row_count FROM customer
            UNION ALL SELECT 'orders', count(*) FROM orders
            UNION ALL SELECT 'lineitem', count(*) FROM lineitem
        )
        SELECT * FROM t UNION ALL SELECT '__total__', CAST(sum(row_count) AS BIGINT) FROM t""",
    "metric_freshness": """
        SELECT 'orders' AS table_name, max(o_orderdate) AS newest,
               CAST(trunc((epoch_us(TIMESTAMP '2024-01-31') - epoch_us(max(o_orderdate)))
                          / 3600000000.0) AS BIGINT) AS lag_hours
        FROM orders
        UNION ALL
        SELECT 'events', max(ts),
               CAST(trunc((epoch_us(TIMESTAMP '2024-01-31') - epoch_us(max(ts)))
                          / 3600000000.0) AS BIGINT)
        FROM events""",
    "metric_stale_tables": """
        SELECT 'orders' AS table_name,
               CAST(trunc((epoch_us(TIMESTAMP '2024-01-31') - epoch_us(max(o_orderdate)))
                          / 3600000000.0) AS BIGINT) AS lag_hours
        FROM orders
        HAVING max(o_orderdate) < TIMESTAMP '2024-01-29'
        UNION ALL
        SELECT 'events', CAST(trunc((epoch_us(TIMESTAMP '2024-01-31') - epoch_us(max(ts)))
                                    / 3600000000.0) AS BIGINT) AS lag_hours
        FROM events HAVING max(ts) < TIMESTAMP '2024-01-29'""",
    "metric_errors": """
        SELECT CAST(ts AS DATE) AS day, count(*) AS runs,
               count(*) FILTER (WHERE event_type = 'error') AS errors,
               round(count(*) FILTER (WHERE event_type = 'error') / CAST(count(*) AS DOUBLE), 6)
                   AS error_rate
        FROM events GROUP BY 1""",
    "metric_sla_miss": """
        WITH runs AS (
            SELECT user_id, CAST(ts AS DATE) AS day,
                   epoch_us(max(ts)) - epoch_us(min(ts)) AS took
            FROM events GROUP BY ALL
        )
        SELECT user_id, day, CAST(took // 60000000 AS BIGINT) AS duration_minutes
        FROM runs WHERE took > 72000000000""",
    "post_load_sql": """
        SELECT event_type, max(n) AS peak, count(*) AS hours
        FROM (SELECT event_type, date_trunc('hour', ts), count(*) AS n FROM events
              WHERE event_type <> 'error' GROUP BY ALL)
        GROUP BY event_type""",
    "missing_slots": """
        SELECT slot AS slot_start
        FROM generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30 23:59:00',
                             INTERVAL 1 MINUTE) g(slot)
        ANTI JOIN (SELECT DISTINCT date_trunc('minute', ts) AS filled FROM events)
            ON slot = filled""",
    "stream_append": "SELECT event_id, user_id, event_type, value FROM events",
    "stream_merge": """
        SELECT * FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "stream_dedup": "SELECT DISTINCT event_id, ts, user_id FROM events",
    "stream_interval_metrics": """
        SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS window_start,
               time_bucket(INTERVAL 15 MINUTE, ts) + INTERVAL 15 MINUTE AS window_end,
               count(*) AS row_count,
               count(*) FILTER (WHERE event_type = 'error') AS error_count
        FROM events GROUP BY 1, 2""",
    "stream_quarantine": """
        SELECT CASE WHEN value > 20 AND event_type = 'error' THEN 'value_in_range|not_error'
                    WHEN value > 20 THEN 'value_in_range'
                    WHEN event_type = 'error' THEN 'not_error' ELSE 'good' END AS outcome,
               count(*) AS n
        FROM events GROUP BY 1""",
    "load_resource_merge": """
        WITH current AS (
            SELECT * REPLACE (
                CASE WHEN o_orderstatus = 'P' THEN o_orderdate + INTERVAL 3650 DAY
                     ELSE o_orderdate END AS o_orderdate,
                CASE WHEN o_orderstatus = 'P' THEN 0.5 ELSE o_totalprice END AS o_totalprice)
            FROM orders
        ),
        early AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
        batch AS (
            SELECT * FROM current WHERE o_orderdate > (SELECT max(o_orderdate) FROM early)
        )
        SELECT *, TIMESTAMP '2024-02-01 00:00:00' AS _extracted_at FROM early
        WHERE o_orderkey NOT IN (SELECT o_orderkey FROM batch)
        UNION ALL
        SELECT *, TIMESTAMP '2024-02-01 01:00:00' FROM batch""",
    "load_audit_rows": """
        SELECT 'orders' AS resource, true AS success,
               count(*) FILTER (WHERE o_orderkey % 97 <> 0) AS rows_processed,
               count(*) FILTER (WHERE o_orderkey % 97 = 0) AS rows_rejected
        FROM orders
        UNION ALL SELECT 'customer', true, count(*), 0 FROM customer
        UNION ALL SELECT 'events', false, 0, 0 FROM (SELECT count(*) FROM events)""",
    "load_from_config": """
        SELECT 'shop_load' AS pipeline_name, 'orders' AS resource, n >= 500 AS success,
               CASE WHEN n >= 500 THEN n ELSE 0 END AS rows_processed,
               CASE WHEN n >= 500 THEN n ELSE 0 END AS raw_orders
        FROM (SELECT count(*) AS n FROM orders
              WHERE o_orderpriority = '1-URGENT' AND o_orderdate >= TIMESTAMP '1998-01-01')
        UNION ALL
        SELECT 'shop_load', 'supplier', n >= 500, CASE WHEN n >= 500 THEN n ELSE 0 END, NULL
        FROM (SELECT count(*) AS n FROM supplier)""",
}
