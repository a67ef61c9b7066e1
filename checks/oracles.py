"""What each query should return, as SQL over the same tables."""

_CENTS = "CAST(CAST({} AS DECIMAL(15,2)) AS VARCHAR)"

_MEASURES = """
SELECT l_orderkey, l_partkey, kind, CAST(floor(measure * 100 + 0.5) AS BIGINT) AS amount FROM (
  SELECT l_orderkey, l_partkey, 'quantity' AS kind, l_quantity AS measure FROM lineitem
  UNION ALL SELECT l_orderkey, l_partkey, 'price', l_extendedprice FROM lineitem
  UNION ALL SELECT l_orderkey, l_partkey, 'discount', l_discount FROM lineitem
)
"""

_DAYS = """
CAST(year(ts) AS INTEGER) AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day
"""

_RUN = """
TIMESTAMP '2024-01-31 22:30:00' AS momento_ingestion, TIMESTAMP '2024-01-31 00:00:00' AS job_process_date
"""

_LATEST = """
SELECT * FROM (
  SELECT *, row_number() OVER (
    PARTITION BY user_id, event_type ORDER BY ts DESC, CAST(event_id AS VARCHAR) DESC) AS rn
  FROM events WHERE event_type <> 'error'
) WHERE rn = 1
"""

_EXPORTED = f"""
SELECT user_id, event_type, event_id, value AS amount, props AS detail_note, epoch_us(ts) AS tstamp,
       ts AS created_at, CAST(NULL AS VARCHAR) AS channel,
       CAST(user_id AS VARCHAR) || '-' || event_type AS id, {_RUN}, {_DAYS}
FROM ({_LATEST})
"""

_UPSERTED = f"""
WITH stored AS (SELECT event_id, user_id, event_type, value, {_DAYS} FROM events)
SELECT event_id, user_id, event_type,
       CASE WHEN day > '20' THEN value
            WHEN event_type = 'click' THEN value + 1
            WHEN event_type = 'view' THEN value + 1 + 1
            WHEN event_type = 'purchase' THEN value + 3
            ELSE value END AS value,
       CAST(CASE WHEN day > '20' THEN 1
                 WHEN event_type = 'click' THEN 2
                 WHEN event_type = 'purchase' THEN 3
                 ELSE 1 END AS BIGINT) AS version,
       year, month, day
FROM stored
UNION ALL
SELECT -event_id - 1, user_id, event_type, value, CAST(1 AS BIGINT), year, month, day
FROM stored WHERE event_type = 'signup' AND day <= '20'
"""

ORACLES: dict[str, str] = {
    "scan_tagged_json": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders""",
    "flatten_collision_coalesce": """
        SELECT CAST(o_orderkey AS VARCHAR) AS key,
               CASE WHEN o_orderkey % 3 = 0 THEN 'old ' ELSE '' END || o_orderstatus AS order_status
        FROM orders""",
    "scan_tagged_variant": """
        SELECT event_id, CASE WHEN event_type = 'click' THEN '' ELSE 'u' END || user_id AS code,
               CASE WHEN event_type = 'click' THEN event_type END AS detail,
               CASE WHEN event_type <> 'click' THEN user_id::VARCHAR END AS detail_user,
               CASE WHEN event_type <> 'click' THEN event_type END AS gap,
               event_type AS mark_0, user_id::VARCHAR AS mark_1, '{"k":"' || user_id || '"}' AS mark_2
        FROM events""",
    "scan_dated_partition": """
        SELECT event_id, event_type FROM events
        WHERE ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-16'""",
    "scan_new_files": """
        SELECT event_id, event_type, run FROM events, (VALUES (1), (2)) AS runs(run)
        WHERE (run = 1 AND (event_type = 'click' AND day(ts) IN (14, 15) OR event_type = 'view' AND day(ts) = 15))
           OR (run = 2 AND (event_type NOT IN ('click', 'view') AND day(ts) = 15 OR event_type = 'view' AND day(ts) = 14
                            OR event_type = 'view' AND day(ts) = 15 AND event_id % 2 = 0))""",
    "scan_catalog": """
        SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM orders""",
    "scan_catalog_pruned": """
        SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM orders
        WHERE year(o_orderdate) = 1997 AND o_orderstatus = 'F'""",
    "scan_format": """
        SELECT c.*, f.data_format
        FROM customer c CROSS JOIN (VALUES ('csv'), ('json'), ('parquet'), ('orc')) AS f(data_format)""",
    "source_hook": "SELECT * FROM orders WHERE o_orderpriority = '1-URGENT'",
    "flatten_scalars": f"""
        SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, {_CENTS.format("c_acctbal")} AS c_acctbal,
               CAST(c_acctbal < 0 AS VARCHAR) AS in_debt
        FROM customer""",
    "flatten_nested": """
        SELECT CAST(c_custkey AS VARCHAR) AS key, CAST(c_nationkey AS VARCHAR) AS home_nation_key,
               c_mktsegment AS home_segment
        FROM customer""",
    "flatten_names": """
        SELECT CAST(c_custkey AS VARCHAR) AS cust_key, c_name AS cust_name,
               CAST(c_nationkey AS VARCHAR) AS nation_i_d, c_mktsegment AS s,
               c_name AS home_address_first_line, CAST(c_custkey AS VARCHAR) AS dotted_key
        FROM customer""",
    "flatten_scalar_set": """
        SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(2 AS INTEGER) AS n_tags,
               o_orderstatus AS status, o_orderpriority AS priority, o_orderstatus AS mixed_text,
               CAST(o_custkey AS VARCHAR) AS mixed_number
        FROM orders""",
    "flatten_list_of_maps": f"""
        SELECT CAST(l_orderkey AS VARCHAR) AS order_key, CAST(l_partkey AS VARCHAR) AS part_key,
               kind AS "measureKind", CAST(amount AS VARCHAR) AS amount
        FROM ({_MEASURES})""",
    "flatten_nested_lists": """
        SELECT o_orderkey, slot::INT AS slot, 'k' || slot AS kind, CASE WHEN o_orderstatus = 'O' THEN '' ELSE 'c' END || (o_orderkey + slot) AS code,
               o_orderdate::TIMESTAMP + to_seconds(slot) AS seen_at, part::INT AS part, o_custkey * 2 + part AS amount, o_orderpriority AS note
        FROM orders, (VALUES (0), (1)) AS a(slot), (VALUES (0), (1)) AS b(part)""",
    "flatten_union_tags": """
        SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
               o_orderpriority AS o_custkey_note
        FROM orders""",
    "flatten_null_tag": """
        SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
               CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS priority,
               CAST(NULL AS VARCHAR) AS never
        FROM orders""",
    "filter_keys_not_null": "SELECT * FROM events WHERE event_type <> 'error' AND value > 1",
    "latest_per_key": f"""
        SELECT user_id, event_id, event_type, {_CENTS.format("value")} AS value FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id DESC) AS rn FROM events
        ) WHERE rn = 1""",
    "latest_per_key_composite": """
        SELECT event_id, ts, user_id, event_type, value, props FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
          FROM events
        ) WHERE rn = 1""",
    "row_count": "SELECT count(*) AS n_rows FROM lineitem",
    "align_cast": """
        SELECT CASE WHEN event_type <> 'error' THEN CAST(user_id AS INTEGER) END AS user_id, event_id, value,
               CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) AS amount, ts,
               strftime(ts, '%Y-%m-%d') AS on_day, value > 10 AS large
        FROM events""",
    "align_rejects": """
        SELECT event_id, name, raw, wanted FROM events, (VALUES
          ('user_id', 'n/a', 'int', 'error'), ('small', '999999999999', 'int', 'view'), ('detail.inner.user_id', 'n/a', 'bigint', 'error'),
          ('numbers[1]', 'n/a', 'bigint', 'error'), ('items[1].qty', 'n/a', 'bigint', 'error'), ('props', '{broken', 'struct<k:bigint>', 'error')
        ) AS bad(name, raw, wanted, kind) WHERE event_type = kind""",
    "align_missing": """
        SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(NULL AS VARCHAR) AS o_comment,
               CAST(NULL AS INTEGER) AS o_clerk, CAST(NULL AS DOUBLE) AS o_rate, CAST(NULL AS VARCHAR) AS o_closed
        FROM orders""",
    "align_struct": """
        SELECT o_orderkey, o_custkey AS cust_key, o_orderstatus AS code, CAST(NULL AS VARCHAR) AS segment,
               CAST(1 AS INTEGER) AS n_fields
        FROM orders""",
    "align_array_cast": """
        SELECT o_orderkey, CAST(0 AS INTEGER) AS slot, CAST(o_orderkey AS VARCHAR) AS element FROM orders
        UNION ALL SELECT o_orderkey, 1, CAST(o_custkey AS VARCHAR) FROM orders
        UNION ALL SELECT o_orderkey, 2, o_orderstatus FROM orders
        UNION ALL SELECT o_orderkey, 3, o_orderpriority FROM orders""",
    "align_list_of_maps": f"""
        SELECT l_orderkey AS order_key, l_partkey AS part_key, kind AS measure_kind,
               CAST(amount AS DOUBLE) AS amount,
               CAST(NULL AS VARCHAR) AS unit
        FROM ({_MEASURES})""",
    "align_json_array": """
        SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS kind FROM events
        UNION ALL SELECT event_id, user_id, event_type FROM events""",
    "surrogate_id": """
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_returnflag) AS id, l_orderkey, l_linenumber, l_returnflag
        FROM lineitem""",
    "sorted_projection": """
        SELECT *, 'o_custkey,o_orderdate,o_orderkey,o_orderpriority,o_orderstatus,o_totalprice' AS column_order
        FROM orders""",
    "ts_default": """
        SELECT event_id,
               CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN ts + INTERVAL 5 HOUR ELSE ts END AS seen,
               CAST(NULL AS TIMESTAMP) AS absent
        FROM events""",
    "ts_epoch_millis": "SELECT event_id, date_trunc('millisecond', ts) AS seen FROM events",
    "ts_multi_format": """
        SELECT event_id,
               CASE WHEN event_type = 'click' AND value < 20 THEN ts
                    WHEN event_type = 'click' THEN date_trunc('millisecond', ts)
                    WHEN event_type = 'view' THEN date_trunc('second', ts)
                    WHEN event_type = 'signup' AND value < 20 THEN date_trunc('millisecond', ts)
                    WHEN event_type = 'signup' THEN date_trunc('second', ts)
                    WHEN event_type = 'purchase' AND value < 20
                      THEN date_trunc('millisecond', ts) + INTERVAL 5 HOUR
                    WHEN event_type = 'purchase' THEN date_trunc('millisecond', ts) - INTERVAL 2 HOUR
               END AS seen
        FROM events""",
    "ts_dispatch": """
        SELECT event_id, date_trunc('millisecond', ts) AS from_number, date_trunc('second', ts) AS from_text,
               ts AS unchanged
        FROM events""",
    "post_filters": """
        SELECT * FROM orders
        WHERE o_totalprice > 100000 AND (o_orderstatus <> 'P' OR o_orderpriority = '2-HIGH')""",
    "rename_columns": """
        SELECT o_orderkey AS order_key, o_custkey AS customer, o_orderstatus, o_totalprice, o_orderdate,
               o_orderpriority
        FROM orders""",
    "sql_columns": """
        SELECT o_orderkey, COALESCE(NULLIF(o_custkey, 0), -1) AS o_custkey, o_orderstatus, o_totalprice,
               o_orderdate, o_orderpriority, CAST(floor(o_totalprice / 100000) AS BIGINT) AS price_band,
               o_orderstatus || '-' || CAST(CAST(floor(o_totalprice / 100000) AS BIGINT) AS VARCHAR) AS label,
               make_timestamp(o_orderkey * 1000 * 1000000) AS from_millis
        FROM orders""",
    "select_columns": "SELECT o_orderpriority, o_orderkey FROM orders",
    "add_metadata": f"SELECT event_id, {_DAYS}, {_RUN} FROM events",
    "utc_to_local": "SELECT event_id, ts - INTERVAL 5 HOUR AS local_ts FROM events",
    "sink_table_overwrite": "SELECT * FROM orders WHERE o_orderstatus <> 'P'",
    "sink_partitioned": f"""
        SELECT event_id, user_id, event_type, CASE WHEN day(ts) = 15 THEN 0.0 ELSE value END AS value,
               CAST(1 AS BIGINT) AS version, {_DAYS}
        FROM events""",
    "sink_format": "SELECT * FROM customer UNION ALL SELECT * FROM customer",
    "upsert_merge": _UPSERTED,
    "upsert_idempotent": _UPSERTED,
    "upsert_many_partitions": _UPSERTED,
    "upsert_null_partition": """
        SELECT event_id, event_type, CASE WHEN event_type = 'error' THEN value + 1 ELSE value END AS value,
               CASE WHEN event_type = 'error' THEN 2 ELSE 1 END AS version,
               CASE WHEN event_type NOT IN ('error', 'view') THEN event_type END AS kind
        FROM events""",
    "upsert_widened": f"""
        SELECT event_id, CASE WHEN day(ts) <= 10 THEN 2 ELSE 1 END::BIGINT AS version,
               CASE WHEN day(ts) <= 10 THEN value + 1 ELSE value::FLOAT::DOUBLE END AS value,
               CASE WHEN day(ts) <= 10 THEN floor(value::DECIMAL(16,4) * 100) ELSE value::DECIMAL(9,2) * 100 END::BIGINT AS cents,
               CASE WHEN day(ts) <= 10 THEN user_id + 1099511627776 ELSE user_id END AS mark, {_DAYS}
        FROM events""",
    "upsert_deletes": f"""
        SELECT event_id, event_type, CASE WHEN event_id % 5 = 1 THEN value + 1 ELSE value END::DECIMAL(15,2)::DOUBLE AS amount,
               epoch_us(ts) - CASE WHEN event_id % 5 = 1 THEN 7 ELSE 0 END AS tstamp,
               epoch_us(ts) + CASE WHEN event_id % 5 = 1 THEN 200 ELSE 0 END AS change_micros, {_DAYS}
        FROM events WHERE event_id % 5 = 1 OR (event_id % 5 IN (3, 4) AND event_id % 97 <> 0)""",
    "job_metrics": """
        SELECT mode, metric, n::BIGINT AS n FROM (
          SELECT 'FULL' AS mode, count(*) AS records, count(*) AS images, count(*) FILTER (event_id % 97 <> 0) AS keyed, 0 AS deletes,
                 count(*) FILTER (event_id % 97 <> 0) AS rows, count(*) FILTER (event_id % 97 <> 0) AS merged, 0 AS deleted FROM events
          UNION ALL
          SELECT 'INC', count(*) FILTER (event_id % 5 < 4) + count(*) FILTER (event_id % 5 IN (1, 2)), count(*) FILTER (event_id % 5 IN (1, 2)),
                 count(*) FILTER (event_id % 5 IN (1, 2)), count(*) FILTER (event_id % 5 < 4), count(*) FILTER (event_id % 5 = 1),
                 count(*) FILTER (event_id % 5 = 1), count(*) FILTER (event_id % 5 < 3 AND event_id % 97 <> 0) FROM events
        ) UNPIVOT (n FOR metric IN (records, images, keyed, deletes, rows, merged, deleted))""",
    "export_key_collision": """
        SELECT 'p-q-' || (o_orderkey // 2) AS id, CASE WHEN o_orderkey % 2 = 0 THEN 'p-q' ELSE 'p' END AS head,
               CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE 'q-' END || (o_orderkey // 2) AS tail, o_orderkey AS order_key
        FROM orders""",
    "sink_declared_output": f"SELECT id, event_id, amount, detail_note FROM ({_EXPORTED})",
    "export_full": _EXPORTED,
    "export_incremental": _EXPORTED,
    "export_from_spec": f"""
        SELECT id, user_id, event_id, amount AS paid, created_at AS seen_at,
               date_trunc('second', created_at) AS tstamp, CAST(round(amount * 100) AS BIGINT) AS paid_cents,
               CAST(round(amount * 100) AS BIGINT) > 2000 AS is_large, momento_ingestion, job_process_date,
               year, month, day
        FROM ({_EXPORTED}) WHERE amount > 5 AND event_type <> 'signup'""",
    "export_to_upsert": f"""
        SELECT * REPLACE (
          CASE WHEN event_type = 'click' THEN CAST(CAST(amount + 1 AS DECIMAL(15,2)) AS DOUBLE) ELSE amount END AS amount,
          CASE WHEN event_type = 'click' THEN tstamp + 1 ELSE tstamp END AS tstamp)
        FROM ({_EXPORTED})""",
}
