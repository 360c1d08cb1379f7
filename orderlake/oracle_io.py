"""Oracle texts for queries that land files, write zones or run streams (added on import)."""

from __future__ import annotations

from orderlake.oracle import (GEO, NET, OG, ORDER_RULES, SQL, WITH_SILVER, _SILVER_OUT)

_RULES_OK = "NOT (" + " OR ".join(f"COALESCE({fail}, false)" for _n, _f, fail, _m in ORDER_RULES) + ")"
_BAND = "CASE WHEN p_retailprice < 930.0 THEN 'LOW' WHEN p_retailprice < 970.0 THEN 'MID' ELSE 'HIGH' END"

# -- B ------------------------------------------------------------------------
SQL["bronze_land_orders"] = WITH_SILVER + """
SELECT order_id, customer_id, order_date, amount, status, priority, CAST(seq AS VARCHAR) AS seq, 1 AS _batch_id
FROM raw_orders"""

SQL["bronze_corrupt_capture"] = WITH_SILVER + r"""
SELECT CASE WHEN regexp_matches(order_id, '^-?[0-9]+$') THEN CAST(order_id AS BIGINT) END AS order_id,
       CASE WHEN customer_id = '' THEN NULL ELSE CAST(customer_id AS BIGINT) END AS customer_id,
       CAST(CASE WHEN regexp_matches(amount, '^-?[0-9]+(\.[0-9]+)?$') THEN CAST(amount AS DECIMAL(12,2)) END
            AS DOUBLE) AS amount,
       seq, status,
       NOT regexp_matches(order_id, '^-?[0-9]+$')
         OR (amount <> '' AND NOT regexp_matches(amount, '^-?[0-9]+(\.[0-9]+)?$')) AS is_corrupt
FROM raw_orders"""

SQL["bronze_incremental_rerun"] = "SELECT * FROM orders"
SQL["bronze_stream_files"] = "SELECT * FROM events"

SQL["zone_partition_layout"] = f"""
SELECT CAST(year(l_shipdate) AS INTEGER) AS ship_year, count(*) AS row_count, CAST(sum({NET}) AS DOUBLE) AS net_revenue
FROM lineitem GROUP BY 1"""

SQL["lifecycle_plan"] = """
WITH p AS (SELECT strftime(o_orderdate, '%Y-%m') AS order_month, count(*) AS row_count,
                  CAST(date_diff('day', CAST(date_trunc('month', min(o_orderdate)) AS DATE), DATE '2001-12-31')
                       AS INTEGER) AS age_days
           FROM orders GROUP BY 1)
SELECT order_month, row_count, age_days,
       CASE WHEN age_days < 365 THEN 'keep' WHEN age_days < 1095 THEN 'archive' ELSE 'expire' END AS action
FROM p"""

# -- C8, M7 -------------------------------------------------------------------
SQL["silver_upsert_idempotent"] = WITH_SILVER + f"\nSELECT {_SILVER_OUT} FROM silver"

SQL["dim_incremental"] = f"""
WITH {GEO}
SELECT md5(length(CAST(c_custkey AS VARCHAR)) || ':' || CAST(c_custkey AS VARCHAR)) AS customer_sk, c_custkey, c_name,
       CASE WHEN c_acctbal < 0 THEN 'COLLECTIONS' ELSE c_mktsegment END AS c_mktsegment, g.nation, g.region
FROM customer LEFT JOIN geo g ON c_nationkey = g.n_nationkey
UNION ALL SELECT md5('2:-1'), -1, 'UNKNOWN', 'UNKNOWN', 'UNKNOWN', 'UNKNOWN'"""

# -- X ------------------------------------------------------------------------
SQL["external_pruned_scan"] = f"""
SELECT l_returnflag, count(*) AS lines, CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS units,
       CAST(sum({NET}) AS DOUBLE) AS net_revenue
FROM lineitem WHERE year(l_shipdate) = 1998 AND l_discount > 0.05 GROUP BY 1"""

SQL["external_join_star"] = f"""
SELECT COALESCE({_BAND}, 'UNKNOWN') AS price_band, CAST(year(l_shipdate) AS INTEGER) AS ship_year,
       count(*) AS lines, CAST(sum({NET}) AS DOUBLE) AS net_revenue
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY ALL"""

# -- L ------------------------------------------------------------------------
SQL["stream_silver_orders"] = WITH_SILVER + f"""
SELECT {_SILVER_OUT}
FROM (SELECT c.*, k.c_custkey IS NOT NULL AS _known FROM cleaned c
      LEFT JOIN (SELECT DISTINCT c_custkey FROM customer) k ON c.customer_id = k.c_custkey)
WHERE {_RULES_OK}"""

SQL["stream_enrich"] = f"""
WITH {GEO}
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, g.region, g.nation
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN geo g ON c_nationkey = g.n_nationkey"""

SQL["stream_gold_daily"] = """
SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start,
       CAST(date_trunc('day', ts) + INTERVAL 1 DAY AS TIMESTAMP) AS window_end,
       event_type, count(*) AS events, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS value_sum
FROM events GROUP BY ALL"""

SQL["stream_upsert_latest"] = WITH_SILVER + f"\nSELECT {_SILVER_OUT} FROM silver"

SQL["medallion_end_to_end"] = WITH_SILVER + f"""
SELECT CAST(date_trunc('month', order_date) AS TIMESTAMP) AS "month", status, count(*) AS orders,
       CAST(sum(amount) AS DOUBLE) AS amount
FROM (SELECT s.*, k.c_custkey IS NOT NULL AS _known FROM silver s
      LEFT JOIN (SELECT DISTINCT c_custkey FROM customer) k ON s.customer_id = k.c_custkey)
WHERE {_RULES_OK}
GROUP BY ALL"""

SQL["stream_dedup"] = "SELECT * FROM events"

# -- G ------------------------------------------------------------------------
SQL["gov_tag_columns"] = "SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer"

SQL["gov_mask_pii"] = """
SELECT c_custkey, md5(c_name) AS c_name, c_nationkey, CAST(NULL AS DOUBLE) AS c_acctbal, c_mktsegment
FROM customer"""

SQL["gov_row_filter"] = f"""
WITH {GEO}, {OG}
SELECT o_orderkey, o_custkey, o_orderstatus, region FROM og
WHERE region IN ('EUROPE', 'MIDDLE EAST', 'AFRICA')"""

# -- K10 ----------------------------------------------------------------------
SQL["parity_two_paths"] = WITH_SILVER + f""",
good AS (
  SELECT s.* FROM silver s ANTI JOIN (SELECT order_id FROM silver
    WHERE order_date IS NULL OR amount IS NULL OR amount < 0 OR status NOT IN ('O', 'F', 'P') OR customer_id IS NULL
       OR customer_id NOT IN (SELECT c_custkey FROM customer)) b USING (order_id))
SELECT CAST(date_trunc('month', order_date) AS TIMESTAMP) AS "month", status AS o_orderstatus,
       count(*) AS wh_orders, count(*) AS lake_orders, CAST(sum(amount) AS DOUBLE) AS wh_total, CAST(sum(amount) AS DOUBLE) AS lake_total,
       'match' AS status, CAST(0 AS BIGINT) AS only_wh_rows, CAST(0 AS BIGINT) AS only_lake_rows
FROM good GROUP BY ALL"""

# G4: the zone catalog.  silver.customer carries the source table's own columns
# (read from DuckDB's information_schema); the gold dimension and the bronze
# landing table have the schemas their builders define.
SQL["gov_catalog_columns"] = """
WITH silver_cols AS (
  SELECT DISTINCT 'silver' AS zone, 'customer' AS "table", 'data-eng' AS owner, 'customers, typed' AS comment,
         column_name AS "column",
         CASE upper(data_type) WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
                               WHEN 'VARCHAR' THEN 'string' ELSE lower(data_type) END AS data_type,
         false AS is_partition,
         CASE column_name WHEN 'c_name' THEN 'pii' WHEN 'c_acctbal' THEN 'financial' END AS tags
  FROM information_schema.columns WHERE table_name = 'customer'),
gold_cols AS (
  SELECT 'gold' AS zone, 'dim_customer' AS "table", 'analytics' AS owner, 'customer dimension' AS comment,
         c AS "column", t AS data_type, false AS is_partition, CAST(NULL AS VARCHAR) AS tags
  FROM (VALUES ('customer_sk', 'string'), ('c_custkey', 'bigint'), ('c_name', 'string'),
               ('c_mktsegment', 'string'), ('nation', 'string'), ('region', 'string')) v(c, t)),
bronze_cols AS (
  SELECT 'bronze' AS zone, 'raw_orders' AS "table", 'data-eng' AS owner, 'raw order deliveries' AS comment,
         c AS "column", t AS data_type, p AS is_partition, CAST(NULL AS VARCHAR) AS tags
  FROM (VALUES ('order_id', 'string', false), ('customer_id', 'string', false), ('order_date', 'string', false),
               ('amount', 'string', false), ('status', 'string', false), ('priority', 'string', false),
               ('seq', 'string', false), ('_batch_id', 'int', true), ('_source_file', 'string', false),
               ('_ingested_at', 'timestamp', false)) v(c, t, p))
SELECT * FROM silver_cols UNION ALL SELECT * FROM gold_cols UNION ALL SELECT * FROM bronze_cols"""


# -- B4, B6 -------------------------------------------------------------------
SQL["bronze_continuous"] = "SELECT * FROM events"

SQL["lifecycle_apply"] = """
SELECT strftime(o_orderdate, '%Y-%m') AS order_month,
       CASE WHEN date_diff('day', CAST(date_trunc('month', o_orderdate) AS DATE), DATE '2001-12-31') < 365 THEN 'lake' ELSE 'archive' END AS location,
       count(*) AS row_count
FROM orders WHERE date_diff('day', CAST(date_trunc('month', o_orderdate) AS DATE), DATE '2001-12-31') < 1095
GROUP BY ALL"""

# -- L1, L3, L6, Q10: what streams and rules set aside --------------------------
_SPLIT = f"""
checked AS (
  SELECT CASE WHEN seq <= 1 THEN 0 ELSE 1 END AS batch_id,
         list_filter([{', '.join(f"CASE WHEN {fail} THEN '{name}' END" for name, _f, fail, _m in ORDER_RULES)}], lambda x: x IS NOT NULL) AS failed
  FROM (SELECT c.*, k.c_custkey IS NOT NULL AS _known FROM cleaned c
        LEFT JOIN (SELECT DISTINCT c_custkey FROM customer) k ON c.customer_id = k.c_custkey))"""

SQL["stream_quarantine"] = WITH_SILVER + "," + _SPLIT + f"""
SELECT batch_id, CASE WHEN len(failed) = 0 THEN 'valid' ELSE 'quarantine' END AS side, array_to_string(failed, ',') AS rules, count(*) AS row_count
FROM checked GROUP BY ALL
UNION ALL SELECT batch_id, 'landed', '', count(*) FROM checked GROUP BY batch_id
UNION ALL SELECT batch_id, 'failed', rule, count_if(list_contains(failed, rule))
  FROM checked, (SELECT unnest([{', '.join(f"'{name}'" for name, *_ in ORDER_RULES)}]) AS rule) GROUP BY batch_id, rule"""

SQL["dq_quarantine_table"] = WITH_SILVER + f"""
SELECT * FROM (
  SELECT {_SILVER_OUT.replace("order_id", "s.order_id", 1)},
         concat_ws(',', {', '.join(f"CASE WHEN {fail} THEN '{name}' END" for name, _f, fail, _m in ORDER_RULES)}) AS failed_rules
  FROM (SELECT s.*, k.c_custkey IS NOT NULL AS _known FROM silver s
        LEFT JOIN (SELECT DISTINCT c_custkey FROM customer) k ON s.customer_id = k.c_custkey) s)
WHERE failed_rules <> ''"""

# weeks 1, 3, 2, 4: by the time week 2 comes, week 3 has closed every day but those of its last hour
SQL["stream_gold_late"] = """
WITH closed AS (SELECT max(ts) - INTERVAL 1 HOUR AS w FROM events WHERE ts < TIMESTAMP '2024-01-22')
SELECT CASE WHEN ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15' AND date_trunc('day', ts) + INTERVAL 1 DAY <= w
            THEN 'late' ELSE 'gold' END AS side,
       CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start, count(*) AS events
FROM events, closed GROUP BY ALL"""

SQL["stream_late_events"] = """
WITH landed AS (
  SELECT event_id, ts, ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-22' AS week3,
         CASE WHEN ts < TIMESTAMP '2024-01-15' THEN 2 ELSE 1 END AS copies FROM events),
closed AS (SELECT max(ts) - INTERVAL 2 DAY AS w FROM events),
judged AS (SELECT *, week3 AND ts <= w AS late FROM landed, closed)
SELECT event_id, CASE WHEN late THEN 'late' ELSE 'kept' END AS outcome, CAST(1 AS BIGINT) AS row_count FROM judged
UNION ALL SELECT event_id, 'resent', CAST(copies - 1 AS BIGINT) FROM judged WHERE copies > 1"""
