"""DuckDB texts that compute the same results as the registered Spark queries.

They run on the source tables registered as views (region nation customer
supplier part orders lineitem events ...).  Types follow :func:`registry.present`:
decimals as DOUBLE, calendar dates as TIMESTAMP, sums of integers as BIGINT.
"""

from __future__ import annotations

from orderlake.fixtures import RAW_ORDERS_SQL

NET = "(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))))"

CLEANED = r"""
cleaned AS (
  SELECT TRY_CAST(trim(order_id) AS BIGINT) AS order_id,
         TRY_CAST(NULLIF(trim(customer_id), '') AS BIGINT) AS customer_id,
         CAST(COALESCE(try_strptime(trim(order_date), '%Y-%m-%d'),
                       try_strptime(trim(order_date), '%d/%m/%Y')) AS DATE) AS order_date,
         TRY_CAST(NULLIF(trim(amount), '') AS DECIMAL(12,2)) AS amount,
         upper(regexp_replace(trim(status), '\s+', ' ', 'g')) AS status,
         CASE WHEN NULLIF(trim(priority), '') = '4-NOT SPECIFIED' THEN NULL
              ELSE NULLIF(trim(priority), '') END AS priority,
         seq
  FROM raw_orders
),
silver AS (
  SELECT * FROM (SELECT DISTINCT * FROM cleaned)
  QUALIFY order_id IS NULL
       OR row_number() OVER (PARTITION BY order_id ORDER BY seq DESC, status ASC NULLS LAST) = 1
)"""

WITH_SILVER = "WITH " + RAW_ORDERS_SQL.strip() + "," + CLEANED

GEO = """geo AS (SELECT n_nationkey, n_name AS nation, r_name AS region
        FROM nation JOIN region ON n_regionkey = r_regionkey)"""
TOT = f"""tot AS (SELECT l_orderkey, count(*) AS lines, sum(CAST(l_quantity AS DECIMAL(12,2))) AS units,
               sum({NET}) AS net, count_if(l_returnflag = 'R') AS returned
        FROM lineitem GROUP BY l_orderkey)"""
OG = """og AS (SELECT o_orderkey, o_custkey, o_orderdate, o_orderstatus,
              COALESCE(g.region, 'UNKNOWN') AS region, COALESCE(g.nation, 'UNKNOWN') AS nation
       FROM orders LEFT JOIN customer ON o_custkey = c_custkey
       LEFT JOIN geo g ON c_nationkey = g.n_nationkey)"""


def date_key_sql(c: str) -> str:
    return f"CAST(year({c}) * 10000 + month({c}) * 100 + day({c}) AS INTEGER)"


def report_sql(source: str, rules, table: str | None = None) -> str:
    """One-scan rule report: rules are (name, family, failing predicate, min_pass)."""
    counts = ", ".join(f"CAST(count_if(COALESCE({fail}, false)) AS BIGINT) AS f{i}"
                       for i, (_n, _f, fail, _m) in enumerate(rules))
    tbl = f"'{table}' AS source_table, " if table else ""
    parts = " UNION ALL ".join(
        f"SELECT {tbl}'{name}' AS rule, '{family}' AS family, n AS checked, f{i} AS failed, "
        f"CAST({min_pass!r} AS DOUBLE) AS min_pass FROM c"
        for i, (name, family, _fail, min_pass) in enumerate(rules))
    cols = "source_table, " if table else ""
    return f"""(WITH c AS (SELECT count(*) AS n, {counts} FROM {source})
  SELECT {cols}rule, family, checked, failed,
         CASE WHEN checked = 0 THEN 1.0 ELSE (checked - failed) / checked END AS pass_rate,
         CASE WHEN checked = 0 THEN 1.0 ELSE (checked - failed) / checked END >= min_pass AS passed
  FROM ({parts}))"""


def ref_source(table: str, col: str, other: str, key: str, flag: str) -> str:
    return (f"(SELECT t.*, k.{key} IS NOT NULL AS {flag} FROM {table} t "
            f"LEFT JOIN (SELECT DISTINCT {key} FROM {other}) k ON t.{col} = k.{key})")


ORDER_RULES = [
    ("order_date_complete", "completeness", "order_date IS NULL", 1.0),
    ("amount_complete", "completeness", "amount IS NULL", 1.0),
    ("amount_non_negative", "range", "amount < 0", 1.0),
    ("status_in_set", "domain", "status NOT IN ('O', 'F', 'P')", 1.0),
    ("customer_id_complete", "completeness", "customer_id IS NULL", 1.0),
    ("customer_id_known", "referential", "customer_id IS NOT NULL AND NOT _known", 1.0),
]
REPORT_RULES = ORDER_RULES + [("priority_complete", "completeness", "priority IS NULL", 0.5)]
SILVER_REF = ref_source("silver", "customer_id", "customer", "c_custkey", "_known")

PROPS = r"""NOT regexp_matches(props, '^\{"k": [0-9]+\}$')"""

SQL: dict[str, str] = {}

# -- C ------------------------------------------------------------------------
SQL["clean_standardise"] = WITH_SILVER + """
SELECT upper(regexp_replace(trim(order_id), '\\s+', ' ', 'g')) AS order_id,
       upper(regexp_replace(trim(customer_id), '\\s+', ' ', 'g')) AS customer_id,
       upper(regexp_replace(trim(order_date), '\\s+', ' ', 'g')) AS order_date,
       upper(regexp_replace(trim(amount), '\\s+', ' ', 'g')) AS amount,
       upper(regexp_replace(trim(status), '\\s+', ' ', 'g')) AS status,
       upper(regexp_replace(trim(priority), '\\s+', ' ', 'g')) AS priority,
       seq
FROM raw_orders""".replace("\\\\", "\\")

SQL["clean_parse_typed"] = WITH_SILVER + """
SELECT TRY_CAST(trim(order_id) AS BIGINT) AS order_id,
       TRY_CAST(trim(customer_id) AS BIGINT) AS customer_id,
       CAST(CAST(COALESCE(try_strptime(trim(order_date), '%Y-%m-%d'),
                          try_strptime(trim(order_date), '%d/%m/%Y')) AS DATE) AS TIMESTAMP) AS order_date,
       CAST(TRY_CAST(trim(amount) AS DECIMAL(12,2)) AS DOUBLE) AS amount,
       status, priority, seq
FROM raw_orders"""

SQL["clean_null_sentinels"] = WITH_SILVER + """
SELECT NULLIF(trim(order_id), '') AS order_id,
       NULLIF(trim(customer_id), '') AS customer_id,
       NULLIF(trim(order_date), '') AS order_date,
       NULLIF(trim(amount), '') AS amount,
       NULLIF(trim(status), '') AS status,
       CASE WHEN NULLIF(trim(priority), '') = '4-NOT SPECIFIED' THEN NULL ELSE NULLIF(trim(priority), '') END AS priority,
       seq
FROM raw_orders"""

_SILVER_OUT = """order_id, customer_id, CAST(order_date AS TIMESTAMP) AS order_date,
       CAST(amount AS DOUBLE) AS amount, status, priority, seq"""

SQL["clean_drop_resends"] = WITH_SILVER + f"""
SELECT {_SILVER_OUT} FROM (SELECT DISTINCT * FROM cleaned)"""

SQL["clean_latest_per_key"] = WITH_SILVER + f"""
SELECT {_SILVER_OUT} FROM cleaned
QUALIFY order_id IS NULL
     OR row_number() OVER (PARTITION BY order_id ORDER BY seq DESC, status ASC NULLS LAST) = 1"""

_FAILED_LIST = "concat_ws(',', " + ", ".join(
    f"CASE WHEN {fail} THEN '{name}' END" for name, _f, fail, _m in ORDER_RULES) + ")"

SQL["clean_quarantine"] = WITH_SILVER + f"""
SELECT order_id, {_FAILED_LIST} AS failed_rules, {_FAILED_LIST} = '' AS is_valid
FROM {SILVER_REF}"""

SQL["clean_orphans"] = WITH_SILVER + """
SELECT s.order_id, s.customer_id, COALESCE(k.c_custkey, -1) AS customer_id_resolved
FROM silver s LEFT JOIN (SELECT DISTINCT c_custkey FROM customer) k ON s.customer_id = k.c_custkey"""

# -- Q ------------------------------------------------------------------------
SQL["dq_completeness"] = WITH_SILVER + "\nSELECT * FROM " + report_sql("silver", [
    (f"{c}_complete", "completeness", f"{c} IS NULL", 0.9)
    for c in ("customer_id", "order_date", "amount", "priority")])


def _uniq(source: str, cols: str, name: str, table: str, min_pass: float) -> str:
    return f"""SELECT '{table}' AS source_table, '{name}' AS rule, 'uniqueness' AS family, checked, distinct_keys,
       duplicate_keys, failed,
       CASE WHEN checked = 0 THEN 1.0 ELSE (checked - failed) / checked END AS pass_rate,
       CASE WHEN checked = 0 THEN 1.0 ELSE (checked - failed) / checked END >= {min_pass!r} AS passed
FROM (SELECT CAST(sum(c) AS BIGINT) AS checked, count(*) AS distinct_keys,
             CAST(count_if(c > 1) AS BIGINT) AS duplicate_keys,
             CAST(COALESCE(sum(CASE WHEN c > 1 THEN c - 1 END), 0) AS BIGINT) AS failed
      FROM (SELECT {cols}, count(*) AS c FROM {source} GROUP BY {cols}))"""


SQL["dq_uniqueness"] = WITH_SILVER + "\n" + "\nUNION ALL\n".join([
    _uniq("cleaned", "order_id", "unique(order_id)", "raw_orders", 1.0),
    _uniq("orders", "o_orderkey", "unique(o_orderkey)", "orders", 1.0),
    _uniq("lineitem", "l_orderkey, l_linenumber", "unique(l_orderkey,l_linenumber)", "lineitem", 0.9)])

SQL["dq_domain"] = WITH_SILVER + "\nSELECT * FROM " + "\nUNION ALL SELECT * FROM ".join([
    report_sql("silver", [("status_in_set", "domain", "status NOT IN ('O', 'F', 'P')", 1.0)], "silver_orders"),
    report_sql("lineitem", [("l_returnflag_in_set", "domain", "l_returnflag NOT IN ('R', 'A', 'N')", 1.0),
                            ("l_linestatus_in_set", "domain", "l_linestatus NOT IN ('O', 'F')", 1.0)], "lineitem"),
    report_sql("events", [("event_type_in_set", "domain",
                           "event_type NOT IN ('signup', 'click', 'view', 'purchase', 'error')", 1.0)], "events")])

SQL["dq_range"] = WITH_SILVER + "\nSELECT * FROM " + "\nUNION ALL SELECT * FROM ".join([
    report_sql("silver", [("amount_in_range", "range", "amount < 0", 1.0)], "silver_orders"),
    report_sql("lineitem", [("l_discount_in_range", "range", "l_discount < 0 OR l_discount > 0.1", 1.0),
                            ("l_quantity_in_range", "range", "l_quantity < 1 OR l_quantity > 50", 1.0),
                            ("l_tax_in_range", "range", "l_tax < 0 OR l_tax > 0.08", 1.0)], "lineitem"),
    report_sql("customer", [("c_acctbal_in_range", "range", "c_acctbal < 0", 0.9)], "customer")])

SQL["dq_pattern"] = WITH_SILVER + "\nSELECT * FROM " + "\nUNION ALL SELECT * FROM ".join([
    report_sql("raw_orders", [
        ("order_id_matches", "pattern", "NOT regexp_matches(order_id, '^[0-9]+$')", 0.9),
        ("order_date_matches", "pattern", "NOT regexp_matches(order_date, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$')", 0.9),
        ("amount_matches", "pattern", r"NOT regexp_matches(amount, '^-?[0-9]+\.[0-9]{2}$')", 0.9),
        ("priority_matches", "pattern", "NOT regexp_matches(priority, '^[1-5]-[A-Z ]+$')", 0.9)], "raw_orders"),
    report_sql("events", [("props_matches", "pattern", PROPS, 1.0)], "events")])

SQL["dq_referential"] = WITH_SILVER + "\nSELECT * FROM " + "\nUNION ALL SELECT * FROM ".join([
    report_sql(ref_source("orders", "o_custkey", "customer", "c_custkey", "_k1"),
               [("o_custkey_refers_to_c_custkey", "referential", "o_custkey IS NOT NULL AND NOT _k1", 1.0)],
               "orders"),
    report_sql("(SELECT l.*, k1.o_orderkey IS NOT NULL AS _k1, k2.p_partkey IS NOT NULL AS _k2, "
               "k3.s_suppkey IS NOT NULL AS _k3 FROM lineitem l "
               "LEFT JOIN (SELECT DISTINCT o_orderkey FROM orders) k1 ON l.l_orderkey = k1.o_orderkey "
               "LEFT JOIN (SELECT DISTINCT p_partkey FROM part) k2 ON l.l_partkey = k2.p_partkey "
               "LEFT JOIN (SELECT DISTINCT s_suppkey FROM supplier) k3 ON l.l_suppkey = k3.s_suppkey)",
               [("l_orderkey_refers_to_o_orderkey", "referential", "l_orderkey IS NOT NULL AND NOT _k1", 1.0),
                ("l_partkey_refers_to_p_partkey", "referential", "l_partkey IS NOT NULL AND NOT _k2", 1.0),
                ("l_suppkey_refers_to_s_suppkey", "referential", "l_suppkey IS NOT NULL AND NOT _k3", 1.0)],
               "lineitem"),
    report_sql(SILVER_REF, [("customer_id_refers_to_c_custkey", "referential",
                             "customer_id IS NOT NULL AND NOT _known", 0.95)], "silver_orders")])

SQL["dq_cross_table"] = WITH_SILVER + "\nSELECT * FROM " + "\nUNION ALL SELECT * FROM ".join([
    report_sql("(SELECT l_shipdate, o_orderdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey)",
               [("ship_not_before_order", "expression", "NOT (l_shipdate >= o_orderdate)", 0.5)], "lineitem"),
    report_sql(f"(SELECT o_totalprice, lines_total FROM orders JOIN "
               f"(SELECT l_orderkey, sum({NET} * (1 + CAST(l_tax AS DECIMAL(4,2)))) AS lines_total "
               f"FROM lineitem GROUP BY l_orderkey) t ON o_orderkey = t.l_orderkey)",
               [("total_matches_lines", "expression",
                 "NOT (abs(CAST(o_totalprice AS DECIMAL(12,2)) - lines_total) <= 0.01)", 0.0)], "orders")])


def _volume(table: str, col: str, lo: int, hi: int, as_of: str, max_age: int) -> str:
    return f"""SELECT '{table}' AS source_table, count(*) AS days, CAST(sum(c) AS BIGINT) AS row_count,
       min(c) AS min_rows_per_day, max(c) AS max_rows_per_day,
       CAST(count_if(c < {lo} OR c > {hi}) AS BIGINT) AS days_out_of_bounds,
       count_if(c < {lo} OR c > {hi}) = 0 AS volume_ok,
       CAST(max(d) AS TIMESTAMP) AS newest,
       CAST(date_diff('day', max(d), DATE '{as_of}') AS INTEGER) AS age_days,
       date_diff('day', max(d), DATE '{as_of}') <= {max_age} AS fresh
FROM (SELECT CAST({col} AS DATE) AS d, count(*) AS c FROM {table} GROUP BY 1)"""


SQL["dq_volume_freshness"] = "\nUNION ALL\n".join([
    _volume("orders", "o_orderdate", 1, 50, "2024-02-01", 30),
    _volume("lineitem", "l_shipdate", 1, 200, "2024-02-01", 30),
    _volume("events", "ts", 100, 1000, "2024-02-01", 30)])

SQL["dq_report"] = WITH_SILVER + "\nSELECT * FROM " + report_sql(SILVER_REF, REPORT_RULES)

SQL["dq_enforced_orders"] = WITH_SILVER + f"""
SELECT {_SILVER_OUT} FROM {SILVER_REF}
WHERE NOT ({" OR ".join(f"COALESCE({fail}, false)" for _n, _f, fail, _m in ORDER_RULES)})"""

# -- M ------------------------------------------------------------------------
SQL["dim_date"] = f"""
WITH b AS (SELECT min(lo) AS lo, max(hi) AS hi FROM (
             SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders
             UNION ALL SELECT min(l_shipdate), max(l_shipdate) FROM lineitem)),
d AS (SELECT CAST(unnest(generate_series(CAST(lo AS DATE), CAST(hi AS DATE), INTERVAL 1 DAY)) AS DATE) AS d FROM b)
SELECT {date_key_sql("d")} AS date_key, CAST(d AS TIMESTAMP) AS "date", CAST(year(d) AS INTEGER) AS "year",
       CAST(quarter(d) AS INTEGER) AS "quarter", CAST(month(d) AS INTEGER) AS "month",
       CAST(day(d) AS INTEGER) AS "day", CAST(isodow(d) AS INTEGER) AS iso_weekday, isodow(d) >= 6 AS is_weekend
FROM d UNION ALL SELECT -1, NULL, NULL, NULL, NULL, NULL, NULL, NULL"""

SQL["dim_customer"] = f"""
WITH {GEO}
SELECT md5(length(CAST(c_custkey AS VARCHAR)) || ':' || CAST(c_custkey AS VARCHAR)) AS customer_sk, c_custkey, c_name, c_mktsegment, g.nation, g.region
FROM customer LEFT JOIN geo g ON c_nationkey = g.n_nationkey
UNION ALL SELECT md5('2:-1'), -1, 'UNKNOWN', 'UNKNOWN', 'UNKNOWN', 'UNKNOWN'"""

SQL["dim_product"] = """
SELECT md5(length(CAST(p_partkey AS VARCHAR)) || ':' || CAST(p_partkey AS VARCHAR)) AS product_sk, p_partkey, p_name, p_brand, p_type, p_size,
       CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS DOUBLE) AS retail_price,
       CASE WHEN p_retailprice < 930.0 THEN 'LOW' WHEN p_retailprice < 970.0 THEN 'MID' ELSE 'HIGH' END AS price_band
FROM part
UNION ALL SELECT md5('2:-1'), -1, 'UNKNOWN', 'UNKNOWN', 'UNKNOWN', NULL, NULL, 'UNKNOWN'"""

SQL["dim_supplier"] = f"""
WITH {GEO}
SELECT md5(length(CAST(s_suppkey AS VARCHAR)) || ':' || CAST(s_suppkey AS VARCHAR)) AS supplier_sk, s_suppkey, s_name, g.nation, g.region
FROM supplier LEFT JOIN geo g ON s_nationkey = g.n_nationkey
UNION ALL SELECT md5('2:-1'), -1, 'UNKNOWN', 'UNKNOWN', 'UNKNOWN'"""

SQL["dim_surrogate_unknown"] = """
SELECT md5(length(CAST(l_partkey AS VARCHAR)) || ':' || l_partkey || '~' || length(CAST(l_suppkey AS VARCHAR)) || ':' || l_suppkey) AS part_supplier_sk,
       l_partkey, l_suppkey
FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)
UNION ALL SELECT md5('2:-1~2:-1'), -1, -1"""

SQL["fact_sales"] = f"""
WITH o AS (SELECT o_orderkey, o_orderdate, COALESCE(k.c_custkey, -1) AS cust_key
           FROM orders LEFT JOIN (SELECT DISTINCT c_custkey FROM customer) k ON o_custkey = k.c_custkey)
SELECT l_orderkey, l_linenumber,
       COALESCE({date_key_sql("o.o_orderdate")}, -1) AS order_date_key,
       COALESCE({date_key_sql("l_shipdate")}, -1) AS ship_date_key,
       md5(length(CAST(COALESCE(o.cust_key, -1) AS VARCHAR)) || ':' || CAST(COALESCE(o.cust_key, -1) AS VARCHAR)) AS customer_sk,
       md5(length(CAST(COALESCE(p.p_partkey, -1) AS VARCHAR)) || ':' || CAST(COALESCE(p.p_partkey, -1) AS VARCHAR)) AS product_sk,
       md5(length(CAST(COALESCE(s.s_suppkey, -1) AS VARCHAR)) || ':' || CAST(COALESCE(s.s_suppkey, -1) AS VARCHAR)) AS supplier_sk,
       CAST(CAST(l_quantity AS DECIMAL(12,2)) AS DOUBLE) AS quantity,
       CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DOUBLE) AS gross,
       CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DOUBLE) AS discount,
       CAST({NET} AS DOUBLE) AS net,
       CAST({NET} * CAST(l_tax AS DECIMAL(4,2)) AS DOUBLE) AS tax,
       l_returnflag = 'R' AS returned
FROM lineitem
LEFT JOIN (SELECT DISTINCT p_partkey FROM part) p ON l_partkey = p.p_partkey
LEFT JOIN (SELECT DISTINCT s_suppkey FROM supplier) s ON l_suppkey = s.s_suppkey
LEFT JOIN o ON l_orderkey = o.o_orderkey"""

SQL["star_revenue_by_brand_year"] = f"""
WITH {GEO}
SELECT g.region, COALESCE(p.p_brand, 'UNKNOWN') AS p_brand, CAST(year(o_orderdate) AS INTEGER) AS "year",
       CAST(sum({NET}) AS DOUBLE) AS net_revenue,
       CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS units,
       count(*) AS lines
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN geo g ON c_nationkey = g.n_nationkey AND g.region = 'EUROPE'
LEFT JOIN part p ON l_partkey = p.p_partkey
GROUP BY ALL"""

SQL["star_leap_year_revenue"] = f"""
SELECT r_name AS region, p_brand, CAST(year(o_orderdate) AS INTEGER) AS "year", CAST(sum({NET}) AS DOUBLE) AS net_revenue,
       CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS units, count(*) AS lines
FROM orders, customer, nation, region, lineitem, part
WHERE o_custkey = c_custkey AND c_nationkey = n_nationkey AND n_regionkey = r_regionkey AND r_name = 'EUROPE'
  AND l_orderkey = o_orderkey AND l_partkey = p_partkey AND year(o_orderdate) % 4 = 0
GROUP BY ALL"""

# -- K ------------------------------------------------------------------------
SQL["kpi_headline"] = f"""
WITH {TOT}
SELECT count(*) AS orders, count(DISTINCT o_custkey) AS customers, count(t.l_orderkey) AS orders_with_lines,
       CAST(sum(t.lines) AS BIGINT) AS lines, CAST(sum(t.units) AS DOUBLE) AS units,
       CAST(sum(t.net) AS DOUBLE) AS net_revenue,
       CAST(CAST(sum(t.net) AS DECIMAL(38,4)) AS DOUBLE) / count(t.l_orderkey) AS avg_order_value
FROM orders LEFT JOIN tot t ON o_orderkey = t.l_orderkey"""

SQL["kpi_monthly_region"] = f"""
WITH {GEO}, {TOT}, {OG}
SELECT region, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS "month", count(*) AS orders,
       CAST(sum(net) AS DOUBLE) AS net_revenue
FROM og LEFT JOIN tot ON o_orderkey = l_orderkey
GROUP BY ALL"""

SQL["kpi_geo_rollup"] = f"""
WITH {GEO}, {TOT}, {OG}
SELECT region, nation, CAST(GROUPING(region, nation) AS INTEGER) AS level, count(*) AS orders,
       CAST(sum(net) AS DOUBLE) AS net_revenue
FROM og LEFT JOIN tot ON o_orderkey = l_orderkey
GROUP BY ROLLUP (region, nation)"""

SQL["kpi_top_products"] = f"""
WITH {GEO}, {OG},
pp AS (SELECT og.region, l_partkey, sum({NET}) AS net_revenue
       FROM lineitem JOIN og ON l_orderkey = o_orderkey GROUP BY ALL),
top AS (SELECT *, row_number() OVER (PARTITION BY region ORDER BY net_revenue DESC, l_partkey ASC) AS rnk
        FROM pp QUALIFY rnk <= 5)
SELECT region, CAST(rnk AS INTEGER) AS "rank", l_partkey AS p_partkey, p_name, p_brand,
       CAST(net_revenue AS DOUBLE) AS net_revenue
FROM top LEFT JOIN part ON l_partkey = p_partkey"""

SQL["kpi_period_change"] = f"""
WITH {GEO}, {TOT}, {OG},
y AS (SELECT region, CAST(year(o_orderdate) AS INTEGER) AS "year", CAST(sum(net) AS DECIMAL(38,4)) AS net_revenue
      FROM og LEFT JOIN tot ON o_orderkey = l_orderkey GROUP BY ALL),
c AS (SELECT region, "year", net_revenue,
             lag(round(net_revenue, 2)) OVER (PARTITION BY region ORDER BY "year") AS prev_revenue
      FROM y)
SELECT region, "year", CAST(net_revenue AS DOUBLE) AS net_revenue, CAST(prev_revenue AS DOUBLE) AS prev_revenue,
       CAST(round(net_revenue, 2) - prev_revenue AS DOUBLE) AS change,
       CASE WHEN prev_revenue <> 0 THEN CAST(round(net_revenue, 2) - prev_revenue AS DOUBLE)
                                        / CAST(prev_revenue AS DOUBLE) * 100.0 END AS change_pct
FROM c"""

SQL["kpi_running_total"] = f"""
WITH {TOT},
m AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS "year",
             CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS "month",
             CAST(sum(net) AS DECIMAL(38,4)) AS net_revenue
      FROM orders LEFT JOIN tot ON o_orderkey = l_orderkey GROUP BY ALL)
SELECT "year", "month", CAST(net_revenue AS DOUBLE) AS net_revenue,
       CAST(sum(net_revenue) OVER (PARTITION BY "year" ORDER BY "month"
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS ytd_revenue
FROM m"""

SQL["kpi_new_returning"] = """
WITH cm AS (SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS "month", count(*) AS n
            FROM orders GROUP BY ALL),
f AS (SELECT *, "month" = min("month") OVER (PARTITION BY o_custkey) AS is_new FROM cm)
SELECT "month", count(*) AS active_customers, CAST(count_if(is_new) AS BIGINT) AS new_customers,
       CAST(count_if(NOT is_new) AS BIGINT) AS returning_customers,
       CAST(sum(CASE WHEN is_new THEN n ELSE 0 END) AS BIGINT) AS orders_new,
       CAST(sum(CASE WHEN NOT is_new THEN n ELSE 0 END) AS BIGINT) AS orders_returning
FROM f GROUP BY "month\""""

SQL["kpi_returns_status"] = """
WITH pp AS (SELECT l_partkey, count(*) AS lines, count_if(l_returnflag = 'R') AS returned,
                   count_if(o_orderstatus = 'F') AS lines_f, count_if(o_orderstatus = 'O') AS lines_o,
                   count_if(o_orderstatus = 'P') AS lines_p
            FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey GROUP BY l_partkey)
SELECT COALESCE(p_brand, 'UNKNOWN') AS p_brand, CAST(sum(lines) AS BIGINT) AS lines,
       CAST(sum(returned) AS BIGINT) AS returned, CAST(sum(lines_f) AS BIGINT) AS lines_f,
       CAST(sum(lines_o) AS BIGINT) AS lines_o, CAST(sum(lines_p) AS BIGINT) AS lines_p,
       CAST(sum(returned) AS BIGINT) / CAST(sum(lines) AS BIGINT) AS return_rate
FROM pp LEFT JOIN part ON l_partkey = p_partkey GROUP BY 1"""

SQL["kpi_quality_panel"] = WITH_SILVER + "\nSELECT * FROM " + "\nUNION ALL SELECT * FROM ".join([
    report_sql(SILVER_REF, REPORT_RULES, "silver_orders"),
    report_sql("(SELECT l.*, k.o_orderkey IS NOT NULL AS _k FROM lineitem l "
               "LEFT JOIN (SELECT DISTINCT o_orderkey FROM orders) k ON l.l_orderkey = k.o_orderkey)",
               [("l_returnflag_in_set", "domain", "l_returnflag NOT IN ('R', 'A', 'N')", 1.0),
                ("l_discount_in_range", "range", "l_discount < 0 OR l_discount > 0.1", 1.0),
                ("l_orderkey_refers_to_o_orderkey", "referential", "l_orderkey IS NOT NULL AND NOT _k", 1.0)],
               "lineitem"),
    report_sql("customer", [("c_name_complete", "completeness", "c_name IS NULL", 1.0),
                            ("c_acctbal_in_range", "range", "c_acctbal < 0", 0.9)], "customer"),
    report_sql("events", [("user_id_complete", "completeness", "user_id IS NULL", 1.0),
                          ("value_in_range", "range", "value < 0", 1.0),
                          ("props_matches", "pattern", PROPS, 1.0)], "events")])


def oracle_sql() -> dict[str, str]:
    from orderlake import oracle_io  # noqa: F401  (adds texts for zone and stream queries)
    return dict(SQL)
