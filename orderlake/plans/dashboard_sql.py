"""The dashboards as SQL text, for a SQL dashboard tool.

K1-K8 run with ``spark.sql`` over the persistent gold views of
:mod:`orderlake.plans.gold` (``{v_orders}`` and so on stand for their names) and
return the same rows as the DataFrame functions of the same name in
:mod:`orderlake.plans.dashboard`.  K9 and K10 read the gold tables that
:mod:`orderlake.registry_io` writes for them.  A test compares every text with
its DataFrame form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from orderlake.plans.gold import VIEWS
from orderlake.sources.zones import Lake

DASHBOARD_SQL: dict[str, str] = {
    "kpi_headline": """
SELECT count(*) AS orders, count(DISTINCT o_custkey) AS customers, count(lines) AS orders_with_lines,
       CAST(sum(lines) AS BIGINT) AS lines, CAST(sum(units) AS DECIMAL(38,2)) AS units,
       CAST(sum(net) AS DECIMAL(38,4)) AS net_revenue,
       CAST(CAST(sum(net) AS DECIMAL(38,4)) AS DOUBLE) / count(lines) AS avg_order_value
FROM {v_orders}""",

    "kpi_monthly_region": """
SELECT region, month, sum(orders) AS orders, CAST(sum(net) AS DECIMAL(38,4)) AS net_revenue
FROM {v_months} GROUP BY region, month""",

    "kpi_geo_rollup": """
SELECT region, nation, CAST(grouping_id() AS INT) AS level, sum(orders) AS orders,
       CAST(sum(net) AS DECIMAL(38,4)) AS net_revenue
FROM {v_months} GROUP BY ROLLUP (region, nation)""",

    "kpi_top_products": """
WITH ranked AS (
  SELECT region, part_key, net_revenue, row_number() OVER (PARTITION BY region ORDER BY net_revenue DESC, part_key ASC) AS rank
  FROM (SELECT region, part_key, CAST(sum(net) AS DECIMAL(38,4)) AS net_revenue
        FROM {v_lines} WHERE region IS NOT NULL GROUP BY region, part_key))
SELECT region, CAST(rank AS INT) AS rank, part_key AS p_partkey, p_name, p_brand, net_revenue
FROM ranked LEFT JOIN {v_products} ON part_key = p_partkey
WHERE rank <= 5""",

    "kpi_period_change": """
WITH yearly AS (
  SELECT region, CAST(year(month) AS INT) AS year, CAST(sum(net) AS DECIMAL(38,4)) AS net_revenue
  FROM {v_months} GROUP BY region, year(month)),
c AS (
  SELECT region, year, net_revenue,
         lag(round(net_revenue, 2)) OVER (PARTITION BY region ORDER BY year) AS prev_revenue
  FROM yearly)
SELECT region, year, net_revenue, prev_revenue, round(net_revenue, 2) - prev_revenue AS change,
       CASE WHEN prev_revenue != 0 THEN CAST(round(net_revenue, 2) - prev_revenue AS DOUBLE)
                                        / CAST(prev_revenue AS DOUBLE) * 100.0 END AS change_pct
FROM c""",

    "kpi_running_total": """
WITH monthly AS (
  SELECT CAST(year(month) AS INT) AS year, month, CAST(sum(net) AS DECIMAL(38,4)) AS net_revenue
  FROM {v_months} GROUP BY month)
SELECT year, month, net_revenue,
       CAST(sum(net_revenue) OVER (PARTITION BY year ORDER BY month
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(38,4)) AS ytd_revenue
FROM monthly""",

    "kpi_new_returning": """
WITH cm AS (SELECT o_custkey, month, count(*) AS n FROM {v_orders} GROUP BY o_custkey, month),
f AS (SELECT *, month = min(month) OVER (PARTITION BY o_custkey) AS is_new FROM cm)
SELECT month, count(*) AS active_customers, count_if(is_new) AS new_customers,
       count_if(NOT is_new) AS returning_customers,
       CAST(sum(CASE WHEN is_new THEN n ELSE 0 END) AS BIGINT) AS orders_new,
       CAST(sum(CASE WHEN NOT is_new THEN n ELSE 0 END) AS BIGINT) AS orders_returning
FROM f GROUP BY month""",

    "kpi_returns_status": """
WITH per_part AS (
  SELECT part_key, count(*) AS lines, count_if(returned) AS returned, count_if(o_orderstatus = 'F') AS lines_f,
         count_if(o_orderstatus = 'O') AS lines_o, count_if(o_orderstatus = 'P') AS lines_p
  FROM {v_lines} GROUP BY part_key),
by_brand AS (
  SELECT coalesce(p_brand, 'UNKNOWN') AS p_brand, CAST(sum(lines) AS BIGINT) AS lines,
         CAST(sum(returned) AS BIGINT) AS returned, CAST(sum(lines_f) AS BIGINT) AS lines_f,
         CAST(sum(lines_o) AS BIGINT) AS lines_o, CAST(sum(lines_p) AS BIGINT) AS lines_p
  FROM per_part LEFT JOIN {v_products} ON part_key = p_partkey GROUP BY coalesce(p_brand, 'UNKNOWN'))
SELECT *, returned / lines AS return_rate FROM by_brand""",
}


def _panel(source: str, view: str, checks: list[tuple[str, str, str, float]]) -> str:
    """One table's part of the quality panel: (rule, family, failing rows, threshold) from one scan of ``view``."""
    counts = ", ".join(f"count_if(coalesce({fails}, false)) AS f{i}" for i, (_, _, fails, _) in enumerate(checks))
    rows = ", ".join(f"'{rule}', '{family}', f{i}, CAST({least} AS DOUBLE)" for i, (rule, family, _, least) in enumerate(checks))
    return f"""
SELECT '{source}' AS source_table, rule, family, n AS checked, failed,
       CASE WHEN n = 0 THEN 1.0D ELSE (n - failed) / n END AS pass_rate, CASE WHEN n = 0 THEN 1.0D ELSE (n - failed) / n END >= least AS passed
FROM (SELECT n, stack({len(checks)}, {rows}) AS (rule, family, failed, least) FROM (SELECT count(*) AS n, {counts} FROM {view}))"""


def _refers(view: str, column: str, other: str, key: str) -> str:
    return f"(SELECT a.*, a.{column} IS NOT NULL AND b._known IS NULL AS _orphan FROM {view} a LEFT JOIN (SELECT DISTINCT {key}, true AS _known FROM {other}) b ON a.{column} = b.{key})"


#: K9 over views named ``silver_orders``, ``customer``, ``orders``, ``lineitem`` and ``events``.
QUALITY_PANEL_SQL = "\nUNION ALL".join([
    _panel("silver_orders", _refers("silver_orders", "customer_id", "customer", "c_custkey"), [
        ("order_date_complete", "completeness", "order_date IS NULL", 1.0), ("amount_complete", "completeness", "amount IS NULL", 1.0),
        ("amount_non_negative", "range", "amount < 0", 1.0), ("status_in_set", "domain", "status NOT IN ('O', 'F', 'P')", 1.0),
        ("customer_id_complete", "completeness", "customer_id IS NULL", 1.0), ("customer_id_known", "referential", "_orphan", 1.0),
        ("priority_complete", "completeness", "priority IS NULL", 0.5)]),
    _panel("lineitem", _refers("lineitem", "l_orderkey", "orders", "o_orderkey"), [
        ("l_returnflag_in_set", "domain", "l_returnflag NOT IN ('R', 'A', 'N')", 1.0),
        ("l_discount_in_range", "range", "l_discount < 0 OR l_discount > 0.1D", 1.0),
        ("l_orderkey_refers_to_o_orderkey", "referential", "_orphan", 1.0)]),
    _panel("customer", "customer", [("c_name_complete", "completeness", "c_name IS NULL", 1.0), ("c_acctbal_in_range", "range", "c_acctbal < 0", 0.9)]),
    _panel("events", "events", [("user_id_complete", "completeness", "user_id IS NULL", 1.0), ("value_in_range", "range", "value < 0", 1.0),
                                ("props_matches", "pattern", "NOT rlike(props, '^[{{]\"k\": [0-9]+[}}]$')", 1.0)])]).replace("{{", "{").replace("}}", "}")

#: K10 over the two gold tables ``{wh}`` and ``{lake}``, month by month and status by status.
PARITY_SQL = """
WITH only_wh AS (SELECT month, o_orderstatus, count(*) AS n FROM (SELECT * FROM {wh} EXCEPT ALL SELECT * FROM {lake}) GROUP BY ALL),
only_lake AS (SELECT month, o_orderstatus, count(*) AS n FROM (SELECT * FROM {lake} EXCEPT ALL SELECT * FROM {wh}) GROUP BY ALL),
pairs AS (
  SELECT coalesce(w.month, l.month) AS month, coalesce(w.o_orderstatus, l.o_orderstatus) AS o_orderstatus, w.orders AS wh_orders,
         l.orders AS lake_orders, w.total AS wh_total, l.total AS lake_total, w.in_wh, l.in_lake
  FROM (SELECT DISTINCT *, true AS in_wh FROM {wh}) w FULL OUTER JOIN (SELECT DISTINCT *, true AS in_lake FROM {lake}) l
    ON w.month <=> l.month AND w.o_orderstatus <=> l.o_orderstatus)
SELECT p.month, p.o_orderstatus, wh_orders, lake_orders, wh_total, lake_total,
       CASE WHEN in_lake IS NULL THEN 'only_wh' WHEN in_wh IS NULL THEN 'only_lake'
            WHEN wh_orders <=> lake_orders AND wh_total <=> lake_total AND a.n IS NULL AND b.n IS NULL THEN 'match' ELSE 'differ' END AS status,
       coalesce(a.n, 0) AS only_wh_rows, coalesce(b.n, 0) AS only_lake_rows
FROM pairs p LEFT JOIN only_wh a ON p.month <=> a.month AND p.o_orderstatus <=> a.o_orderstatus
LEFT JOIN only_lake b ON p.month <=> b.month AND p.o_orderstatus <=> b.o_orderstatus"""


def run_dashboard(lake: Lake, name: str) -> DataFrame:
    """Run one dashboard text over the lake's gold views."""
    return lake.spark.sql(DASHBOARD_SQL[name].format(**{v: lake.name("gold", v) for v in VIEWS}))
