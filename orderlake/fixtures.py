"""``raw_orders``: messy order records derived from the ``orders`` table.

The driver tables are clean, so the defects are planted by arithmetic on the
order key ``k`` (see FIXTURES.md section 2).  One scan of ``orders``; resends
and newer versions are produced by ``explode`` of a per-row version list, not by
re-reading the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RAW_COLUMNS = ("order_id", "customer_id", "order_date", "amount", "status", "priority", "seq")

# Fixed values of the fixture (FIXTURES.md section 2).
IMPOSSIBLE_DATE = "1998-13-45"
ORPHAN_CUSTOMER = "999999999"
BAD_AMOUNT = "abc"
BAD_STATUS = "?"


def raw_orders(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    k_txt = k.cast("string")
    amount_txt = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    # version tags: 0 = base row, 1 = exact resend, 2 = newer version
    versions = F.filter(
        F.array(F.lit(0), F.when(k % 25 == 0, F.lit(1)), F.when(k % 33 == 0, F.lit(2))),
        lambda v: v.isNotNull())
    base_status = (F.when(k % 70 == 7, F.lit(BAD_STATUS))
                   .when(k % 3 == 0, F.concat(F.lit(" "), F.lower("o_orderstatus")))
                   .otherwise(F.col("o_orderstatus")))
    return (orders
            .select("*", F.explode(versions).alias("_v"))
            .select(
                F.when(k % 50 == 0, F.concat(F.lit("  "), k_txt, F.lit(" "))).otherwise(k_txt).alias("order_id"),
                F.when(k % 45 == 4, F.lit(""))
                 .when(k % 45 == 5, F.lit(ORPHAN_CUSTOMER))
                 .otherwise(F.col("o_custkey").cast("string")).alias("customer_id"),
                F.when(k % 60 == 5, F.lit(IMPOSSIBLE_DATE))
                 .when(k % 60 == 6, F.date_format("o_orderdate", "dd/MM/yyyy"))
                 .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("order_date"),
                F.when(k % 40 == 1, F.lit(BAD_AMOUNT))
                 .when(k % 40 == 2, F.lit(""))
                 .when(k % 40 == 3, F.concat(F.lit("-"), amount_txt))
                 .otherwise(amount_txt).alias("amount"),
                F.when(F.col("_v") == 2, F.lit("F")).otherwise(base_status).alias("status"),
                F.col("o_orderpriority").alias("priority"),
                F.when(F.col("_v") == 2, F.lit(2)).otherwise(F.lit(1)).alias("seq"),
            ))


# The same records in DuckDB SQL, used by the oracle texts.
RAW_ORDERS_SQL = """
raw_base AS (
  SELECT o_orderkey AS k,
    CASE WHEN o_orderkey % 50 = 0 THEN '  ' || CAST(o_orderkey AS VARCHAR) || ' '
         ELSE CAST(o_orderkey AS VARCHAR) END AS order_id,
    CASE WHEN o_orderkey % 45 = 4 THEN ''
         WHEN o_orderkey % 45 = 5 THEN '999999999'
         ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
    CASE WHEN o_orderkey % 60 = 5 THEN '1998-13-45'
         WHEN o_orderkey % 60 = 6 THEN strftime(o_orderdate, '%d/%m/%Y')
         ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_date,
    CASE WHEN o_orderkey % 40 = 1 THEN 'abc'
         WHEN o_orderkey % 40 = 2 THEN ''
         WHEN o_orderkey % 40 = 3 THEN '-' || CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR)
         ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END AS amount,
    CASE WHEN o_orderkey % 70 = 7 THEN '?'
         WHEN o_orderkey % 3 = 0 THEN ' ' || lower(o_orderstatus)
         ELSE o_orderstatus END AS status,
    o_orderpriority AS priority,
    1 AS seq
  FROM orders
),
raw_orders AS (
  SELECT order_id, customer_id, order_date, amount, status, priority, seq FROM raw_base
  UNION ALL
  SELECT order_id, customer_id, order_date, amount, status, priority, seq FROM raw_base WHERE k % 25 = 0
  UNION ALL
  SELECT order_id, customer_id, order_date, amount, 'F' AS status, priority, 2 AS seq FROM raw_base WHERE k % 33 = 0
)"""
