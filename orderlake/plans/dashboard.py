"""SQL-dashboard result sets K1-K8 as DataFrame functions over the gold views.

Each function takes the loaded :class:`~orderlake.sources.zones.Lake` and reads
gold alone (:mod:`orderlake.plans.gold`): time and geography come from the
month summary, order measures from the order summary, product measures from the
star's fact, which is reduced to (part, ...) sums before it meets the products.
No dashboard joins lines with orders.

Money stays decimal until the last projection (see functions.money).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlake.functions.money import TOTAL
from orderlake.plans.star import UNKNOWN_LABEL
from orderlake.sources.zones import Lake


# -- K1 -------------------------------------------------------------------------
def kpi_headline(lake: Lake) -> DataFrame:
    agg = lake.read("gold", "v_orders").agg(
        F.count(F.lit(1)).alias("orders"),
        F.countDistinct("o_custkey").alias("customers"),
        F.count("lines").alias("orders_with_lines"),
        F.sum("lines").cast("bigint").alias("lines"),
        F.sum("units").cast("decimal(38,2)").alias("units"),
        F.sum("net").cast(TOTAL).alias("net_revenue"))
    return agg.withColumn("avg_order_value",
                          F.col("net_revenue").cast("double") / F.col("orders_with_lines"))


# -- K2 -------------------------------------------------------------------------
def kpi_monthly_region(lake: Lake) -> DataFrame:
    return (lake.read("gold", "v_months").groupBy("region", "month")
            .agg(F.sum("orders").alias("orders"), F.sum("net").cast(TOTAL).alias("net_revenue")))


# -- K3 -------------------------------------------------------------------------
def kpi_geo_rollup(lake: Lake) -> DataFrame:
    return (lake.read("gold", "v_months").rollup("region", "nation")
            .agg(F.grouping_id().cast("int").alias("level"),
                 F.sum("orders").alias("orders"),
                 F.sum("net").cast(TOTAL).alias("net_revenue")))


# -- K4 -------------------------------------------------------------------------
def kpi_top_products(lake: Lake, n: int = 5) -> DataFrame:
    """Best ``n`` parts by net revenue within each region (lines of unknown parts count as part -1).

    ``row_number() <= n`` is planned with a map-side WindowGroupLimit: each
    input partition forwards at most ``n`` rows per region, so the region
    groups never hold more than ``n x partitions`` rows each.
    """
    per_part = (lake.read("gold", "v_lines").where("region IS NOT NULL").groupBy("region", "part_key")
                .agg(F.sum("net").cast(TOTAL).alias("net_revenue")))
    w = Window.partitionBy("region").orderBy(F.col("net_revenue").desc(), F.col("part_key").asc())
    top = per_part.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
    part = lake.read("gold", "v_products").select("p_partkey", "p_name", "p_brand")
    return (top.join(part, top["part_key"] == part["p_partkey"], "left")
               .select("region", F.col("rank").cast("int").alias("rank"),
                       F.col("part_key").alias("p_partkey"), "p_name", "p_brand", "net_revenue"))


# -- K5 -------------------------------------------------------------------------
def kpi_period_change(lake: Lake) -> DataFrame:
    yearly = (lake.read("gold", "v_months").groupBy("region", F.year("month").cast("int").alias("year"))
              .agg(F.sum("net").cast(TOTAL).alias("net_revenue")))
    w = Window.partitionBy("region").orderBy("year")
    cur = F.round("net_revenue", 2)
    prev = F.lag(cur).over(w)
    out = (yearly.withColumn("prev_revenue", prev)
                 .withColumn("change", F.round("net_revenue", 2) - F.col("prev_revenue")))
    return out.withColumn(
        "change_pct",
        F.when(F.col("prev_revenue") != 0,
               F.col("change").cast("double") / F.col("prev_revenue").cast("double") * F.lit(100.0)))


# -- K6 -------------------------------------------------------------------------
def kpi_running_total(lake: Lake) -> DataFrame:
    monthly = (lake.read("gold", "v_months").groupBy(F.year("month").cast("int").alias("year"), "month")
               .agg(F.sum("net").cast(TOTAL).alias("net_revenue")))
    w = Window.partitionBy("year").orderBy("month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return monthly.withColumn("ytd_revenue", F.sum("net_revenue").over(w).cast(TOTAL))


# -- K7 -------------------------------------------------------------------------
def kpi_new_returning(lake: Lake) -> DataFrame:
    """Customers active per month, split by whether the month is their first.

    Orders are first reduced to (customer, month) counts, so the window that
    finds each customer's first month sees at most one row per active month
    even for a customer that places a large share of all orders.
    """
    cm = lake.read("gold", "v_orders").groupBy("o_custkey", "month").agg(F.count(F.lit(1)).alias("n"))
    first = F.min("month").over(Window.partitionBy("o_custkey"))
    flagged = cm.withColumn("is_new", F.col("month") == first)
    return flagged.groupBy("month").agg(
        F.count(F.lit(1)).alias("active_customers"),
        F.count_if("is_new").alias("new_customers"),
        F.count_if(~F.col("is_new")).alias("returning_customers"),
        F.sum(F.when(F.col("is_new"), F.col("n")).otherwise(0)).cast("bigint").alias("orders_new"),
        F.sum(F.when(~F.col("is_new"), F.col("n")).otherwise(0)).cast("bigint").alias("orders_returning"))


# -- K8 -------------------------------------------------------------------------
def kpi_returns_status(lake: Lake) -> DataFrame:
    """Return rate by brand with the status mix of the orders the lines belong to."""
    per_part = lake.read("gold", "v_lines").groupBy("part_key").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if("returned").alias("returned"),
        F.count_if(F.col("o_orderstatus") == "F").alias("lines_f"),
        F.count_if(F.col("o_orderstatus") == "O").alias("lines_o"),
        F.count_if(F.col("o_orderstatus") == "P").alias("lines_p"))
    part = lake.read("gold", "v_products").select("p_partkey", "p_brand")
    by_brand = (per_part.join(part, per_part["part_key"] == part["p_partkey"], "left")
                        .groupBy(F.coalesce("p_brand", F.lit(UNKNOWN_LABEL)).alias("p_brand"))
                        .agg(*[F.sum(c).cast("bigint").alias(c)
                               for c in ("lines", "returned", "lines_f", "lines_o", "lines_p")]))
    return by_brand.withColumn("return_rate", F.col("returned") / F.col("lines"))
