"""Gold: the loaded star, its summaries, and the views that dashboards read.

:func:`load_gold` writes, in the gold zone,

* the star (``dim_date``, ``dim_customer``, ``dim_product``, ``fact_sales``, M8);
* ``order_summary``: one row per order with its customer's geography and the
  sums of its lines, so no dashboard shuffles lines by order again;
* ``month_summary``: orders and revenue by month, region and nation, at most
  months x 25 rows, for the dashboards on time and geography;

and creates one persistent view per dashboard input (``CREATE VIEW`` in the gold
schema).  :func:`gold_of` loads a folder's tables once per application and again
only when the source files have changed.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.functions.money import TOTAL
from orderlake.plans import star as M
from orderlake.session import _fs
from orderlake.sources.zones import Lake
from orderlake.tables import Tables

_PARTITIONS = "spark.sql.shuffle.partitions"
PART_BYTES = 4 << 20      # of source files: some 400,000 lines
SOURCES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def month_start(c) -> Column:
    return F.trunc(F.col(c) if isinstance(c, str) else c, "month").cast("timestamp_ntz")


def order_summary(t: Tables, lake: Lake) -> DataFrame:
    """Every order once; measures are NULL for an order without lines."""
    per_order = lake.read("gold", "fact_sales").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("quantity").cast("decimal(38,2)").alias("units"),
        F.sum("net").cast(TOTAL).alias("net"), F.count_if("returned").alias("returned"))
    orders = M.orders_geo(t).drop("cust_key")
    return (orders.join(per_order, orders["o_orderkey"] == per_order["l_orderkey"], "left").drop("l_orderkey")
            .withColumn("month", month_start("o_orderdate")).withColumn("order_year", F.year("o_orderdate")))


def month_summary(lake: Lake) -> DataFrame:
    return lake.read("gold", "order_summary").groupBy("month", "region", "nation").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("net").cast(TOTAL).alias("net"))


VIEWS = {
    "v_orders": "SELECT o_orderkey, o_custkey, o_orderdate, o_orderstatus, region, nation, month, lines, units, net, returned FROM {order_summary}",
    "v_months": "SELECT month, region, nation, orders, net FROM {month_summary}",
    "v_lines": "SELECT l_orderkey, part_key, cust_key, region, o_orderstatus, net, quantity, returned, order_year FROM {fact_sales}",
    "v_products": "SELECT p_partkey, p_name, p_brand, p_type, price_band FROM {dim_product}",
}
TABLES = ("order_summary", "month_summary", "fact_sales", "dim_product", "dim_customer", "dim_date")


@contextmanager
def shuffles_for(spark: SparkSession, source_bytes: int):
    """At least one shuffle partition for each ``PART_BYTES`` of the sources while a load runs.

    A join's sort then fits its task whatever the size of the tables; adaptive execution puts small
    partitions together again.  The session's own number stays if it is larger, and returns afterwards.
    """
    before = spark.conf.get(_PARTITIONS)
    spark.conf.set(_PARTITIONS, str(max(int(before), -(-source_bytes // PART_BYTES))))
    try:
        yield
    finally:
        spark.conf.set(_PARTITIONS, before)


def load_gold(t: Tables, lake: Lake) -> None:
    with shuffles_for(t.spark, sum(size for _, size, _ in _files_of(t))):
        M.load_star(t, lake)
        lake.write(order_summary(t, lake), "gold", "order_summary", ["order_year"])
        lake.write(month_summary(lake), "gold", "month_summary")
    names = {n: lake.name("gold", n) for n in TABLES}
    for view, text in VIEWS.items():
        t.spark.sql(f"CREATE OR REPLACE VIEW {lake.name('gold', view)} AS {text.format(**names)}")


_loaded: dict[str, tuple[str, tuple, Lake]] = {}


def _files_of(t: Tables) -> tuple:
    """Names, sizes and times of the source files: metadata only."""
    out = []
    for name in SOURCES:
        fs, p = _fs(t.spark, f"{t.sf_dir}/{name}.parquet")
        status = fs.getFileStatus(p)
        parts = fs.listStatus(p) if status.isDirectory() else [status]
        out += sorted((str(s.getPath()), s.getLen(), s.getModificationTime()) for s in parts)
    return tuple(out)


def gold_of(t: Tables) -> Lake:
    """The loaded gold of a folder: from an earlier call of this application while its sources are unchanged."""
    app, files = t.spark.sparkContext.applicationId, _files_of(t)
    found = _loaded.get(t.sf_dir)
    if found is None or found[:2] != (app, files):
        lake = Lake(t.spark)
        load_gold(t, lake)
        _loaded[t.sf_dir] = (app, files, lake)
    return _loaded[t.sf_dir][2]
