"""Star schema M1-M8 and direct queries over lake files X1-X2.

Join strategy.  ``nation`` and ``region`` are bounded by definition (25 and 5
rows), so the flattened geography is broadcast explicitly.  Every other
dimension grows with the data (customer, part and supplier scale linearly with
the scale factor), so those joins carry no hint: the planner broadcasts them
only when their size statistics are below ``autoBroadcastJoinThreshold`` (at
planning time, or at run time under AQE) and otherwise uses a sort-merge join,
which AQE splits when a key is skewed.

Surrogate keys are ``md5`` of the natural key, so facts get their dimension
keys without a lookup table and without a global ``row_number`` (which would
run on one task).  The unknown member has natural key -1.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.functions.dates import date_key
from orderlake.functions.money import discount_amount, gross_amount, money, net_amount, tax_amount
from orderlake.tables import Tables

UNKNOWN = -1
UNKNOWN_LABEL = "UNKNOWN"
# Price bands of the product dimension (upper bounds, exclusive).
PRICE_BANDS = ((930.0, "LOW"), (970.0, "MID"))
TOP_BAND = "HIGH"


def surrogate(*cols) -> Column:
    """Stable surrogate key from the natural key (same value on every run and engine).

    Each part goes in with its length, and NULL as a mark of its own, so
    different natural keys never give the same text.
    """
    parts = []
    for c in cols:
        text = (F.col(c) if isinstance(c, str) else c).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("null")))
    return F.md5(F.concat_ws("~", *parts))


# -- geography (bounded: 25 nations, 5 regions) --------------------------------
def geography(t: Tables) -> DataFrame:
    return (t.nation.join(F.broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey"))
            .select("n_nationkey", F.col("n_name").alias("nation"), F.col("r_name").alias("region")))


# -- M1 -------------------------------------------------------------------------
def dim_date_between(bounds: DataFrame, lo_col: str = "lo", hi_col: str = "hi") -> DataFrame:
    """One row per day between the bounds of a one-row frame (no cross join)."""
    days = bounds.select(F.explode(F.sequence(F.col(lo_col).cast("date"), F.col(hi_col).cast("date"),
                                              F.expr("INTERVAL 1 DAY"))).alias("date"))
    return days.select(
        date_key("date").alias("date_key"),
        "date",
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month"),
        F.dayofmonth("date").alias("day"),
        (F.weekday("date") + 1).alias("iso_weekday"),
        (F.weekday("date") >= 5).alias("is_weekend"))


def dim_date(t: Tables) -> DataFrame:
    """Calendar covering every order date and ship date in the data, and the unknown day (-1)."""
    o = t.orders.agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
    s = t.lineitem.agg(F.min("l_shipdate").alias("lo"), F.max("l_shipdate").alias("hi"))
    bounds = o.unionByName(s).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    days = dim_date_between(bounds)
    unknown = [F.lit(UNKNOWN).alias("date_key")] + [F.lit(None).cast(f.dataType).alias(f.name) for f in days.schema.fields[1:]]
    return days.unionByName(t.spark.range(1).select(*unknown))


# -- M5 -------------------------------------------------------------------------
def with_surrogate(df: DataFrame, natural: Sequence[str], sk: str,
                   unknown: Mapping[str, object] | None = None) -> DataFrame:
    """Adds ``sk`` = md5 of the natural key and appends the unknown member.

    ``unknown`` gives attribute values for the extra row; natural key columns
    get -1 and other columns NULL unless given.
    """
    keyed = df.select(surrogate(*natural).alias(sk), *df.columns)
    vals = dict(unknown or {})
    spark = df.sparkSession
    fields = []
    for f in df.schema.fields:
        if f.name in natural:
            v = F.lit(UNKNOWN).cast(f.dataType)
        elif f.name in vals:
            v = F.lit(vals[f.name]).cast(f.dataType)
        else:
            v = F.lit(None).cast(f.dataType)
        fields.append(v.alias(f.name))
    member = spark.range(1).select(*fields)
    member = member.select(surrogate(*natural).alias(sk), *df.columns)
    return keyed.unionByName(member)


# -- M2, M3, M4 -----------------------------------------------------------------
def dim_customer(t: Tables) -> DataFrame:
    geo = geography(t)
    base = (t.customer.join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select("c_custkey", "c_name", "c_mktsegment", "nation", "region"))
    return with_surrogate(base, ["c_custkey"], "customer_sk",
                          {"c_name": UNKNOWN_LABEL, "c_mktsegment": UNKNOWN_LABEL,
                           "nation": UNKNOWN_LABEL, "region": UNKNOWN_LABEL})


def price_band(c: Column) -> Column:
    expr = None
    for hi, label in PRICE_BANDS:
        expr = F.when(c < F.lit(hi), F.lit(label)) if expr is None else expr.when(c < F.lit(hi), F.lit(label))
    return expr.otherwise(F.lit(TOP_BAND))


def dim_product(t: Tables) -> DataFrame:
    base = t.part.select("p_partkey", "p_name", "p_brand", "p_type", "p_size",
                         money("p_retailprice").alias("retail_price"),
                         price_band(F.col("p_retailprice")).alias("price_band"))
    return with_surrogate(base, ["p_partkey"], "product_sk",
                          {"p_name": UNKNOWN_LABEL, "p_brand": UNKNOWN_LABEL, "p_type": UNKNOWN_LABEL,
                           "price_band": UNKNOWN_LABEL})


def dim_supplier(t: Tables) -> DataFrame:
    geo = geography(t)
    base = (t.supplier.join(F.broadcast(geo), F.col("s_nationkey") == F.col("n_nationkey"), "left")
            .select("s_suppkey", "s_name", "nation", "region"))
    return with_surrogate(base, ["s_suppkey"], "supplier_sk",
                          {"s_name": UNKNOWN_LABEL, "nation": UNKNOWN_LABEL, "region": UNKNOWN_LABEL})


# -- M6 -------------------------------------------------------------------------
def _known(df: DataFrame, fk: str, dim: DataFrame, dim_key: str, out: str) -> DataFrame:
    """``out`` = the foreign key if the dimension has it, else the unknown member (-1).

    Orphans are flagged by ``rules.mark_orphans``, one lazy left join."""
    from orderlake.functions.rules import mark_orphans
    flagged = mark_orphans(df, fk, dim, dim_key, f"_{out}_orphan")
    missing = F.col(f"_{out}_orphan") | F.col(fk).isNull()
    return (flagged.withColumn(out, F.when(missing, F.lit(UNKNOWN).cast("bigint")).otherwise(F.col(fk).cast("bigint")))
                   .drop(f"_{out}_orphan"))


def fact_sales(t: Tables) -> DataFrame:
    """One row per order line with dimension keys and exact money measures.

    The customer check runs at order grain, before the line join.  The part
    and supplier checks come after the lines' one shuffle, by order key: by then
    adaptive execution has measured the dimensions' keys and broadcasts those
    under its limit, so the joined lines are not shuffled again.
    """
    return _fact(t, orders_of(t)).drop("cust_key", "part_key", "supp_key")


def orders_of(t: Tables) -> DataFrame:
    """Orders with the customer key that the dimension knows (-1 otherwise)."""
    return _known(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), "o_custkey", t.customer, "c_custkey", "cust_key")


def orders_geo(t: Tables) -> DataFrame:
    """Orders with the region and nation of their customer (unknown if missing)."""
    geo = geography(t)
    cust = t.customer.select("c_custkey", "c_nationkey")
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    j = (o.join(cust, o["o_custkey"] == cust["c_custkey"], "left")
          .join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey"), "left"))
    return j.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus",
                    F.coalesce("region", F.lit(UNKNOWN_LABEL)).alias("region"),
                    F.coalesce("nation", F.lit(UNKNOWN_LABEL)).alias("nation"),
                    F.coalesce("c_custkey", F.lit(UNKNOWN).cast("bigint")).alias("cust_key"))


def _fact(t: Tables, orders: DataFrame) -> DataFrame:
    """The fact with its natural keys beside the surrogates, and the other columns of ``orders`` (NULL without an order)."""
    return fact_columns(fact_lines(t, orders))


#: What the keys and measures of the fact are made from.
_LINE = ("l_orderkey", "l_linenumber", "order_date_key", "ship_date_key", "cust_key", "part_key", "supp_key", "l_quantity",
         "l_extendedprice", "l_discount", "l_tax", "l_returnflag")


def fact_lines(t: Tables, orders: DataFrame) -> DataFrame:
    """Lines with their checked natural keys and the other columns of ``orders``: all that needs a join, and no more."""
    extra = [c for c in orders.columns if c not in ("o_orderkey", "o_custkey", "o_orderdate", "cust_key")]
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
                              "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag")
    j = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"], "left")
    j = _known(j, "l_partkey", t.part, "p_partkey", "part_key")
    j = _known(j, "l_suppkey", t.supplier, "s_suppkey", "supp_key")
    return j.select(
        "l_orderkey", "l_linenumber",
        F.coalesce(date_key("o_orderdate"), F.lit(UNKNOWN)).alias("order_date_key"),
        F.coalesce(date_key("l_shipdate"), F.lit(UNKNOWN)).alias("ship_date_key"),
        F.coalesce(F.col("cust_key"), F.lit(UNKNOWN).cast("bigint")).alias("cust_key"), *_LINE[5:], *extra)


def fact_columns(lines: DataFrame) -> DataFrame:
    """Surrogates and exact measures of :func:`fact_lines`, row by row; its other columns follow."""
    return lines.select(
        "l_orderkey", "l_linenumber", "order_date_key", "ship_date_key", "cust_key", "part_key", "supp_key",
        surrogate("cust_key").alias("customer_sk"),
        surrogate("part_key").alias("product_sk"),
        surrogate("supp_key").alias("supplier_sk"),
        F.col("l_quantity").cast("decimal(12,2)").alias("quantity"),
        gross_amount().alias("gross"),
        discount_amount().alias("discount"),
        net_amount().alias("net"),
        tax_amount().alias("tax"),
        (F.col("l_returnflag") == "R").alias("returned"), *[c for c in lines.columns if c not in _LINE])


# -- M8 -------------------------------------------------------------------------
def star_query(fact: DataFrame, dims: Sequence[tuple], filters: Sequence[Column],
               by: Sequence[str], measures: Sequence[Column]) -> DataFrame:
    """Filter dimensions, join them to the fact on (fact_key, dim_key), aggregate.

    ``dims`` holds (dim, fact_key, dim_key) or (dim, fact_key, dim_key, bounded).
    A dimension whose size is bounded by definition (the calendar, geography)
    is broadcast by hint; on a fact table partitioned by that dimension's key,
    Spark then adds a dynamic partition-pruning filter to the fact scan, so
    only the partitions matching the filtered dimension are read.  Other
    dimensions are left to the run-time (measured) broadcast decision.
    """
    out = fact
    for d in dims:
        dim, fact_key, dim_key = d[:3]
        bounded = len(d) > 3 and d[3]
        out = out.join(F.broadcast(dim) if bounded else dim, out[fact_key] == dim[dim_key])
    for f in filters:
        out = out.where(f)
    return out.groupBy(*by).agg(*measures)


def load_star(t: Tables, lake) -> None:
    """Write the dimensions and the fact to gold; the fact by order year (NULL: unknown order date).

    The fact keeps the natural keys next to the surrogates: joins on 8-byte
    integers move a quarter of the bytes of joins on hashes.  It also carries
    the order's status and its customer's geography, which join at order grain
    here and would have to meet every line later (NULL for a line without order).
    Lines are dealt out to the years and sorted by them before their surrogates and
    measures are made, which are several times as wide and would spill.
    """
    lake.write(dim_date(t), "gold", "dim_date")
    lake.write(dim_customer(t), "gold", "dim_customer")
    lake.write(dim_product(t), "gold", "dim_product")
    year = F.when(F.col("order_date_key") != UNKNOWN, F.floor(F.col("order_date_key") / 10000)).cast("int")
    lake.write(fact_lines(t, orders_geo(t)).withColumn("order_year", year), "gold", "fact_sales", ["order_year"],
               derive=fact_columns, compression="zstd")


def revenue_by_brand_year(lake, region: str, days: DataFrame | None = None) -> DataFrame:
    """Revenue of a region's customers by brand and order year, from the loaded star.

    Lines meet the region's customers, are reduced to (part, year), and only
    these sums meet the product dimension: one shuffle of lines at most.  The
    filter on the customer dimension reaches the fact scan as a Bloom filter on
    the customer key, where the tables are large enough for Spark to build one.
    ``days`` (rows of the calendar) limits the order years; its years are known
    only at run time and prune the fact's year folders then.
    """
    cust = lake.read("gold", "dim_customer").where(F.col("region") == region).select("c_custkey", F.col("region").alias("cust_region"))
    prod = lake.read("gold", "dim_product").select("p_partkey", "p_brand")
    dims = [(cust, "cust_key", "c_custkey")]
    if days is not None:
        dims.insert(0, (days.select(F.col("year").alias("day_year")).where("day_year IS NOT NULL").distinct(), "order_year", "day_year", True))
    per_part = star_query(
        lake.read("gold", "fact_sales"), dims, [], ["cust_region", "part_key", "order_year"],
        [F.sum("net").cast("decimal(38,4)").alias("net"), F.sum("quantity").cast("decimal(38,2)").alias("quantity"),
         F.count(F.lit(1)).alias("n")])
    return star_query(
        per_part, [(prod, "part_key", "p_partkey")], [], [F.col("cust_region").alias("region"), "p_brand", F.col("order_year").alias("year")],
        [F.sum("net").cast("decimal(38,4)").alias("net_revenue"), F.sum("quantity").cast("decimal(38,2)").alias("units"),
         F.sum("n").cast("bigint").alias("lines")])


def leap_days(lake) -> DataFrame:
    """The calendar's 29ths of February: an attribute of the days, not of the fact's partitions."""
    return lake.read("gold", "dim_date").where("month = 2 AND day = 29")


# -- X1, X2 ---------------------------------------------------------------------
def external(spark, path: str, fmt: str = "parquet", name: str | None = None) -> DataFrame:
    """A relation over lake files, queried in place (no load step).

    Partition columns in the folder layout become filterable columns; filters
    on them prune folders at planning time, other filters are pushed to the
    parquet reader and only referenced columns are read.
    """
    df = spark.read.format(fmt).load(path)
    if name:
        df.createOrReplaceTempView(name)
    return df
