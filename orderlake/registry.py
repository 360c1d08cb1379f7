"""

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the source
tables of ``sf_dir`` (or over data Spark derives from them).  Results are
passed through :func:`present`: exact decimals leave as double and calendar
dates as midnight ``timestamp_ntz`` (the type of the source tables), so that
the oracle texts in :mod:`orderlake.oracle` can produce the same types.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.fixtures import raw_orders
from orderlake.functions import rules as R
from orderlake.operators import clean as C
from orderlake.operators import quality as Q
from orderlake.plans import dashboard as K
from orderlake.plans import star as M
from orderlake.plans.gold import gold_of
from orderlake.tables import Tables

QueryFn = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, QueryFn] = {}


def present(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("timestamp_ntz")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def query(name: str):
    def deco(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return present(fn(Tables(spark, sf_dir)))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        _REGISTRY[name] = run
        return fn
    return deco


def queries() -> dict[str, QueryFn]:
    # modules that register further queries on import
    from orderlake import registry_io  # noqa: F401
    return dict(_REGISTRY)


# -- shared inputs ------------------------------------------------------------
def silver_orders(t: Tables) -> DataFrame:
    """raw_orders cleaned, de-duplicated, newest version per order (15,000 at sf0.01)."""
    return C.latest_orders(C.clean_orders(raw_orders(t.orders)))


RAW_STRING_COLS = ["order_id", "customer_id", "order_date", "amount", "status", "priority"]

# -- C ------------------------------------------------------------------------
@query("clean_standardise")
def _c1(t):
    return C.standardise(raw_orders(t.orders), RAW_STRING_COLS)


@query("clean_parse_typed")
def _c2(t):
    return C.parse_typed(raw_orders(t.orders), C.ORDER_TYPES)


@query("clean_null_sentinels")
def _c3(t):
    return C.null_sentinels(raw_orders(t.orders), {"priority": [C.PRIORITY_SENTINEL]}, blank_cols=RAW_STRING_COLS)


@query("clean_drop_resends")
def _c4(t):
    return C.drop_resends(C.clean_orders(raw_orders(t.orders)))


@query("clean_latest_per_key")
def _c5(t):
    return C.latest_per_key(C.clean_orders(raw_orders(t.orders)), ["order_id"],
                            [F.col("seq").desc(), F.col("status").asc_nulls_last()])


@query("clean_quarantine")
def _c6(t):
    flagged = C.flag_failures(silver_orders(t), C.order_rules(t.customer))
    return flagged.select("order_id", F.concat_ws(",", "_failed").alias("failed_rules"),
                          (F.size("_failed") == 0).alias("is_valid"))


@query("clean_orphans")
def _c7(t):
    s = silver_orders(t).select("order_id", "customer_id")
    return C.resolve_refs(s, t.customer, "customer_id", "c_custkey", mode="unknown")


# -- Q ------------------------------------------------------------------------
def _tagged(report: DataFrame, table: str) -> DataFrame:
    return report.select(F.lit(table).alias("source_table"), *report.columns)


@query("dq_completeness")
def _q1(t):
    return Q.completeness(silver_orders(t), ["customer_id", "order_date", "amount", "priority"], min_pass=0.9)


@query("dq_uniqueness")
def _q2(t):
    return (_tagged(Q.uniqueness(C.clean_orders(raw_orders(t.orders)), ["order_id"]), "raw_orders")
            .unionByName(_tagged(Q.uniqueness(t.orders, ["o_orderkey"]), "orders"))
            .unionByName(_tagged(Q.uniqueness(t.lineitem, ["l_orderkey", "l_linenumber"], min_pass=0.9),
                                 "lineitem")))


@query("dq_domain")
def _q3(t):
    return (Q.run_checks(silver_orders(t), [R.in_set("status", C.ORDER_STATUSES)], "silver_orders")
            .unionByName(Q.run_checks(t.lineitem, [R.in_set("l_returnflag", ["R", "A", "N"]),
                                                   R.in_set("l_linestatus", ["O", "F"])], "lineitem"))
            .unionByName(Q.run_checks(t.events, [R.in_set("event_type",
                                                          ["signup", "click", "view", "purchase", "error"])],
                                      "events")))


@query("dq_range")
def _q4(t):
    return (Q.run_checks(silver_orders(t), [R.in_range("amount", lo=0)], "silver_orders")
            .unionByName(Q.run_checks(t.lineitem, [R.in_range("l_discount", 0, 0.1), R.in_range("l_quantity", 1, 50),
                                                   R.in_range("l_tax", 0, 0.08)], "lineitem"))
            .unionByName(Q.run_checks(t.customer, [R.in_range("c_acctbal", lo=0, min_pass=0.9)], "customer")))


PATTERNS = {
    "order_id": r"^[0-9]+$",
    "order_date": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
    "amount": r"^-?[0-9]+\.[0-9]{2}$",
    "priority": r"^[1-5]-[A-Z ]+$",
    "props": r'^\{"k": [0-9]+\}$',
}


@query("dq_pattern")
def _q5(t):
    raw_rules = [R.matches(c, PATTERNS[c], min_pass=0.9) for c in ("order_id", "order_date", "amount", "priority")]
    return (Q.run_checks(raw_orders(t.orders), raw_rules, "raw_orders")
            .unionByName(Q.run_checks(t.events, [R.matches("props", PATTERNS["props"])], "events")))


@query("dq_referential")
def _q6(t):
    return (Q.run_checks(t.orders, [R.refers_to("o_custkey", t.customer, "c_custkey")], "orders")
            .unionByName(Q.run_checks(t.lineitem, [R.refers_to("l_orderkey", t.orders, "o_orderkey"),
                                                   R.refers_to("l_partkey", t.part, "p_partkey"),
                                                   R.refers_to("l_suppkey", t.supplier, "s_suppkey")], "lineitem"))
            .unionByName(Q.run_checks(silver_orders(t), [R.refers_to("customer_id", t.customer, "c_custkey",
                                                                     min_pass=0.95)], "silver_orders")))


@query("dq_cross_table")
def _q7(t):
    lines = t.lineitem.select("l_orderkey", "l_shipdate")
    o = t.orders.select("o_orderkey", "o_orderdate", "o_totalprice")
    line_grain = lines.join(o, lines["l_orderkey"] == o["o_orderkey"])
    ship_rule = R.satisfies("ship_not_before_order", lambda: F.col("l_shipdate") >= F.col("o_orderdate"), 0.5)
    from orderlake.functions.money import net_amount, rate
    totals = (t.lineitem.groupBy("l_orderkey")
              .agg(F.sum(net_amount() * (F.lit(1) + rate("l_tax"))).alias("lines_total")))
    order_grain = o.join(totals, o["o_orderkey"] == totals["l_orderkey"])
    total_rule = R.satisfies("total_matches_lines",
                             lambda: F.abs(F.col("o_totalprice").cast("decimal(12,2)") - F.col("lines_total"))
                             <= F.lit("0.01").cast("decimal(4,2)"),
                             0.0)
    return (Q.run_checks(line_grain, [ship_rule], "lineitem")
            .unionByName(Q.run_checks(order_grain, [total_rule], "orders")))


AS_OF = "2024-02-01"


@query("dq_volume_freshness")
def _q8(t):
    as_of = F.lit(AS_OF).cast("date")
    return (Q.volume_freshness(t.orders, "o_orderdate", 1, 50, as_of, 30, "orders")
            .unionByName(Q.volume_freshness(t.lineitem, "l_shipdate", 1, 200, as_of, 30, "lineitem"))
            .unionByName(Q.volume_freshness(t.events, "ts", 100, 1000, as_of, 30, "events")))


def report_rules(t: Tables):
    return C.order_rules(t.customer) + [R.is_complete("priority", min_pass=0.5, action="warn",
                                                      name="priority_complete")]


@query("dq_report")
def _q9(t):
    return Q.run_checks(silver_orders(t), report_rules(t))


@query("dq_enforced_orders")
def _q10(t):
    kept, _obs = Q.enforce(silver_orders(t), report_rules(t))
    return kept


# -- M ------------------------------------------------------------------------
@query("dim_date")
def _m1(t):
    return M.dim_date(t)


@query("dim_customer")
def _m2(t):
    return M.dim_customer(t)


@query("dim_product")
def _m3(t):
    return M.dim_product(t)


@query("dim_supplier")
def _m4(t):
    return M.dim_supplier(t)


@query("dim_surrogate_unknown")
def _m5(t):
    """Bridge dimension of (part, supplier) pairs seen in lines, composite natural key."""
    pairs = t.lineitem.select("l_partkey", "l_suppkey").distinct()
    return M.with_surrogate(pairs, ["l_partkey", "l_suppkey"], "part_supplier_sk")


@query("fact_sales")
def _m6(t):
    return M.fact_sales(t)


@query("star_revenue_by_brand_year")
def _m8(t):
    return M.revenue_by_brand_year(gold_of(t), "EUROPE")


@query("star_leap_year_revenue")
def _m8_pruned(t):
    """M8 with a filter on the calendar: the fact's other year folders are not read."""
    lake = gold_of(t)
    return M.revenue_by_brand_year(lake, "EUROPE", M.leap_days(lake))


# -- K ------------------------------------------------------------------------
for _name, _fn in [("kpi_headline", K.kpi_headline), ("kpi_monthly_region", K.kpi_monthly_region),
                   ("kpi_geo_rollup", K.kpi_geo_rollup), ("kpi_top_products", K.kpi_top_products),
                   ("kpi_period_change", K.kpi_period_change), ("kpi_running_total", K.kpi_running_total),
                   ("kpi_new_returning", K.kpi_new_returning), ("kpi_returns_status", K.kpi_returns_status)]:
    query(_name)(lambda t, fn=_fn: fn(gold_of(t)))


def quality_panel(t: Tables) -> DataFrame:
    """Q9 reports of every table side by side (K9)."""
    return (Q.run_checks(silver_orders(t), report_rules(t), "silver_orders")
            .unionByName(Q.run_checks(t.lineitem, [R.in_set("l_returnflag", ["R", "A", "N"]),
                                                   R.in_range("l_discount", 0, 0.1),
                                                   R.refers_to("l_orderkey", t.orders, "o_orderkey")], "lineitem"))
            .unionByName(Q.run_checks(t.customer, [R.is_complete("c_name"),
                                                   R.in_range("c_acctbal", lo=0, min_pass=0.9)], "customer"))
            .unionByName(Q.run_checks(t.events, [R.is_complete("user_id"), R.in_range("value", lo=0),
                                                 R.matches("props", PATTERNS["props"])], "events")))


@query("kpi_quality_panel")
def _k9(t):
    return quality_panel(t)
