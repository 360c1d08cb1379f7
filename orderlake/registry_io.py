"""Queries that land files, write zone tables or run streams (registered on import).

Each call works in a fresh folder under the checkpoint root (see
``session.scratch_dir``); the source folder is only read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.fixtures import RAW_COLUMNS, raw_orders
from orderlake.functions.dates import date_key
from orderlake.functions.money import money, net_amount
from orderlake.operators import clean as C
from orderlake.operators import governance as G
from orderlake.operators import quality as Q
from orderlake.operators.reconcile import two_way
from orderlake.operators.upsert import bucket_count, create_keyed, read_keyed, upsert
from orderlake.plans import star as M
from orderlake.registry import query, silver_orders
from orderlake.session import scratch_dir, session_tz
from orderlake.sources.incremental import ingest_new, run_available, run_continuous, stream_files
from orderlake.sources.messy import read_messy
from orderlake.sources.zones import Lake, land_raw, read_landed, retention_plan
from orderlake.streaming import medallion as L
from orderlake.tables import Tables


def latest_first():
    """Version order of an order record: highest seq, then status (total order)."""
    return [F.col("seq").desc(), F.col("status").asc_nulls_last()]


# Delivery boundaries used to split source tables into landed files.
ORDER_DELIVERY_SPLIT = "1998-01-01"
IDLE_SECONDS = 3.0            # a continuous run stops after so long without a new batch
EVENT_WEEKS = ("2024-01-08", "2024-01-15", "2024-01-22")


def _land_raw_order_deliveries(t: Tables, landing: str) -> list[str]:
    """raw_orders as JSON lines in two deliveries: first versions (with resends), then newer versions."""
    first, newer = _versions(raw_orders(t.orders))
    return [L.land(first, landing, "json"), L.land(newer, landing, "json")]


def _versions(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """First versions (and rows without a number), then newer ones: every row is in one of them."""
    first = F.coalesce(F.col("seq") <= 1, F.lit(True))
    return raw.where(first), raw.where(~first)


def _event_weeks(t: Tables) -> list[DataFrame]:
    e = t.events
    bounds = [None, *EVENT_WEEKS, None]
    out = []
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        cond = F.lit(True)
        if lo:
            cond = cond & (F.col("ts") >= F.lit(lo).cast("timestamp_ntz"))
        if hi:
            cond = cond & (F.col("ts") < F.lit(hi).cast("timestamp_ntz"))
        out.append(e.where(F.coalesce(cond, F.lit(lo is None))))      # events without a time come first
    return out


def _order_deliveries(t: Tables) -> list[DataFrame]:
    split = F.lit(ORDER_DELIVERY_SPLIT).cast("timestamp_ntz")
    early = F.coalesce(F.col("o_orderdate") < split, F.lit(True))     # orders without a date come first
    return [t.orders.where(early), t.orders.where(~early)]


# -- B ------------------------------------------------------------------------
@query("bronze_land_orders")
def _b1(t):
    spark = t.spark
    landing = scratch_dir(spark, "landing")
    L.land(raw_orders(t.orders), landing, "json")
    landed = read_landed(spark, landing, list(RAW_COLUMNS), "json")
    lake = Lake(spark)
    lake.write(land_raw(landed, 1, list(RAW_COLUMNS), F.col("_file")), "bronze", "raw_orders", ["_batch_id"])
    return lake.read("bronze", "raw_orders").drop("_source_file", "_ingested_at")


CORRUPT_SCHEMA = ("order_id bigint, customer_id bigint, order_date string, amount decimal(12,2), "
                  "status string, priority string, seq int")


@query("bronze_corrupt_capture")
def _b2(t):
    spark = t.spark
    landing = scratch_dir(spark, "landing-csv")
    (raw_orders(t.orders).write.option("header", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(f"{landing}/delivery-1"))
    # no cache(): the projection keeps typed columns next to the corrupt one, so
    # Spark can prune the parse; caching a whole landing zone would not scale
    df = read_messy(spark, f"{landing}/delivery-1", CORRUPT_SCHEMA, "csv", header=True)
    return df.select("order_id", "customer_id", "amount", "seq", "status",
                     F.col("_corrupt").isNotNull().alias("is_corrupt"))


@query("bronze_incremental_rerun")
def _b3(t):
    spark = t.spark
    root = scratch_dir(spark, "ingest")
    landing, dst, ckpt = f"{root}/landing", f"{root}/bronze/orders", f"{root}/_checkpoints/orders"
    schema = t.orders.schema
    for delivery in _order_deliveries(t):
        L.land(delivery, landing)
        ingest_new(spark, landing, dst, ckpt, schema)
        ingest_new(spark, landing, dst, ckpt, schema)      # rerun with nothing new adds nothing
    return spark.read.parquet(dst).drop("_source_file")


@query("bronze_stream_files")
def _b4(t):
    spark = t.spark
    root = scratch_dir(spark, "stream-files")
    landing = f"{root}/landing"
    for week in _event_weeks(t):
        L.land(week, landing, order_by="ts")
    s = stream_files(spark, landing, t.events.schema, "parquet", max_files_per_trigger=2)
    run_available(s, f"{root}/bronze/events", f"{root}/_checkpoints/events")
    return spark.read.parquet(f"{root}/bronze/events")


@query("bronze_continuous")
def _b4_continuous(t):
    """A stream that runs until told to stop, is stopped in the middle and started again."""
    spark = t.spark
    root = scratch_dir(spark, "continuous")
    landing, out, ckpt = f"{root}/landing", f"{root}/bronze/events", f"{root}/_checkpoints/events"
    weeks = _event_weeks(t)
    for week in weeks[:3]:
        L.land(week, landing, order_by="ts")
    s = stream_files(spark, landing, t.events.schema, "parquet", max_files_per_trigger=2)
    run_continuous(s, out, ckpt, "100 milliseconds", lambda seen: seen["batches"] >= 1)
    L.land(weeks[3], landing, order_by="ts")
    run_continuous(s, out, ckpt, "100 milliseconds", lambda seen: seen["idle_seconds"] > IDLE_SECONDS)
    run_available(s, out, ckpt)             # what a slow start may have left
    return spark.read.parquet(out)


@query("zone_partition_layout")
def _b5(t):
    lake = Lake(t.spark)
    lines = t.lineitem.withColumn("ship_year", F.year("l_shipdate"))
    lake.write(lines, "silver", "lineitem", ["ship_year"])
    return (lake.read("silver", "lineitem").groupBy("ship_year")
            .agg(F.count(F.lit(1)).alias("row_count"), F.sum(net_amount()).cast("decimal(38,4)").alias("net_revenue")))


RETENTION_AS_OF = "2001-12-31"


def order_month_table(t: Tables, lake: Lake) -> str:
    orders = t.orders.withColumn("order_month", F.date_format("o_orderdate", "yyyy-MM"))
    return lake.write(orders, "bronze", "orders", ["order_month"])


def orders_retention_plan(lake: Lake) -> DataFrame:
    df = lake.read("bronze", "orders")
    return retention_plan(df, "order_month", F.to_date(F.concat(F.col("order_month"), F.lit("-01"))),
                          F.lit(RETENTION_AS_OF).cast("date"), hot_days=365, warm_days=3 * 365)


@query("lifecycle_plan")
def _b6(t):
    lake = Lake(t.spark)
    order_month_table(t, lake)
    return orders_retention_plan(lake)


@query("lifecycle_apply")
def _b6_apply(t):
    """The plan carried out: where each partition's rows are afterwards."""
    lake = Lake(t.spark)
    order_month_table(t, lake)
    lake.apply_retention("bronze", "orders", orders_retention_plan(lake), "order_month", f"{lake.root}/archive")
    place = F.when(F.contains(F.col("_metadata.file_path"), F.lit("/archive/")), "archive").otherwise("lake")
    return lake.read("bronze", "orders").groupBy("order_month", place.alias("location")).agg(F.count(F.lit(1)).alias("row_count"))


# -- C8, M7 -------------------------------------------------------------------
@query("silver_upsert_idempotent")
def _c8(t):
    spark = t.spark
    cleaned = C.drop_resends(C.clean_orders(raw_orders(t.orders)))
    path = f"{scratch_dir(spark, 'keyed-orders')}/table"
    first, changes = _versions(cleaned)
    create_keyed(C.latest_per_key(first, ["order_id"], latest_first(), null_keys="drop"), path, ["order_id"], bucket_count(t.orders))
    for _ in range(2):          # the second time is a replay: no change
        upsert(spark, path, changes, order=latest_first(), rejected=f"{path}-rejected")
    return read_keyed(spark, path)


def customer_changes(t: Tables) -> DataFrame:
    """Attribute changes for the customer dimension: customers in debt move to COLLECTIONS."""
    current = M.dim_customer(t)
    debtors = t.customer.where(F.col("c_acctbal") < 0).select("c_custkey")
    return (current.join(debtors, "c_custkey", "left_semi")
                   .withColumn("c_mktsegment", F.lit("COLLECTIONS")))


@query("dim_incremental")
def _m7(t):
    spark = t.spark
    path = f"{scratch_dir(spark, 'dim-customer')}/table"
    create_keyed(M.dim_customer(t), path, ["c_custkey"], bucket_count(t.customer))
    changes = customer_changes(t)
    for _ in range(2):
        upsert(spark, path, changes, ["c_custkey"])
    return read_keyed(spark, path)


# -- X ------------------------------------------------------------------------
def lineitem_lake_files(t: Tables) -> str:
    lake = Lake(t.spark)
    lake.write(t.lineitem.withColumn("ship_year", F.year("l_shipdate")), "silver", "lineitem", ["ship_year"])
    return lake.path("silver", "lineitem")


def pruned_scan(spark, path: str) -> DataFrame:
    files = M.external(spark, path)
    return (files.where((F.col("ship_year") == 1998) & (F.col("l_discount") > 0.05))
                 .groupBy("l_returnflag")
                 .agg(F.count(F.lit(1)).alias("lines"),
                      F.sum(money("l_quantity")).cast("decimal(38,2)").alias("units"),
                      F.sum(net_amount()).cast("decimal(38,4)").alias("net_revenue")))


@query("external_pruned_scan")
def _x1(t):
    return pruned_scan(t.spark, lineitem_lake_files(t))


@query("external_join_star")
def _x2(t):
    spark = t.spark
    files = M.external(spark, lineitem_lake_files(t))
    lake = Lake(spark)
    lake.write(M.dim_product(t), "gold", "dim_product")
    prod = lake.read("gold", "dim_product").select("p_partkey", "price_band")
    return (files.join(prod, files["l_partkey"] == prod["p_partkey"], "left")
                 .groupBy(F.coalesce("price_band", F.lit(M.UNKNOWN_LABEL)).alias("price_band"), "ship_year")
                 .agg(F.count(F.lit(1)).alias("lines"),
                      F.sum(net_amount()).cast("decimal(38,4)").alias("net_revenue")))


# -- L ------------------------------------------------------------------------
def _raw_stream(spark, landing):
    return stream_files(spark, landing, spark.createDataFrame([], L.RAW_SCHEMA).schema, "json")


@query("stream_silver_orders")
def _l1(t):
    spark = t.spark
    root = scratch_dir(spark, "stream-silver")
    landing = f"{root}/landing"
    _land_raw_order_deliveries(t, landing)
    silver = L.silver_stream(_raw_stream(spark, landing), C.order_rules(t.customer))
    run_available(silver, f"{root}/silver/orders", f"{root}/_checkpoints/silver")
    return spark.read.parquet(f"{root}/silver/orders")


@query("stream_quarantine")
def _l1_split(t):
    """Every landed row on one side, valid or rejected with its rules, and the counts of each batch."""
    spark = t.spark
    root = scratch_dir(spark, "stream-quarantine")
    landing, silver, quarantine, counts = (f"{root}/{x}" for x in ("landing", "silver", "quarantine", "counts"))
    sink = L.split_sink(silver, quarantine, C.order_rules(t.customer), counts)
    for delivery in _versions(raw_orders(t.orders)):
        L.land(delivery, landing, "json")
        run_available(_raw_stream(spark, landing), None, f"{root}/_checkpoints/split", foreach_batch=sink)
    batch = F.col(L.BATCH).cast("int").alias("batch_id")
    n = F.count(F.lit(1)).alias("row_count")
    valid = spark.read.parquet(silver).groupBy(batch).agg(n).select("batch_id", F.lit("valid").alias("side"), F.lit("").alias("rules"), "row_count")
    bad = (spark.read.parquet(quarantine).groupBy(batch, F.col("failed_rules").alias("rules")).agg(n)
           .select("batch_id", F.lit("quarantine").alias("side"), "rules", "row_count"))
    seen = spark.read.parquet(counts)
    told = seen.select(batch, F.when(F.col("rule").isNull(), "landed").otherwise("failed").alias("side"), F.coalesce("rule", F.lit("")).alias("rules"),
                       F.when(F.col("rule").isNull(), F.col("checked")).otherwise(F.col("failed")).alias("row_count"))
    return valid.unionByName(bad).unionByName(told)


@query("stream_enrich")
def _l2(t):
    spark = t.spark
    root = scratch_dir(spark, "stream-enrich")
    landing = f"{root}/landing"
    geo = M.geography(t)
    lake = Lake(spark)
    lake.write(t.customer.join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey"), "left")
               .select("c_custkey", "region", "nation"),
               "silver", "customer_geo")
    dim = lake.read("silver", "customer_geo")
    for d in _order_deliveries(t):
        L.land(d, landing)
    s = stream_files(spark, landing, t.orders.schema).select("o_orderkey", "o_custkey", "o_orderstatus",
                                                             "o_totalprice")
    enriched = L.enrich(s, dim, F.col("o_custkey") == F.col("c_custkey"), "left").drop("c_custkey")
    run_available(enriched, f"{root}/silver/orders_geo", f"{root}/_checkpoints/enrich")
    return spark.read.parquet(f"{root}/silver/orders_geo")


EVENT_MEASURES = lambda: [F.count(F.lit(1)).alias("events"),
                          F.sum(money("value")).cast("decimal(38,2)").alias("value_sum")]


@query("stream_gold_daily")
def _l3(t):
    spark = t.spark
    root = scratch_dir(spark, "stream-gold")
    landing, gold = f"{root}/landing", f"{root}/gold/events_daily"
    for week in _event_weeks(t):
        L.land(week, landing, order_by="ts")
        L.run_gold_windows(spark, landing, t.events.schema, gold, f"{root}/_checkpoints/gold", "ts",
                           "1 day", "1 hour", ["event_type"], EVENT_MEASURES())
    return read_keyed(spark, gold)


@query("stream_gold_late")
def _l3_late(t):
    """Deliveries out of order: what gold counts and what came too late for it, by day."""
    spark = t.spark
    root = scratch_dir(spark, "stream-gold-late")
    landing, gold = f"{root}/landing", f"{root}/gold/events_daily"
    w1, w2, w3, w4 = _event_weeks(t)
    for week in (w1, w3, w2, w4):
        L.land(week, landing, order_by="ts")
        L.run_gold_windows(spark, landing, t.events.schema, gold, f"{root}/_checkpoints/gold", "ts",
                           "1 day", "1 hour", [], [F.count(F.lit(1)).alias("events")])
    late = (spark.read.parquet(f"{gold}-late").groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("window_start"))
            .agg(F.count(F.lit(1)).alias("events")))
    return (read_keyed(spark, gold).select(F.lit("gold").alias("side"), "window_start", "events")
            .unionByName(late.select(F.lit("late").alias("side"), "window_start", "events")))


@query("stream_upsert_latest")
def _l4(t):
    spark = t.spark
    root = scratch_dir(spark, "stream-upsert")
    landing, target = f"{root}/landing", f"{root}/silver/orders"
    schema = spark.createDataFrame([], L.RAW_SCHEMA).schema
    _land_raw_order_deliveries(t, landing)
    L.stream_upsert(spark, landing, schema, target, f"{root}/_checkpoints/a", ["order_id"], latest_first(),
                    bucket_count(t.orders), C.clean_orders, fmt="json")
    # replay every delivery from a fresh checkpoint into the same table: nothing changes
    L.stream_upsert(spark, landing, schema, target, f"{root}/_checkpoints/b", ["order_id"], latest_first(),
                    bucket_count(t.orders), C.clean_orders, fmt="json")
    return read_keyed(spark, target)


@query("medallion_end_to_end")
def _l5(t):
    spark = t.spark
    root = scratch_dir(spark, "medallion")
    landing = f"{root}/landing"
    m = L.Medallion(spark, landing, bucket_count(t.orders), f"{root}/lake")
    for delivery in _versions(raw_orders(t.orders)):
        L.land(delivery, landing, "json")
        m.run(t.customer)
    return m.run(t.customer)          # nothing new: same gold


@query("stream_dedup")
def _l6(t):
    spark = t.spark
    root = scratch_dir(spark, "stream-dedup")
    landing, out, ckpt = f"{root}/landing", f"{root}/silver/events", f"{root}/_checkpoints/dedup"
    w1, w2, w3, w4 = _event_weeks(t)
    tz = session_tz(spark)

    def run():
        s = stream_files(spark, landing, t.events.schema)
        run_available(L.dedup_stream(s, ["event_id"], "ts", "2 days", tz), out, ckpt)

    L.land(w1, landing, order_by="ts")
    L.land(w2, landing, order_by="ts")
    L.land(w2, landing, order_by="ts")      # resent in the same micro-batch
    run()
    L.land(w3, landing, order_by="ts")
    run()
    L.land(w4, landing, order_by="ts")
    L.land(w1, landing, order_by="ts")      # resent weeks later
    run()
    return spark.read.parquet(out)


@query("stream_late_events")
def _l6_late(t):
    """De-duplication with a week that comes after its time: every landed row is kept, resent or late."""
    spark = t.spark
    root = scratch_dir(spark, "stream-late")
    landing, out, ckpt = f"{root}/landing", f"{root}/silver/events", f"{root}/_checkpoints/dedup"
    w1, w2, w3, w4 = _event_weeks(t)
    for deliveries in ((w1, w2, w2), (w4,), (w3, w1)):
        for d in deliveries:
            L.land(d, landing, order_by="ts")
        s = stream_files(spark, landing, t.events.schema)
        run_available(L.dedup_stream(s, ["event_id"], "ts", "2 days", session_tz(spark)), out, ckpt)
    landed = spark.read.schema(t.events.schema).option("recursiveFileLookup", "true").parquet(landing)
    return L.dedup_outcomes(landed, spark.read.parquet(out), ["event_id"]).withColumnRenamed("rows", "row_count")


@query("dq_quarantine_table")
def _q10_table(t):
    """Rejected orders with the rules they broke, as the lake keeps them."""
    lake = Lake(t.spark)
    Q.enforce_to(lake, silver_orders(t), C.order_rules(t.customer), "silver", "orders")
    return lake.read("silver", "orders_quarantine")


# -- G ------------------------------------------------------------------------
def customer_tags(spark):
    return G.tag_table(spark, [("customer", "c_name", "pii"), ("customer", "c_acctbal", "financial")])


def role_grants(spark):
    return G.grant_table(spark, [("finance", "financial"), ("steward", "pii"), ("steward", "financial")])


def region_grants(spark):
    return spark.createDataFrame([("emea_analyst", "EUROPE"), ("emea_analyst", "MIDDLE EAST"),
                                  ("emea_analyst", "AFRICA"), ("apac_analyst", "ASIA")], "role string, value string")


@query("gov_tag_columns")
def _g1(t):
    spark = t.spark
    return G.governed_view(t.customer, "customer", customer_tags(spark), role_grants(spark), "finance")


@query("gov_mask_pii")
def _g2(t):
    spark = t.spark
    return G.mask_by_tag(t.customer, "customer", customer_tags(spark), role_grants(spark), "analyst",
                         {"pii": "hash", "financial": "redact"})


@query("gov_row_filter")
def _g3(t):
    og = M.orders_geo(t).select("o_orderkey", "o_custkey", "o_orderstatus", "region")
    return G.row_policy(og, "region", region_grants(t.spark), "emea_analyst")


@query("gov_catalog_columns")
def _g4(t):
    spark = t.spark
    lake = Lake(spark)
    tags = customer_tags(spark)
    G.register(lake, t.customer, "silver", "customer", "customers, typed", "data-eng", tags)
    G.register(lake, M.dim_customer(t), "gold", "dim_customer", "customer dimension", "analytics")
    G.register(lake, land_raw(raw_orders(t.orders), 1), "bronze", "raw_orders", "raw order deliveries",
               "data-eng", partition_by=["_batch_id"])
    return G.catalog_report(lake)


# -- K10 ----------------------------------------------------------------------
def warehouse_months(t: Tables, lake: Lake) -> str:
    """The warehouse path: the cleaned orders are loaded as a fact with keys into the calendar, and
    the month and status figures come from the loaded star.  Nothing of it runs on a stream."""
    Q.enforce_to(lake, silver_orders(t), C.order_rules(t.customer), "silver", "orders")
    orders = lake.read("silver", "orders")
    fact = orders.select("order_id", "status", "amount", date_key("order_date").alias("order_date_key"))
    lake.write(fact, "gold", "fact_orders")
    bounds = orders.agg(F.min("order_date").alias("lo"), F.max("order_date").alias("hi"))
    lake.write(M.dim_date_between(bounds), "gold", "dim_order_date")
    loaded, days = lake.read("gold", "fact_orders"), lake.read("gold", "dim_order_date")
    months = (M.star_query(loaded, [(days, "order_date_key", "date_key", True)], [], ["year", "month", "status"],
                           [F.count(F.lit(1)).alias("orders"), F.sum("amount").cast("decimal(38,2)").alias("total")])
              .select(F.make_date("year", "month", F.lit(1)).alias("month"), F.col("status").alias("o_orderstatus"), "orders", "total"))
    return lake.write(months, "gold", "warehouse_months")


def lake_months(t: Tables, lake: Lake) -> str:
    """The streaming path: deliveries through bronze, upserted silver and incremental gold (L5)."""
    root = scratch_dir(t.spark, "parity")
    m = L.Medallion(t.spark, f"{root}/landing", bucket_count(t.orders), f"{root}/lake")
    for delivery in _versions(raw_orders(t.orders)):
        L.land(delivery, f"{root}/landing", "json")
        gold = m.run(t.customer)
    return lake.write(gold.select("month", F.col("status").alias("o_orderstatus"), "orders", F.col("amount").alias("total")), "gold", "lake_months")


@query("parity_two_paths")
def _k10(t):
    lake = Lake(t.spark)
    warehouse_months(t, lake)
    lake_months(t, lake)
    return two_way(lake.read("gold", "warehouse_months"), lake.read("gold", "lake_months"), ["month", "o_orderstatus"], ["orders", "total"])
