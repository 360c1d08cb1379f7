import pytest
from pyspark.sql import functions as F

from orderlake.fixtures import raw_orders
from orderlake.operators import clean as C
from orderlake.operators.upsert import read_keyed
from orderlake.session import scratch_dir, session_tz
from orderlake.sources import incremental as I
from orderlake.sources.incremental import run_available, run_continuous, stream_files
from orderlake.streaming import medallion as L


def _same(a, b):
    return sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_silver_stream_equals_batch(tiny):
    spark = tiny.spark
    root = scratch_dir(spark, "test-l1")
    raw = raw_orders(tiny.orders)
    L.land(raw, f"{root}/landing", "json")
    s = stream_files(spark, f"{root}/landing", spark.createDataFrame([], L.RAW_SCHEMA).schema, "json")
    run_available(L.silver_stream(s), f"{root}/out", f"{root}/ckpt")
    batch = C.clean_orders(raw.select(*[c for c in raw.columns]))
    assert _same(spark.read.parquet(f"{root}/out").select(*batch.columns), batch)


def test_stream_enrich_equals_batch_join(tiny):
    spark = tiny.spark
    root = scratch_dir(spark, "test-l2")
    L.land(tiny.orders, f"{root}/landing")
    dim = tiny.customer.select("c_custkey", "c_mktsegment")
    s = stream_files(spark, f"{root}/landing", tiny.orders.schema).select("o_orderkey", "o_custkey")
    run_available(L.enrich(s, dim, F.col("o_custkey") == F.col("c_custkey")), f"{root}/out", f"{root}/ckpt")
    batch = tiny.orders.select("o_orderkey", "o_custkey").join(dim, F.col("o_custkey") == F.col("c_custkey"), "left")
    assert _same(spark.read.parquet(f"{root}/out"), batch)


def test_gold_windows_stream_equals_batch_across_deliveries(tiny):
    spark = tiny.spark
    root = scratch_dir(spark, "test-l3")
    e = tiny.events
    measures = lambda: [F.count(F.lit(1)).alias("events")]
    for lo, hi in (("2024-01-01", "2024-01-10"), ("2024-01-10", "2024-01-20"), ("2024-01-20", "2024-02-01")):
        L.land(e.where((F.col("ts") >= lo) & (F.col("ts") < hi)), f"{root}/landing", order_by="ts")
        L.run_gold_windows(spark, f"{root}/landing", e.schema, f"{root}/gold", f"{root}/ckpt", "ts", "1 day",
                           "1 hour", ["event_type"], measures())
    got = read_keyed(spark, f"{root}/gold").select("window_start", "event_type", "events")
    assert spark.read.parquet(f"{root}/gold-late").count() == 0
    batch = (e.groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("window_start"), "event_type")
              .agg(F.count(F.lit(1)).alias("events")))
    assert _same(got, batch)


def test_event_time_windows_follow_source_days_in_any_session_zone(spark):
    from orderlake.functions.dates import from_event_time, to_event_time
    old = session_tz(spark)
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([("2024-01-05 23:30:00",)], "s string").select(F.col("s").cast("timestamp_ntz").alias("ts"))
        w = df.select(F.window(to_event_time("ts", "America/New_York"), "1 day").alias("w"))
        start = w.select(from_event_time("w.start", "America/New_York").alias("s")).first().s
        assert start.isoformat() == "2024-01-05T00:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_stream_upsert_replay_is_idempotent(tiny):
    spark = tiny.spark
    root = scratch_dir(spark, "test-l4")
    raw = raw_orders(tiny.orders)
    L.land(raw.where("seq = 1"), f"{root}/landing", "json")
    L.land(raw.where("seq = 2"), f"{root}/landing", "json")
    schema = spark.createDataFrame([], L.RAW_SCHEMA).schema
    order = [F.col("seq").desc(), F.col("status").asc_nulls_last()]
    L.stream_upsert(spark, f"{root}/landing", schema, f"{root}/t", f"{root}/c1", ["order_id"], order, 8,
                    transform=C.clean_orders, fmt="json")
    expected = C.latest_orders(C.clean_orders(raw))
    first_rows = sorted(map(tuple, read_keyed(spark, f"{root}/t").select(*expected.columns).collect()))
    L.stream_upsert(spark, f"{root}/landing", schema, f"{root}/t", f"{root}/c2", ["order_id"], order, 8,
                    transform=C.clean_orders, fmt="json")
    # a fresh read: a DataFrame listed before the rewrite would point at replaced files
    assert sorted(map(tuple, read_keyed(spark, f"{root}/t").select(*expected.columns).collect())) == first_rows
    assert first_rows == sorted(map(tuple, expected.collect()))


def test_dedup_stream_drops_resends(tiny):
    spark = tiny.spark
    root = scratch_dir(spark, "test-l6")
    e = tiny.events
    L.land(e, f"{root}/landing", order_by="ts")
    L.land(e.where("ts < '2024-01-05'"), f"{root}/landing", order_by="ts")
    s = stream_files(spark, f"{root}/landing", e.schema)
    run_available(L.dedup_stream(s, ["event_id"], "ts", "1 day", session_tz(spark)), f"{root}/out", f"{root}/ckpt")
    assert spark.read.parquet(f"{root}/out").count() == e.count()


def test_medallion_rerun_changes_nothing(tiny):
    spark = tiny.spark
    root = scratch_dir(spark, "test-l5")
    raw = raw_orders(tiny.orders)
    m = L.Medallion(spark, f"{root}/landing", 8, f"{root}/lake")
    L.land(raw, f"{root}/landing", "json")
    first = sorted(map(tuple, m.run(tiny.customer).collect()))
    assert sorted(map(tuple, m.run(tiny.customer).collect())) == first
    assert spark.read.parquet(m.silver).count() == tiny.orders.count()


def test_medallion_incremental_gold_equals_full_recompute(tiny):
    from orderlake.operators import quality as Q
    spark = tiny.spark
    root = scratch_dir(spark, "test-l5-incr")
    raw = raw_orders(tiny.orders)
    m = L.Medallion(spark, f"{root}/landing", 8, f"{root}/lake")
    L.land(raw.where("seq = 1"), f"{root}/landing", "json")
    m.run(tiny.customer)
    L.land(raw.where("seq = 2"), f"{root}/landing", "json")
    gold = m.run(tiny.customer)
    silver = spark.read.parquet(m.silver)
    valid, _ = Q.enforce(silver, C.order_rules(tiny.customer))
    full = (valid.groupBy(F.trunc("order_date", "month").alias("month"), "status")
                 .agg(F.count(F.lit(1)).cast("bigint").alias("orders"),
                      F.sum("amount").cast("decimal(38,2)").alias("amount")))
    assert _same(gold.select(*full.columns), full)
    # the notes of batches that gold already holds are dropped; those of the last run are still there
    assert [r.batch_id for r in spark.read.parquet(m.dirty).select("batch_id").distinct().collect()] == [1]


def test_dedup_stream_collapses_a_hot_group_of_copies(tiny):
    spark = tiny.spark
    root = scratch_dir(spark, "test-l6-hot")
    e = tiny.events
    copies = e.where("event_id = 3").select("*", F.explode(F.sequence(F.lit(1), F.lit(2000))).alias("_c")).drop("_c")
    L.land(e.unionByName(copies), f"{root}/landing", order_by="ts")
    s = stream_files(spark, f"{root}/landing", e.schema)
    run_available(L.dedup_stream(s, ["event_id"], "ts", "1 day", session_tz(spark)), f"{root}/out", f"{root}/ckpt")
    out = spark.read.parquet(f"{root}/out")
    assert out.count() == e.count() and out.select("event_id").distinct().count() == e.count()
    assert _same(out, e)


def test_rows_with_unparsed_keys_are_set_aside_by_the_medallion(tiny):
    spark = tiny.spark
    root = scratch_dir(spark, "test-l5-null")
    raw = raw_orders(tiny.orders)
    bad = raw.limit(20).withColumn("order_id", F.lit("n/a"))
    m = L.Medallion(spark, f"{root}/landing", 8, f"{root}/lake")
    for delivery in (raw.unionByName(bad), bad):
        L.land(delivery, f"{root}/landing", "json")
        m.run(tiny.customer)
    assert read_keyed(spark, m.silver).count() == tiny.orders.count()
    assert spark.read.parquet(f"{m.silver}-rejected").groupBy("batch_id").count().count() == 2


def test_valid_and_quarantined_rows_make_up_each_batch(tiny):
    spark = tiny.spark
    root = scratch_dir(spark, "test-split")
    raw = raw_orders(tiny.orders)
    for part in (raw.where("seq = 1"), raw.where("seq = 2")):
        L.land(part, f"{root}/landing", "json")
        s = stream_files(spark, f"{root}/landing", spark.createDataFrame([], L.RAW_SCHEMA).schema, "json")
        totals = run_available(s, None, f"{root}/ckpt",
                               foreach_batch=L.split_sink(f"{root}/ok", f"{root}/bad", C.order_rules(tiny.customer)))
        assert totals["rows"] == part.count()
    ok, bad = spark.read.parquet(f"{root}/ok"), spark.read.parquet(f"{root}/bad")
    assert ok.count() + bad.count() == raw.count() and bad.where("failed_rules = ''").count() == 0
    valid, quarantine = C.split_valid(C.clean_orders(raw), C.order_rules(tiny.customer))
    assert (ok.count(), bad.count()) == (valid.count(), quarantine.count())


def test_counts_of_every_batch_are_returned(tiny, monkeypatch):
    spark = tiny.spark
    root = scratch_dir(spark, "test-totals")
    L.land(raw_orders(tiny.orders), f"{root}/landing", "json", n_files=12)
    s = stream_files(spark, f"{root}/landing", spark.createDataFrame([], L.RAW_SCHEMA).schema, "json", max_files_per_trigger=1)
    key = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(key, "3")                       # fewer than there are batches
    monkeypatch.setattr(I, "POLL_SECONDS", 0.05)
    try:
        totals = run_available(L.silver_stream(s, C.order_rules(tiny.customer)), f"{root}/out", f"{root}/ckpt")
    finally:
        spark.conf.unset(key)
    assert totals["batches"] == 12 and totals["rows"] == raw_orders(tiny.orders).count()
    observed = [b["observed"]["silver_dq"] for b in totals["per_batch"].values()]
    assert sum(o["rows"] for o in observed) == totals["rows"] and sum(o["amount_non_negative"] for o in observed) > 0


def test_continuous_run_stops_on_its_condition_and_hands_over(tiny):
    spark = tiny.spark
    root = scratch_dir(spark, "test-continuous")
    L.land(tiny.orders, f"{root}/landing", n_files=4)
    s = stream_files(spark, f"{root}/landing", tiny.orders.schema, max_files_per_trigger=1)
    totals = run_continuous(s, f"{root}/out", f"{root}/ckpt", "200 milliseconds", lambda t: t["batches"] >= 2)
    assert 2 <= totals["batches"] <= 4
    run_available(s, f"{root}/out", f"{root}/ckpt")
    assert _same(spark.read.parquet(f"{root}/out"), tiny.orders)


@pytest.mark.parametrize("bounded", [None, 1])
def test_late_events_are_kept_whatever_the_order_of_deliveries(tiny, bounded):
    """Gold and the late rows together are the rows landed, and only rows whose window had closed are late."""
    spark = tiny.spark
    e = tiny.events
    second = F.col("ts") >= "2024-01-15"
    untimed = e.limit(3).withColumn("ts", F.lit(None).cast("timestamp_ntz"))
    for order in ((second, ~second), (~second, second)):
        root = scratch_dir(spark, "test-late")
        for part in order:
            L.land(e.where(part).unionByName(untimed), f"{root}/landing", n_files=2)
            L.run_gold_windows(spark, f"{root}/landing", e.schema, f"{root}/gold", f"{root}/ckpt", "ts", "1 day", "1 hour",
                               ["event_type"], [F.count(F.lit(1)).alias("events")], max_files_per_trigger=bounded)
        gold, late = read_keyed(spark, f"{root}/gold"), spark.read.parquet(f"{root}/gold-late")
        assert gold.agg(F.sum("events")).first()[0] + late.count() == e.count() + 6
        assert late.where("ts IS NULL").count() == 6
        want = e.where(~second & (F.col("ts") < "2024-01-14")).count() if order[0] is second else 0
        if bounded is None:
            assert late.where("ts IS NOT NULL AND ts < '2024-01-14'").count() == want


def test_a_replayed_batch_changes_neither_gold_nor_the_late_rows(tiny):
    spark = tiny.spark
    root = scratch_dir(spark, "test-l3-replay")
    batch = spark.createDataFrame([("2024-01-01 10:00:00", 1), ("2024-01-05 10:00:00", 2), (None, 3)], "ts string, v int").withColumn(
        "ts", F.col("ts").cast("timestamp_ntz"))
    for _ in range(2):
        L.late_sink(f"{root}/late", "ts", "1 day", ["2024-01-03T00:00:00.000Z"], "UTC")(batch, 5)
    assert sorted(r.v for r in spark.read.parquet(f"{root}/late").collect()) == [1, 3]


def test_dedup_outcomes_add_up_and_late_rows_are_named(tiny):
    spark = tiny.spark
    landed = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, "c"), (3, "c"), (None, "d"), (None, "d")], "k int, v string")
    kept = spark.createDataFrame([(1, "a"), (2, "b"), (None, "d")], "k int, v string")
    got = sorted(map(str, L.dedup_outcomes(landed, kept, ["k"]).collect()))
    assert got == sorted(map(str, spark.createDataFrame([(1, "kept", 1), (1, "resent", 1), (2, "kept", 1), (3, "late", 2), (None, "kept", 1),
                                                         (None, "resent", 1)], "k int, outcome string, rows long").collect()))
    assert sorted(r.k for r in L.late_rows(landed.where("k IS NOT NULL"), kept, ["k"]).collect()) == [3, 3]


def test_rows_dropped_by_the_watermark_are_counted(tiny):
    spark = tiny.spark
    root = scratch_dir(spark, "test-dropped")
    e = tiny.events
    late = e.where("ts < '2024-01-03'")
    dropped = []
    for part in (e.where("ts >= '2024-01-20'"), late):
        L.land(part, f"{root}/landing")
        s = stream_files(spark, f"{root}/landing", e.schema)
        totals = run_available(L.dedup_stream(s, ["event_id"], "ts", "1 day", session_tz(spark)), f"{root}/out", f"{root}/ckpt")
        dropped.append(totals["dropped"])
    assert dropped == [0, late.count()]
    landed = spark.read.schema(e.schema).option("recursiveFileLookup", "true").parquet(f"{root}/landing")
    assert _same(L.late_rows(landed, spark.read.parquet(f"{root}/out"), ["event_id"]), late)


def test_split_counts_are_replaced_by_a_replay(tiny):
    spark = tiny.spark
    root = scratch_dir(spark, "test-split-replay")
    rules = C.order_rules(tiny.customer)
    sink = L.split_sink(f"{root}/ok", f"{root}/bad", rules, f"{root}/counts")
    raw = raw_orders(tiny.orders)
    for _ in range(2):
        sink(raw, 0)
    whole = spark.read.parquet(f"{root}/counts").where("rule IS NULL").collect()
    assert [(r.checked, r.failed) for r in whole] == [(raw.count(), spark.read.parquet(f"{root}/bad").count())]
    assert spark.read.parquet(f"{root}/ok").count() + whole[0].failed == whole[0].checked
