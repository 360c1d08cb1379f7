import os

from pyspark.sql import functions as F

from orderlake.registry_io import order_month_table, orders_retention_plan
from orderlake.session import scratch_dir
from orderlake.sources.incremental import ingest_new
from orderlake.sources.messy import read_messy
from orderlake.sources.zones import Lake, land_raw
from orderlake.streaming.medallion import land


def test_land_raw_keeps_every_row_as_text(tiny):
    df = land_raw(tiny.orders, 7)
    assert df.count() == tiny.orders.count()
    assert all(f.dataType.simpleString() == "string" for f in df.schema.fields if not f.name.startswith("_"))
    assert {"_batch_id", "_source_file", "_ingested_at"} <= set(df.columns)


def test_messy_csv_and_json_corrupt_capture(spark):
    d = scratch_dir(spark, "test-messy")
    local = d.replace("file:", "", 1)        # the test writes its two small inputs with plain Python
    with open(f"{local}/a.csv", "w") as f:
        f.write("id,amt,ts\n1,1.5,2024-01-01\nx,2.0,2024-01-02\n3,abc,2024-01-03\n4,4.0,not-a-date\n5,5.0\n6,6.0,2024-01-06,extra\n")
    df = read_messy(spark, f"{d}/a.csv", "id int, amt double, ts date", "csv", header=True).cache()
    bad = df.where(F.col("_corrupt").isNotNull()).count()
    assert df.count() == 6 and bad == 5          # bad id, bad number, bad date, short row, long row
    with open(f"{local}/b.json", "w") as f:
        f.write('{"id": 1, "a": {"b": 2}}\n{"id": 2, "a": \n{"id": "x", "a": {"b": 3}, "z": 1}\n')
    j = read_messy(spark, f"{d}/b.json", "id int, a struct<b:int>", "json").cache()
    assert j.where(F.col("_corrupt").isNotNull()).count() == 2


def test_zone_layout_and_retention(tiny):
    lake = Lake(tiny.spark)
    order_month_table(tiny, lake)
    folders = sorted(os.listdir(lake.path("bronze", "orders").replace("file:", "")))
    assert any(f.startswith("order_month=1995-01") for f in folders)
    plan = orders_retention_plan(lake)
    expired = plan.where("action = 'expire'").agg(F.sum("row_count")).first()[0]
    total = lake.read("bronze", "orders").count()
    dropped = lake.drop_partitions("bronze", "orders", plan, "order_month")
    assert dropped > 0
    assert lake.read("bronze", "orders").count() == total - expired


def test_incremental_ingest_reruns_add_nothing(tiny):
    spark = tiny.spark
    root = scratch_dir(spark, "test-ingest")
    landing, dst, ckpt = f"{root}/landing", f"{root}/bronze", f"{root}/ckpt"
    o = tiny.orders
    counts = []
    for part in (o.where(F.col("o_orderkey") < 500), o.where(F.col("o_orderkey") >= 500)):
        land(part, landing)
        for _ in range(2):
            ingest_new(spark, landing, dst, ckpt, o.schema)
            counts.append(spark.read.parquet(dst).count())
    n1 = o.where(F.col("o_orderkey") < 500).count()
    assert counts == [n1, n1, o.count(), o.count()]


def test_rewrite_replaces_only_the_partitions_written(spark):
    key = "spark.sql.sources.partitionOverwriteMode"
    spark.conf.set(key, "static")
    lake = Lake(spark)
    lake.write(spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "v int, p string"), "silver", "t", ["p"])
    lake.write(spark.createDataFrame([(9, "a")], "v int, p string"), "silver", "t", ["p"])
    assert sorted(map(tuple, lake.read("silver", "t").collect())) == [(2, "b"), (3, "c"), (9, "a")]
    assert spark.conf.get(key) == "static"      # the session setting is left as it was


def test_bucketed_dimension_is_joined_without_a_shuffle_of_its_own(tiny):
    from tests.conftest import plan_text
    spark = tiny.spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    lake = Lake(spark)
    lake.write(tiny.customer.select("c_custkey", "c_mktsegment"), "silver", "cust", bucket_by=(8, ["c_custkey"]))
    dim = lake.read("silver", "cust")
    j = tiny.orders.select("o_orderkey", "o_custkey").join(dim, F.col("o_custkey") == F.col("c_custkey"), "left")
    plan = plan_text(j)
    tree = plan.split("\n\n")[0]
    assert tree.count("Exchange") == 1            # only the orders side moves
    assert "Bucketed: true" in plan or "bucketed" in plan.lower()
    assert j.count() == tiny.orders.count()


def test_a_hot_partition_value_is_written_by_many_tasks(tiny):
    spark = tiny.spark
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    try:
        spark.conf.set(key, "16k")
        lake = Lake(spark)
        hot = tiny.lineitem.repartition(12).withColumn("p", F.when(F.col("l_linenumber") > 6, "b").otherwise("a"))
        lake.write(hot, "silver", "hot", ["p"])
    finally:
        spark.conf.set(key, old)
    folder = lake.path("silver", "hot").replace("file:", "", 1)
    assert len([f for f in os.listdir(f"{folder}/p=a") if f.endswith(".parquet")]) > 4
    assert lake.read("silver", "hot").count() == tiny.lineitem.count()


def test_new_partition_values_of_a_rewrite_are_found_and_quoted_values_dropped(spark):
    lake = Lake(spark)
    lake.write(spark.createDataFrame([(1, "a")], "v int, p string"), "silver", "t", ["p"])
    lake.write(spark.createDataFrame([(2, "it's")], "v int, p string"), "silver", "t", ["p"])
    assert sorted(map(tuple, lake.read("silver", "t").collect())) == [(1, "a"), (2, "it's")]
    plan = spark.createDataFrame([("it's", "expire"), ("a", "keep")], "p string, action string")
    assert lake.drop_partitions("silver", "t", plan, "p") == 1
    assert sorted(map(tuple, lake.read("silver", "t").collect())) == [(1, "a")]


def test_bucketed_write_keeps_its_comment_and_refuses_append(spark):
    lake = Lake(spark)
    lake.write(spark.range(5), "silver", "b", bucket_by=(2, ["id"]), comment="ids")
    assert spark.catalog.getTable(f"{lake.schema('silver')}.b").description == "ids"
    import pytest
    with pytest.raises(ValueError):
        lake.write(spark.range(5), "silver", "b", bucket_by=(2, ["id"]), mode="append")


def test_a_partition_of_unknown_age_is_kept(spark):
    from orderlake.sources.zones import retention_plan
    df = spark.createDataFrame([("x", None), ("y", "1990-01-01")], "p string, d string")
    plan = retention_plan(df, "p", F.to_date("d"), F.lit("2001-01-01").cast("date"), 10, 20)
    assert {r.p: r.action for r in plan.collect()} == {"x": "keep", "y": "expire"}


def test_a_cluster_without_a_shared_folder_is_an_error(spark, monkeypatch):
    import pytest

    from orderlake import session as S
    monkeypatch.setattr(S, "_context_checkpoint_dir", lambda s: None)

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn"}.get(key, default)

    class Fake:
        conf = Conf()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.checkpoint_root(Fake())


def test_archived_partitions_keep_their_rows_and_a_second_run_moves_nothing(tiny, monkeypatch):
    import pytest

    from orderlake.sources import zones as Z
    lake = Lake(tiny.spark)
    order_month_table(tiny, lake)
    rows = lake.read("bronze", "orders")
    before = {r.order_month: r["count"] for r in rows.groupBy("order_month").count().collect()}
    plan = orders_retention_plan(lake)
    actions = {r.order_month: r.action for r in plan.collect()}
    archive = f"{lake.root}/archive"
    real = Z.delete_path
    monkeypatch.setattr(Z, "delete_path", lambda *a: (_ for _ in ()).throw(OSError("planted")))
    with pytest.raises(OSError):
        lake.archive_partitions("bronze", "orders", plan, "order_month", archive)      # cut off after the first copy
    monkeypatch.setattr(Z, "delete_path", real)
    count = lambda: {r.order_month: r["count"] for r in lake.read("bronze", "orders").groupBy("order_month").count().collect()}
    assert count() == before
    n_archived = sum(a == "archive" for a in actions.values())
    assert lake.apply_retention("bronze", "orders", plan, "order_month", archive) == (n_archived - 1, sum(a == "expire" for a in actions.values()))
    assert count() == {m: n for m, n in before.items() if actions[m] != "expire"}
    files = lake.read("bronze", "orders").select("order_month", F.col("_metadata.file_path").alias("f")).distinct().collect()
    assert all(("/archive/" in r.f) == (actions[r.order_month] == "archive") for r in files)
    again = orders_retention_plan(lake)
    assert lake.archive_partitions("bronze", "orders", again, "order_month", archive) == 0
    one = next(m for m, a in actions.items() if a == "archive")
    assert lake.read("bronze", "orders").where(F.col("order_month") == one).count() == before[one]
