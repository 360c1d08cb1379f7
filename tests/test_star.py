from pyspark.sql import functions as F

from orderlake.plans import star as M
from orderlake.plans.gold import gold_of
from orderlake.registry_io import lineitem_lake_files, pruned_scan
from orderlake.sources.zones import Lake
from orderlake.tables import Tables
from tests.conftest import plan_text


def test_dim_date_has_no_gaps(tiny):
    d = M.dim_date(tiny).where(F.col("date_key") != M.UNKNOWN)
    r = d.agg(F.count(F.lit(1)).alias("n"), F.min("date").alias("lo"), F.max("date").alias("hi"),
              F.countDistinct("date_key").alias("keys")).first()
    assert r.n == r.keys == (r.hi - r.lo).days + 1


def test_surrogates_are_stable_and_unknown_member_exists(tiny):
    a = {r.c_custkey: r.customer_sk for r in M.dim_customer(tiny).collect()}
    b = {r.c_custkey: r.customer_sk for r in M.dim_customer(tiny).collect()}
    assert a == b and -1 in a and len(set(a.values())) == len(a)


def test_fact_has_one_row_per_line_and_known_keys(tiny):
    fact = M.fact_sales(tiny)
    assert fact.count() == tiny.lineitem.count()
    dims = M.dim_customer(tiny).select("customer_sk")
    assert fact.join(dims, "customer_sk", "left_anti").count() == 0


def test_surrogates_of_different_keys_differ(spark):
    rows = [("a", "b~c"), ("a~b", "c"), ("a", None), (None, "a"), ("", "a"), ("null", "a"), (None, None), ("a~1:b", "c"), ("1:a", "")]
    df = spark.createDataFrame(rows, "x string, y string")
    assert df.select(M.surrogate("x", "y").alias("sk")).distinct().count() == len(rows)


def test_lines_without_an_order_stay_in_the_star(tiny):
    """With an order missing and a ship date missing, every line meets an order day and a ship day."""
    class Holed(Tables):
        def __getattr__(self, name):
            df = super().__getattr__(name)
            if name == "orders":
                return df.where("o_orderkey <> 7")
            if name == "lineitem":
                return df.withColumn("l_shipdate", F.when(F.col("l_orderkey") != 3, F.col("l_shipdate")))
            return df
    t = Holed(tiny.spark, tiny.sf_dir)
    fact, days = M.fact_sales(t), M.dim_date(t).select("date_key", "year")
    assert fact.where(F.col("order_date_key") == M.UNKNOWN).count() > 0 and fact.where(F.col("ship_date_key") == M.UNKNOWN).count() > 0
    for key in ("order_date_key", "ship_date_key"):
        out = M.star_query(fact, [(days, key, "date_key", True)], [], ["year"], [F.count(F.lit(1)).alias("n")])
        assert out.agg(F.sum("n")).first()[0] == tiny.lineitem.count()
    lake = Lake(tiny.spark)
    M.load_star(t, lake)
    assert lake.read("gold", "fact_sales").count() == tiny.lineitem.count()


def test_loaded_star_shuffles_lines_at_most_once_and_prunes_years(tiny):
    lake = gold_of(tiny)
    plan = plan_text(M.revenue_by_brand_year(lake, "EUROPE")).split("\n\n")[0]
    assert plan.count("Exchange") <= 6 and "md5" not in plan
    years = (lake.read("gold", "dim_date").groupBy("year").agg(F.count(F.lit(1)).alias("days")).where(F.col("days") == 366).select("year"))
    q = M.star_query(lake.read("gold", "fact_sales"), [(years, "order_year", "year", True)], [], ["year"], [F.sum("net").alias("net")])
    assert "dynamicpruning" in plan_text(q).lower()
    assert {r.year for r in q.collect()} == {1996, 2000}


def test_external_scan_prunes_partitions_and_columns(tiny):
    path = lineitem_lake_files(tiny)
    plan = plan_text(pruned_scan(tiny.spark, path))
    assert "PartitionFilters: [isnotnull(ship_year" in plan and "(ship_year#" in plan
    assert "PushedFilters: [IsNotNull(l_discount), GreaterThan(l_discount,0.05)]" in plan
    read_schema = [line for line in plan.splitlines() if line.startswith("ReadSchema")][0]
    assert "l_tax" not in read_schema and "l_shipdate" not in read_schema


def test_star_query_prunes_fact_partitions_dynamically(tiny):
    lake = Lake(tiny.spark)
    fact = M.fact_sales(tiny).withColumn("order_year", (F.col("order_date_key") / 10000).cast("int"))
    lake.write(fact, "gold", "fact_sales", ["order_year"])
    # a filter on a dimension *attribute* (leap years), not on the key: only
    # run-time (dynamic) pruning can limit the fact scan to matching partitions
    years = (M.dim_date(tiny).groupBy("year").agg(F.count(F.lit(1)).alias("days"))
             .where(F.col("days") == 366).select("year"))
    q = M.star_query(lake.read("gold", "fact_sales"), [(years, "order_year", "year", True)], [],
                     ["year"], [F.sum("net").alias("net")])
    plan = plan_text(q)
    assert "dynamicpruning" in plan.lower()
    got = {r.year: r.net for r in q.collect()}
    want = {r.order_year: r.n for r in fact.where(F.col("order_year").isin(1996, 2000))
            .groupBy("order_year").agg(F.sum("net").alias("n")).collect()}
    assert got == want and set(got) == {1996, 2000}


def test_lines_are_shuffled_once_for_the_fact(tiny):
    fact = M.fact_sales(tiny)
    fact.collect()                                   # the plan as adaptive execution left it
    final = plan_text(fact).split("== Initial Plan ==")[0]
    assert final.count("BroadcastHashJoin") >= 2, final


def test_the_registered_star_query_prunes_years_and_filters_customers_at_run_time(tiny):
    """The calendar's filter prunes the fact's year folders, the customers' one reaches its scan as a Bloom filter."""
    from orderlake.registry import queries
    spark = tiny.spark
    small = {"spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}       # the tables here are small
    old = {k: spark.conf.get(k) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        q = queries()["star_leap_year_revenue"](spark, tiny.sf_dir)
        plan = plan_text(q)
        assert "dynamicpruning" in plan.lower() and "might_contain" in plan and "bloom_filter_agg" in plan
        got = {(r["year"], r["p_brand"]): r["lines"] for r in q.collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert {y for y, _ in got} == {1996, 2000}
    fact = gold_of(tiny).read("gold", "fact_sales")
    assert sum(got.values()) == fact.where("order_year IN (1996, 2000) AND region = 'EUROPE'").count()
    assert queries()["star_leap_year_revenue"](spark, tiny.sf_dir).count() == len(got)


def test_only_the_asked_years_lines_are_read(tiny):
    lake = gold_of(tiny)
    q = M.revenue_by_brand_year(lake, "EUROPE", M.leap_days(lake))
    q.collect()
    def scans(node):
        found = [node] if "FileSourceScanExec" in node.getClass().getSimpleName() else []
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            return scans(node.executedPlan())
        if hasattr(node, "plan") and "QueryStageExec" in node.getClass().getSimpleName():
            return scans(node.plan())
        kids = node.children()
        return found + [x for i in range(kids.size()) for x in scans(kids.apply(i))]
    read = [(s.metrics().apply("numOutputRows").value(), s.metrics().apply("numFiles").value()) for s in scans(q._jdf.queryExecution().executedPlan())
            if s.metrics().contains("numPartitions") and "order_year" in s.toString()]
    lines = lake.read("gold", "fact_sales")
    assert read and read[0][0] == lines.where("order_year IN (1996, 2000)").count() < lines.count()


def test_surrogates_are_made_after_the_lines_are_dealt_out(tiny, spark, monkeypatch):
    """The fact crosses the writers' shuffle and sort without surrogates and measures; its rows are those of M6."""
    seen, write = {}, Lake.write
    monkeypatch.setattr(Lake, "write", lambda self, df, zone, table, *a, **k: (seen.update({table: df}), write(self, df, zone, table, *a, **k))[1])
    lake = Lake(spark)
    M.load_star(tiny, lake)
    assert not {"customer_sk", "product_sk", "supplier_sk", "gross", "net"} & set(seen["fact_sales"].columns)
    want = M.fact_sales(tiny)
    got = lake.read("gold", "fact_sales").select(*want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_shuffles_follow_the_bytes_of_the_sources(spark):
    from orderlake.plans import gold
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with gold.shuffles_for(spark, 1000 * gold.PART_BYTES + 1):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "1001"
    with gold.shuffles_for(spark, 0):
        assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
