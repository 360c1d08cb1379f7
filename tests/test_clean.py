import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from orderlake.fixtures import raw_orders
from orderlake.operators import clean as C
from tests.conftest import plan_text


def test_standardise_trims_collapses_and_folds(spark):
    df = spark.createDataFrame([("  a  b\t c ",), ("X",)], "s string")
    assert [r.s for r in C.standardise(df, ["s"]).collect()] == ["A B C", "X"]


def test_parse_typed_bad_values_become_null(spark):
    df = spark.createDataFrame([(" 12 ", "abc", "1998-13-45"), ("x", "-1.50", "05/10/1998"), ("7", "", "1998-10-05")],
                               "i string, m string, d string")
    out = C.parse_typed(df, {"i": "bigint", "m": "decimal(12,2)", "d": "date"}).collect()
    assert [r.i for r in out] == [12, None, 7]
    assert [None if r.m is None else str(r.m) for r in out] == [None, "-1.50", None]
    assert [None if r.d is None else r.d.isoformat() for r in out] == [None, "1998-10-05", "1998-10-05"]


def test_null_sentinels_and_defaults(spark):
    df = spark.createDataFrame([(" ", "4-NOT SPECIFIED"), ("a", "1-URGENT")], "a string, p string")
    out = C.null_sentinels(df, {"p": ["4-NOT SPECIFIED"]}, blank_cols=["a"], defaults={"a": "n/a"}).collect()
    assert [(r.a, r.p) for r in out] == [("n/a", None), ("a", "1-URGENT")]


rows = st.lists(st.tuples(st.integers(0, 5), st.integers(1, 3), st.sampled_from(["O", "F", "P"])), max_size=30)


@settings(max_examples=15, deadline=None)
@given(rows)
def test_drop_resends_and_latest_are_idempotent(spark, data):
    df = spark.createDataFrame(data, "order_id int, seq int, status string")
    once = C.drop_resends(df)
    assert sorted(once.collect()) == sorted(C.drop_resends(once).collect())
    order = [F.col("seq").desc(), F.col("status").asc()]
    latest = C.latest_per_key(df, ["order_id"], order)
    assert sorted(latest.collect()) == sorted(C.latest_per_key(latest, ["order_id"], order).collect())
    assert latest.count() == len({k for k, _, _ in data})
    best = {}
    for k, s, st_ in data:
        if k not in best or (s, [-ord(c) for c in st_]) > (best[k][0], [-ord(c) for c in best[k][1]]):
            best[k] = (s, st_)
    assert {(r.order_id, r.seq, r.status) for r in latest.collect()} == {(k, v[0], v[1]) for k, v in best.items()}


def test_latest_per_key_passes_null_keys_and_hot_keys(spark):
    data = [(None, 1), (None, 2), (None, 2)] + [(1, s) for s in range(500)]
    df = spark.createDataFrame(data, "k int, seq int")
    out = C.latest_per_key(df, ["k"], [F.col("seq").desc()]).collect()
    assert sorted((r.k if r.k is not None else -9, r.seq) for r in out) == [(-9, 1), (-9, 2), (1, 499)]


def test_null_keys_spread_over_tasks_and_composite_keys_work(spark):
    data = [(None, "a", i % 300) for i in range(900)] + [(1, None, 7), (1, None, 7), (1, "a", 1), (1, "a", 2), (None, None, None)]
    df = spark.createDataFrame(data, "k int, j string, v int").repartition(3)
    out = C.latest_per_key(df, ["k", "j"], [F.col("v").desc()])
    assert sorted(map(str, out.collect())) == sorted(map(str, df.where("k IS NULL OR j IS NULL OR v = 2").distinct().collect()))
    assert C.latest_per_key(df, ["k", "j"], [F.col("v").desc()], null_keys="drop").collect() == [(1, "a", 2)]
    assert "WindowGroupLimit" in plan_text(out)


@pytest.mark.parametrize("name, raw_scans, shuffles", [("clean_latest_per_key", 1, 1), ("dq_report", 1, 4), ("dq_enforced_orders", 1, 3),
                                                       ("clean_quarantine", 1, 3)])
def test_the_cleaning_recipe_reads_its_input_once(tiny, name, raw_scans, shuffles):
    from orderlake.registry import queries
    plan = plan_text(queries()[name](tiny.spark, tiny.sf_dir)).split("\n\n")[0]
    once = plan_text(raw_orders(tiny.orders)).split("\n\n")[0].count("Scan parquet")     # resends and versions are made from orders
    assert plan.count("Scan parquet") == raw_scans * once + (0 if name == "clean_latest_per_key" else 1), plan
    assert plan.count("Exchange") <= shuffles, plan


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-5, 5)), st.sampled_from(["O", "F", "?"])), max_size=25))
def test_quarantine_split_is_a_partition(spark, data):
    from orderlake.functions import rules as R
    df = spark.createDataFrame(data, "amount int, status string")
    rules = [R.is_complete("amount"), R.in_range("amount", lo=0), R.in_set("status", ["O", "F"])]
    valid, quarantine = C.split_valid(df, rules)
    assert valid.count() + quarantine.count() == len(data)
    for r in quarantine.collect():
        assert len(r._failed) >= 1


def test_resolve_refs_modes(spark):
    fact = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "id int, fk bigint")
    dim = spark.createDataFrame([(10,), (11,)], "k bigint")
    assert sorted(r.id for r in C.resolve_refs(fact, dim, "fk", "k", "reject").collect()) == [2, 3]
    assert [r.id for r in C.resolve_refs(fact, dim, "fk", "k", "keep").collect()] == [1]
    got = {r.id: r.fk_resolved for r in C.resolve_refs(fact, dim, "fk", "k", "unknown").collect()}
    assert got == {1: 10, 2: -1, 3: -1}


def test_raw_orders_defect_counts_match_fixture_doc(small):
    """The counts of FIXTURES.md section 2 (sf0.01)."""
    raw = raw_orders(small.orders)
    assert raw.count() == 16055
    silver = C.latest_orders(C.clean_orders(raw))
    r = silver.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("order_date").isNull()).alias("date_null"),
        F.count_if(F.col("amount").isNull()).alias("amount_null"),
        F.count_if(F.col("amount") < 0).alias("negative"),
        F.count_if(~F.col("status").isin("O", "F", "P")).alias("bad_status"),
        F.count_if(F.col("customer_id").isNull()).alias("cust_null"),
        F.count_if(F.col("customer_id") == 999999999).alias("orphan"),
        F.count_if(F.col("priority").isNull()).alias("prio_null")).first()
    assert (r.rows, r.date_null, r.amount_null, r.negative, r.bad_status, r.cust_null, r.orphan, r.prio_null) == \
        (15000, 250, 750, 375, 209, 334, 334, 3020)
    valid, quarantine = C.split_valid(silver, C.order_rules(small.customer))
    assert quarantine.count() == 2168
    assert valid.count() == 15000 - 2168


def test_mark_orphans(spark):
    from orderlake.functions.rules import mark_orphans
    fact = spark.createDataFrame([(i, i % 7 if i % 5 else None) for i in range(200)], "id int, fk bigint")
    dim = spark.createDataFrame([(k,) for k in (0, 1, 2, 3, 4, 4, None)], "k bigint")
    got = mark_orphans(fact, "fk", dim, "k", "orphan")
    assert got.count() == 200
    assert {r.fk for r in got.where("orphan").collect()} == {5, 6}


def test_plans_are_built_without_running_a_job(tiny):
    """Reading a table's schema is the only job: one per table opened."""
    from orderlake import registry
    spark = tiny.spark
    sc = spark.sparkContext
    for name in ("clean_quarantine", "clean_orphans", "dq_referential", "dq_report", "dq_enforced_orders", "fact_sales",
                 "kpi_quality_panel"):
        sc.setJobGroup(f"build-{name}", name)
        registry.queries()[name](spark, tiny.sf_dir)
        jobs = sc.statusTracker().getJobIdsForGroup(f"build-{name}")
        stages = [sc.statusTracker().getStageInfo(s) for j in jobs for s in sc.statusTracker().getJobInfo(j).stageIds]
        sc.setJobGroup("", "")
        assert all(s is None or s.name.startswith("parquet at") for s in stages), (name, [s.name for s in stages])
