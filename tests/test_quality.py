import re

import pytest
from pyspark.sql import functions as F

from orderlake.functions import rules as R
from orderlake.operators import quality as Q
from tests.conftest import plan_text


def test_run_checks_one_scan_one_row_per_rule(tiny):
    rules = [R.in_set("l_returnflag", ["R", "A", "N"]), R.in_range("l_discount", 0, 0.1),
             R.is_complete("l_shipdate"), R.matches("l_linestatus", "^[OF]$")]
    report = Q.run_checks(tiny.lineitem, rules, "lineitem")
    rows = report.collect()
    assert [r.rule for r in rows] == [r.name for r in rules]
    assert {r.checked for r in rows} == {tiny.lineitem.count()}
    plan = plan_text(Q.run_checks(tiny.lineitem, rules, "lineitem"))     # planned, not yet run
    scans = [line for line in plan.splitlines() if re.match(r"^\(\d+\) Scan parquet", line)]
    assert len(scans) == 1          # every rule from a single scan


def test_uniqueness_counts(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (3,), (3,)], "k int")
    r = Q.uniqueness(df, ["k"]).first()
    assert (r.checked, r.distinct_keys, r.duplicate_keys, r.failed) == (6, 3, 2, 3)
    assert r.passed is False


def test_enforce_warn_drop_fail(spark):
    df = spark.createDataFrame([(1, "O"), (-2, "O"), (3, "?")], "amount int, status string")
    rules = [R.in_range("amount", lo=0, action="drop"), R.in_set("status", ["O"], action="warn")]
    kept, obs = Q.enforce(df, rules)
    assert sorted(r.amount for r in kept.collect()) == [1, 3]
    m = obs.get
    assert m["rows"] == 3 and m["amount_in_range"] == 1 and m["status_in_set"] == 1
    failing, _ = Q.enforce(df, [R.in_range("amount", lo=0, action="fail")])
    with pytest.raises(Exception, match="quality rule failed"):
        failing.collect()


def test_gate_raises_below_threshold(spark):
    df = spark.createDataFrame([(None,), (1,)], "a int")
    with pytest.raises(Q.QualityGateError):
        Q.gate(Q.run_checks(df, [R.is_complete("a", min_pass=0.9)]))
    Q.gate(Q.run_checks(df, [R.is_complete("a", min_pass=0.5)]))


def test_volume_freshness(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2024-01-01",), ("2024-01-03",)], "d string") \
        .select(F.to_timestamp("d").alias("d"))
    r = Q.volume_freshness(df, "d", 2, 5, F.lit("2024-01-10").cast("date"), 5, "t").first()
    assert (r.days, r.row_count, r.days_out_of_bounds, r.age_days, r.fresh) == (2, 3, 1, 7, False)


def test_referential_rule_counts_orphans(spark):
    fact = spark.createDataFrame([(1,), (2,), (None,)], "fk int")
    dim = spark.createDataFrame([(1,)], "k int")
    r = Q.run_checks(fact, [R.refers_to("fk", dim, "k")]).first()
    assert (r.checked, r.failed) == (3, 1)


def test_referential_rules_beside_plain_ones_in_one_scan(spark):
    fact = spark.createDataFrame([(i, i % 7 if i % 5 else None, i % 3, float(i)) for i in range(700)], "id int, a bigint, b int, m double")
    dims = spark.createDataFrame([(k,) for k in (0, 1, 2, 2, None)], "k bigint"), spark.createDataFrame([(0,), (1,)], "k int")
    rules = [R.in_range("m", lo=100.0), R.refers_to("a", dims[0], "k", name="a_known"), R.is_complete("a"),
             R.refers_to("b", dims[1], "k", name="b_known", min_pass=0.5)]
    rows = Q.run_checks(fact, rules, "fact").collect()
    want = [100, sum(1 for i in range(700) if i % 5 and i % 7 > 2), 140, sum(1 for i in range(700) if i % 3 == 2)]
    assert [(r.rule, r.checked, r.failed) for r in rows] == [(r.name, 700, w) for r, w in zip(rules, want)]
    plan = plan_text(Q.run_checks(fact, rules)).split("\n\n")[0]
    assert plan.count("Scan ExistingRDD") == 3                       # the table once, and each dimension
    assert [(r.checked, r.failed, r.pass_rate) for r in Q.run_checks(fact.limit(0), rules).collect()] == [(0, 0, 1.0)] * 4
    text = spark.createDataFrame([("x",)], "k string")
    with pytest.raises(ValueError, match="one type"):
        Q.run_checks(fact, [R.refers_to("a", text, "k")])


def test_the_referential_report_shuffles_counts_not_rows(tiny):
    """Every exchange below a join carries counted keys or another table's keys."""
    from orderlake.registry import queries
    plan = plan_text(queries()["dq_referential"](tiny.spark, tiny.sf_dir)).split("\n\n")[0]
    # lines once, orders twice (own rules and the recipe), customer twice, part, supplier, orders as the lines' reference
    assert plan.count("Scan parquet") == 8, plan


def test_a_hot_foreign_key_is_one_row_per_partition(spark):
    fact = spark.range(100_000).selectExpr("CASE WHEN id % 3 = 0 THEN 7L ELSE id END AS fk").repartition(4)
    dim = spark.range(50_000).selectExpr("id AS k")
    r = Q.run_checks(fact, [R.refers_to("fk", dim, "k")]).first()
    assert (r.checked, r.failed) == (100_000, sum(1 for i in range(50_000, 100_000) if i % 3))


def test_enforced_rows_and_quarantine_are_two_sides_of_one_write(spark):
    from orderlake.sources.zones import Lake
    df = spark.createDataFrame([(1, 5, "O"), (2, -1, "O"), (3, None, "?"), (4, 7, "F")], "id int, amount int, status string")
    rules = [R.is_complete("amount"), R.in_range("amount", lo=0), R.in_set("status", ["O", "F"])]
    lake = Lake(spark)
    for _ in range(2):                               # a rerun replaces both sides
        seen = Q.enforce_to(lake, df, rules, "silver", "t")
    assert seen == {"rows": 4, "rejected": 2, "amount_complete": 1, "amount_in_range": 1, "status_in_set": 1}
    assert sorted(r.id for r in lake.read("silver", "t").collect()) == [1, 4] and lake.read("silver", "t").columns == df.columns
    assert {r.id: r.failed_rules for r in lake.read("silver", "t_quarantine").collect()} == {
        2: "amount_in_range", 3: "amount_complete,status_in_set"}
    assert "PartitionFilters: [isnotnull(is_valid" in plan_text(lake.read("silver", "t"))
