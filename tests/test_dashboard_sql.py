"""The SQL dashboard texts return the same rows as the DataFrame functions, and both read gold alone."""

import pytest

from orderlake.plans import dashboard as K
from orderlake.plans.dashboard_sql import DASHBOARD_SQL, PARITY_SQL, QUALITY_PANEL_SQL, run_dashboard
from orderlake.plans.gold import SOURCES, gold_of
from orderlake.registry import present


@pytest.mark.parametrize("name", sorted(DASHBOARD_SQL))
def test_sql_text_equals_dataframe_function(tiny, name):
    lake = gold_of(tiny)
    sql, df = present(run_dashboard(lake, name)), present(getattr(K, name)(lake))
    assert sql.columns == df.columns
    assert [f.dataType for f in sql.schema.fields] == [f.dataType for f in df.schema.fields]
    assert sorted(map(tuple, sql.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)
    for form in (sql, df):
        files = form.inputFiles()
        assert files and all("/gold/" in f and tiny.sf_dir not in f for f in files)


def test_gold_is_loaded_once_and_again_when_a_source_changes(spark, tiny, tmp_path):
    import shutil

    from orderlake.tables import Tables
    for name in SOURCES:
        shutil.copy(f"{tiny.sf_dir}/{name}.parquet", tmp_path / f"{name}.parquet")
    t = Tables(spark, str(tmp_path))
    first = gold_of(t)
    assert gold_of(t) is first and gold_of(tiny) is not first
    fewer = t.orders.where("o_orderkey <> 5").toPandas()
    fewer.to_parquet(tmp_path / "orders.parquet", coerce_timestamps="us")
    spark.catalog.refreshByPath(str(tmp_path))
    second = gold_of(t)
    assert second is not first
    got = K.kpi_headline(second).first()
    assert got["orders"] == len(fewer) and got["lines"] == t.lineitem.where("l_orderkey <> 5").count()


def test_the_quality_panel_text_equals_its_dataframe_form(tiny):
    from orderlake.registry import quality_panel, silver_orders
    tiny.register_views()
    silver_orders(tiny).createOrReplaceTempView("silver_orders")
    sql, df = tiny.spark.sql(QUALITY_PANEL_SQL), quality_panel(tiny)
    assert sorted(map(tuple, sql.select(*df.columns).collect())) == sorted(map(tuple, df.collect()))


def test_two_way_comparison_finds_a_planted_difference_on_each_side(spark):
    from orderlake.operators.reconcile import two_way
    rows = [("2001-01-01", "O", 5, 1.0), ("2001-01-01", "F", 6, 2.0), ("2001-02-01", "O", 7, 3.0), (None, None, 1, None)]
    schema = "month string, o_orderstatus string, orders long, total double"
    a = spark.createDataFrame([*rows, ("2001-03-01", "P", 1, 1.0), ("2001-04-01", "O", 9, 9.0)], schema)
    b = spark.createDataFrame([rows[0], ("2001-01-01", "F", 6, 2.5), rows[2], rows[2], rows[3], ("2001-05-01", "P", 1, 1.0),
                               ("2001-04-01", "O", 9, 9.0)], schema)
    a.createOrReplaceTempView("parity_wh")
    b.createOrReplaceTempView("parity_lake")
    got = two_way(a, b, ["month", "o_orderstatus"], ["orders", "total"])
    sql = spark.sql(PARITY_SQL.format(wh="parity_wh", lake="parity_lake"))
    assert sorted(map(str, got.select(*sql.columns).collect())) == sorted(map(str, sql.collect()))
    found = {(r["month"], r["o_orderstatus"]): (r["status"], r["only_wh_rows"], r["only_lake_rows"]) for r in got.collect()}
    assert found == {("2001-01-01", "O"): ("match", 0, 0), ("2001-01-01", "F"): ("differ", 1, 1), ("2001-02-01", "O"): ("differ", 0, 1),
                     (None, None): ("match", 0, 0), ("2001-03-01", "P"): ("only_wh", 1, 0), ("2001-05-01", "P"): ("only_lake", 0, 1),
                     ("2001-04-01", "O"): ("match", 0, 0)}


def test_the_two_paths_are_told_apart_when_one_goes_wrong(tiny, monkeypatch):
    """An order lost on the streaming path alone, then one on the warehouse path alone."""
    from pyspark.sql import functions as F

    from orderlake import registry_io as R
    from orderlake.operators.reconcile import two_way
    from orderlake.sources.zones import Lake
    keys, measures = ["month", "o_orderstatus"], ["orders", "total"]
    lake = Lake(tiny.spark)
    R.lake_months(tiny, lake)
    R.warehouse_months(tiny, lake)
    whole = lake.read("gold", "warehouse_months")
    assert {r["status"] for r in two_way(whole, lake.read("gold", "lake_months"), keys, measures).collect()} == {"match"}
    real = R.silver_orders
    gone = real(tiny).where("order_date IS NOT NULL AND status = 'O' AND customer_id IS NOT NULL AND amount > 0").first()["order_id"]
    monkeypatch.setattr(R, "silver_orders", lambda t: real(t).where(F.col("order_id") != gone))
    R.warehouse_months(tiny, lake)
    off = two_way(lake.read("gold", "warehouse_months"), lake.read("gold", "lake_months"), keys, measures).where("status <> 'match'").collect()
    assert len(off) == 1 and off[0]["o_orderstatus"] == "O" and (off[0]["lake_orders"] or 0) - (off[0]["wh_orders"] or 0) == 1
