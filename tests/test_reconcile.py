from orderlake.operators.reconcile import reconcile


def test_every_status_and_null_keys(spark):
    a = spark.createDataFrame([(1, "x", 5), (2, "x", 5), (3, None, 1), (None, None, 2), (6, "y", None)], "k int, j string, m int")
    b = spark.createDataFrame([(1, "x", 5), (2, "x", 6), (4, "x", 1), (None, None, 2), (6, "y", None)], "k int, j string, m int")
    got = {(r.k, r.j): (r.wh_m, r.lake_m, r.status) for r in reconcile(a, b, ["k", "j"], ["m"]).collect()}
    assert got == {(1, "x"): (5, 5, "match"), (2, "x"): (5, 6, "differ"), (3, None): (1, None, "only_wh"),
                   (4, "x"): (None, 1, "only_lake"), (None, None): (2, 2, "match"), (6, "y"): (None, None, "match")}
    left = reconcile(a.select("k", "m"), b.select("k", "m"), ["k"], ["m"]).where("k IS NULL").first()
    assert left.status == "match"
