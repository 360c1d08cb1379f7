from hypothesis import given, settings, strategies as st

from orderlake.operators import governance as G

TAGS = [("customer", "c_name", "pii"), ("customer", "c_acctbal", "financial"), ("customer", "c_acctbal", "pii")]


@settings(max_examples=10, deadline=None)
@given(st.sets(st.sampled_from(["pii", "financial", "other"])))
def test_governed_view_never_returns_ungranted_column(tiny, granted):
    spark = tiny.spark
    tags = G.tag_table(spark, TAGS)
    grants = G.grant_table(spark, [("r", t) for t in granted] or [("nobody", "x")])
    cols = set(G.governed_view(tiny.customer, "customer", tags, grants, "r").columns)
    for _, col, tag in TAGS:
        if tag not in granted:
            assert col not in cols
    assert {"c_custkey", "c_nationkey", "c_mktsegment"} <= cols


def test_mask_and_metadata(tiny):
    spark = tiny.spark
    tags = G.tag_table(spark, TAGS[:2])
    grants = G.grant_table(spark, [("finance", "financial")])
    masked = G.mask_by_tag(tiny.customer, "customer", tags, grants, "finance", {"pii": "hash"})
    r = masked.first()
    assert len(r.c_name) == 32 and r.c_acctbal is not None
    view = G.governed_view(tiny.customer, "customer", tags, grants, "finance")
    assert view.schema["c_acctbal"].metadata == {"tags": ["financial"]}


def test_the_strictest_mask_of_a_column_wins(spark):
    df = spark.createDataFrame([("Ann",)], "name string")
    tags = G.tag_table(spark, [("t", "name", "a_financial"), ("t", "name", "z_pii")])
    grants = G.grant_table(spark, [("r", "other")])
    mask = lambda methods: G.mask_by_tag(df, "t", tags, grants, "r", methods).first().name
    assert mask({"a_financial": "partial", "z_pii": "redact"}) is None
    assert len(mask({"a_financial": "partial", "z_pii": "hash"})) == 32
    assert mask({"a_financial": "partial", "z_pii": "partial"}) == "Xxx"
    assert mask({"a_financial": "partial"}) is None          # a tag without a method is redacted


def test_quotes_in_comments_and_owners(spark):
    from orderlake.sources.zones import Lake
    lake = Lake(spark)
    G.register(lake, spark.range(1), "silver", "t", "it's \\ here", "o'team")
    r = G.catalog_report(lake).first()
    assert (r.comment, r.owner) == ("it's \\ here", "o'team")


def test_row_policy(tiny):
    spark = tiny.spark
    df = spark.createDataFrame([(1, "EUROPE"), (2, "ASIA")], "id int, region string")
    grants = spark.createDataFrame([("eu", "EUROPE")], "role string, value string")
    assert [r.id for r in G.row_policy(df, "region", grants, "eu").collect()] == [1]
    assert G.row_policy(df, "region", grants, "nobody").count() == 0


def test_catalog_report_ignores_session_temp_views(tiny):
    from orderlake.sources.zones import Lake
    spark = tiny.spark
    tiny.customer.createOrReplaceTempView("customer")
    lake = Lake(spark)
    G.register(lake, tiny.customer, "silver", "customer", "customers", "team")
    rows = G.catalog_report(lake).collect()
    assert {(r.zone, r.table) for r in rows} == {("silver", "customer")}
    assert len(rows) == len(tiny.customer.columns)
