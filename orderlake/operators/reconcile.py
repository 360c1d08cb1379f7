"""Comparing two results that should agree (K10)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reconcile(a: DataFrame, b: DataFrame, keys: Sequence[str], measures: Sequence[str], a_name: str = "wh",
              b_name: str = "lake") -> DataFrame:
    """Per key both values of each measure and a status: match, differ, only_<a>, only_<b>.

    A full outer join on the keys; NULL equals NULL in keys and measures, and a
    column of its own says which sides have the key.
    """
    aa = a.select(*[F.col(k).alias(f"_a_{k}") for k in keys], *[F.col(m).alias(f"{a_name}_{m}") for m in measures],
                  F.lit(True).alias("_in_a"))
    bb = b.select(*[F.col(k).alias(f"_b_{k}") for k in keys], *[F.col(m).alias(f"{b_name}_{m}") for m in measures],
                  F.lit(True).alias("_in_b"))
    cond, same = F.lit(True), F.lit(True)
    for k in keys:
        cond = cond & F.col(f"_a_{k}").eqNullSafe(F.col(f"_b_{k}"))
    for m in measures:
        same = same & F.col(f"{a_name}_{m}").eqNullSafe(F.col(f"{b_name}_{m}"))
    status = (F.when(F.col("_in_b").isNull(), F.lit(f"only_{a_name}")).when(F.col("_in_a").isNull(), F.lit(f"only_{b_name}"))
              .when(same, F.lit("match")).otherwise(F.lit("differ")))
    return aa.join(bb, cond, "full_outer").select(
        *[F.coalesce(f"_a_{k}", f"_b_{k}").alias(k) for k in keys],
        *[c for m in measures for c in (f"{a_name}_{m}", f"{b_name}_{m}")], status.alias("status"))


def two_way(a: DataFrame, b: DataFrame, keys: Sequence[str], measures: Sequence[str], a_name: str = "wh",
            b_name: str = "lake") -> DataFrame:
    """:func:`reconcile`, beside the rows of each side that the other does not have (``exceptAll`` both ways).

    The two methods check each other: the join compares measures per key and would miss a row that is
    there twice on one side; ``exceptAll`` counts rows as they are and knows no keys.  A status of
    ``match`` with a row on only one side is such a case and becomes ``differ``.
    """
    cols = [*keys, *measures]
    surplus = []
    for name, x, y in ((a_name, a, b), (b_name, b, a)):
        only = x.select(*cols).exceptAll(y.select(*cols)).groupBy(*[F.col(k).alias(f"_{name}_{k}") for k in keys])
        surplus.append((name, only.agg(F.count(F.lit(1)).alias(f"only_{name}_rows"))))
    out = reconcile(a.dropDuplicates(cols), b.dropDuplicates(cols), keys, measures, a_name, b_name)
    for name, only in surplus:
        same = F.lit(True)
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_{name}_{k}"))
        out = out.join(only, same, "left").drop(*[f"_{name}_{k}" for k in keys])
        out = out.withColumn(f"only_{name}_rows", F.coalesce(f"only_{name}_rows", F.lit(0)))
    unequal = (F.col("status") == "match") & ((F.col(f"only_{a_name}_rows") > 0) | (F.col(f"only_{b_name}_rows") > 0))
    return out.withColumn("status", F.when(unequal, "differ").otherwise(F.col("status")))
