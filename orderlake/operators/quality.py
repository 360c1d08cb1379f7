"""Data-quality operators Q1-Q10.

Row-level rules of a table are evaluated in ONE scan with partial aggregation
before the shuffle, referential rules among them (by counted keys), then
unpivoted with ``stack`` into one row per rule.  Group-level checks (uniqueness, volume) are one
``groupBy`` each.  Nothing is collected to the driver except the one-row
aggregate that decides a ``fail`` action in :func:`enforce`.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.functions.rules import Rule, helper_columns, prepare_all

REPORT_COLUMNS = ("rule", "family", "checked", "failed", "pass_rate", "passed")


def _sql_str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _report_from_counts(agg: DataFrame, rules: Sequence[Rule], extra: Sequence[str] = ()) -> DataFrame:
    """Unpivot a one-row aggregate of ``_n`` and ``_f<i>`` into one row per rule."""
    parts = []
    for i, r in enumerate(rules):
        parts += [_sql_str(r.name), _sql_str(r.family), f"_f{i}", f"CAST({r.min_pass!r} AS DOUBLE)"]
    stacked = agg.selectExpr(*extra, "_n AS checked",
                             f"stack({len(rules)}, {', '.join(parts)}) AS (rule, family, failed, min_pass)")
    pass_rate = F.when(F.col("checked") == 0, F.lit(1.0)).otherwise(
        (F.col("checked") - F.col("failed")) / F.col("checked"))
    return (stacked.withColumn("pass_rate", pass_rate)
                   .withColumn("passed", F.col("pass_rate") >= F.col("min_pass"))
                   .select(*extra, *REPORT_COLUMNS))


# -- Q9 -----------------------------------------------------------------------
def run_checks(df: DataFrame, rules: Sequence[Rule], table: str | None = None) -> DataFrame:
    """All row-level rules of ``df`` in one scan; one result row per rule.

    A referential rule needs no row-level join: each row also emits (rule, foreign key), these are
    counted with partial counts before the shuffle, and only the counted keys meet the other table's
    keys.  So a hot key is one row per input partition, and rows are never shuffled whole.
    """
    refs = [i for i, r in enumerate(rules) if r.ref is not None]
    plain = [F.count_if(r.failing()).alias(f"_f{i}") for i, r in enumerate(rules) if i not in refs]
    if not refs:
        agg = df.agg(F.count(F.lit(1)).alias("_n"), *plain)
    else:
        agg = _counts_with_references(df, rules, refs)
    extra = []
    if table is not None:
        agg = agg.withColumn("source_table", F.lit(table))
        extra = ["source_table"]
    return _report_from_counts(agg, rules, extra)


def _key_type(df: DataFrame, rules: Sequence[Rule], refs: Sequence[int]) -> str:
    """One type that every foreign key and the key it refers to can be compared in."""
    types = {frame.schema[c].dataType for i in refs for frame, c in ((df, rules[i].ref[0]), (rules[i].ref[1], rules[i].ref[2]))}
    if all(isinstance(t, T.IntegralType) for t in types):
        return "bigint"
    if len(types) > 1:
        raise ValueError(f"referential rules of one report need keys of one type, not {sorted(t.simpleString() for t in types)}")
    return types.pop().simpleString()


def _counts_with_references(df: DataFrame, rules: Sequence[Rule], refs: Sequence[int]) -> DataFrame:
    kind = _key_type(df, rules, refs)
    flags = [i for i in range(len(rules)) if i not in refs]
    # rule -1 carries the row itself, with the rules that look at nothing else
    own = F.struct(F.lit(-1).alias("rule"), F.lit(None).cast(kind).alias("key"),
                   *[rules[i].failing().alias(f"b{i}") for i in flags])
    keyed = [F.struct(F.lit(i).alias("rule"), F.col(rules[i].ref[0]).cast(kind).alias("key"),
                      *[F.lit(False).alias(f"b{k}") for k in flags]) for i in refs]
    emitted = df.select(F.explode(F.array(own, *keyed)).alias("e")).select("e.*").where("rule = -1 OR key IS NOT NULL")
    counted = emitted.groupBy("rule", "key").agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(f"b{i}")).alias(f"_f{i}") for i in flags])
    known = None
    for i in refs:
        _, other, key = rules[i].ref
        part = other.select(F.lit(i).alias("rule"), F.col(key).cast(kind).alias("key")).where("key IS NOT NULL")
        known = part if known is None else known.unionByName(part)
    left = counted.join(known, ["rule", "key"], "left_anti")          # the row counts and the orphans' counts
    sums = [F.coalesce(F.sum(F.when(F.col("rule") == -1, F.col("n"))), F.lit(0)).cast("bigint").alias("_n")]
    for i in range(len(rules)):
        one = F.sum(F.when(F.col("rule") == i, F.col("n"))) if i in refs else F.sum(f"_f{i}")
        sums.append(F.coalesce(one, F.lit(0)).cast("bigint").alias(f"_f{i}"))
    return left.agg(*sums)


# -- Q1, Q3, Q4, Q5, Q6, Q7: rule families (see functions.rules) ---------------
def completeness(df: DataFrame, cols: Sequence[str], min_pass: float = 1.0) -> DataFrame:
    from orderlake.functions.rules import is_complete
    return run_checks(df, [is_complete(c, min_pass) for c in cols])


# -- Q2 -----------------------------------------------------------------------
def uniqueness(df: DataFrame, cols: Sequence[str], name: str | None = None, min_pass: float = 1.0) -> DataFrame:
    """Keys seen more than once and the surplus rows they bring.

    One ``groupBy(cols).count()`` (partial counts before the shuffle, so a hot
    key costs one row per input partition), then a one-row aggregate.
    """
    name = name or "unique(" + ",".join(cols) + ")"
    per_key = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_c"))
    agg = per_key.agg(
        F.sum("_c").cast("bigint").alias("checked"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col("_c") > 1).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(F.col("_c") > 1, F.col("_c") - 1)), F.lit(0)).cast("bigint").alias("failed"))
    pass_rate = F.when(F.col("checked") == 0, F.lit(1.0)).otherwise(
        (F.col("checked") - F.col("failed")) / F.col("checked"))
    return (agg.withColumn("rule", F.lit(name)).withColumn("family", F.lit("uniqueness"))
               .withColumn("pass_rate", pass_rate)
               .withColumn("passed", F.col("pass_rate") >= F.lit(float(min_pass)))
               .select("rule", "family", "checked", "distinct_keys", "duplicate_keys", "failed", "pass_rate", "passed"))


# -- Q8 -----------------------------------------------------------------------
def volume_freshness(df: DataFrame, date_col: str, min_rows: int, max_rows: int, as_of: Column,
                     max_age_days: int, table: str) -> DataFrame:
    """Rows per day against bounds, and the age of the newest row at ``as_of``.

    ``as_of`` is a Column (e.g. ``current_date()`` in production, a fixed date
    in tests).  One groupBy per day (bounded by the calendar), then one row.
    """
    per_day = df.groupBy(F.to_date(F.col(date_col)).alias("_d")).agg(F.count(F.lit(1)).alias("_c"))
    agg = per_day.agg(
        F.count(F.lit(1)).alias("days"),
        F.sum("_c").cast("bigint").alias("row_count"),
        F.min("_c").alias("min_rows_per_day"),
        F.max("_c").alias("max_rows_per_day"),
        F.count_if((F.col("_c") < min_rows) | (F.col("_c") > max_rows)).alias("days_out_of_bounds"),
        F.max("_d").alias("newest"))
    age = F.datediff(as_of, F.col("newest"))
    return (agg.withColumn("source_table", F.lit(table))
               .withColumn("age_days", age.cast("int"))
               .withColumn("fresh", age <= F.lit(max_age_days))
               .withColumn("volume_ok", F.col("days_out_of_bounds") == 0)
               .select("source_table", "days", "row_count", "min_rows_per_day", "max_rows_per_day", "days_out_of_bounds",
                       "volume_ok", "newest", "age_days", "fresh"))


# -- Q10 ----------------------------------------------------------------------
class QualityGateError(RuntimeError):
    pass


def enforce(df: DataFrame, rules: Sequence[Rule], name: str = "dq") -> tuple[DataFrame, Observation | str]:
    """Apply each rule's action: ``warn`` keeps and counts, ``drop`` removes,
    ``fail`` stops the job at the first failing row (``raise_error`` in the
    projection, so a write never commits partial output).

    Counts of every rule are published through an :class:`Observation` that
    is filled by whatever action runs the returned DataFrame.  On a streaming
    DataFrame the metrics are published under ``name`` in each micro-batch's
    progress (``observedMetrics``) instead.
    """
    prepared = prepare_all(df, rules)
    obs = name if df.isStreaming else Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows")] + [F.count_if(r.failing()).alias(r.name) for r in rules]
    observed = prepared.observe(obs, *metrics)
    for r in rules:
        if r.action == "fail":
            # a filter, not a dropped column: the optimizer must not prune the check away
            observed = observed.where(
                F.when(r.failing(), F.raise_error(F.lit(f"quality rule failed: {r.name}")).cast("boolean"))
                 .otherwise(F.lit(True)))
    drop = [r for r in rules if r.action == "drop"]
    if drop:
        keep = ~F.greatest(*[r.failing() for r in drop]) if len(drop) > 1 else ~drop[0].failing()
        observed = observed.where(keep)
    return observed.drop(*helper_columns(prepared)), obs


def enforce_to(lake, df: DataFrame, rules: Sequence[Rule], zone: str, table: str) -> dict:
    """Write the rows that pass to ``<zone>.<table>`` and those that fail, with the rules they broke, to
    ``<zone>.<table>_quarantine``; returns the counts observed by the write.

    One pass and one write: ``<table>_checked`` is partitioned by the verdict, and the two names are views
    that read one side's folder each.  Together they are the input.
    """
    from orderlake.operators.clean import flag_failures
    seen = Observation()
    flagged = flag_failures(df, rules)
    observed = flagged.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.size("_failed") > 0).alias("rejected"),
                               *[F.count_if(F.array_contains("_failed", r.name)).alias(r.name) for r in rules])
    checked = lake.write(observed.withColumns({"failed_rules": F.concat_ws(",", "_failed"), "is_valid": F.size("_failed") == 0}).drop("_failed"),
                         zone, f"{table}_checked", ["is_valid"])
    cols = ", ".join(f"`{c}`" for c in df.columns)
    for name, what, side in ((table, cols, "is_valid"), (f"{table}_quarantine", f"{cols}, failed_rules", "NOT is_valid")):
        lake.spark.sql(f"CREATE OR REPLACE VIEW {lake.name(zone, name)} AS SELECT {what} FROM {checked} WHERE {side}")
    return seen.get


def gate(report: DataFrame) -> None:
    """Raise if any rule of a Q9 report missed its threshold (one-row check)."""
    bad = report.where(~F.col("passed")).agg(F.count(F.lit(1)).alias("n")).first()["n"]
    if bad:
        raise QualityGateError(f"{bad} quality rule(s) below threshold")
