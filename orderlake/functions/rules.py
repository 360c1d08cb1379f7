"""Data-quality rules as Column predicates.

A rule is a name, a family (after the constraint families of Schelter et al.,
PVLDB 2018), and a *failing* predicate.  The predicate is NULL-safe: NULL counts
as passing, so that completeness is the only rule about missing values.  Rules
that need another table (referential integrity) carry a ``prepare`` step that
adds a boolean match column with one left join.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable, Optional, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    name: str
    family: str
    fails: Callable[[], Column]
    min_pass: float = 1.0
    action: str = "drop"   # warn | drop | fail (Q10)
    prepare: Optional[Callable[[DataFrame], DataFrame]] = field(default=None, compare=False)
    ref: Optional[tuple[str, DataFrame, str]] = field(default=None, compare=False)   # (column, other table, its key)

    def failing(self) -> Column:
        return F.coalesce(self.fails(), F.lit(False))


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_complete(col: str, min_pass: float = 1.0, action: str = "drop", name: str | None = None) -> Rule:
    return Rule(name or f"{col}_complete", "completeness", lambda: F.col(col).isNull(), min_pass, action)


def in_set(col: str, values: Sequence, min_pass: float = 1.0, action: str = "drop",
           name: str | None = None) -> Rule:
    vals = list(values)
    return Rule(name or f"{col}_in_set", "domain", lambda: ~F.col(col).isin(vals), min_pass, action)


def in_range(col: str, lo=None, hi=None, min_pass: float = 1.0, action: str = "drop",
             name: str | None = None) -> Rule:
    def fails():
        c = F.col(col)
        cond = F.lit(False)
        if lo is not None:
            cond = cond | (c < F.lit(lo))
        if hi is not None:
            cond = cond | (c > F.lit(hi))
        return cond
    return Rule(name or f"{col}_in_range", "range", fails, min_pass, action)


def matches(col: str, regex: str, min_pass: float = 1.0, action: str = "drop",
            name: str | None = None) -> Rule:
    return Rule(name or f"{col}_matches", "pattern", lambda: ~F.col(col).rlike(regex), min_pass, action)


def satisfies(name: str, predicate: Callable[[], Column], min_pass: float = 1.0,
              action: str = "warn") -> Rule:
    """Cross-column rule: fails where ``predicate`` is false."""
    return Rule(name, "expression", lambda: ~predicate(), min_pass, action)


def mark_orphans(df: DataFrame, fk: str, dim: DataFrame, dim_key: str, flag: str) -> DataFrame:
    """Adds boolean ``flag``: ``fk`` is not NULL and has no match in ``dim[dim_key]``.

    One left join with the dimension's distinct keys, in batch and on a stream
    alike.  No job runs while the plan is built: at run time Spark broadcasts
    the keys if their measured size allows it, and otherwise shuffles and splits
    skewed keys (those without a key among them).
    """
    found = dim.select(F.col(dim_key).alias("_orphan_key")).where(F.col("_orphan_key").isNotNull()).distinct()
    found = found.withColumn("_found", F.lit(True))
    j = df.join(found, df[fk] == found["_orphan_key"], "left")
    return (j.withColumn(flag, F.col(fk).isNotNull() & F.col("_found").isNull())
             .drop("_orphan_key", "_found"))


def refers_to(col: str, other: DataFrame, other_key: str, min_pass: float = 1.0,
              action: str = "drop", name: str | None = None) -> Rule:
    """Referential integrity: a non-NULL ``col`` must exist in ``other[other_key]``.

    ``prepare`` flags orphans with :func:`mark_orphans` (every input row kept
    exactly once).
    """
    rule_name = name or f"{col}_refers_to_{other_key}"
    flag = f"_ref_{rule_name}"

    def prepare(df: DataFrame) -> DataFrame:
        return mark_orphans(df, col, other, other_key, flag)

    return Rule(rule_name, "referential", lambda: F.col(flag), min_pass, action, prepare, (col, other, other_key))


def prepare_all(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    for r in rules:
        if r.prepare is not None:
            df = r.prepare(df)
    return df


def helper_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("_ref_")]
