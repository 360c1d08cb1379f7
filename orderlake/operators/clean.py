"""Cleaning operators C1-C7.

All of them are projections, filters, one window or one join: no Python runs
per row.  Shuffles: C4 and C5 shuffle once on the business key (with map-side
combine / map-side group limit), C7 joins on the foreign key.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.functions.dates import DEFAULT_DATE_FORMATS, parse_date_multi
from orderlake.functions.text import blank_to_null, standardise_col

# The sentinel that stands for "missing" in the priority column.
PRIORITY_SENTINEL = "4-NOT SPECIFIED"
BUSINESS_COLUMNS = ("order_id", "customer_id", "order_date", "amount", "status", "priority", "seq")
ORDER_STATUSES = ("O", "F", "P")


# -- C1 -----------------------------------------------------------------------
def standardise(df: DataFrame, cols: Sequence[str], case: str = "upper") -> DataFrame:
    """Trim, collapse inner white space and fold case of the given text columns."""
    return df.withColumns({c: standardise_col(c, case) for c in cols})


# -- C2 -----------------------------------------------------------------------
def _typed(c: str, spec: str) -> Column:
    if spec.startswith("date"):
        formats = tuple(spec.split(":", 1)[1].split("|")) if ":" in spec else DEFAULT_DATE_FORMATS
        return parse_date_multi(c, formats)
    # try_cast: an unparseable value becomes NULL instead of failing the job (ANSI mode)
    return F.expr(f"try_cast(trim(`{c}`) AS {spec})")


def parse_typed(df: DataFrame, spec: Mapping[str, str]) -> DataFrame:
    """Tolerant typing.  ``spec`` maps column -> SQL type, or ``date:fmt1|fmt2``."""
    return df.withColumns({c: _typed(c, t) for c, t in spec.items()})


# -- C3 -----------------------------------------------------------------------
def null_sentinels(df: DataFrame, sentinels: Mapping[str, Sequence[str]] | None = None,
                   blank_cols: Sequence[str] = (), defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Blank text and sentinel values become NULL; optional defaults fill NULLs afterwards."""
    out = {}
    for c in blank_cols:
        out[c] = blank_to_null(c)
    for c, values in (sentinels or {}).items():
        base = out.get(c, F.col(c))
        out[c] = F.when(base.isin(list(values)), F.lit(None)).otherwise(base)
    df = df.withColumns(out) if out else df
    if defaults:
        df = df.fillna(dict(defaults))
    return df


# -- C4 -----------------------------------------------------------------------
def drop_resends(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Identical records kept once.  Lineage columns (``_*``) are ignored."""
    cols = list(cols) if cols else [c for c in df.columns if not c.startswith("_")]
    return df.dropDuplicates(cols)


# -- C5 -----------------------------------------------------------------------
def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], null_keys: str = "distinct") -> DataFrame:
    """Newest version of each key, in one pass over ``df``: one scan, one shuffle.

    ``order`` ranks versions best-first; the remaining columns are appended as a
    final tie-break so the choice is deterministic.  ``row_number() = 1`` is
    planned with a map-side WindowGroupLimit, so a key that holds a large share
    of the rows is cut to one row per input partition before the shuffle.

    Rows with a NULL in the key have no version chain.  In the same window they
    are grouped by their whole content, so they spread over all tasks and each
    different one stays, identical ones once (they are resends, as in C4).
    ``null_keys="drop"`` leaves them out, for callers that have set them aside.
    """
    keys = list(keys)
    if null_keys not in ("distinct", "drop"):
        raise ValueError(null_keys)
    tie = [F.col(c).asc_nulls_last() for c in df.columns if c not in keys]
    unknown = F.lit(False)
    for k in keys:
        unknown = unknown | F.col(k).isNull()
    if null_keys == "drop":
        df, group = df.where(~unknown), keys
    else:
        # NULL for every row with a key, so it costs those rows one bit
        group = [*keys, F.when(unknown, F.struct(*df.columns))]
    w = Window.partitionBy(*group).orderBy(*order, *tie)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


# -- C6 -----------------------------------------------------------------------
def flag_failures(df: DataFrame, rules) -> DataFrame:
    """Adds ``_failed``: array of the names of the rules a row breaks (empty if none)."""
    from orderlake.functions.rules import helper_columns, prepare_all
    prepared = prepare_all(df, rules)
    failed = F.filter(F.array(*[F.when(r.failing(), F.lit(r.name)) for r in rules]),
                      lambda x: x.isNotNull())
    return prepared.withColumn("_failed", failed).drop(*helper_columns(prepared))


def split_valid(df: DataFrame, rules) -> tuple[DataFrame, DataFrame]:
    """Every row goes to exactly one side: (valid, quarantine-with-failed-rules)."""
    flagged = flag_failures(df, rules)
    ok = F.size("_failed") == 0
    return flagged.where(ok).drop("_failed"), flagged.where(~ok)


# -- C7 -----------------------------------------------------------------------
UNKNOWN_KEY = -1


def resolve_refs(fact: DataFrame, dim: DataFrame, fk: str, dim_key: str, mode: str = "unknown",
                 unknown=UNKNOWN_KEY) -> DataFrame:
    """Rows whose foreign key is missing from ``dim``.

    mode ``reject``: the rows that cannot be resolved (orphans and NULL keys);
    ``keep``: the matched rows; ``unknown``: every row, orphans and NULL keys
    mapped to the unknown member, with ``<fk>_resolved``.  Orphans are found
    with one lazy left join (``rules.mark_orphans``).
    """
    from orderlake.functions.rules import mark_orphans
    flagged = mark_orphans(fact, fk, dim, dim_key, "_orphan")
    unresolved = F.col("_orphan") | F.col(fk).isNull()
    if mode == "reject":
        return flagged.where(unresolved).drop("_orphan")
    if mode == "keep":
        return flagged.where(~unresolved).drop("_orphan")
    if mode != "unknown":
        raise ValueError(mode)
    resolved = F.when(unresolved, F.lit(unknown).cast(fact.schema[fk].dataType)).otherwise(F.col(fk))
    return flagged.withColumn(f"{fk}_resolved", resolved).drop("_orphan")


# -- the cleaning recipe for raw_orders ---------------------------------------
ORDER_TYPES = {"order_id": "bigint", "customer_id": "bigint", "order_date": "date", "amount": "decimal(12,2)"}


def clean_orders(raw: DataFrame) -> DataFrame:
    """C1 + C3 + C2 on raw order records: one projection, no shuffle."""
    df = standardise(raw, ["status"])
    df = null_sentinels(df, {"priority": [PRIORITY_SENTINEL]}, blank_cols=["customer_id", "amount", "priority"])
    return parse_typed(df, ORDER_TYPES)


def latest_orders(cleaned: DataFrame) -> DataFrame:
    """C4 and C5 in one pass: newest version (highest seq) per order, resends removed.

    Resends of a numbered order lose the same window that picks the version, so
    they need no shuffle of their own.
    """
    return latest_per_key(cleaned, ["order_id"], [F.col("seq").desc(), F.col("status").asc_nulls_last()])


def order_rules(customer: DataFrame):
    """Rules that send a silver order to quarantine (priority may be NULL by design)."""
    from orderlake.functions import rules as R
    return [
        R.is_complete("order_date", name="order_date_complete"),
        R.is_complete("amount", name="amount_complete"),
        R.in_range("amount", lo=0, name="amount_non_negative"),
        R.in_set("status", ORDER_STATUSES, name="status_in_set"),
        R.is_complete("customer_id", name="customer_id_complete"),
        R.refers_to("customer_id", customer, "c_custkey", name="customer_id_known"),
    ]
