"""Tag-based governance G1-G4: governed views, masking, row policies, zone catalog.

Tags and grants are small policy tables: ``tags(table, column, tag)``,
``grants(role, tag)`` and ``row_grants(role, value)``.  Resolving them touches
metadata only (at most one row per column of the governed table); the data
path is a plain ``select``, masking expressions, or a semi join.

These views produce governed *data products*.  Open-source Spark has no access
control of its own: anyone who can read the underlying files can read all
columns, so the views are only a boundary when file access is restricted to
the service that serves them.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.sources.zones import sql_string

# What each masking method does to a value of a protected column, the strictest first.
MASKS = {
    "redact": lambda c, dtype: F.lit(None).cast(dtype),
    "hash": lambda c, dtype: F.md5(c.cast("string")),
    "partial": lambda c, dtype: F.mask(c.cast("string")),
}


def tag_table(spark: SparkSession, rows: Sequence[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(list(rows), "table string, column string, tag string")


def grant_table(spark: SparkSession, rows: Sequence[tuple[str, str]]) -> DataFrame:
    return spark.createDataFrame(list(rows), "role string, tag string")


def _column_tags(tags: DataFrame, table: str) -> dict[str, set[str]]:
    out: dict[str, set[str]] = {}
    for r in tags.where(F.col("table") == table).select("column", "tag").collect():
        out.setdefault(r["column"], set()).add(r["tag"])
    return out


def _granted(grants: DataFrame, role: str) -> set[str]:
    return {r["tag"] for r in grants.where(F.col("role") == role).select("tag").distinct().collect()}


def with_tag_metadata(df: DataFrame, tags: DataFrame, table: str) -> DataFrame:
    """Carry each column's tags in its StructField metadata (kept through select and parquet)."""
    for col, ts in _column_tags(tags, table).items():
        if col in df.columns:
            df = df.withMetadata(col, {"tags": sorted(ts)})
    return df


# -- G1 -------------------------------------------------------------------------
def governed_view(df: DataFrame, table: str, tags: DataFrame, grants: DataFrame, role: str) -> DataFrame:
    """Only the columns whose tags are all granted to ``role`` (untagged columns are open)."""
    col_tags, granted = _column_tags(tags, table), _granted(grants, role)
    allowed = [c for c in df.columns if col_tags.get(c, set()) <= granted]
    return with_tag_metadata(df.select(*allowed), tags, table)


# -- G2 -------------------------------------------------------------------------
def mask_by_tag(df: DataFrame, table: str, tags: DataFrame, grants: DataFrame, role: str,
                methods: Mapping[str, str]) -> DataFrame:
    """Columns carrying a tag the role lacks are masked by the strictest of those
    tags' methods (``methods`` maps tag -> redact | hash | partial, redact if not
    given); others pass unchanged.  ``hash`` is a pseudonym, not a secret: who can
    guess a value can check the guess."""
    col_tags, granted = _column_tags(tags, table), _granted(grants, role)
    out = []
    for f in df.schema.fields:
        c = f.name
        missing = col_tags.get(c, set()) - granted
        col: Column = F.col(c)
        if missing:
            asked = {methods.get(tag, "redact") for tag in missing}
            method = next(m for m in MASKS if m in asked)
            col = MASKS[method](col, f.dataType)
        out.append(col.alias(c))
    return df.select(*out)


# -- G3 -------------------------------------------------------------------------
def row_policy(df: DataFrame, column: str, row_grants: DataFrame, role: str) -> DataFrame:
    """Rows whose ``column`` value is granted to ``role``.

    The granted values of one role are a policy list (bounded by the domain
    of ``column``, e.g. 5 regions), so they are broadcast into a semi join.
    """
    allowed = row_grants.where(F.col("role") == role).select(F.col("value").alias("_allowed")).distinct()
    return df.join(F.broadcast(allowed), df[column] == F.col("_allowed"), "left_semi")


# -- G4 -------------------------------------------------------------------------
def register(lake, df: DataFrame, zone: str, name: str, comment: str, owner: str,
             tags: DataFrame | None = None, partition_by: Sequence[str] = ()) -> str:
    """Write ``df`` as ``<zone>.<name>`` with comment, owner and column tags."""
    full = lake.write(df, zone, name, partition_by)
    spark = lake.spark
    spark.sql(f"COMMENT ON TABLE {full} IS {sql_string(comment)}")
    props = {"data_owner": owner}   # "owner" itself is reserved by Spark
    if tags is not None:
        for col, ts in _column_tags(tags, name).items():
            props[f"tags.{col}"] = ",".join(sorted(ts))
    kv = ", ".join(f"{sql_string(k)} = {sql_string(v)}" for k, v in props.items())
    spark.sql(f"ALTER TABLE {full} SET TBLPROPERTIES ({kv})")
    return full


def catalog_report(lake) -> DataFrame:
    """Every table of the lake's zones with owner, comment, columns and their tags."""
    spark = lake.spark
    rows = []
    for zone in ("bronze", "silver", "gold"):
        schema = lake.schema(zone)
        for t in spark.catalog.listTables(schema):
            if t.isTemporary:          # session temp views are listed under every schema
                continue
            props = {r["key"]: r["value"] for r in
                     spark.sql(f"SHOW TBLPROPERTIES `{schema}`.`{t.name}`").collect()}
            for c in spark.catalog.listColumns(f"`{schema}`.`{t.name}`"):
                rows.append((zone, t.name, props.get("data_owner"), t.description, c.name, c.dataType,
                             c.isPartition, props.get(f"tags.{c.name}")))
    return spark.createDataFrame(rows, "zone string, table string, owner string, comment string, column string, "
                                       "data_type string, is_partition boolean, tags string")
