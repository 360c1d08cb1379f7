"""Three-zone lake on catalog schemas (B1, B5, B6).

A lake has a root folder; each zone (bronze, silver, gold) is a schema whose
LOCATION is ``<root>/<zone>``, and each table a managed parquet table under
it, so partitions are folders ``<root>/<zone>/<table>/<col>=<value>/`` and can
be dropped with ``ALTER TABLE .. DROP PARTITION``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.session import delete_path, scratch_dir

ZONES = ("bronze", "silver", "gold")


def sql_string(text: str) -> str:
    """``text`` as a SQL string literal."""
    return "'" + str(text).replace("\\", "\\\\").replace("'", "\\'") + "'"


class Lake:
    def __init__(self, spark: SparkSession, root: str | None = None, prefix: str | None = None):
        self.spark = spark
        self.root = (root or scratch_dir(spark, "lake")).rstrip("/")
        # schema names are global to the session: a prefix keeps two lakes apart
        self.prefix = prefix if prefix is not None else f"lake_{uuid.uuid4().hex[:8]}_"
        for z in ZONES:
            spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{self.schema(z)}` LOCATION '{self.root}/{z}'")

    def schema(self, zone: str) -> str:
        if zone not in ZONES:
            raise ValueError(f"unknown zone {zone!r}")
        return f"{self.prefix}{zone}"

    def name(self, zone: str, table: str) -> str:
        return f"`{self.schema(zone)}`.`{table}`"

    def path(self, zone: str, table: str) -> str:
        return f"{self.root}/{zone}/{table}"

    # -- B5 ---------------------------------------------------------------------
    def write(self, df: DataFrame, zone: str, table: str, partition_by: Sequence[str] = (),
              mode: str = "overwrite", comment: str | None = None,
              bucket_by: tuple[int, Sequence[str]] | None = None,
              derive: Callable[[DataFrame], DataFrame] | None = None, compression: str | None = None) -> str:
        """Write ``df`` as ``<zone>.<table>``, partitioned by ``partition_by``.

        Rows are rebalanced by the partition columns: adaptive execution gives a
        large partition value as many tasks as its bytes ask for and packs small
        ones together, so neither the number of writers of a hot date nor the
        number of small files is fixed beforehand.  Overwrites of a partitioned
        table replace only the partition values present in ``df``.

        ``bucket_by=(n, keys)`` stores the table in ``n`` hash buckets of
        ``keys``: joins on ``keys`` then read it without a shuffle.  Such a
        table is always rewritten whole.

        ``derive`` makes the stored columns from those of ``df``, row by row and with the partition
        columns kept: rows of a partitioned table cross the shuffle and the writers' sort before it.
        ``compression`` is the codec of the files, by default the session's.
        """
        name, full = self.name(zone, table), f"{self.schema(zone)}.{table}"
        if mode not in ("overwrite", "append"):
            raise ValueError(mode)
        out = df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df
        if derive:
            if bucket_by:
                raise ValueError("derive does not go with buckets")
            out = derive(out.sortWithinPartitions(*partition_by) if partition_by else out)
        codec = {"compression": compression} if compression else {}
        exists = self.spark.catalog.tableExists(full)
        if bucket_by:
            if mode != "overwrite":
                raise ValueError("a bucketed table is rewritten whole")
            n, keys = bucket_by
            w = df.repartition(n, *[F.col(k) for k in keys]).write.format("parquet").options(**codec).mode("overwrite")
            w = w.bucketBy(n, *keys).sortBy(*keys)
            (w.partitionBy(*partition_by) if partition_by else w).saveAsTable(name)
        elif exists and mode == "overwrite" and partition_by:
            # into the table's own folder: the dynamic mode is then an option of this write alone
            (out.select(*self.spark.table(name).columns).write.mode("overwrite").options(**codec)
             .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(self.path(zone, table)))
            self.spark.catalog.recoverPartitions(full)
            self.spark.catalog.refreshTable(full)
        elif exists and mode == "append":
            out.select(*self.spark.table(name).columns).write.insertInto(name)
        else:
            w = out.write.format("parquet").options(**codec).mode("overwrite")
            if partition_by:
                w = w.partitionBy(*partition_by)
            w.saveAsTable(name)
        if comment:
            self.spark.sql(f"COMMENT ON TABLE {name} IS {sql_string(comment)}")
        return name

    def read(self, zone: str, table: str) -> DataFrame:
        return self.spark.table(self.name(zone, table))

    # -- B6 ---------------------------------------------------------------------
    def drop_partitions(self, zone: str, table: str, plan: DataFrame, column: str) -> int:
        """Drop the partitions the plan marks ``expire``.

        The list of expired values is bounded by the number of partitions (a
        few thousand at most), never by the number of rows.
        """
        expired = [r[0] for r in plan.where(F.col("action") == "expire").select(column).collect()]
        name = self.name(zone, table)
        for v in expired:
            self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (`{column}` = {sql_string(v)})")
        return len(expired)

    def archive_partitions(self, zone: str, table: str, plan: DataFrame, column: str, archive: str) -> int:
        """Move the partitions the plan marks ``archive`` to a folder below ``archive``; the table keeps their rows.

        Per partition: its files are copied by Spark, then ``SET LOCATION`` points the catalog at the copy,
        then the old folder is deleted.  A reader sees one whole copy at any time, a crash leaves at worst a
        copy that the next call overwrites, and a partition that is there already is left alone.  The list
        of values is bounded by the number of partitions.
        """
        marked = [r[0] for r in plan.where(F.col("action") == "archive").select(column).collect()]
        name, moved = self.name(zone, table), 0
        for v in marked:
            spec = f"PARTITION (`{column}` = {sql_string(v)})"
            rows = self.spark.sql(f"DESCRIBE FORMATTED {name} {spec}").where("col_name = 'Location'").collect()
            old, new = rows[0]["data_type"], f"{archive.rstrip('/')}/{zone}/{table}/{column}={v}"
            if old.rstrip("/").endswith(new.split(":", 1)[-1]):
                continue
            self.spark.read.parquet(old).write.mode("overwrite").parquet(new)
            self.spark.sql(f"ALTER TABLE {name} {spec} SET LOCATION {sql_string(new)}")
            delete_path(self.spark, old)
            moved += 1
        self.spark.catalog.refreshTable(f"{self.schema(zone)}.{table}")
        return moved

    def apply_retention(self, zone: str, table: str, plan: DataFrame, column: str, archive: str) -> tuple[int, int]:
        """Carry out a retention plan: (partitions archived, partitions dropped)."""
        return (self.archive_partitions(zone, table, plan, column, archive), self.drop_partitions(zone, table, plan, column))


# -- B1 -------------------------------------------------------------------------
def land_raw(df: DataFrame, batch_id: int, business_cols: Sequence[str] | None = None,
             file_col: Column | None = None) -> DataFrame:
    """Bronze record: every business column as text, plus lineage.

    ``_batch_id`` (delivery), ``_source_file`` (file the row came from, when
    read from files) and ``_ingested_at``.  Nothing is filtered.
    """
    cols = list(business_cols or [c for c in df.columns if not c.startswith("_")])
    src = file_col if file_col is not None else F.lit(None).cast("string")
    return df.select(*[F.col(c).cast("string").alias(c) for c in cols],
                     F.lit(batch_id).alias("_batch_id"),
                     src.alias("_source_file"),
                     F.current_timestamp().alias("_ingested_at"))


def read_landed(spark: SparkSession, path: str, cols: Sequence[str], fmt: str = "json") -> DataFrame:
    """Read landed text files with every column as string, plus the file name."""
    schema = ", ".join(f"`{c}` string" for c in cols)
    df = spark.read.schema(schema).format(fmt).option("recursiveFileLookup", "true").load(path)
    return df.withColumn("_file", F.col("_metadata.file_name"))


# -- B6 -------------------------------------------------------------------------
def retention_plan(df: DataFrame, partition_col: str, partition_date: Column, as_of: Column,
                   hot_days: int, warm_days: int) -> DataFrame:
    """Per partition: rows, age in days at ``as_of``, and the action.

    keep while younger than ``hot_days``, archive until ``warm_days``, expire
    after; a partition of unknown age is kept.  One groupBy on the partition column (partial counts first).
    """
    per = df.groupBy(partition_col).agg(F.count(F.lit(1)).alias("row_count"),
                                        F.min(partition_date).alias("_pdate"))
    age = F.datediff(as_of, F.col("_pdate"))
    action = (F.when(age.isNull() | (age < hot_days), F.lit("keep"))
              .when(age < warm_days, F.lit("archive"))
              .otherwise(F.lit("expire")))
    return per.select(partition_col, "row_count", age.cast("int").alias("age_days"), action.alias("action"))
