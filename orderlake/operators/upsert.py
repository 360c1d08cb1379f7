"""Idempotent keyed upsert without a transactional table format (C8, M7, L4).

The keyed table is parquet partitioned by ``_bucket = pmod(xxhash64(key), n)``.
An upsert touches only the buckets that hold changed keys:

1. tag changes with their bucket and fetch the set of touched bucket ids (at
   most ``n_buckets`` integers for hash buckets, or key range / width for range
   buckets: a bound fixed by the caller's layout, not by the rows); it becomes
   a static partition filter, so the target scan lists and reads only those
   bucket folders;
2. union the touched buckets' current rows with the changes and keep the
   newest version per key (C5), changes winning ties;
3. write the merged buckets once, to ``<path>/_staging`` (readers of the table
   do not see names that begin with an underscore), and then the layout beside
   them, which marks the staging folder as complete;
4. publish: per bucket, delete the old folder and rename the staged one into
   its place.  No row is written twice.

The table keeps its own layout (key, number of buckets, range width, schema) in
``_layout.json``.  Readers and writers take it from there, so a source that
grows cannot send a key to a second bucket; a call that names another key,
count or width is an error.  The same file is the commit mark, of the table and
of a staging folder: Spark's ``_SUCCESS`` files, which a cluster may turn off,
mean nothing here.

A crash in step 3 leaves a staging folder without a layout: the table is
untouched and the next call deletes that folder.  A crash in step 4 leaves a
complete one: :func:`read_keyed` takes pending buckets from it, and the next call
finishes the renames first.  A first load is staged and published the same way.
No other folder is ever deleted: one that holds buckets without a layout raises
:class:`LayoutError`.  Applying the same change set twice gives the same
table, which is what makes a replayed micro-batch or a rerun job safe.

A row whose key has a NULL part belongs to no key and cannot be replaced on a
replay.  Such rows never enter the table: they are written to ``rejected`` (one
folder per batch, overwritten by a replay) or, without that folder, refused.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.operators.clean import latest_per_key
from orderlake.session import child_names, delete_path, move_path, path_exists, read_text, write_text

BUCKET = "_bucket"
STAGING = "_staging"
LAYOUT = "_layout.json"
BYTES_PER_BUCKET = 256 << 20


class NullKeyError(ValueError):
    """A change set holds rows without a key and no folder for rejected rows was given."""


class LayoutError(ValueError):
    """A call does not fit the table's own layout, or a folder holds buckets without one."""


@dataclass(frozen=True)
class Layout:
    """How a keyed table is laid out; ``schema`` is that of its rows, as JSON."""

    keys: tuple[str, ...]
    n_buckets: int
    range_width: int | None
    schema: str

    def rows(self, df: DataFrame) -> DataFrame:
        """``df`` with the table's columns and types."""
        return df.select(*[F.col(f.name).cast(f.dataType) for f in T.StructType.fromJson(json.loads(self.schema)).fields])

    def read(self, spark: SparkSession, path: str) -> DataFrame:
        """Bucket folders of ``path`` with the table's schema (none at all is an empty table)."""
        schema = T.StructType.fromJson(json.loads(self.schema)).add(BUCKET, T.IntegerType())
        folders = [f"{path}/{n}" for n in child_names(spark, path) if n.startswith(f"{BUCKET}=")]
        if not folders:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).option("basePath", path).parquet(path)

    def bucket(self) -> Column:
        return bucket_of(self.keys, self.n_buckets, self.range_width)

    def check(self, keys: Sequence[str] | None, n_buckets: int | None, range_width: int | None) -> None:
        for name, asked, own in (("key", tuple(keys) if keys else None, self.keys), ("bucket count", n_buckets, self.n_buckets),
                                 ("range width", range_width, self.range_width)):
            if asked is not None and asked != own:
                raise LayoutError(f"the table's {name} is {own}, the call's is {asked}")


def layout_of(spark: SparkSession, path: str) -> Layout | None:
    """The layout of the committed table at ``path``; ``None`` if there is no table.

    A complete first load that was cut off while publishing counts as committed.  Buckets without a
    layout are somebody's rows, not an absent table: they raise.
    """
    for place in (f"{path}/{LAYOUT}", f"{path}/{STAGING}/{LAYOUT}"):
        if path_exists(spark, place):
            found = json.loads(read_text(spark, place))
            return Layout(tuple(found["keys"]), found["n_buckets"], found["range_width"], found["schema"])
    if any(n.startswith(f"{BUCKET}=") for n in child_names(spark, path)):
        raise LayoutError(f"{path} holds buckets but no {LAYOUT}")
    return None


def bucket_count(df: DataFrame, bytes_per_bucket: int = BYTES_PER_BUCKET, least: int = 8) -> int:
    """Hash buckets for a table of about the size of ``df`` (the planner's estimate; no job)."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(least, -(-size // bytes_per_bucket))


def bucket_of(keys: Sequence[str], n_buckets: int, range_width: int | None = None) -> Column:
    """Hash buckets (default: any change set spreads evenly), or, with
    ``range_width``, ranges of one increasing numeric key (new and recently
    changed keys then sit in the last few buckets, so an upsert of recent
    changes rewrites only those; a keyed table has one row per key, so ranges
    of a dense key cannot skew)."""
    if range_width:
        if len(keys) != 1:
            raise ValueError("range buckets need exactly one numeric key")
        return F.floor(F.col(keys[0]) / F.lit(range_width)).cast("int")
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(n_buckets)).cast("int")


def has_null_key(keys: Sequence[str]) -> Column:
    cond = F.lit(False)
    for k in keys:
        cond = cond | F.col(k).isNull()
    return cond


def _write(df: DataFrame, path: str, mode: str) -> None:
    """One folder per bucket; adaptive execution splits a large bucket over many tasks and packs small ones."""
    df.hint("rebalance", F.col(BUCKET)).write.mode(mode).partitionBy(BUCKET).parquet(path)


def create_keyed(df: DataFrame, path: str, keys: Sequence[str], n_buckets: int,
                 range_width: int | None = None) -> None:
    """First load of a keyed table (one latest row per key).

    An existing table is an error, and so is a NULL key (raised by the write itself).
    """
    spark = df.sparkSession
    if table_exists(spark, path):
        raise LayoutError(f"a keyed table already exists at {path}")
    layout = Layout(tuple(keys), n_buckets, range_width, df.schema.json())
    bucket = F.when(has_null_key(keys), F.raise_error(F.lit("keyed table: NULL key")).cast("int"))
    _stage(df.withColumn(BUCKET, bucket.otherwise(layout.bucket())), path, layout)
    publish(spark, path)


def _stage(rows: DataFrame, path: str, layout: Layout) -> None:
    """Write buckets beside the table; the layout, written last, says that they are complete."""
    delete_path(rows.sparkSession, f"{path}/{STAGING}")      # what an earlier call staged and did not complete
    _write(rows, f"{path}/{STAGING}", "errorifexists")
    write_text(rows.sparkSession, f"{path}/{STAGING}/{LAYOUT}", json.dumps(asdict(layout)))


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a load of the table was committed; read errors are not taken for absence."""
    return layout_of(spark, path) is not None


def _pending(spark: SparkSession, path: str) -> list[int]:
    """Buckets of a complete staging folder that are not renamed yet."""
    if not path_exists(spark, f"{path}/{STAGING}/{LAYOUT}"):
        return []
    return sorted(int(n.split("=")[1]) for n in child_names(spark, f"{path}/{STAGING}") if n.startswith(f"{BUCKET}="))


def recover(spark: SparkSession, path: str) -> None:
    """Finish a publish that was cut off, or drop an incomplete staging folder."""
    if path_exists(spark, f"{path}/{STAGING}"):
        publish(spark, path)


def publish(spark: SparkSession, path: str) -> None:
    """Rename the staged buckets into the table; may be repeated after a crash at any point."""
    for b in _pending(spark, path):
        delete_path(spark, f"{path}/{BUCKET}={b}")
        move_path(spark, f"{path}/{STAGING}/{BUCKET}={b}", f"{path}/{BUCKET}={b}")
    if path_exists(spark, f"{path}/{STAGING}/{LAYOUT}") and not path_exists(spark, f"{path}/{LAYOUT}"):
        move_path(spark, f"{path}/{STAGING}/{LAYOUT}", f"{path}/{LAYOUT}")
    delete_path(spark, f"{path}/{STAGING}")
    spark.catalog.refreshByPath(path)


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    """The table's rows; buckets of an unfinished publish are taken from its staging folder."""
    return read_buckets(spark, path).drop(BUCKET)


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    """:func:`read_keyed` with the bucket of each row, a partition column that prunes folders."""
    layout = layout_of(spark, path)
    if layout is None:
        raise LayoutError(f"no keyed table at {path}")
    pending = _pending(spark, path)
    table = layout.read(spark, path)
    if pending:
        staged = layout.read(spark, f"{path}/{STAGING}").where(F.col(BUCKET).isin(pending))
        table = table.where(~F.col(BUCKET).isin(pending)).unionByName(staged)
    return table


def upsert(spark: SparkSession, path: str, changes: DataFrame, keys: Sequence[str] | None = None, n_buckets: int | None = None,
           order: Sequence[Column] = (), range_width: int | None = None, rejected: str | None = None,
           batch_id: int = 0) -> list[int]:
    """Replace changed keys and add new ones in the keyed table at ``path``.

    Key and buckets are the table's own; ``keys``, ``n_buckets`` and ``range_width``, if given, must
    agree with them.  ``order`` ranks versions of one key best-first (e.g. a version column
    descending); when it ties, the incoming change wins over the stored row.
    Returns the ids of the buckets that were rewritten.
    """
    layout = layout_of(spark, path)
    if layout is None:
        raise LayoutError(f"no keyed table at {path}")
    layout.check(keys, n_buckets, range_width)
    keys = layout.keys
    recover(spark, path)
    target = layout.read(spark, path)
    bucket = F.when(~has_null_key(keys), layout.bucket())
    ch = layout.rows(changes).withColumn(BUCKET, bucket).withColumn("_src", F.lit(1))
    ch = ch.persist()          # read twice: for the bucket ids and for the merge
    try:
        touched = [r[0] for r in ch.select(BUCKET).distinct().collect()]
        if None in touched:
            touched.remove(None)
            if rejected is None:
                raise NullKeyError(f"the changes hold rows with a NULL in {list(keys)}")
            ch.where(F.col(BUCKET).isNull()).drop(BUCKET, "_src").write.mode("overwrite").parquet(f"{rejected}/batch_id={batch_id}")
        if not touched:
            return []
        current = target.where(F.col(BUCKET).isin(touched)).withColumn("_src", F.lit(0))
        merged = latest_per_key(current.unionByName(ch.where(F.col(BUCKET).isNotNull())), keys,
                                list(order) + [F.col("_src").desc()], null_keys="drop").drop("_src")
        _stage(merged, path, layout)
        publish(spark, path)
        return sorted(touched)
    finally:
        ch.unpersist()
