"""Helpers shared by the operators: tokens, written tables, column names, labelled samples."""

from __future__ import annotations

import os
import zipfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import orderlake
from orderlake.session import scratch_dir

#: Bytes of one Arrow batch handed to a task: what a task holds of a batch (its texts as bytes, lists and
#: results) is a small multiple of this, however long the texts are.
BATCH_BYTES = 8 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Word separators: space and the control characters tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def split_words(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text: ``bytes.split`` cuts at exactly the six separators of ``WORD``."""
    return text.split()


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 bytes of a string column, NULL as empty; no decoding, so odd bytes cannot fail."""
    return [b if b is not None else b"" for b in batch.column(column).cast(pa.binary()).to_pylist()]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts lineage: a lost executor costs the tasks it ran, never the work before this table.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark, purpose)}/data"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores added while the frame already has a column of that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def _bytes(setting: str) -> int:
    """Bytes of a Spark size setting such as ``67108864b`` or ``8m``; none set is no bound."""
    number = setting.lower().rstrip("kmgtb")
    unit = {"k": 10, "m": 20, "g": 30, "t": 40}.get(setting.lower()[len(number):][:1], 0)
    return int(number) << unit if int(number) > 0 else 1 << 62


def ship_package(spark: SparkSession) -> None:
    """Let Spark serve this package's modules to the Python workers (once per application), in batches bounded by bytes.

    The bound is a setting of the session, which plans read when they run; a smaller one stays.
    """
    sc = spark.sparkContext
    if _bytes(spark.conf.get(_BATCH_CONF)) > BATCH_BYTES:
        spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))
    if getattr(sc, "_orderlake_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(orderlake.__file__))
    path = os.path.join(sc._temp_dir, "orderlake.zip")       # the driver's own folder; executors fetch from it
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("orderlake", os.path.relpath(full, root)))
    sc.addPyFile(path)
    sc._orderlake_shipped = True


def map_arrow(df: DataFrame, run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` whose workers can import this package."""
    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema) -> DataFrame:
    """:func:`map_arrow` with a function of one batch; an empty partition yields nothing."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)
    return map_arrow(df, run, schema)


def small_batches(batches: Iterable[pa.RecordBatch], rows: int = 128) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, for work that makes many arrays per token."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def keep_rows(df: DataFrame, decide: Callable[[list[bytes]], list[bool]], text: str = "text") -> DataFrame:
    """Rows (all columns) for which ``decide`` says True; no shuffle and no join."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(decide(texts_of(batch, text)), pa.bool_()))
                pa.default_memory_pool().release_unused()
    return map_arrow(df, run, df.schema)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, fold=None) -> DataFrame:
    """(text, label) of at most ``2 * per_class`` labelled documents, the same ones on every run.

    Per class the ids with the smallest hash are taken, from rows that pass ``fold`` (a condition
    on ``doc_id``).  Repeated label rows of an id count once, by their mean (a tie is 1); repeated
    document rows of an id count once, by the smallest text.  NULL ids and labels are left out.
    """
    known = labels.select("doc_id", F.col(label).cast("double").alias("y")).where("doc_id IS NOT NULL AND y IS NOT NULL")
    if fold is not None:
        known = known.where(fold)
    known = known.groupBy("doc_id").agg(F.when(F.avg("y") >= 0.5, 1).otherwise(0).alias("label"))
    order = [F.xxhash64(F.lit("labelled sample"), "doc_id"), F.col("doc_id")]
    picked = [known.where(F.col("label") == v).orderBy(*order).limit(per_class) for v in (0, 1)]
    ids = F.broadcast(picked[0].unionByName(picked[1]))      # at most 2 * per_class ids
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).join(ids, "doc_id")
    return rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("label").alias("label"))


def class_totals(labels: DataFrame, label: str, fold=None) -> tuple[int, int]:
    """Number of label rows of class 0 and 1 (the natural class shares)."""
    rows = labels.where(F.col("doc_id").isNotNull()) if fold is None else labels.where(F.col("doc_id").isNotNull() & fold)
    got = rows.agg(F.count_if(F.col(label) == 0).alias("n0"), F.count_if(F.col(label) == 1).alias("n1")).first()
    return int(got["n0"] or 0), int(got["n1"] or 0)
