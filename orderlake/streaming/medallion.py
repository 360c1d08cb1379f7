"""Medallion streaming L1-L6.

The stream path reuses the batch functions: the same cleaning (C1-C3), rules
(Q10) and keyed upsert (C8) run on streaming DataFrames or inside
``foreachBatch``; there is no second implementation.

Exactly-once: every query has its own checkpoint; sinks are either the parquet
file sink (its commit log makes a replayed batch a no-op) or a ``foreachBatch``
that performs an idempotent upsert (a replayed batch rewrites the same rows).
"""

from __future__ import annotations

import uuid
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orderlake.functions.dates import from_event_time, to_event_time
from orderlake.operators import clean as C
from orderlake.operators import quality as Q
from orderlake.operators.upsert import BUCKET, create_keyed, has_null_key, layout_of, read_buckets, table_exists, upsert
from orderlake.session import child_names, delete_path, path_exists, scratch_dir, session_tz
from orderlake.sources.incremental import ingest_new, run_available, stream_files


BATCH = "batch_id"


def land(df: DataFrame, landing: str, fmt: str = "parquet", n_files: int | None = None,
         order_by: str | None = None) -> str:
    """Write one delivery as new files in its own folder under ``landing``.

    Each delivery gets a fresh folder name (a file replaced in place under the
    same name is not re-read by the file source).  ``order_by`` range-partitions
    the delivery so its files follow the event order; without ``n_files`` the
    number of ranges follows the session's shuffle partitions (and AQE), so a
    large delivery is written by many tasks.  Without ``order_by`` the input's
    own partitioning is kept (no shuffle).
    """
    path = f"{landing.rstrip('/')}/delivery-{uuid.uuid4().hex[:12]}"
    if order_by:
        out = df.repartitionByRange(n_files, order_by) if n_files else df.repartitionByRange(order_by)
    else:
        out = df.repartition(n_files) if n_files else df
    out.write.format(fmt).mode("errorifexists").save(path)
    return path


# -- L1 -------------------------------------------------------------------------
def silver_stream(stream: DataFrame, rules: Sequence = (), name: str = "silver_dq") -> DataFrame:
    """C1-C3 on a stream of raw order records; rules applied per their action,
    counts published per micro-batch under ``name`` (``run_available`` returns them)."""
    cleaned = C.clean_orders(stream)
    if not rules:
        return cleaned
    kept, _ = Q.enforce(cleaned, rules, name)
    return kept


def split_sink(silver: str, quarantine: str, rules: Sequence, counts: str | None = None):
    """``foreachBatch`` function: valid rows to ``silver``, rejected ones with their failed rules to
    ``quarantine``, each in a folder per batch that a replay overwrites; together they are the batch.

    ``counts`` gets one row per batch and rule with the rows checked and failed (rule NULL: the batch
    itself, failed meaning rejected).  They are observed by the writes, not by a pass of their own.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        flagged = C.flag_failures(C.clean_orders(batch), rules).persist()
        try:
            ok = F.size("_failed") == 0
            sides = []
            for side, path in ((flagged.where(ok).drop("_failed"), silver),
                               (flagged.where(~ok).withColumn("failed_rules", F.concat_ws(",", "_failed")), quarantine)):
                broken = [F.count_if(F.array_contains("_failed", r.name)).alias(r.name) for r in rules] if path == quarantine else []
                seen = Observation()
                side.observe(seen, F.count(F.lit(1)).alias("rows"), *broken).drop("_failed").write.mode("overwrite").parquet(
                    f"{path}/{BATCH}={batch_id}")
                sides.append(seen.get)
            if counts:
                checked = sides[0]["rows"] + sides[1]["rows"]
                rows = [(None, checked, sides[1]["rows"])] + [(r.name, checked, sides[1][r.name]) for r in rules]
                (spark.createDataFrame(rows, "rule string, checked long, failed long").coalesce(1)
                 .write.mode("overwrite").parquet(f"{counts}/{BATCH}={batch_id}"))
        finally:
            flagged.unpersist()
    return sink


# -- L2 -------------------------------------------------------------------------
def enrich(stream: DataFrame, dim: DataFrame, on: Column, how: str = "left") -> DataFrame:
    """Stream-static join: each micro-batch joins the current dimension snapshot.

    A stateless micro-batch is planned with adaptive execution, so the side to
    broadcast is chosen by its measured size and skewed keys are split.  The
    static side is read again by every batch.
    """
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti"):
        raise ValueError("a stream-static join keeps the stream on the left")
    return stream.join(dim, on, how)


# -- L3 -------------------------------------------------------------------------
def gold_windows(stream: DataFrame, ts_col: str, width: str, lateness: str, by: Sequence[str],
                 measures: Sequence[Column], tz: str) -> DataFrame:
    """Tumbling event-time windows with a watermark.

    The watermark bounds the state: a window's state is dropped once the
    watermark passes its end, and rows older than the watermark are dropped
    as late.  Run in ``update`` mode with :func:`upsert_sink` so every
    changed window is written as it changes and the gold table is complete
    at any time (append mode would hold back still-open windows).
    """
    ev = stream.withColumn("_event_time", to_event_time(ts_col, tz))
    agg = (ev.withWatermark("_event_time", lateness)
             .groupBy(F.window("_event_time", width).alias("_w"), *by)
             .agg(*measures))
    return agg.select(from_event_time("_w.start", tz).alias("window_start"),
                      from_event_time("_w.end", tz).alias("window_end"),
                      *by, *[m for m in agg.columns if m not in ("_w", *by)])


def upsert_sink(path: str, keys: Sequence[str], n_buckets: int, order: Sequence[Column] = (),
                transform: Callable[[DataFrame], DataFrame] | None = None,
                on_write: Callable[[int, list[int] | None], None] | None = None, rejected: str | None = None):
    """``foreachBatch`` function: (optional transform) then idempotent keyed upsert.

    ``n_buckets`` is for the first load alone; later batches go by the table's own layout.

    Rows without a key go to ``rejected/batch_id=<n>`` (default:
    ``<path>-rejected``), which a replay overwrites.  ``on_write(batch_id,
    buckets)`` is called after the write with the rewritten bucket ids
    (``None``: the table was created, every bucket is new).  If the driver fails
    before it returns, the stream replays the batch, so the callback runs again
    for the same batch id."""
    rejected = rejected or f"{path}-rejected"

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        df = transform(batch) if transform else batch
        if table_exists(spark, path):
            touched = upsert(spark, path, df, keys, order=order, rejected=rejected, batch_id=batch_id)
        else:
            df = df.persist()
            try:
                null_key = has_null_key(keys)
                if not df.where(null_key).isEmpty():
                    df.where(null_key).write.mode("overwrite").parquet(f"{rejected}/batch_id={batch_id}")
                latest = C.latest_per_key(df.where(~null_key), keys, list(order), null_keys="drop")
                create_keyed(latest, path, keys, n_buckets)
            finally:
                df.unpersist()
            touched = None
        if on_write is not None and touched != []:
            on_write(batch_id, touched)
    return sink


def late_sink(late: str, ts_col: str, width: str, watermarks: Sequence[str], tz: str):
    """``foreachBatch`` function: the rows of batch n of this run whose window had closed under the n-th
    watermark, and those without a time, each batch in a folder that a replay overwrites."""
    turn = iter([*watermarks, *watermarks[-1:] * 1_000_000])

    def sink(batch: DataFrame, batch_id: int) -> None:
        closed = F.lit(next(turn)).cast("timestamp")
        ev = batch.withColumn("_event_time", to_event_time(ts_col, tz))
        # the guard keeps rows without a time, which have no window
        end = F.expr(f"window(coalesce(_event_time, TIMESTAMP_SECONDS(0)), '{width}').end")
        ev = ev.withColumn("_end", end)
        (ev.where(F.col("_event_time").isNull() | (F.col("_end") <= closed)).drop("_event_time", "_end")
         .write.mode("overwrite").parquet(f"{late}/{BATCH}={batch_id}"))
    return sink


def run_gold_windows(spark: SparkSession, src: str, schema, gold_path: str, checkpoint: str, ts_col: str,
                     width: str, lateness: str, by: Sequence[str], measures: Sequence[Column], n_buckets: int = 8,
                     max_files_per_trigger: int | None = None, max_bytes_per_trigger: str | None = None,
                     late_path: str | None = None) -> dict:
    """Run the windowed aggregate over newly landed files; read gold with :func:`read_keyed`.

    Spark holds the windows in its state store until the watermark closes them, and every batch upserts
    the windows it changed by their key (C8), so a replay changes nothing and gold is complete at any time.
    The rows that Spark drops as late are kept: a second, stateless query over the same files writes them
    to ``late_path`` (default ``<gold_path>-late``), under the watermarks that the first one's batches
    reported.  Gold plus late rows are then the rows landed, for runs of one batch and for bounded
    batches alike while no file lands between the two queries.
    """
    bounds = {"max_files_per_trigger": max_files_per_trigger, "max_bytes_per_trigger": max_bytes_per_trigger}
    tz = session_tz(spark)
    s = stream_files(spark, src, schema, "parquet", **bounds)
    windows = gold_windows(s, ts_col, width, lateness, by, measures, tz)
    sink = upsert_sink(gold_path, ["window_start", "window_end", *by], n_buckets)
    totals = run_available(windows, None, checkpoint, foreach_batch=sink, output_mode="update")
    marks = [totals["per_batch"][b]["watermark"] for b in sorted(totals["per_batch"])]
    marks = marks[:1] + marks[:-1]              # Spark drops rows by the watermark of the batch before
    late = late_path or f"{gold_path}-late"
    run_available(stream_files(spark, src, schema, "parquet", **bounds), None, f"{checkpoint}-late",
                  foreach_batch=late_sink(late, ts_col, width, marks or ["1970-01-01T00:00:00.000Z"], tz))
    return totals


# -- L4 -------------------------------------------------------------------------
def stream_upsert(spark: SparkSession, src: str, schema, path: str, checkpoint: str, keys: Sequence[str],
                  order: Sequence[Column], n_buckets: int,
                  transform: Callable[[DataFrame], DataFrame] | None = None, fmt: str = "parquet",
                  max_files_per_trigger: int | None = None, max_bytes_per_trigger: str | None = None) -> dict:
    """Newest row per key from a stream of versions, safe to replay."""
    s = stream_files(spark, src, schema, fmt, max_files_per_trigger, max_bytes_per_trigger=max_bytes_per_trigger)
    return run_available(s, None, checkpoint, foreach_batch=upsert_sink(path, keys, n_buckets, order, transform))


# -- L6 -------------------------------------------------------------------------
def dedup_stream(stream: DataFrame, keys: Sequence[str], ts_col: str, lateness: str, tz: str,
                 spread_copies: bool = True) -> DataFrame:
    """Drop resent events: a key seen within ``lateness`` of event time is dropped;
    state for a key is released once the watermark passes it.

    Streaming de-duplication has no map-side combine: every copy of a key is
    sent to the one task that owns the key.  With ``spread_copies`` a first
    stage de-duplicates on (key, input split), so copies in different splits
    collapse in parallel and the second stage, on the key alone, receives at
    most one row per split.  A key resent a billion times then never reaches a
    single task whole.  The split id is deterministic on replay, and for data
    without copies the first stage keeps no more state than plain dedup.
    """
    ev = stream.withColumn("_event_time", to_event_time(ts_col, tz)).withWatermark("_event_time", lateness)
    if spread_copies:
        ev = (ev.withColumn("_split", F.spark_partition_id())
                .dropDuplicatesWithinWatermark([*keys, "_split"])
                .drop("_split"))
    return ev.dropDuplicatesWithinWatermark(list(keys)).drop("_event_time")


def dedup_outcomes(landed: DataFrame, kept: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every key of ``landed`` with its rows by outcome: ``kept``, ``resent`` or ``late``.

    ``kept`` is the sink of :func:`dedup_stream` over ``landed``.  A key that never reached it came later
    than the watermark: all its rows are late (:func:`late_rows` gives them).  Of the other keys one row
    is kept and the rest were resent.  So the three add up to the rows landed.  Rows are counted by key
    on both sides before they meet.
    """
    seen = landed.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    stayed = kept.groupBy(*keys).agg(F.count(F.lit(1)).alias("stayed"))
    same = F.lit(True)
    for k in keys:
        same = same & seen[k].eqNullSafe(stayed[k])
    both = seen.join(stayed, same, "left").select(*[seen[k] for k in keys], "rows", F.coalesce("stayed", F.lit(0)).alias("stayed"))
    outcomes = F.array(F.struct(F.lit("kept").alias("outcome"), F.col("stayed").alias("rows")),
                       F.struct(F.when(F.col("stayed") > 0, "resent").otherwise("late").alias("outcome"),
                                (F.col("rows") - F.col("stayed")).alias("rows")))
    return both.select(*keys, F.explode(outcomes).alias("o")).select(*keys, "o.*").where("rows <> 0")


def late_rows(landed: DataFrame, kept: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``landed`` that :func:`dedup_stream` dropped as late: no row of their key was kept."""
    return landed.join(kept.select(*keys).distinct(), list(keys), "left_anti")


# -- L5 -------------------------------------------------------------------------
RAW_SCHEMA = ("order_id string, customer_id string, order_date string, amount string, status string, "
              "priority string, seq int")


class Medallion:
    """Bronze -> silver -> gold for raw order deliveries, in one rerunnable call.

    bronze: new landed files appended with lineage (B3 bookmark);
    silver: new bronze rows cleaned (C1-C3) and upserted by order id (C5/C8),
            so resends and older versions never duplicate a key;
    gold:   valid silver orders (Q10 drop rules) aggregated by month and status.

    Gold is maintained incrementally.  Silver is bucketed by key and every
    upsert rewrites whole buckets, so gold keeps one partial aggregate per
    silver bucket; a run recomputes the partials of the buckets rewritten since
    the last run (recorded per micro-batch in ``_state/dirty``) and sums the
    partials (at most buckets x months x statuses rows).  Its cost follows what
    changed, not the size of silver.  Every hop is idempotent: a rerun after a
    failure at any point, or with nothing new, leaves the same tables.
    """

    def __init__(self, spark: SparkSession, landing: str, n_buckets: int, root: str | None = None,
                 max_files_per_trigger: int | None = None, max_bytes_per_trigger: str | None = None):
        self.spark = spark
        self.landing = landing
        self.root = (root or scratch_dir(spark, "medallion")).rstrip("/")
        self.n_buckets = n_buckets
        self.bounds = {"max_files_per_trigger": max_files_per_trigger, "max_bytes_per_trigger": max_bytes_per_trigger}

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze/orders"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver/orders"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold/orders_by_month_status"

    @property
    def gold_partial(self) -> str:
        return f"{self.root}/gold/_partial_by_bucket"

    @property
    def dirty(self) -> str:
        return f"{self.root}/_state/dirty"

    @property
    def folded(self) -> str:
        return f"{self.root}/_state/gold_folded"

    def _mark_dirty(self, batch_id: int, buckets: list[int] | None) -> None:
        ids = list(range(layout_of(self.spark, self.silver).n_buckets)) if buckets is None else list(buckets)
        if ids:
            (self.spark.createDataFrame([(b,) for b in ids], "bucket int")
             .write.mode("overwrite").parquet(f"{self.dirty}/batch_id={batch_id}"))

    def run(self, customer: DataFrame) -> DataFrame:
        spark = self.spark
        schema = spark.createDataFrame([], RAW_SCHEMA).schema
        ingest_new(spark, self.landing, self.bronze, f"{self.root}/_checkpoints/bronze", schema, fmt="json",
                   **self.bounds)
        bronze_schema = spark.read.parquet(self.bronze).schema
        s = stream_files(spark, self.bronze, bronze_schema, "parquet", **self.bounds).drop("_source_file")
        sink = upsert_sink(self.silver, ["order_id"], self.n_buckets,
                           [F.col("seq").desc(), F.col("status").asc_nulls_last()], transform=C.clean_orders,
                           on_write=self._mark_dirty)
        run_available(s, None, f"{self.root}/_checkpoints/silver", foreach_batch=sink)
        self._refresh_gold(customer)
        return spark.read.parquet(self.gold)

    def _refresh_gold(self, customer: DataFrame) -> None:
        spark = self.spark
        folded = spark.read.parquet(self.folded).first()["batch_id"] if path_exists(spark, f"{self.folded}/_SUCCESS") else -1
        batches = [int(n.split("=")[1]) for n in child_names(spark, self.dirty) if n.startswith("batch_id=")]
        news = [b for b in batches if b > folded]
        if news:
            dirty = spark.read.parquet(self.dirty).where(F.col("batch_id") > folded)
            buckets = sorted(r[0] for r in dirty.select("bucket").distinct().collect())     # at most n_buckets ids
            silver = read_buckets(spark, self.silver).where(F.col(BUCKET).isin(buckets))
            valid, _ = Q.enforce(silver, C.order_rules(customer))
            partial = (valid.groupBy(BUCKET, F.trunc("order_date", "month").alias("month"), "status")
                            .agg(F.count(F.lit(1)).alias("orders"),
                                 F.sum("amount").cast("decimal(38,2)").alias("amount"))
                            .withColumn("is_marker", F.lit(False)))
            # one marker row per bucket, so a bucket left with no valid row is still replaced
            markers = spark.createDataFrame([(b, None, None, 0, None, True) for b in buckets], partial.schema)
            (partial.unionByName(markers).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self.gold_partial))
            spark.createDataFrame([(max(news),)], "batch_id long").write.mode("overwrite").parquet(self.folded)
        for b in batches:
            if b <= folded:                       # noted by an earlier run
                delete_path(spark, f"{self.dirty}/batch_id={b}")
        if not path_exists(spark, self.gold_partial):
            return
        gold = (spark.read.parquet(self.gold_partial).where(~F.col("is_marker"))
                .groupBy("month", "status")
                .agg(F.sum("orders").cast("bigint").alias("orders"),
                     F.sum("amount").cast("decimal(38,2)").alias("amount")))
        gold.write.mode("overwrite").parquet(self.gold)
