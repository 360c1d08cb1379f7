"""Incremental file ingest (B3, B4) on the Structured Streaming file source.

``ingest_new`` is a bookmark: the checkpoint records which files were read and
the file sink's log records which output files were committed, so a rerun
reads only files that arrived since and a repeated run with nothing new adds
nothing.  :func:`run_available` processes what is there, in micro-batches
bounded by files or bytes, and stops; :func:`run_continuous` keeps the same
stream running with ``processingTime`` until a condition holds.
"""

from __future__ import annotations

import time
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

POLL_SECONDS = 0.5


def stream_files(spark: SparkSession, src: str, schema: T.StructType, fmt: str = "parquet",
                 max_files_per_trigger: int | None = None, glob: str | None = None,
                 max_bytes_per_trigger: str | None = None) -> DataFrame:
    """A streaming DataFrame over the files arriving in ``src`` (any depth).

    ``max_files_per_trigger`` or ``max_bytes_per_trigger`` (e.g. ``"50g"``)
    bounds a micro-batch, so a backfill does not become one batch.
    """
    r = (spark.readStream.schema(schema).format(fmt)
         .option("recursiveFileLookup", "true"))
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger:
        r = r.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return r.load(src)


def _writer(stream: DataFrame, dst: str | None, checkpoint: str, fmt: str, partition_by, foreach_batch, output_mode):
    w = stream.writeStream.option("checkpointLocation", checkpoint)
    if foreach_batch is not None:
        return w.foreachBatch(foreach_batch).outputMode(output_mode)
    w = w.format(fmt).outputMode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w.option("path", dst)


def _watch(query, stop_when: Callable[[dict], bool] | None = None) -> dict:
    """Totals of a running query until it ends or ``stop_when(totals)`` holds.

    Progress is gathered by batch id while the query runs, as Spark keeps only
    the last entries.  ``per_batch`` has each batch's rows, observed metrics,
    the watermark it ran under and the rows its stateful operators dropped as
    later than that; ``idle_seconds`` is the time since the last new batch.
    """
    seen: dict[int, dict] = {}
    ended, changed = False, time.monotonic()
    while not ended:
        ended = query.awaitTermination(POLL_SECONDS)
        before = len(seen)
        for p in query.recentProgress:
            if p.get("numInputRows", 0) > 0:
                seen[p["batchId"]] = {"rows": p["numInputRows"],
                                      "observed": {k: v.asDict() for k, v in (p.get("observedMetrics") or {}).items()},
                                      "watermark": (p.get("eventTime") or {}).get("watermark"),
                                      "dropped": sum(o.get("numRowsDroppedByWatermark", 0) for o in p.get("stateOperators") or ())}
        if len(seen) > before:
            changed = time.monotonic()
        totals = {"batches": len(seen), "rows": sum(b["rows"] for b in seen.values()),
                  "dropped": sum(b["dropped"] for b in seen.values()), "idle_seconds": time.monotonic() - changed, "per_batch": seen}
        if not ended and stop_when is not None and stop_when(totals):
            query.stop()
            ended = True
    if query.exception() is not None:
        raise query.exception()
    return totals


def run_available(stream: DataFrame, dst: str | None, checkpoint: str, fmt: str = "parquet",
                  partition_by=(), foreach_batch=None, output_mode: str = "append") -> dict:
    """Run a stream over everything available now, then stop; returns totals and per-batch counts."""
    w = _writer(stream, dst, checkpoint, fmt, partition_by, foreach_batch, output_mode)
    return _watch(w.trigger(availableNow=True).start())


def run_continuous(stream: DataFrame, dst: str | None, checkpoint: str, interval: str,
                   stop_when: Callable[[dict], bool], fmt: str = "parquet", partition_by=(), foreach_batch=None,
                   output_mode: str = "append") -> dict:
    """Keep a stream running, one micro-batch per ``interval``, until ``stop_when(totals)`` holds.

    The checkpoint is the same as :func:`run_available`'s, so either can take
    over from the other.
    """
    w = _writer(stream, dst, checkpoint, fmt, partition_by, foreach_batch, output_mode)
    return _watch(w.trigger(processingTime=interval).start(), stop_when)


def ingest_new(spark: SparkSession, src: str, dst: str, checkpoint: str, schema: T.StructType,
               fmt: str = "parquet", max_files_per_trigger: int | None = None, glob: str | None = None,
               max_bytes_per_trigger: str | None = None) -> dict:
    """Append rows of files not seen before from ``src`` to the parquet table at ``dst``."""
    s = stream_files(spark, src, schema, fmt, max_files_per_trigger, glob, max_bytes_per_trigger)
    s = s.withColumn("_source_file", F.col("_metadata.file_name"))
    return run_available(s, dst, checkpoint)
