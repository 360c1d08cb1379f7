"""Session defaults and the shared scratch folder.

Scratch data (stream checkpoints, zone tables written by a query, staging
tables for upserts) lives under the folder the cluster names in
``spark.checkpoint.dir``.  Only when that setting is absent and the master is
this machine (tests) do we create one of our own and register it as the
checkpoint dir; on a cluster a missing setting is an error, because a folder of
the driver is not seen by the executors.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    # No broadcast from plan-time size *estimates* (after column pruning they
    # are loose: at sf0.1 the planner broadcast the whole line table).  AQE
    # still converts a join to broadcast at run time when the *measured*
    # shuffle output of a side is under its threshold; bounded tables (nation,
    # region, policy lists) are broadcast by explicit hints.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "orderlake", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the defaults this library is tuned for."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _context_checkpoint_dir(spark: SparkSession) -> str | None:
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # Spark Connect has no SparkContext
        return None


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and scratch tables.

    Order: the context's checkpoint dir, then ``spark.checkpoint.dir``; if both
    are unset a fresh folder is created and registered, but only if all tasks
    run in this process (master ``local``); otherwise this raises.
    """
    root = _context_checkpoint_dir(spark)
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"spark.checkpoint.dir is not set; master {master!r} needs a folder all executors share")
        root = tempfile.mkdtemp(prefix="orderlake-ckpt-")
        try:
            spark.sparkContext.setCheckpointDir(root)
        except Exception:
            pass
    return root


def _fs(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and the path as its object: any store Spark can write to."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there.  Errors other than its absence rise."""
    fs, p = _fs(spark, path)
    return fs.exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def move_path(spark: SparkSession, src: str, dst: str) -> None:
    """Rename a folder; an absent parent or a refusal of the store is an error."""
    fs, p = _fs(spark, src)
    if not fs.rename(p, spark._jvm.org.apache.hadoop.fs.Path(dst)):
        raise OSError(f"cannot move {src} to {dst}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small metadata file, put in place by a rename so that it is there whole or not at all."""
    fs, p = _fs(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.draft")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    if fs.exists(p):
        fs.delete(p, False)
    if not fs.rename(draft, p):
        raise OSError(f"cannot write {path}")


def read_text(spark: SparkSession, path: str) -> str:
    """The text of a small metadata file."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder (metadata only); empty if the folder is not there."""
    fs, p = _fs(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unique folder under the checkpoint root for one run of one job."""
    root = checkpoint_root(spark).rstrip("/")
    path = f"{root}/orderlake/{purpose}-{uuid.uuid4().hex[:12]}"
    fs, p = _fs(spark, path)
    fs.mkdirs(p)
    return path


def session_tz(spark: SparkSession) -> str:
    return spark.conf.get("spark.sql.session.timeZone", "UTC")
