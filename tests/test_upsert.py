import os

import pytest
from pyspark.sql import functions as F

from orderlake.operators import upsert as U
from orderlake.operators.upsert import LayoutError, NullKeyError, bucket_count, create_keyed, read_keyed, upsert
from orderlake.session import path_exists, scratch_dir
from orderlake.streaming.medallion import upsert_sink
from tests.conftest import plan_text


def _files(path):
    out = {}
    for d, _, fs in os.walk(path.replace("file:", "", 1)):
        for f in fs:
            if f.endswith(".parquet"):
                p = os.path.join(d, f)
                out[p] = os.path.getmtime(p)
    return out


def test_upsert_replaces_adds_and_is_idempotent(spark):
    path = f"{scratch_dir(spark, 'test-upsert')}/table"
    base = spark.createDataFrame([(k, 1, f"v{k}") for k in range(100)], "k int, ver int, v string")
    create_keyed(base, path, ["k"], 16)
    changes = spark.createDataFrame([(5, 2, "new5"), (200, 1, "added"), (7, 0, "older")], "k int, ver int, v string")
    before = _files(path)
    upsert(spark, path, changes, ["k"], 16, [F.col("ver").desc()])
    once = sorted(read_keyed(spark, path).collect())
    upsert(spark, path, changes, ["k"], 16, [F.col("ver").desc()])
    twice = sorted(read_keyed(spark, path).collect())
    assert once == twice
    got = {r.k: r.v for r in once}
    assert len(got) == 101 and got[5] == "new5" and got[200] == "added" and got[7] == "v7"
    after = _files(path)
    assert before and after
    untouched = [p for p in before if p in after and before[p] == after[p]]
    assert len(untouched) >= len(before) - 3      # only the touched buckets were rewritten


def test_range_buckets_rewrite_only_recent_buckets(spark):
    path = f"{scratch_dir(spark, 'test-upsert-range')}/table"
    base = spark.createDataFrame([(k, 1) for k in range(1000)], "k long, v int")
    create_keyed(base, path, ["k"], 0, range_width=100)
    before = _files(path)
    upsert(spark, path, spark.createDataFrame([(995, 2), (1001, 1)], "k long, v int"), ["k"], 0,
           [F.col("v").desc()], range_width=100)
    after = _files(path)
    changed = {p.split("_bucket=")[1].split("/")[0] for p in after if p not in before or before[p] != after[p]}
    assert changed == {"9", "10"}
    got = {r.k: r.v for r in read_keyed(spark, path).collect()}
    assert len(got) == 1001 and got[995] == 2 and got[1001] == 1


def _table(spark, purpose, n=100, buckets=8):
    path = f"{scratch_dir(spark, purpose)}/table"
    create_keyed(spark.createDataFrame([(k, 1) for k in range(n)], "k int, v int"), path, ["k"], buckets)
    return path


def _rows(spark, path):
    return sorted(map(tuple, read_keyed(spark, path).collect()))


def test_an_unreadable_file_raises_and_nothing_is_lost(spark):
    path = _table(spark, "test-upsert-damaged")
    files = sorted(_files(path))
    for f in files:                                # whichever file Spark looks at for the schema
        size = os.path.getsize(f)
        with open(f, "r+b") as h:
            h.seek(size - 8)
            h.write(b"\0" * 8)
    before = {f: open(f, "rb").read() for f in files}
    with pytest.raises(Exception):
        upsert_sink(path, ["k"], 8)(spark.createDataFrame([(1, 9), (2, 9), (3, 9)], "k int, v int"), 1)
    assert {f: open(f, "rb").read() for f in sorted(_files(path))} == before


def test_rows_without_a_key_are_set_aside_and_replays_change_nothing(spark):
    path = _table(spark, "test-upsert-null")
    changes = spark.createDataFrame([(None, 5), (None, 5), (3, 7)], "k int, v int")
    with pytest.raises(NullKeyError):
        upsert(spark, path, changes, ["k"], 8)
    assert len(_rows(spark, path)) == 100
    for _ in range(3):
        upsert(spark, path, changes, ["k"], 8, rejected=f"{path}-rejected", batch_id=4)
        assert len(_rows(spark, path)) == 100 and (3, 7) in _rows(spark, path)
        assert spark.read.parquet(f"{path}-rejected").drop("batch_id").count() == 2
    with pytest.raises(Exception, match="NULL key"):
        create_keyed(changes, f"{path}-other", ["k"], 8)


def test_the_first_batch_of_a_stream_sets_aside_rows_without_a_key(spark):
    path = f"{scratch_dir(spark, 'test-sink-null')}/table"
    sink = upsert_sink(path, ["k"], 4)
    batch = spark.createDataFrame([(None, 1), (1, 1), (2, 1)], "k int, v int")
    for _ in range(3):
        sink(batch, 0)
        assert _rows(spark, path) == [(1, 1), (2, 1)]
        assert spark.read.parquet(f"{path}-rejected").count() == 1


@pytest.mark.parametrize("steps", [0, 1, 2, 3])
def test_a_crash_while_publishing_is_recovered(spark, monkeypatch, steps):
    path = _table(spark, "test-upsert-crash", 100, 4)
    changes = spark.createDataFrame([(k, 2) for k in range(50)] + [(500, 2)], "k int, v int")
    want = [(k, 2 if k < 50 else 1) for k in range(100)] + [(500, 2)]
    done = []
    real = U.move_path

    def failing(spark, src, dst):
        if len(done) == steps:
            raise OSError("planted between delete and rename")
        done.append(src)
        real(spark, src, dst)
    monkeypatch.setattr(U, "move_path", failing)
    with pytest.raises(OSError, match="planted"):
        upsert(spark, path, changes, ["k"], 4)
    monkeypatch.setattr(U, "move_path", real)
    assert _rows(spark, path) == want              # a reader sees the merge whole even now
    upsert(spark, path, changes.limit(0), ["k"], 4)
    assert _rows(spark, path) == want and not path_exists(spark, f"{path}/_staging")
    upsert(spark, path, changes, ["k"], 4)
    assert _rows(spark, path) == want and not path_exists(spark, f"{path}/_staging")


def test_a_crash_while_staging_leaves_the_table_alone(spark):
    path = _table(spark, "test-upsert-half")
    spark.createDataFrame([(1, 99, 0)], "k int, v int, _bucket int").write.partitionBy("_bucket").parquet(f"{path}/_staging")
    assert (1, 1) in _rows(spark, path)
    upsert(spark, path, spark.createDataFrame([(2, 5)], "k int, v int"), ["k"], 8)
    assert (1, 1) in _rows(spark, path) and (2, 5) in _rows(spark, path) and len(_rows(spark, path)) == 100


def test_an_existing_table_is_not_created_again(spark):
    path = _table(spark, "test-upsert-twice")
    with pytest.raises(Exception, match="already exists"):
        create_keyed(spark.createDataFrame([(1, 1)], "k int, v int"), path, ["k"], 8)


def test_buckets_are_written_by_as_many_tasks_as_their_bytes_ask_for(spark, tiny):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    rows = tiny.lineitem.repartition(12).withColumn("_bucket", F.lit(0))
    assert "rebalance" in plan_text(rows.hint("rebalance", F.col("_bucket"))).lower()
    try:
        spark.conf.set(key, "16k")
        path = f"{scratch_dir(spark, 'test-upsert-hot')}/table"
        U._write(rows, path, "overwrite")
        assert len(_files(path)) > 4
    finally:
        spark.conf.set(key, old)


def test_bucket_count_follows_the_bytes(tiny):
    assert bucket_count(tiny.lineitem) == 8
    assert bucket_count(tiny.lineitem, bytes_per_bucket=1000) > 50


NO_MARKS = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}


def test_a_cluster_without_success_files_loses_nothing(spark):
    conf = spark._jsc.hadoopConfiguration()
    for k, v in NO_MARKS.items():
        conf.set(k, v)
    try:
        path = _table(spark, "test-upsert-no-marks")
        assert not any(f == "_SUCCESS" for _, _, fs in os.walk(path.replace("file:", "", 1)) for f in fs)
        sink = upsert_sink(path, ["k"], 8)
        sink(spark.createDataFrame([(1, 9), (2, 9), (300, 9)], "k int, v int"), 1)
        assert len(_rows(spark, path)) == 101 and (1, 9) in _rows(spark, path)
        with pytest.raises(LayoutError, match="already exists"):
            create_keyed(spark.createDataFrame([(1, 1)], "k int, v int"), path, ["k"], 8)
    finally:
        for k in NO_MARKS:
            conf.unset(k)


def test_the_table_goes_by_its_own_layout(spark):
    path = _table(spark, "test-upsert-layout", buckets=8)
    changes = spark.createDataFrame([(k, 2) for k in (5, 6, 7, 8, 200)], "k int, v int")
    for wrong in ({"n_buckets": 16}, {"keys": ["v"]}, {"range_width": 10}):
        with pytest.raises(LayoutError):
            upsert(spark, path, changes, **wrong)
    upsert_sink(path, ["k"], 64)(changes, 3)              # a stream whose source has grown since
    rows = _rows(spark, path)
    assert len(rows) == 101 == len({k for k, _ in rows}) and (200, 2) in rows and (5, 2) in rows
    assert U.layout_of(spark, path).n_buckets == 8


def test_buckets_without_a_layout_are_never_deleted(spark):
    path = _table(spark, "test-upsert-foreign")
    os.remove(f"{path}/_layout.json".replace("file:", "", 1))
    before = _files(path)
    changes = spark.createDataFrame([(1, 9)], "k int, v int")
    for call in (lambda: upsert(spark, path, changes), lambda: upsert_sink(path, ["k"], 8)(changes, 0), lambda: read_keyed(spark, path),
                 lambda: create_keyed(changes, path, ["k"], 8)):
        with pytest.raises(LayoutError, match="no _layout"):
            call()
    assert _files(path) == before


@pytest.mark.parametrize("steps", [0, 2])
def test_a_crash_in_the_first_load_is_recovered_or_repeated(spark, monkeypatch, steps):
    path = f"{scratch_dir(spark, 'test-upsert-first')}/table"
    rows = spark.createDataFrame([(k, 1) for k in range(50)], "k int, v int")
    monkeypatch.setattr(U, "write_text", lambda *a: (_ for _ in ()).throw(OSError("planted")))
    with pytest.raises(OSError):
        create_keyed(rows, path, ["k"], 4)                # staged, but not complete: no table
    assert not U.table_exists(spark, path)
    monkeypatch.undo()
    real, done = U.move_path, []

    def failing(spark, src, dst):
        if len(done) == steps:
            raise OSError("planted")
        done.append(src)
        real(spark, src, dst)
    monkeypatch.setattr(U, "move_path", failing)
    with pytest.raises(OSError):
        create_keyed(rows, path, ["k"], 4)                # complete, cut off while publishing: a table
    monkeypatch.setattr(U, "move_path", real)
    assert len(_rows(spark, path)) == 50
    upsert(spark, path, spark.createDataFrame([(1, 2), (99, 2)], "k int, v int"))
    assert len(_rows(spark, path)) == 51 and (1, 2) in _rows(spark, path)


def test_a_table_may_be_empty(spark):
    path = f"{scratch_dir(spark, 'test-upsert-empty')}/table"
    create_keyed(spark.createDataFrame([], "k int, v int"), path, ["k"], 4)
    assert _rows(spark, path) == []
    upsert(spark, path, spark.createDataFrame([(1, 2)], "k int, v int"))
    assert _rows(spark, path) == [(1, 2)]
