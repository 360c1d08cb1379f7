import random
import zlib
from collections import defaultdict

import pytest

from orderlake.llm import sharding as S
from orderlake.llm.queries import QUERIES, SHARDS
from tests.conftest import SF_SMALL
from tests.llm.conftest import documents, edge_rows


def check(rows, docs, shards):
    want = sorted((str(i), len(t) + 16, zlib.crc32(t)) for i, t in docs)
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in rows) == want
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))


def test_query(spark):
    rows = QUERIES["op7_virtual_slots"](spark, SF_SMALL).collect()
    docs = [(i, t) for i, t, _ in documents(SF_SMALL)]
    check(rows, docs, SHARDS)
    load = defaultdict(int)
    for r in rows:
        load[r["shard"]] += r["size"]
    mean = sum(load.values()) / SHARDS
    assert len(load) == SHARDS and max(load.values()) < 1.1 * mean and min(load.values()) > 0.9 * mean
    assert {r["law"] for r in rows} == {"bytes"} and {r["grown_shard"] for r in rows} == {None}


def test_edges(spark, edge_docs, no_docs):
    check(S.assign(spark, edge_docs, 4).collect(), [(i, (t or "").encode()) for i, t, _ in edge_rows()], 4)
    assert S.assign(spark, no_docs, 4).count() == 0


def test_a_hot_record_is_counted_not_gathered(spark):
    docs = spark.range(20_000).selectExpr("id % 3 * 0 + 7 AS doc_id", "'same' AS text")
    rows = S.assign(spark, docs, 4)
    assert S.records(docs).count() == 1
    assert sorted(r["slot"] for r in rows.collect()) == list(range(20_000))


def test_new_shard_takes_rows_only_into_itself_and_versions_stay(spark, tmp_path):
    rng = random.Random(1)
    slot_bytes = [rng.randint(0, 1000) for _ in range(S.VIRTUAL)]
    even = S.even_map(10)
    even_load = [sum(b for b, s in zip(slot_bytes, even) if s == k) for k in range(10)]
    now = S.rebalance(even, slot_bytes, 10)
    load = [sum(b for b, s in zip(slot_bytes, now) if s == k) for k in range(10)]
    assert max(load) - min(load) <= 1000 < max(even_load) - min(even_load)
    assert sum(a != b for a, b in zip(even, now)) < S.VIRTUAL / 5      # an edit, not a new map
    grown = S.add_shard(now, slot_bytes, 10)
    assert all(b in (a, 10) for a, b in zip(now, grown))
    load = [sum(b for b, s in zip(slot_bytes, grown) if s == k) for k in range(11)]
    assert max(load) < 1.02 * sum(load) / 11 and min(load) > 0.98 * sum(load) / 11
    for version, slots in enumerate((even, now, grown)):
        S.save_map(spark, str(tmp_path), version, slots)
    got = sorted(map(tuple, S.load_map(spark, str(tmp_path), 1).collect()))
    assert got == list(enumerate(now))


def test_the_stored_map_is_edited_and_old_versions_stay(spark, tmp_path):
    folder = str(tmp_path / "map")
    docs = spark.range(4_000).selectExpr("id AS doc_id", "repeat('x', int(id % 50) * 20) AS text")
    before = {r["doc_id"]: r["shard"] for r in S.assign(spark, docs, 4, folder).collect()}
    versions = S.map_versions(spark, folder)
    assert {r["doc_id"]: r["shard"] for r in S.assign(spark, docs, 4, folder).collect()} == before
    assert S.map_versions(spark, folder) == versions           # nothing drifted: no edit, no version

    grown = {r["doc_id"]: r["shard"] for r in S.assign(spark, docs, 5, folder).collect()}
    assert S.map_versions(spark, folder) == [*versions, versions[-1] + 1]
    assert all(grown[i] in (s, 4) for i, s in before.items())
    size = {i: i % 50 * 20 + 16 for i in grown}
    taken = sum(size[i] for i, s in grown.items() if s == 4)
    assert 0.95 < 5 * taken / sum(size.values()) < 1.05        # the law is by bytes: heavy slots, so fewer rows
    assert {r["doc_id"]: r["shard"] for r in S.place(spark, docs, folder, versions[-1]).collect()} == before

    heavy = docs.union(spark.range(300).selectExpr("id + 10000", "repeat('y', 20000)"))
    load = defaultdict(int)
    moved = 0
    for r in S.assign(spark, heavy, 5, folder).collect():
        load[r["shard"]] += r["size"]
        moved += r["doc_id"] < 4_000 and grown[r["doc_id"]] != r["shard"]
    assert max(load.values()) < 1.03 * min(load.values()) and moved < 1_500
    assert len(S.map_versions(spark, folder)) == len(versions) + 2
    with pytest.raises(ValueError, match="cannot shrink"):
        S.assign(spark, docs, 3, folder)
    with pytest.raises(ValueError, match="already there"):
        S.save_map(spark, folder, 0, S.even_map(4))


def test_a_write_cut_short_is_no_version(spark, tmp_path):
    S.save_map(spark, str(tmp_path), 0, S.even_map(3))
    (tmp_path / "version=1" / "_temporary").mkdir(parents=True)
    assert S.map_versions(spark, str(tmp_path)) == [0] and S.map_versions(spark, str(tmp_path / "none")) == []
    S.save_map(spark, str(tmp_path), 1, S.even_map(3))
    assert S.map_versions(spark, str(tmp_path)) == [0, 1] and S.map_slots(spark, str(tmp_path), 1) == S.even_map(3)


def test_stretches_of_copies(spark, monkeypatch):
    monkeypatch.setattr(S, "COPIES", 100)
    ids = [(None, 250), ("a", 100), ("b", 101), ("c", 1)]
    docs = spark.createDataFrame([(i, "t") for i, n in ids for _ in range(n)], "doc_id string, text string")
    check(S.assign(spark, docs, 2).collect(), [(i, b"t") for i, n in ids for _ in range(n)], 2)
