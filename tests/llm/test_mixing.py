import pytest

from orderlake.llm import mixing as M
from orderlake.llm.common import split_words
from orderlake.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.conftest import documents, edge_rows


def brute_targets(sizes: dict) -> dict:
    """Reshare the excess again and again until no source is above three times its size."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, open_, left = dict.fromkeys(names, 0.0), set(names), float(sum(sizes.values()))
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += left * weight[s] / total
        left = 0.0
        for s in list(open_):
            if target[s] >= 3 * sizes[s]:
                left += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
                open_.discard(s)
    return target


@pytest.mark.parametrize("sizes", [{"a": 1, "b": 100, "c": 1000, None: 5}, {"a": 10}, {"a": 0, "b": 7}, {"a": 0}, {},
                                   {"Z": 3, "a": 3, "é": 900, "z": 1, None: 0}, {"s%02d" % i: (i * 37) % 11 for i in range(25)}])
def test_targets(spark, sizes):
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()] or [], "source string, size long")
    got = {r["source"]: r["target"] for r in M.source_targets(rows).collect()}
    want = brute_targets(sizes)
    assert got.keys() == want.keys()
    for s in want:
        assert got[s] == pytest.approx(want[s], rel=1e-9, abs=1e-9)


def check(rows, docs):
    sizes = {}
    for _, text, source in docs:
        sizes[source] = sizes.get(source, 0) + len(split_words(text))
    targets = brute_targets(sizes)
    assert sorted((r["doc_id"] is None, r["doc_id"], r["size"]) for r in rows) == sorted(
        (i is None, i, len(split_words(t))) for i, t, _ in docs)
    by_target = {}
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        by_target.setdefault((r["source_size"], round(r["target"], 6)), []).append(r["taken"])
    assert set(by_target) == {(sizes[s], round(targets[s], 6)) for s in sizes}
    return by_target


def test_query_comes_near_its_targets(spark):
    rows = QUERIES["op2_source_mixing"](spark, SF_SMALL).collect()
    for (size, target), taken in check(rows, documents(SF_SMALL)).items():
        assert sum(taken) == pytest.approx(target, rel=0.08)
    again = QUERIES["op2_source_mixing"](spark, SF_SMALL).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_edges_and_emitted_copies(edge_docs, no_docs):
    rows = M.plan_mix(edge_docs).collect()
    check(rows, [(i, (t or "").encode(), s) for i, t, s in edge_rows()])
    mixed = M.mix(edge_docs)
    assert mixed.columns == edge_docs.columns
    want = {}
    for r in rows:
        want[r["doc_id"], r["size"]] = want.get((r["doc_id"], r["size"]), 0) + r["copies"]
    got = {}
    for r in mixed.collect():
        key = (r["doc_id"], len(split_words((r["text"] or "").encode())))
        got[key] = got.get(key, 0) + 1
    assert got == {k: n for k, n in want.items() if n}
    assert M.plan_mix(no_docs).count() == 0 and M.mix(no_docs).count() == 0


def test_salted_join_gives_the_same(edge_docs, monkeypatch):
    want = sorted(map(str, M.plan_mix(edge_docs).collect()))
    monkeypatch.setattr(M, "MAX_BROADCAST_SOURCES", 0)
    assert sorted(map(str, M.plan_mix(edge_docs).collect())) == want
