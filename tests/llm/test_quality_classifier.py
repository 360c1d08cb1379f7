import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from orderlake.llm import quality_classifier as Q
from orderlake.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.conftest import edge_rows


def test_features_are_words_characters_and_equal_neighbours():
    memo = {}
    ids, counts = Q.document_features("für für".encode(), memo)
    got = dict(zip(ids.tolist(), counts.tolist()))
    assert got[Q.REPEAT] == 1 and got[Q.END] == 1
    marked = "<für>"
    grams = [marked] + [marked[i:i + n] for n in Q.NGRAMS for i in range(len(marked) - n + 1)]
    assert len(Q.word_features("für".encode())) == len(grams)
    assert sum(counts) == 2 * len(grams) + 2


def test_scorer_is_the_mean_over_features():
    rng = np.random.default_rng(0)
    model = Q.SubwordModel(rng.normal(size=Q.BUCKETS), 0.3)
    one = model.scorer()
    for text in (b"", b"the the cat", "naïve text with wörds".encode() * 9):
        ids, counts = Q.document_features(text, {})
        logit = float((model.table[ids] * counts).sum() / counts.sum() + 0.3)
        assert one(text) == pytest.approx(1 / (1 + np.exp(-logit)), abs=1e-9)


def test_held_out_accuracy_and_fold(spark):
    got = {r["doc_id"]: r for r in QUERIES["op1_quality_classifier"](spark, SF_SMALL).collect()}
    labels = pq.read_table(f"{SF_SMALL}/labels.parquet").to_pylist()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    assert all(r["predicted"] == int(r["score"] >= 0.5) for r in got.values())
    held = [(got[r["doc_id"]]["predicted"], r["quality"]) for r in labels if got[r["doc_id"]]["held_out"]]
    assert len(held) > 80
    for label in (0, 1):
        own = [p == y for p, y in held if y == label]
        assert sum(own) / len(own) > 0.9


def test_edge_rows_and_reruns(edge_docs, no_docs, edge_labels):
    model = Q.fit(edge_docs, edge_labels)
    a = sorted(Q.score(edge_docs, model).collect(), key=str)
    b = sorted(Q.score(edge_docs, Q.fit(edge_docs, edge_labels)).collect(), key=str)
    assert a == b and len(a) == len(edge_rows())
    assert all(0 <= r["score"] <= 1 for r in a)
    assert Q.keep_good(edge_docs, model, 0.0).count() == len(a)
    assert Q.keep_good(edge_docs, model).columns == edge_docs.columns
    assert Q.score(no_docs, model).count() == 0
    flat = Q.fit(no_docs, edge_labels.limit(0))
    assert {r["score"] for r in Q.score(edge_docs, flat).collect()} == {0.5}


def test_ids_of_any_type(edge_docs, edge_labels):
    name = "lpad(cast(doc_id AS string), 6, '0') AS doc_id"       # padded: the same order as the numbers
    named = Q.fit(edge_docs.selectExpr(name, "text"), edge_labels.selectExpr(name, "quality"))
    plain = Q.fit(edge_docs, edge_labels)
    assert named.bias == plain.bias and np.array_equal(named.table, plain.table)
