from collections import Counter

import numpy as np
import pyarrow.parquet as pq

from orderlake.llm import gbt_rules as G
from orderlake.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.conftest import documents, edge_rows


def brute(text):
    s = text.decode()
    words = text.split()
    grams = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {k for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for k in (i, i + 1, i + 2)}
    seen, dups = set(), 0
    for line in text.split(b"\n"):
        if line.split():
            dups += line in seen
            seen.add(line)
    return (len(words), sum(len(w.decode()) for w in words), sum(s.count(c) for c in "#*$%&|<>"), dups, len(covered))


def compare(rows, docs):
    got = sorted((str(r["doc_id"]), *[r[c] for c in G.BASE], r["base_failed"]) for r in rows)
    want = []
    for i, text in docs:
        b = brute(text)
        want.append((str(i), *b, b[0] < 50 or 100 * b[4] > 50 * b[0]))
    assert got == sorted(want)
    assert not any(r["kept"] and r["base_failed"] for r in rows)


def test_query_against_brute_force_and_labels(spark):
    rows = QUERIES["op10_gbt_rules"](spark, SF_SMALL).collect()
    compare(rows, [(i, t) for i, t, _ in documents(SF_SMALL)])
    kept = {r["doc_id"]: r for r in rows}
    labels = pq.read_table(f"{SF_SMALL}/labels.parquet").to_pylist()
    good = [kept[r["doc_id"]]["kept"] for r in labels if r["quality"] == 1 and not kept[r["doc_id"]]["base_failed"]]
    bad = [kept[r["doc_id"]]["kept"] for r in labels if r["quality"] == 0]
    assert sum(good) / len(good) > 0.97 and sum(bad) / len(bad) < 0.05


def test_counts_of_odd_texts():
    for text in ["", " ", "a", "a a a a", "a b c a b c d", "x\nx\n\n \n x\nx", "é ü\x85日 |<>|", "a\tb\x0bc\x0cd\re", "a b a b a b a"]:
        assert G.counts_of(text.encode())[:5] == brute(text.encode()), text


def test_edges(edge_docs, no_docs, edge_labels):
    forest = G.fit(edge_docs, edge_labels)
    compare(G.verdicts(edge_docs, forest).collect(), [(i, (t or "").encode()) for i, t, _ in edge_rows()])
    kept = G.keep_good(edge_docs, forest, 0.0)
    assert kept.columns == edge_docs.columns and kept.count() == sum(
        not (b[0] < 50 or 2 * b[4] > b[0]) for _, t, _ in edge_rows() for b in [brute((t or "").encode())])
    assert G.verdicts(no_docs, forest).count() == 0
    flat = G.fit(no_docs, edge_labels.limit(0))
    assert all(r["kept"] != r["base_failed"] for r in G.verdicts(edge_docs, flat).collect())


def test_forest_is_monotonic_and_flat_scoring_equals_walking():
    rng = np.random.default_rng(0)
    x = rng.random((3000, len(G.FEATURES)))
    y = (x[:, 2] + 0.3 * np.sin(9 * x[:, 2]) + 0.2 * rng.normal(size=3000) + 0.3 * x[:, 0] < 0.7).astype(float)
    signs = list(G.FEATURES.values())
    forest = G.grow(x, y, signs, 1500, 1500)
    assert ((forest.probability(x) > 0.5) == y).mean() > 0.85
    for j, sign in enumerate(signs):
        if sign:
            base = x[:50].copy()
            steps = []
            for v in np.linspace(0, 1, 21):
                base[:, j] = v
                steps.append(forest.logit(base))
            assert (sign * np.diff(np.array(steps), axis=0) >= -1e-9).all()

    def walk(row):
        total = forest.base
        for at in forest.roots:
            while forest.feature[at] >= 0:
                at = forest.left[at] if row[forest.feature[at]] <= forest.threshold[at] else forest.right[at]
            total += forest.value[at]
        return total
    assert np.allclose([walk(r) for r in x[:100]], forest.logit(x[:100]))


def test_labels_of_absent_documents_count_nowhere(spark):
    """Most bad documents were rejected before: neither their number nor the limit may cost a clean one."""
    import random
    rng = random.Random(9)
    clean = lambda: " ".join(f"word{rng.randint(0, 10 ** 5)}" for _ in range(80))
    # a missed bad document looks like a clean one
    docs = spark.createDataFrame([(i, clean()) for i in range(240)], "doc_id long, text string")
    own = [(i, 0 if i % 12 == 0 else 1) for i in range(240)]
    gone = [(1000 + i, 0) for i in range(4000)]
    labels = spark.createDataFrame(own + gone, "doc_id long, quality int")
    alone = spark.createDataFrame(own, "doc_id long, quality int")
    got, want = G.fit(docs, labels), G.fit(docs, alone)
    assert np.isclose(got.base, np.log(220 / 20)) and np.isclose(want.base, np.log(220 / 20))
    kept = {r["doc_id"] for r in G.keep_good(docs, got).collect()}
    assert kept == {r["doc_id"] for r in G.keep_good(docs, want).collect()}
    assert sum(i % 12 != 0 for i in kept) == 220
    assert np.isclose(G.fit(docs, labels, per_class=10).base, np.log(220 / 20))
