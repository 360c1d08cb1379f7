import itertools
import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from orderlake.llm import near_dup as N
from orderlake.llm.components import components
from orderlake.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.conftest import documents, edge_rows


def brute(docs):
    """Class (smallest id) of each row by all pairs that share a shingle; ids of NULL sort last."""
    bags, words = {}, {}
    for n, (i, text) in enumerate(docs):
        w = words[n] = text.lower().split()
        bags[n] = Counter(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter({(): 1})
    parent = {n: n for n in bags}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    by = defaultdict(list)
    for n, bag in bags.items():
        for s in bag:
            by[s].append(n)
    for a, b in {p for own in by.values() for p in itertools.combinations(own, 2)}:
        if sum((bags[a] & bags[b]).values()) / sum((bags[a] | bags[b]).values()) >= 0.8:
            parent[find(a)] = find(b)
    groups = defaultdict(list)
    for n in bags:
        groups[find(n)].append(n)
    out = []
    for own in groups.values():
        ids = [docs[n][0] for n in own if docs[n][0] is not None]
        out += [(docs[n][0], min(ids) if ids else None) for n in own]
    return sorted(out, key=str)


def test_query_equals_all_pairs(spark):
    got = QUERIES["op8_near_duplicates"](spark, SF_SMALL).collect()
    assert sorted(map(tuple, got), key=str) == brute([(i, t) for i, t, _ in documents(SF_SMALL)])


def test_edges(edge_docs, no_docs):
    docs = [(i, (t or "").encode()) for i, t, _ in edge_rows()]
    assert sorted(map(tuple, N.classify(edge_docs).collect()), key=str) == brute(docs)
    kept = N.deduplicate(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=str)
    # texts without words, 4, the copies of 5, those of 8, both texts of 9 and all else that stands alone
    assert ids == sorted([1, 4, 5, 8, 9, 9, 10, 11, 12, 100, 200, None], key=str)
    assert N.classify(no_docs).count() == 0 and N.deduplicate(no_docs).count() == 0


def test_chains_in_a_large_group_of_near_copies(spark):
    """Copies of copies: many are near others than the smallest of their bucket, as only all pairs show."""
    rng = random.Random(5)
    docs = [(0, " ".join(f"w{rng.randint(0, 10 ** 6)}" for _ in range(150)))]
    for i in range(1, 160):
        words = docs[rng.randrange(len(docs))][1].split()
        for _ in range(rng.randint(1, 4)):
            words[rng.randrange(len(words))] = f"n{rng.randint(0, 10 ** 6)}"
        docs.append((i, " ".join(words)))
    rng.shuffle(docs)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = sorted(map(tuple, N.classify(frame).collect()), key=str)
    assert got == brute([(i, t.encode()) for i, t in docs])


def test_items_add_up_term_frequencies():
    words = "a b c d e a b c d e a b c d e x".encode().split()
    shingles = N.shingles_of(words)
    items, own = N.items_of(shingles)
    assert len(shingles) == 12 and len(items) == len(set(items.tolist())) == 12 and set(own.tolist()) == set(shingles.tolist())


def weighted_jaccard(a, b):
    keys = set(a) | set(b)
    return sum(min(a.get(k, 0), b.get(k, 0)) for k in keys) / sum(max(a.get(k, 0), b.get(k, 0)) for k in keys)


def test_samples_agree_as_often_as_the_weighted_similarity_says():
    rng = np.random.default_rng(2)
    agree, want = [], []
    for _ in range(60):
        pool = np.unique(rng.integers(0, 2 ** 32, 120, dtype=np.uint32))
        heavy = np.sort(rng.choice(pool, 50, replace=False))
        sampler = N.Sampler(heavy, np.full(50, 0.2, np.float32))
        a, b = pool[:90], pool[30:]
        weight = lambda x: {int(i): 0.2 if i in heavy else 1.0 for i in x}
        want.append(weighted_jaccard(weight(a), weight(b)))
        agree.append((sampler.samples(a, sampler.weights(a)) == sampler.samples(b, sampler.weights(b))).mean())
    assert np.mean(agree) == pytest.approx(np.mean(want), abs=0.03)


def test_similarities_against_sets():
    rng = np.random.default_rng(1)
    sets = []
    for _ in range(12):
        items = np.unique(rng.integers(0, 60, 40).astype(np.uint32))
        sets.append((items, None if rng.random() < 0.3 else np.where(items < 20, 0.25, 1.0).astype(np.float32)))
    plain = [{int(i): float(1 if w is None else w[k]) for k, i in enumerate(x)} for x, w in sets]
    # weights are a function of the item, as inverse document frequencies are
    sets = [(x, np.where(x < 20, 0.25, 1.0).astype(np.float32)) for x, _ in sets]
    plain = [{i: 0.25 if i < 20 else 1.0 for i in p} for p in plain]
    got = N.similarities(sets[:5], sets[5:])
    for a in range(5):
        for b in range(7):
            assert got[a, b] == pytest.approx(weighted_jaccard(plain[a], plain[5 + b]), abs=1e-5)
    assert N.similarities(sets[:1], [(np.array([99], np.uint32), None)])[0, 0] == 0


def test_heavy_shingles_are_counted_exactly(spark, monkeypatch):
    monkeypatch.setattr(N, "HEAVY_LEAST", 3)
    docs = [(i, "five words that all share " + " ".join(f"u{i}x{k}" for k in range(20))) for i in range(30)]
    docs += [(100 + i, " ".join(f"v{i}x{k}" for k in range(20))) for i in range(30)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    rows = N._nodes_and_candidates(frame)
    heavy, weight = N.heavy_shingles(frame, rows.where("shingle IS NOT NULL").select("shingle"), 60)
    assert heavy.tolist() == N.shingles_of(b"five words that all share".split()).tolist()
    assert weight[0] == pytest.approx(np.log(2) / np.log(10), abs=1e-6)


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(60)] + [(7, 7)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    assert got == {x: find(x) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("share", [3, 2])
def test_a_large_group_of_edited_copies_is_one_class(spark, share):
    """Copies of plain similarity 0.836 that hold a third or half of 12,000 rows: their size must not part them."""
    rng = random.Random(share)
    base = [f"b{k}" for k in range(55)]
    docs = [(i, " ".join(base + [f"e{i}x{k}" for k in range(5)]) if i % share == 0 else
             " ".join(f"u{rng.randint(0, 10 ** 7)}" for _ in range(30))) for i in range(12_000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(8)
    got = dict(map(tuple, N.classify(frame).collect()))
    assert len(got) == 12_000
    assert all(got[i] == (0 if i % share == 0 else i) for i in got)


def test_nearness_is_the_larger_of_weighted_and_plain():
    w = lambda x: np.where(x < 20, 0.25, 1.0).astype(np.float32)
    a, b = np.arange(22, dtype=np.uint64), np.concatenate((np.arange(20), [30, 31])).astype(np.uint64)
    assert N.nearness([(a, w(a))], [(b, w(b))])[0, 0] == pytest.approx(20 / 24)
    c = np.arange(15, 35, dtype=np.uint64)
    d = c[5:]
    assert N.nearness([(c, w(c))], [(d, None)])[0, 0] == pytest.approx(15 / 16.25)


def test_few_candidates_reach_the_driver(spark, monkeypatch):
    """Copies that lie together are frequent in their own chunk alone; partitions of one row name what they hold."""
    monkeypatch.setattr(N, "HEAVY_LEAST", 3)
    common = "five words that all share "
    docs = [(i, common + " ".join(f"g{i // 10}x{k}" for k in range(30))) for i in range(400)]
    for parts in (40, 400):
        frame = spark.createDataFrame(spark.sparkContext.parallelize(docs, parts), "doc_id long, text string")
        rows = N._nodes_and_candidates(frame)
        named = rows.where("shingle IS NOT NULL").select("shingle").distinct().count()
        candidates = N.heavy_candidates(rows, 400)
        assert named > 1000 and candidates.count() == 1
        heavy, _ = N.heavy_shingles(frame, candidates, 400)
        assert heavy.tolist() == N.shingles_of(common.encode().split()).tolist()


def test_short_texts_of_equal_32_bit_checksum_are_apart():
    """64-bit ids throughout: of 300,000 one-word texts about ten pairs collide in 32 bits."""
    ids = np.concatenate([N.shingles_of([b"%d" % k]) for k in range(300_000)])
    assert ids.dtype == np.uint64 and len(np.unique(ids)) == len(ids)
    items, own = N.items_of(np.sort(np.concatenate((ids[:5], ids[:2]))))
    assert items.dtype == np.uint64 and len(items) == 7 and set(own.tolist()) == set(ids[:5].tolist())


def test_every_shingle_weighs_by_its_document_frequency(spark):
    """In 60 documents, far from a crowd: unlike boilerplate must not part two texts whose own words are the same."""
    plates = [" ".join(f"p{k}x{i}" for i in range(30)) for k in range(2)]
    own = lambda i: " ".join(f"u{i}x{k}" for k in range(100))
    docs = [(i, f"{plates[i % 2]} {own(i // 2 if i < 2 else i)}") for i in range(60)]
    bags = [Counter(zip(*[t.split()[k:] for k in range(5)])) for _, t in docs[:2]]
    assert sum((bags[0] & bags[1]).values()) / sum((bags[0] | bags[1]).values()) < 0.8
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert dict(map(tuple, N.classify(frame).collect())) == {i: max(0, i - 1) if i < 2 else i for i in range(60)}


@pytest.mark.parametrize("heavy", [[], ["a b c d e"]])
def test_document_frequencies_are_exact(spark, monkeypatch, heavy):
    """Over many ranges and chunks; copies, repeated shingles and heavy ones included."""
    monkeypatch.setattr(N, "RANGE_SHINGLES", 16)
    monkeypatch.setattr(N, "CHUNK_DOCS", 3)
    rng = random.Random(6)
    texts = ["a b c d e " + " ".join(rng.choice("fg") for _ in range(rng.randint(6, 12))) for _ in range(40)]
    texts += texts[:5] + ["", None, "a b c d e a b c d e", "one", "alone among them all"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    known = np.sort(np.concatenate([np.empty(0, np.uint64), *[N.shingles_of(h.encode().split()) for h in heavy]]))
    sampler = N.Sampler(known, np.full(len(known), 0.3, np.float32))
    want, found = {}, Counter()
    bags = {t: N.shingles_of(t.encode().split()) for t in texts if t}
    for t in filter(None, texts):
        found.update(set(bags[t].tolist()))
    for t, bag in bags.items():
        if np.mean([found[s] > 1 for s in bag.tolist()]) >= 0.8:
            want[N.node_of(t.encode().split())] = [(s, found[s]) for s in sorted(set(bag.tolist())) if found[s] > 1 and s not in known]
    got = {bytes(r["node"]): list(zip(np.frombuffer(r["shared"], np.uint64).tolist(), np.frombuffer(r["n"], np.uint32).tolist()))
           for r in N.shared_shingles(frame, sampler, sum(map(len, bags.values()))).collect()}
    assert got == want and len(want) > 10


def test_texts_cross_one_shuffle_when_one_of_each_class_is_kept(spark):
    frame = spark.createDataFrame([(1, "a b c", "x"), (1, "a b c", "x"), (None, "a b c", "y"), (2, "d", "z")], "doc_id long, text string, lang string")
    kept = N.deduplicate(frame)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, kept.collect())) == [(1, "a b c", "x"), (2, "d", "z")]
    assert sum("Exchange" in line and "hashpartitioning(node_" in line for line in plan.splitlines()) == 1


def test_counting_a_range_takes_a_small_multiple_of_its_bytes():
    """Less than by np.unique with inverse numbers; what a group gives back leaves in small batches."""
    values = np.random.default_rng(3).integers(0, 200_000, 400_000, dtype=np.uint64)
    tracemalloc.start()
    got = N._times(values)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    _, which, n = np.unique(values, return_inverse=True, return_counts=True)
    before = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (got == n[which]).all() and peak < 5 * values.nbytes and N.RANGE_SHINGLES * 8 <= N.SENT_BYTES * 2
    assert N._times(values[:0]).tolist() == [] and before > peak / 2
    column = pa.chunked_array([pa.array([b"ab" * 4, b"", b"cd" * 8], pa.binary()).slice(1), pa.array([], pa.binary()), pa.array([b"ef" * 4], pa.binary())])
    assert N._joined(column, np.uint64).tobytes() == b"cd" * 8 + b"ef" * 4 and len(N._joined(column.slice(0, 0), np.uint64)) == 0
    wide = pa.table({"x": pa.array([bytes(1 << 18)] * 64, pa.binary())})
    cut = N._in_small_batches(wide)
    assert cut.equals(wide) and max(b.nbytes for b in cut.to_batches()) <= N.SENT_BYTES
