import math
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from orderlake.llm import language_model as L
from orderlake.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.conftest import documents, edge_rows


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2


def brute(rows):
    counts = Counter()
    for i, text in rows:
        if not held(i):
            counts.update(text.lower().split() + [L.END])
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, text in rows:
        tokens = text.lower().split() + [L.END]
        out.append((str(i), held(i), len(tokens), sum(counts[w] > 0 for w in tokens), n,
                    sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens)))
    return sorted(out)


def compare(got, rows):
    got = sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in got)
    for a, b in zip(got, brute(rows), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9, abs=1e-9) and a[6] <= 1e-6


def test_query_against_brute_force_and_better_than_its_base(spark):
    got = QUERIES["op6_language_model"](spark, SF_SMALL).collect()
    compare(got, [(i, t) for i, t, _ in documents(SF_SMALL)])
    own = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in own) > 0.995 * sum(r["base_score"] for r in own)      # at least 0.5% better


def test_edges(edge_docs, no_docs):
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 2
    scored, vocab = L.fit_and_score(edge_docs, ~fold)
    got = scored.withColumn("held_out", fold).withColumn("train_tokens", F.lit(vocab.tokens)).collect()
    compare(got, [(i, (t or "").encode()) for i, t, _ in edge_rows()])
    assert L.fit_and_score(no_docs, ~fold)[0].count() == 0
    untrained, vocab = L.fit_and_score(edge_docs, F.lit(False))
    assert vocab.tokens == 0 and all(r["base_score"] == 0 and math.isfinite(r["score"]) for r in untrained.collect())


def test_words_outside_the_heavy_ones_meet_their_counts(edge_docs, monkeypatch):
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 2
    rows = lambda got: sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in got)
    want = rows(L.fit_and_score(edge_docs, ~fold)[0].collect())
    whole = L.vocabulary
    monkeypatch.setattr(L, "vocabulary", lambda counts: whole(counts, singles=4, heavy=9))
    assert rows(L.fit_and_score(edge_docs, ~fold)[0].collect()) == want


def test_heavy_words_are_whole_steps_of_the_count(spark):
    words = [(f"w{i}".encode(), 1000 // (i + 1)) for i in range(200)] + [(L.END, 77)]
    counts = spark.createDataFrame(words, "word binary, n long")
    for heavy in (0, 5, 60, 1000):
        vocab = L.vocabulary(counts, singles=4, heavy=heavy)
        assert len(vocab.words) - 1 <= heavy and vocab.words[0] == L.END and vocab.counts[0] == 77
        assert (vocab.tokens, vocab.distinct) == (sum(n for _, n in words), 201)
        assert vocab.words[1:] == [w for w, _ in words[:len(vocab.words) - 1]] or sorted(vocab.counts[1:])[::-1] == list(vocab.counts[1:])
        assert all(n < vocab.counts[-1] for w, n in words if w not in vocab.words) or heavy == 0


def fitted(docs, singles, heavy):
    """The parts of ``fit_and_score`` on all rows, with a vocabulary small enough to have every kind of unit."""
    counts = L.word_counts(docs)
    vocab = L.vocabulary(counts, singles=singles, heavy=heavy)
    encoded = L.encode(docs, vocab)
    p = L.train(encoded, vocab)
    return counts, vocab, p, L.train_units(encoded, vocab, p)


def test_score_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("doc_id < 40").select("doc_id", "text")
    counts, vocab, p, inside = fitted(docs, 20, 900)
    rows = documents(SF_SMALL)
    rows = [(i, t) for i, t, _ in rows if i < 40]
    seen = Counter()
    for _, text in rows:
        seen.update(text.lower().split() + [L.END])
    assert vocab.hashed > 1 and vocab.classes > 21
    number = {w: k for k, w in enumerate(vocab.words)}
    unit = lambda w: number[w] if w in number else len(number) + xxhash.xxh64_intdigest(w, 42) % vocab.hashed
    mates = {}
    for w in seen:
        if w not in number:
            mates.setdefault(unit(w), []).append(seen[w])
    members = {}
    for u, c in enumerate(vocab.class_of):
        members.setdefault(c, []).append(u)

    def softmax(scores, at):
        scores = np.asarray(scores, np.float64)
        return scores[at] - scores.max() - math.log(np.exp(scores - scores.max()).sum())

    def brute_score(text):
        log, before = 0.0, [vocab.begin, vocab.begin]
        for w in text.lower().split() + [L.END]:
            u = unit(w)
            c = int(vocab.class_of[u])
            h = p.ctx1[before[0]] + p.ctx2[before[1]]
            log += softmax(p.out @ h + p.bias, c)
            own = members[c]
            if len(own) > 1:
                log += softmax([inside.out[k] @ p.ctx1[before[0]] + inside.bias[k] for k in own], own.index(u))
            if w not in number:
                log += math.log((seen[w] + 1) / (sum(mates.get(u, [])) + len(mates.get(u, [])) + 1))
            before = [c, before[0]]
        return log / math.log(10)
    got = {r["doc_id"]: r["score"] for r in L.score(docs, counts, vocab, L.normalise(p), inside).collect()}
    for i, text in rows:
        assert got[i] == pytest.approx(brute_score(text), rel=1e-4, abs=1e-3)


def test_partitions_do_not_change_the_model_and_no_class_takes_all_rare_words(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    sums = []
    for parts in (1, 64):
        scored, vocab = L.fit_and_score(docs.repartition(parts), F.lit(True))
        sums.append(scored.agg(F.sum("score")).first()[0])
    assert sums[0] == pytest.approx(sums[1], rel=1e-4)
    assert vocab.class_shares()[vocab.singles:].max() < 0.1


def test_hash_of_units_is_spark_xxhash64(spark):
    words = [b"", b"a", "ü".encode() * 9, b"x" * 100]
    rows = spark.createDataFrame([(w,) for w in words], "word binary").select("word", F.xxhash64("word").alias("h")).collect()
    assert all(xxhash.xxh64_intdigest(bytes(r["word"]), L.HASH_SEED) == r["h"] % 2 ** 64 for r in rows)


def test_classes_sum_to_one_and_training_helps():
    rng = np.random.default_rng(0)
    shares = np.array([0.1, 0.4, 0.3, 0.2])
    # class 1 is mostly followed by 2, and 2 by 1
    w = [1]
    for _ in range(40_000):
        w.append(int(rng.choice(4, p=[0.05, 0.05, 0.85, 0.05] if w[-1] == 1 else [0.05, 0.85, 0.05, 0.05] if w[-1] == 2 else shares)))
    docs = np.array_split(np.array(w), 80)
    c1, c2, w = L.contexts(docs, 4)
    assert c1[0] == 4 and c2[0] == 4 and c2[1] == 4 and c1[len(docs[0])] == 4 and c1[1] == docs[0][0]
    trainer = L.Trainer(L.Parameters.start(shares), shares)
    before = L.normalise(trainer.p).log10(c1, c2, w).mean()
    for k in range(20):
        trainer.apply(L.gradients(trainer.p, shares, docs[k::20], rng.random(4)))
    tables = L.normalise(trainer.p)
    assert tables.log10(c1, c2, w).mean() > before + 0.1
    one, two = np.meshgrid(np.arange(5), np.arange(5))
    total = sum(10.0 ** tables.log10(one.ravel(), two.ravel(), np.full(25, k)) for k in range(4))
    assert total == pytest.approx(np.ones(25), abs=1e-4)


def test_units_of_a_class_follow_their_contexts_and_sum_to_one():
    rng = np.random.default_rng(0)
    hidden = rng.normal(0, 0.5, (6, L.DIM)).astype(np.float32)
    counts = np.full((6, 3), 20.0, np.float32)
    counts[1, 2], counts[4, 0] = 2000, 2000
    shares = (counts.sum(0) / counts.sum()).astype(np.float32)
    out, bias, norm = L.fit_units(counts, shares, hidden)
    logs = hidden @ out.T + bias - norm[:, None]
    assert np.exp(logs).sum(1) == pytest.approx(np.ones(6), abs=1e-4)
    assert (counts * logs).sum() > (counts * np.log(shares)).sum() + 100
    out, bias, norm = L.fit_units(np.zeros((6, 3), np.float32), shares, hidden)
    assert np.exp(bias - norm[:, None]) == pytest.approx(np.tile(shares, (6, 1)), abs=1e-5)


def test_counts_of_units_cross_packed(edge_docs, monkeypatch):
    """One row per task and class, not one per cell."""
    vocab = L.vocabulary(L.word_counts(edge_docs), singles=4, heavy=150)
    encoded = L.encode(edge_docs, vocab)
    frames, whole = [], L.map_arrow
    monkeypatch.setattr(L, "map_arrow", lambda df, run, schema: frames.append(whole(df, run, schema)) or frames[-1])
    p = L.Parameters.start(vocab.class_shares())
    got = L.train_units(encoded, vocab, p)
    sent = next(f for f in frames if "class" in f.columns)
    assert sent.count() <= sent.rdd.getNumPartitions() * (vocab.classes - vocab.singles)
    docs = [np.frombuffer(r["units"], np.int32) for r in encoded.collect()]
    c1, _, w = L.contexts([vocab.class_of[u] for u in docs], vocab.begin)
    units = np.concatenate(docs)
    for c in range(vocab.singles, vocab.classes):
        members = np.flatnonzero(vocab.class_of == c)
        counts, share = np.zeros((len(members), vocab.classes + 1), np.float32), np.zeros(len(members))
        np.add.at(counts, (vocab.inner[units[w == c]], c1[w == c]), 1)
        share[vocab.inner[members]] = vocab.totals[members] + 1.0
        out, bias, norm = L.fit_units(counts.T, (share / share.sum()).astype(np.float32), p.ctx1)
        assert (got.out[members] == out[vocab.inner[members]]).all() and (got.norm[c] == norm).all()
