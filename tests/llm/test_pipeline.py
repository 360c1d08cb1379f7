"""Each stage against a brute-force version of itself on its own input, and the whole run."""

import hashlib
from collections import Counter

import public_tokenizers
import sentencepiece

import __spark_entry__ as E
import corpus_pipeline as P
from orderlake.llm import quality_classifier, queries
from orderlake.llm.common import materialise, table
from tests.conftest import SF_SMALL
from tests.llm.test_gbt_rules import brute as base_counts
from tests.llm.test_mixing import brute_targets
from tests.llm.test_near_dup import brute as classes


def rows_of(df):
    return [(r["doc_id"], (r["text"] or "").encode(), r["source"]) for r in df.collect()]


def test_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(E.queries())
    assert [int(n[2:].split("_")[0]) for n in queries.QUERIES] == list(range(1, 14))
    assert set(queries.ORACLE) <= set(E.oracle_sql())
    assert len(P.STAGES) == 5


def test_stages(spark, tmp_path):
    docs = table(spark, SF_SMALL, "documents")
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF_SMALL, "labels").collect()}
    before = rows_of(docs)
    for n, (name, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, SF_SMALL)
        if n < 4:
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{n}")
        out = spark.read.parquet(f"{tmp_path}/{n}")
        if n < 4:
            after = rows_of(out)
        if n == 0:
            score = quality_classifier.fit(docs, table(spark, SF_SMALL, "labels")).scorer()
            assert sorted(after) == sorted(r for r in before if score(r[1]) >= 0.5)
            assert all(labels[i] for i, _, _ in after if i in labels)
            lost = {i for i, _, _ in before} - {i for i, _, _ in after}
            assert sum(labels[i] == 1 for i in lost if i in labels) <= 1
        elif n == 1:
            assert set(after) <= set(before)
            lost = set(before) - set(after)
            kept_counts = [base_counts(t) for _, t, _ in after]
            assert all(b[0] >= 50 and 2 * b[4] <= b[0] for b in kept_counts)
            hard = [i for i, t, _ in lost for b in [base_counts(t)] if b[0] >= 50 and 2 * b[4] <= b[0]]
            assert sum(labels.get(i) == 1 for i in hard) <= 3
        elif n == 2:
            want = {c for _, c in classes([(i, t) for i, t, _ in before])}
            assert sorted(i for i, _, _ in after) == sorted(want) and set(after) <= set(before)
        elif n == 3:
            assert set(after) <= set(before)
            sizes, taken = Counter(), Counter()
            for _, t, s in before:
                sizes[s] += len(t.split())
            for _, t, s in after:
                taken[s] += len(t.split())
            targets = brute_targets(dict(sizes))
            assert all(abs(taken[s] - targets[s]) < 0.08 * targets[s] for s in sizes)
            assert max(Counter(after).values()) <= 3
        else:
            library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
            want = Counter((i, len(x), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest())
                           for i, t, _ in before for x in [library.encode(t.decode())])
            assert Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"]) for r in out.collect()) == want
        docs, before = out, after


def test_run_is_the_stages_one_after_another(spark):
    got = P.run(spark, SF_SMALL)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and got.count() > 500


def test_stages_on_edge_rows_and_empty_tables(spark, tmp_path, edge_docs, no_docs, edge_labels):
    """Every stage takes NULLs, empty and long texts, repeated rows and clashing columns, and an empty table."""
    edge_labels.write.parquet(f"{tmp_path}/labels.parquet")
    for docs, empty in ((edge_docs, False), (no_docs, True)):
        for name, stage in P.STAGES:
            out = materialise(stage(spark, docs, str(tmp_path)), f"edges-{name}")
            assert name == P.STAGES[-1][0] or out.columns == docs.columns, name
            n = out.count()
            assert n == 0 if empty else n <= 3 * docs.count(), name
            if name in ("quality_classifier", "quality_rules", "near_duplicates"):
                assert out.exceptAll(docs).count() == 0, name
            if name == "near_duplicates":
                assert empty or n == out.select("text").distinct().count()
