import random

import pytest

EDGE_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
               "score double, copies long, node_ binary, c0 string, shard int, `salt_` int, label int, size long, target double")


def edge_rows():
    """(doc_id, text, source): NULLs, empty and very long texts, repeated rows, repeated ids, ties."""
    rng = random.Random(3)
    words = ["alpha", "beta", "Gamma", "delta", "über", "日本", "x", "the", "of", "%%%"]
    prose = [" ".join(rng.choice(words) + str(rng.randint(0, 40)) for _ in range(120)) for _ in range(6)]
    near = prose[0].split(" ")
    near[60] = "changed"
    rows = [(None, None, None), (1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (4, "one two", "b"), (5, prose[0], "b"),
            (6, prose[0], "a"), (6, prose[0], "a"), (7, " ".join(near), "c"), (8, prose[1], "c"), (None, prose[2], "a"),
            (9, prose[3], "ä"), (9, prose[4], "A"), (10, "very " * 30_000 + "long", "b"), (11, prose[5].upper(), "b"),
            (12, "x" * 60_000, "c"), (100, prose[1] + "\n" + prose[1], "a"), (200, "  two  spaces \n\nline\r\nend ", "b"), (300, None, "b")]
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark):
    rows = [(i, t, "en", s, 0, 0.5, 1, b"n", "c", 3, 4, 1, 5, 6.0) for i, t, s in edge_rows()]
    return spark.createDataFrame(rows, EDGE_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], EDGE_SCHEMA)


@pytest.fixture(scope="session")
def edge_labels(spark):
    rows = [(5, 1, 0), (8, 1, 0), (9, 1, 0), (10, 0, 0), (12, 0, 1), (12, None, 1), (None, 1, 0), (4, 0, 0), (4, 1, 0), (777, 0, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def documents(sf_dir):
    """(doc_id, text bytes, source) of a folder, read without Spark."""
    import pyarrow.parquet as pq
    t = pq.read_table(f"{sf_dir}/documents.parquet", columns=["doc_id", "text", "source"]).to_pylist()
    return [(r["doc_id"], (r["text"] or "").encode(), r["source"]) for r in t]
