import math
from collections import defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

from orderlake.llm import vector_codes as V
from orderlake.llm.queries import QUERIES
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<double>, label int, v string, code int, same_label int"


def by_hand(rows):
    """{(vec_id, vector): (code, error, label_error)} and the books, with Python integers, one vector at a time."""
    fine = [(i, [math.floor(1024 * x) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    fine.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(fine[0][1])
    cuts = [width * p // 4 for p in range(5)]
    parts = list(zip(cuts, cuts[1:]))
    same = [r for r in fine if len(r[1]) == width]
    books = [[r[1][a:b] for r in same[:256]] for a, b in parts]

    def assign(v):
        out = []
        for (a, b), book in zip(parts, books):
            out.append(min((sum((x - y) ** 2 for x, y in zip(v[a:b], e)), k) for k, e in enumerate(book)))
        return out
    for _ in range(4):
        members = [defaultdict(list) for _ in parts]
        for _, v, _ in same:
            for p, (_, k) in enumerate(assign(v)):
                members[p][k].append(v[parts[p][0]:parts[p][1]])
        for p, groups in enumerate(members):
            for k, vs in groups.items():
                books[p][k] = [sum(col) // len(vs) for col in zip(*vs)]
    out, labels = [], defaultdict(int)
    for i, v, label in fine:
        got = assign(v) if len(v) == width else None
        code, error = ("".join(f"{k:02x}" for _, k in got), sum(d for d, _ in got)) if got else (None, None)
        labels[label] += error or 0
        out.append((i, code, error, label))
    return [(i, code, error, labels[label]) for i, code, error, label in out], books


def check(df, rows):
    want, books = by_hand(rows)
    got = df.collect()
    assert sorted(map(str, ((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in got))) == sorted(map(str, want))
    book = V.Codebooks([np.array(b, object).reshape(len(b), -1) for b in books], [0])
    assert {r["codebooks_sha256"] for r in got} == {book.sha256()}


def test_query(spark):
    t = pq.read_table(f"{SF_SMALL}/embeddings.parquet").to_pylist()
    check(QUERIES["op12_vector_codes"](spark, SF_SMALL), [(r["vec_id"], r["embedding"], r["label"]) for r in t])


def test_edges(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), rng.normal(size=8).round(1).tolist(), int(i) % 3) for i in range(300)]
    rows += [(None, rows[0][1], None), (5, rows[5][1], 1), (5, rows[6][1], 1), (901, None, 1), (902, [None] * 8, 1), (903, [math.nan] * 8, 1),
             (904, [math.inf] + [0.0] * 7, 0), (905, [1.0] * 7, 2), (906, [], None), (907, [1e12, -1e12] * 4, None), (908, [0.0] * 8, 777)]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA).repartition(5)
    check(V.compress(df), rows)
    assert V.compress(df.limit(0)).count() == 0
    assert V.compress(df.where("vec_id in (901, 902, 903, 904)")).count() == 0


@pytest.mark.parametrize("width", [0, 1, 3, 6])
def test_widths_that_four_does_not_divide(spark, width):
    rows = [(i, [((i * 7 + d * 3) % 11) / 16 - 0.3 for d in range(width)], i % 2) for i in range(40)]
    check(V.compress(spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)), rows)


def test_partitioning_does_not_matter(spark):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    one, many = (sorted(map(tuple, V.compress(df.repartition(n)).collect())) for n in (1, 9))
    assert one == many
