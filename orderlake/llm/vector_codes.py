"""Vector code compression: product codes by per-dimension value dictionaries.

Vectors become integers, and parts of them are coded by the nearest of 256 codebook entries.  The
distances never multiply per vector: for each dimension the *distinct* integers of a block form a
dictionary, the squared differences of every dictionary value to all entries are tabulated once, and
a part's distances are gathers from those tables, added over the part's dimensions.  All arithmetic
is on integers, so results do not depend on partitioning.

Per round a task sends one row per entry it used (sums and counts, combined again by Spark); the
driver holds the codebooks alone, whose size is ``PARTS * ENTRIES`` entries of a fixed dimension.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import map_arrow, materialise

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
#: Rows whose distances a task holds at once: 4 bytes by 256 entries each, so a block stays in cache.
BLOCK = 1024
#: Components are 64-bit integers; a larger product counts as not finite.
LIMIT = 2.0 ** 62


@dataclass(frozen=True)
class Codebooks:
    """``entries[part]`` is an (entries, dimensions of the part) array of integers; ``cuts`` are the parts' borders."""

    entries: list[np.ndarray]
    cuts: list[int]

    @property
    def width(self) -> int:
        return self.cuts[-1]

    def sha256(self) -> str:
        """Digest of all components by part, entry and position, as decimal numbers joined by commas."""
        return hashlib.sha256(",".join(str(int(v)) for part in self.entries for v in part.ravel()).encode()).hexdigest()


def quantise(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, label, v): components as floor(1024 * x).

    Rows without a vector, or with a component that is NULL, not finite or beyond ``LIMIT`` are left out.
    """
    scaled = F.transform(F.col(vector).cast("array<double>"), lambda x: x * SCALE)
    fine = F.forall(scaled, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(LIMIT)))
    return (vectors.select("vec_id", "label", scaled.alias("v")).where(F.col("v").isNotNull() & fine)
            .select("vec_id", "label", F.transform("v", lambda x: F.floor(x).cast("long")).alias("v")))


def first_codebooks(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> Codebooks | None:
    """Entry k is the k-th smallest vec_id's part (ties by vector, NULL ids last); NULL for an empty table.

    The first vector's length is the table's; a vector of another length is no entry.
    """
    order = [F.col("vec_id").asc_nulls_last(), F.col("v")]
    head = rows.orderBy(*order).limit(1).select(F.size("v").alias("width")).first()
    if head is None:
        return None
    top = rows.where(F.size("v") == head["width"]).orderBy(*order).limit(entries).select("v").collect()   # at most ``entries``
    values = np.array([r["v"] for r in top], np.int64).reshape(len(top), head["width"])
    cuts = [head["width"] * p // parts for p in range(parts + 1)]
    return Codebooks([values[:, a:b].copy() for a, b in zip(cuts, cuts[1:])], cuts)


def _number_type(values: np.ndarray, entries: np.ndarray):
    """The narrowest type that holds every sum of squares exactly; Python integers if no machine type does."""
    most = max((int(a.max(initial=0)) - int(b.min(initial=0)) for a, b in ((values, entries), (entries, values))), default=0)
    bound = most * most * max(values.shape[1], 1)
    return np.int32 if bound < 2 ** 31 else np.int64 if bound < 2 ** 63 else object


def nearest(values: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry (ties to the lower one) and its squared distance, for each row of ``values``."""
    rows, dims = values.shape
    kind = _number_type(values, entries)
    tables, codes = [], []
    for d in range(dims):
        distinct, code = np.unique(values[:, d], return_inverse=True)
        step = distinct.astype(kind)[:, None] - entries[:, d].astype(kind)[None, :]
        tables.append(step * step)
        codes.append(code.reshape(rows))
    best, error = np.zeros(rows, np.int64), np.zeros(rows, kind)
    for at in range(0, rows, BLOCK):
        here = slice(at, min(at + BLOCK, rows))
        size = here.stop - at
        total = np.zeros((size, len(entries)), kind)
        for table, code in zip(tables, codes):
            total += table[code[here]]
        best[here] = total.argmin(axis=1)
        error[here] = total[np.arange(size), best[here]]
    return best, error


def _matrices(batches, width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(batch, rows whose vectors have the table's length, their vectors as a matrix)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column("v")
        fits = np.asarray(column.value_lengths()) == width
        picked = column.filter(pa.array(fits)) if not fits.all() else column
        yield batch, fits, np.asarray(picked.flatten(), np.int64).reshape(int(fits.sum()), width)


def _partial_sums(books: Codebooks):
    """Task function: per entry used, the number of parts and the component sums as two 32-bit halves."""
    def run(batches):
        count = [np.zeros(len(e), np.int64) for e in books.entries]
        high, low = ([np.zeros(e.shape, np.int64) for e in books.entries] for _ in range(2))
        for _, _, matrix in _matrices(batches, books.width):
            for p, (a, b) in enumerate(zip(books.cuts, books.cuts[1:])):
                part = np.ascontiguousarray(matrix[:, a:b])
                best, _ = nearest(part, books.entries[p])
                count[p] += np.bincount(best, minlength=len(count[p]))
                order = np.argsort(best, kind="stable")
                used, starts = np.unique(best[order], return_index=True)
                if b > a:
                    high[p][used] += np.add.reduceat(part[order] >> 32, starts, axis=0)
                    low[p][used] += np.add.reduceat(part[order] & 0xFFFFFFFF, starts, axis=0)
        for p, n in enumerate(count):
            used = np.flatnonzero(n)
            yield pa.RecordBatch.from_pydict({
                "part": pa.array(np.full(len(used), p, np.int32)), "entry": pa.array(used.astype(np.int32)), "n": pa.array(n[used]),
                "high": pa.array([h.tolist() for h in high[p][used]], pa.list_(pa.int64())),
                "low": pa.array([v.tolist() for v in low[p][used]], pa.list_(pa.int64()))})
    return run


def improve(rows: DataFrame, books: Codebooks) -> Codebooks:
    """One round: every part to its nearest entry, then every entry to the floor of its parts' mean; unused entries stay."""
    sums = map_arrow(rows.select("v"), _partial_sums(books), "part int, entry int, n long, high array<long>, low array<long>")
    widest = max(b - a for a, b in zip(books.cuts, books.cuts[1:]))
    totals = sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[
        F.sum(F.get(half, F.lit(d))).alias(f"{half}{d}") for half in ("high", "low") for d in range(widest)])
    out = [e.copy() for e in books.entries]
    for r in totals.collect():                                # at most PARTS * ENTRIES rows
        for d in range(out[r["part"]].shape[1]):
            out[r["part"]][r["entry"], d] = ((r[f"high{d}"] << 32) + r[f"low{d}"]) // r["n"]
    return Codebooks(out, books.cuts)


def train(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks after ``rounds`` rounds over all rows; NULL for an empty table."""
    books = first_codebooks(rows, parts, entries)
    for _ in range(rounds if books else 0):
        books = improve(rows, books)
    return books


def encode(rows: DataFrame, books: Codebooks) -> DataFrame:
    """(vec_id, label, code, error) of every row; ``code`` has two hex digits for each part.

    A vector of another length than the table's has neither code nor error.  An error beyond a long is
    the largest long.
    """
    def run(batches):
        for batch, fits, matrix in _matrices(batches, books.width):
            code, error = [""] * len(matrix), np.zeros(len(matrix), object)
            for p, (a, b) in enumerate(zip(books.cuts, books.cuts[1:])):
                best, off = nearest(np.ascontiguousarray(matrix[:, a:b]), books.entries[p])
                code = [c + format(k, "02x") for c, k in zip(code, best.tolist())]
                error += off
            found = iter(zip(code, error.tolist()))
            rows_out = [next(found) if ok else (None, None) for ok in fits.tolist()]
            yield pa.RecordBatch.from_pydict({
                "vec_id": batch.column("vec_id"), "label": batch.column("label"), "code": pa.array([c for c, _ in rows_out], pa.string()),
                "error": pa.array([None if e is None else min(e, 2 ** 63 - 1) for _, e in rows_out], pa.int64())})
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    return map_arrow(rows, run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")


def compress(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every vector that can be coded.

    Rows with a NULL vector or a NULL or non-finite component are left out (:func:`quantise`); repeated
    rows and ids each keep their row; fewer than 256 rows give as many entries, and equal entries lose
    to the lowest.  Widths that 4 does not divide give parts that differ by one component.  NULL labels
    are one label; an empty table gives an empty one; other columns are not read.
    """
    rows = materialise(quantise(vectors, vector), "vector-integers")
    books = train(rows)
    if books is None:
        return rows.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
                           F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    coded = materialise(encode(rows, books), "vector-codes")
    # summed per label before the join: a hot label is one row, its vectors never meet in a task
    per_label = coded.groupBy(F.col("label").alias("same_label")).agg(F.try_sum("error").alias("label_error"))
    return (coded.join(per_label, F.col("label").eqNullSafe(F.col("same_label")))
            .select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256")))


def _round_sql(k: int) -> str:
    """The assignment of round ``k`` and the codebooks after it."""
    return f"""
d{k} AS MATERIALIZED (
  SELECT v.vec_id, v.part, e.entry, sum((v.x - e.x) * (v.x - e.x))::BIGINT AS dist
  FROM cells v JOIN book{k} e ON v.part = e.part AND v.pos = e.pos GROUP BY ALL),
near{k} AS MATERIALIZED (
  SELECT vec_id, part, arg_min(entry, dist * 256 + entry) AS entry, min(dist) AS dist FROM d{k} GROUP BY ALL)""" + (
        "" if k == ROUNDS else f""",
mean{k} AS (
  SELECT n.part, n.entry, v.pos, sum(v.x) AS s, count(*)::HUGEINT AS c
  FROM near{k} n JOIN cells v ON v.vec_id = n.vec_id AND v.part = n.part GROUP BY ALL),
book{k + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, b.pos, coalesce((m.s - ((m.s % m.c) + m.c) % m.c) // m.c, b.x)::BIGINT AS x
  FROM book{k} b LEFT JOIN mean{k} m USING (part, entry, pos))""")


#: For tables whose vec_ids are distinct and whose vectors have one length that 4 divides.
COMPRESS_SQL = f"""
WITH fine AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
places AS (SELECT unnest(range(0, (SELECT any_value(len(v)) FROM fine))) AS i),
cells AS MATERIALIZED (
  SELECT vec_id, i // (len(v) // {PARTS}) AS part, i % (len(v) // {PARTS}) AS pos, v[i + 1] AS x FROM fine, places),
firsts AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM fine QUALIFY entry < {ENTRIES}),
book0 AS MATERIALIZED (SELECT part, entry, pos, x FROM cells JOIN firsts USING (vec_id)),{','.join(_round_sql(k) for k in range(ROUNDS + 1))},
coded AS (
  SELECT vec_id, string_agg(printf('%02x', entry::INT), '' ORDER BY part) AS code, sum(dist)::BIGINT AS error
  FROM near{ROUNDS} GROUP BY vec_id)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, pos)) FROM book{ROUNDS}) AS codebooks_sha256
FROM coded JOIN fine USING (vec_id)
"""
