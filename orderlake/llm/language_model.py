"""LM scoring: a log-bilinear neural model trained in numpy with noise-contrastive estimation.

Vocabulary.  Word counts cover all training documents (one shuffle).  Every token belongs to a *unit*: a
frequent word is a unit of its own (at most ``HEAVY`` of them, a table of bounded size), all other words
share hashed units whose number grows with the number of distinct words (some 64 words each, at most
``HASHED``).  The ``SINGLES`` most frequent words and the end token are classes of their own; all other
units lie in classes of at most ``SPAN`` units: frequent words by their endings, hashed units in order.

Model.  P(word) = P(class | c1, c2) * P(unit | class, c1) * P(word | unit), where c1 is the class of the
token before and c2 the one before that.  The score of a class is ``bias + out . (ctx1[c1] + ctx2[c2])``,
that of a unit inside its class ``bias + out . ctx1[c1]`` with a learned vector of its own; both are
normalised exactly by matrix products over all contexts.  Inside a hashed unit a word has its add-one
share of the unit's counts, with one place for unknown words.  So every text has a normalised probability.

Training.  Both levels start from the unigram model.  Classes: the documents are dealt to ``ROUNDS`` by a
hash; in each round all tasks send their gradients of noise-contrastive estimation for the same parameters,
which are added up and applied once.  A document's noise samples follow from its own hash, so the result
does not depend on partitions.  Units: tokens are counted by (class, unit, c1) in Spark, and each class
(a table of bounded size) is fitted to its counts by itself, with the noise taken at its expectation.

Scoring.  The frequent words travel to the tasks with their counts and vectors (bounded tables); only other
words are joined with the counts, so no frequent word is ever a join key.

NULL and empty texts are just the end token; an empty table gives no rows; no training rows give a uniform
start.  Equal rows are scored alike and all given back.  Long texts are worked on whole, in pieces.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import map_arrow, materialise, ship_package, small_batches, split_words, texts_of
from orderlake.session import scratch_dir

SINGLES = 512
HEAVY = 200_000
HASHED = 1 << 16
SPAN = 512
HASH_SEED = 42            # fixed value: the seed of Spark's xxhash64
DIM = 16
ROUNDS = 12
PIECE = 4096              # tokens of a document that share noise samples
NOISE = 64
RATE = 0.3
STEADY = 50.0             # tokens by which the step of a rare row is damped
UNIT_STEPS = 12
FLUSH = 400_000           # distinct words or cells a task counts before it hands them on
END = b""                 # the end token; no word is empty


def words_of(text: bytes) -> list[bytes]:
    """Words with A-Z lower-cased (bytes.lower changes nothing else)."""
    return split_words(text.lower())


def word_counts(training: DataFrame) -> DataFrame:
    """(word, n) over all tokens of the training documents, pre-counted per task, as a written table."""
    def run(batches):
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for text in texts_of(batch):
                counts.update(words_of(text))
            counts[END] += batch.num_rows
            if len(counts) >= FLUSH:
                yield _counts(counts)
                counts.clear()
        if counts:
            yield _counts(counts)

    def _counts(counts):
        return pa.RecordBatch.from_arrays([pa.array(list(counts.keys()), pa.binary()), pa.array(list(counts.values()), pa.int64())],
                                          ["word", "n"])
    partial = map_arrow(training.select("text"), run, "word binary, n long")
    return materialise(partial.groupBy("word").agg(F.sum("n").alias("n")).where("n > 0"), "lm-counts")


@dataclass
class Vocabulary:
    """Units: ``words`` (the end token first, then by count), then ``hashed`` more for all other words."""

    words: list[bytes]
    counts: np.ndarray
    singles: int              # the first units, which are classes of their own
    hashed: int               # a power of two
    unit_tokens: np.ndarray   # training tokens and distinct words of each hashed unit
    unit_words: np.ndarray
    tokens: int               # N
    distinct: int             # V

    def __post_init__(self) -> None:
        size, heavy = len(self.words) + self.hashed, len(self.words)
        order = sorted(range(self.singles, heavy), key=lambda i: self.words[i][::-1])
        place = np.empty(size - self.singles, np.int64)
        place[np.array(order, np.int64) - self.singles] = np.arange(len(order))
        place[len(order):] = np.arange(len(order), size - self.singles)
        self.class_of = np.concatenate([np.arange(self.singles), self.singles + place // SPAN]).astype(np.int32)
        self.inner = np.concatenate([np.zeros(self.singles, np.int64), place % SPAN]).astype(np.int32)
        self.classes = int(self.class_of.max()) + 1
        self.totals = np.concatenate([self.counts, self.unit_tokens]).astype(np.float64)

    @property
    def begin(self) -> int:
        """Context before the first word."""
        return self.classes

    def class_shares(self) -> np.ndarray:
        """Smoothed unigram distribution over the classes."""
        full = np.bincount(self.class_of, self.totals, self.classes) + 1.0
        return full / full.sum()

    def numbers(self) -> Callable[[list[bytes]], np.ndarray]:
        """A function that gives the units of words."""
        number, heavy, mask = {w: i for i, w in enumerate(self.words)}, len(self.words), self.hashed - 1
        get, digest = number.get, xxhash.xxh64_intdigest

        def units(words: list[bytes]) -> np.ndarray:
            return np.array([heavy + (digest(w, HASH_SEED) & mask) if (i := get(w)) is None else i for w in words], np.int32)
        return units


def vocabulary(counts: DataFrame, singles: int = SINGLES, heavy: int = HEAVY) -> Vocabulary:
    """Totals of all words, and the heavy ones: all that occur at least so often that no more than ``heavy`` do.

    The limit is found from word numbers per eighth of an octave of the count (some hundred rows), so the
    driver receives the heavy words and two numbers per hashed unit.
    """
    total = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v"),
                       F.max(F.when(F.col("word") == F.lit(END), F.col("n"))).alias("ends")).first()
    words = counts.where(F.col("word") != F.lit(END)).withColumn("step", F.floor(F.log2("n") * 8).cast("int"))
    least, room = None, heavy
    for step, number in sorted(map(tuple, words.groupBy("step").count().collect()), reverse=True):
        room -= number
        if room < 0:
            break
        least = step
    top = words.where(F.col("step") >= least).select("word", "n").collect() if least is not None else []
    top.sort(key=lambda r: (-r["n"], bytes(r["word"])))
    known = [END] + [bytes(r["word"]) for r in top]
    n = np.array([total["ends"] or 0] + [r["n"] for r in top], np.int64)
    distinct = int(total["v"] or 0)
    hashed = min(HASHED, 1 << max(0, (distinct - len(known)) // 64).bit_length())
    rare = words if least is None else words.where(F.col("step") < least)
    tokens, members = np.zeros(hashed, np.int64), np.zeros(hashed, np.int64)
    for r in rare.groupBy(F.xxhash64("word").bitwiseAND(hashed - 1).alias("unit")).agg(
            F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect():
        tokens[r["unit"]], members[r["unit"]] = r["n"], r["v"]
    return Vocabulary(known, n, min(singles, len(known)), hashed, tokens, members, int(total["n"] or 0), distinct)


@dataclass
class Parameters:
    ctx1: np.ndarray          # (classes + 1, DIM)
    ctx2: np.ndarray
    out: np.ndarray           # (classes, DIM)
    bias: np.ndarray          # (classes,)

    @classmethod
    def start(cls, shares: np.ndarray, seed: int = 5) -> "Parameters":
        classes = len(shares)
        rng = np.random.default_rng(seed)
        draw = lambda n: rng.normal(0, 0.3, (n, DIM)).astype(np.float32)
        return cls(draw(classes + 1), draw(classes + 1), draw(classes), np.log(shares).astype(np.float32))


def _sums_by_row(index: np.ndarray, values: np.ndarray, rows: int) -> np.ndarray:
    """Rows of ``values`` added up by ``index``."""
    total = np.zeros((rows, values.shape[1]))
    if len(index):
        order = np.argsort(index.astype(np.uint16) if rows <= 1 << 16 else index, kind="stable")      # 16 bits: by radix
        placed = index[order]
        first = np.flatnonzero(np.append(True, placed[1:] != placed[:-1]))
        total[placed[first]] = np.add.reduceat(values[order], first, axis=0)
    return total


def gradients(p: Parameters, shares: np.ndarray, docs: list[np.ndarray], points: np.ndarray) -> np.ndarray:
    """Noise-contrastive gradients of some documents (arrays of classes), one row per row of ctx1, ctx2 and out.

    A row holds the gradient of the vector, that of the bias (out only) and the number of tokens behind it.
    The noise of a document is drawn from ``shares`` at equal steps from the document's point in [0, 1).
    """
    classes = len(shares)
    log_noise = np.log(NOISE * shares).astype(np.float32)
    edges, offset = np.cumsum(shares), p.bias - log_noise
    c1, c2, w = contexts(docs, classes)
    hidden, target = p.ctx1[c1] + p.ctx2[c2], p.out[w]
    real = np.einsum("ij,ij->i", hidden, target) + offset[w]
    d_real = -1.0 / (1.0 + np.exp(np.clip(real, -30, 30)))                # gradient of -log sigmoid(real)
    back = d_real[:, None] * target
    noise_at, noise_grad, at = [], [], 0
    for size, point in zip(map(len, docs), points):
        for a in range(at, at + size, PIECE):
            b = min(a + PIECE, at + size)
            draws = (np.arange(NOISE) + (point + a - at) % 1.0) / NOISE
            noise = np.minimum(np.searchsorted(edges, draws, side="right"), classes - 1)
            out = p.out[noise]
            d_fake = 1.0 / (1.0 + np.exp(-np.clip(hidden[a:b] @ out.T + offset[noise], -30, 30)))   # of -log sigmoid(-fake)
            back[a:b] += d_fake @ out
            noise_at.append(noise)
            noise_grad.append(np.column_stack([d_fake.T @ hidden[a:b], d_fake.sum(0), np.zeros(NOISE)]))
        at += size
    ones, none = np.ones((len(w), 1), np.float32), np.zeros((len(w), 1), np.float32)
    g_out = _sums_by_row(w, np.hstack([d_real[:, None] * hidden, d_real[:, None], ones]), classes)
    g_out += _sums_by_row(np.concatenate(noise_at), np.concatenate(noise_grad), classes)
    behind = np.hstack([back, none, ones])
    return np.concatenate([_sums_by_row(c1, behind, classes + 1), _sums_by_row(c2, behind, classes + 1), g_out])


class Trainer:
    """Parameters with adaptive steps: one step for the summed gradients of a round."""

    def __init__(self, start: Parameters, shares: np.ndarray):
        self.p, self.shares = start, shares
        self.squares = np.full((3 * len(shares) + 2, DIM + 1), 1e-4)

    def apply(self, total: np.ndarray) -> None:
        g = total[:, :-1] / (total[:, -1:] + STEADY)
        self.squares += g * g
        step = (RATE * g / np.sqrt(self.squares)).astype(np.float32)
        p, n = self.p, len(self.shares)
        self.p = Parameters(p.ctx1 - step[:n + 1, :-1], p.ctx2 - step[n + 1:2 * n + 2, :-1],
                            p.out - step[2 * n + 2:, :-1], p.bias - step[2 * n + 2:, -1])


def contexts(ids: list[np.ndarray], begin: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(c1, c2, w) of all tokens of some documents, each ending in the end token's class (0)."""
    w = np.concatenate(ids)
    c1, c2 = np.roll(w, 1), np.roll(w, 2)
    starts = np.cumsum([0] + [len(i) for i in ids[:-1]])
    c1[starts] = begin
    c2[starts] = begin
    later = starts[np.array([len(i) for i in ids]) > 1] + 1
    c2[later] = begin
    return c1, c2, w


def encode(training: DataFrame, vocab: Vocabulary) -> DataFrame:
    """(point, units, round) of the training documents as a written table in one folder per round."""
    spark = training.sparkSession
    shared = spark.sparkContext.broadcast(vocab)

    def run(batches):
        units = shared.value.numbers()
        for batch in batches:
            lists = [np.append(units(words_of(t)), np.int32(0)).tobytes() for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("point"), pa.array(lists, pa.binary()), batch.column("round")],
                                             ["point", "units", "round"])
    mark = F.xxhash64(F.lit("lm"), F.col("doc_id").cast("string"), F.col("text"))
    rows = training.select("text", (F.pmod(mark, F.lit(1 << 20)) / float(1 << 20)).alias("point"),
                           F.pmod(F.shiftright(mark, 20), F.lit(ROUNDS)).cast("int").alias("round"))
    schema = "point double, units binary, round int"
    path = f"{scratch_dir(spark, 'lm-units')}/data"
    map_arrow(rows, run, schema).write.partitionBy("round").parquet(path)
    return spark.read.schema(schema).parquet(path)


def _unit_lists(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(u, np.int32) for u in batch.column("units").to_pylist()]


def train(encoded: DataFrame, vocab: Vocabulary) -> Parameters:
    """``ROUNDS`` synchronised steps, each from the gradients of its own part of the documents.

    Tasks send one row per context or class they met; rows are summed in Spark, and the driver receives one row
    per context and class.
    """
    shares = vocab.class_shares()
    rows = 3 * len(shares) + 2
    trainer = Trainer(Parameters.start(shares), shares)
    names = [f"v{i}" for i in range(DIM + 2)]
    class_of = encoded.sparkSession.sparkContext.broadcast(vocab.class_of)

    def task(p):
        def run(batches):
            total = np.zeros((rows, DIM + 2))
            for batch in small_batches(batches):
                docs = [class_of.value[u] for u in _unit_lists(batch)]
                total += gradients(p, shares, docs, batch.column("point").to_numpy())
            at = np.flatnonzero(total.any(1))
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *map(pa.array, total[at].T)], ["at", *names])
        return run
    for k in range(ROUNDS):
        sent = map_arrow(encoded.where(F.col("round") == k).select("point", "units"), task(trainer.p),
                         "at int, " + ", ".join(f"{n} double" for n in names))
        got = sent.groupBy("at").agg(*[F.sum(n).alias(n) for n in names]).toArrow()
        total = np.zeros((rows, DIM + 2))
        total[got.column("at").to_numpy()] = np.column_stack([got.column(n).to_numpy() for n in names])
        trainer.apply(total)
    return trainer.p


def fit_units(counts: np.ndarray, shares: np.ndarray, hidden: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(vectors, biases, log normalisers by context) of one class from its counts by context and unit.

    Noise-contrastive estimation on counts: each token stands against ``NOISE`` draws from ``shares`` (the class's
    own unigram shares), taken at their expectation.  Without counts the shares are the model.
    """
    seen = np.flatnonzero(counts.any(1))
    n, h = counts[seen], hidden[seen]
    vectors, bias = np.zeros((len(shares), DIM), np.float32), np.log(shares).astype(np.float32)
    log_noise = np.log(NOISE * shares).astype(np.float32)
    drawn = n.sum(1, keepdims=True) * (NOISE * shares).astype(np.float32)
    weight = n.sum(0)[:, None] + STEADY
    squares = np.full((len(shares), DIM + 1), 1e-4)
    for _ in range(UNIT_STEPS if len(seen) else 0):
        p = 1.0 / (1.0 + np.exp(-np.clip(h @ vectors.T + (bias - log_noise), -30, 30)))
        d = (n + drawn) * p - n
        g = np.column_stack([d.T @ h, d.sum(0)]) / weight
        squares += g * g
        step = (RATE * g / np.sqrt(squares)).astype(np.float32)
        vectors -= step[:, :-1]
        bias -= step[:, -1]
    scores = hidden @ vectors.T + bias
    top = scores.max(1, keepdims=True)
    return vectors, bias, (np.log(np.exp(scores - top).sum(1)) + top[:, 0]).astype(np.float32)


@dataclass
class UnitTables:
    """log P(unit | class, c1) = bias[unit] + out[unit] . ctx1[c1] - norm[class, c1], all natural logarithms."""

    ctx1: np.ndarray
    out: np.ndarray
    bias: np.ndarray
    norm: np.ndarray

    def log10(self, c1: np.ndarray, w: np.ndarray, units: np.ndarray) -> np.ndarray:
        logs = np.einsum("ij,ij->i", self.ctx1[c1], self.out[units]) + self.bias[units] - self.norm[w, c1]
        return logs.astype(np.float64) / np.log(10.0)


def train_units(encoded: DataFrame, vocab: Vocabulary, p: Parameters) -> UnitTables:
    """Count (class, unit, c1) over all training tokens and fit each class to its counts.

    Counts are summed per task and cross the shuffle packed, one row per class; a class adds up its rows batch by
    batch in a table of at most ``SPAN`` times (classes + 1) cells, so no class or word is hot.  The driver receives
    one row per class.
    """
    spark = encoded.sparkSession
    wide, singles = vocab.classes + 1, vocab.singles
    shared = spark.sparkContext.broadcast((vocab.class_of, vocab.inner))

    def pack(parts):
        keys, n = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        return keys, np.bincount(n, np.concatenate([c for _, c in parts]), len(keys)).astype(np.int64)

    def rows(keys, n):
        own, cells = keys // (SPAN * wide), (keys % (SPAN * wide)).astype(np.int32)
        first = np.flatnonzero(np.concatenate((np.ones(min(1, len(own)), bool), own[1:] != own[:-1])))
        spans = list(zip(first.tolist(), np.append(first[1:], len(own)).tolist()))
        return pa.RecordBatch.from_arrays([pa.array(own[first].astype(np.int32)), pa.array([cells[i:j].tobytes() for i, j in spans], pa.binary()),
                                           pa.array([n[i:j].astype(np.uint32).tobytes() for i, j in spans], pa.binary())], ["class", "cells", "n"])

    def count(batches):
        class_of, inner = shared.value
        held, size = [], 0
        for batch in small_batches(batches):
            docs = _unit_lists(batch)
            c1, _, w = contexts([class_of[u] for u in docs], vocab.begin)
            units = np.concatenate(docs)
            some = w >= singles
            keys, n = np.unique((w[some].astype(np.int64) * SPAN + inner[units[some]]) * wide + c1[some], return_counts=True)
            held.append((keys, n))
            size += len(keys)
            if size >= FLUSH:
                yield rows(*pack(held))
                held, size = [], 0
        if held:
            yield rows(*pack(held))
    cells = map_arrow(encoded.select("units"), count, "class int, cells binary, n binary")
    start = [np.flatnonzero(vocab.class_of == c) for c in range(singles, vocab.classes)]
    shares = []
    for members in start:
        full = np.zeros(len(members))
        full[vocab.inner[members]] = vocab.totals[members] + 1.0
        shares.append((full / full.sum()).astype(np.float32))
    hidden = p.ctx1
    own = spark.sparkContext.broadcast(shares)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for c, at, n in zip(*(batch.column(k).to_pylist() for k in ("class", "cells", "n"))):
                if total is None:
                    share = own.value[c - singles]
                    total = np.zeros(len(share) * wide, np.int64)
                total[np.frombuffer(at, np.int32)] += np.frombuffer(n, np.uint32)      # a row has each cell once
        counts = total.reshape(-1, wide).astype(np.float32)
        got = fit_units(counts.T, share, hidden)
        yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), *[pa.array([a.astype(np.float32).tobytes()], pa.binary()) for a in got]],
                                         ["class", "out", "bias", "norm"])
    ship_package(spark)
    fitted = cells.groupBy("class").applyInArrow(fit, "class int, out binary, bias binary, norm binary")
    out = np.zeros((len(vocab.class_of), DIM), np.float32)
    bias = np.zeros(len(vocab.class_of), np.float32)
    norm = np.zeros((vocab.classes, wide), np.float32)
    for members, share in zip(start, shares):                 # classes without any token keep their shares
        bias[members] = np.log(share)[vocab.inner[members]]
    for r in fitted.collect():
        members = start[r["class"] - singles]
        out[members] = np.frombuffer(r["out"], np.float32).reshape(-1, DIM)[vocab.inner[members]]
        bias[members] = np.frombuffer(r["bias"], np.float32)[vocab.inner[members]]
        norm[r["class"]] = np.frombuffer(r["norm"], np.float32)
    return UnitTables(hidden, out, bias, norm)


@dataclass
class Tables:
    """log10 P(w | c1, c2) = first[c1, w] + second[c2, w] - norm[c1, c2]; sizes bounded by the classes."""

    first: np.ndarray
    second: np.ndarray
    norm: np.ndarray

    def log10(self, c1: np.ndarray, c2: np.ndarray, w: np.ndarray) -> np.ndarray:
        return self.first[c1, w].astype(np.float64) + self.second[c2, w] - self.norm[c1, c2]


def normalise(p: Parameters) -> Tables:
    """Scores by context class and their normalisers, by batched matrix products over all context pairs."""
    first = p.ctx1 @ p.out.T + p.bias
    second = p.ctx2 @ p.out.T
    e1 = first.max(1, keepdims=True)
    e2 = second.max(1, keepdims=True)
    # sum over w of exp(first[c1, w] + second[c2, w]) for all pairs is one product of two matrices
    sums = np.exp(first - e1).astype(np.float64) @ np.exp(second - e2).astype(np.float64).T
    norm = np.log(sums) + e1 + e2.T
    scale = np.log(10.0)
    return Tables((first / scale).astype(np.float32), (second / scale).astype(np.float32), (norm / scale).astype(np.float32))


def score(docs: DataFrame, counts: DataFrame, vocab: Vocabulary, tables: Tables, inside: UnitTables) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) of every row.

    NULL and empty texts are just the end token.  Equal (doc_id, text) rows are scored once and given
    back as often as they came.  Words outside the heavy ones leave as (document, word, times) rows,
    meet their counts in a join by word, and return as one sum per document.
    """
    spark = docs.sparkSession
    share = -np.log10(vocab.unit_tokens + vocab.unit_words + 1.0)      # of the one place of an unknown word
    shared = spark.sparkContext.broadcast((vocab, tables, inside, share))

    def run(batches):
        vocab, tab, inside, share = shared.value
        heavy, singles, class_of, units_of = len(vocab.words), vocab.singles, vocab.class_of, vocab.numbers()
        log_count, known = np.log10(vocab.counts + 1.0), vocab.counts > 0
        for batch in small_batches(batches):
            texts = texts_of(batch)
            found, rare = [], []
            for text in texts:
                tokens = words_of(text)
                ids = np.append(units_of(tokens), np.int32(0))
                found.append(ids)
                rare.append(Counter([tokens[i] for i in np.flatnonzero(ids >= heavy)]))
            ids = np.concatenate(found)
            sizes = [len(i) for i in found]
            starts = np.cumsum([0] + sizes[:-1])
            c1, c2, w = contexts([class_of[i] for i in found], vocab.begin)
            add = lambda x: np.add.reduceat(x, starts)
            own = ids < heavy
            word = np.where(own, ids, 0)
            model = tab.log10(c1, c2, w) + np.where(own, 0.0, share[np.where(own, 0, ids - heavy)])
            grouped = np.flatnonzero(w >= singles)
            model[grouped] += inside.log10(c1[grouped], w[grouped], ids[grouped])
            key, hashes = batch.column("doc_id"), [xxhash.xxh3_64_intdigest(t) - (1 << 63) for t in texts]
            count = batch.num_rows
            none = lambda kind: pa.nulls(count, kind)
            yield pa.RecordBatch.from_arrays(
                [key, pa.array(hashes, pa.int64()), none(pa.binary()), none(pa.int64()), pa.array(sizes, pa.int64()),
                 pa.array(add((own & known[word]).astype(np.int64))), pa.array(add(np.where(own, log_count[word], 0.0))), pa.array(add(model))], NAMES)
            at = np.repeat(np.arange(count), [len(r) for r in rare])
            if len(at):
                n = len(at)
                yield pa.RecordBatch.from_arrays(
                    [key.take(pa.array(at)), pa.array(np.array(hashes, np.int64)[at]), pa.array([x for r in rare for x in r], pa.binary()),
                     pa.array([x for r in rare for x in r.values()], pa.int64()),
                     *[pa.nulls(n, pa.int64()) for _ in range(2)], *[pa.nulls(n, pa.float64()) for _ in range(2)]], NAMES)
    NAMES = ["doc_id", "text_hash", "word", "times", "n_tokens", "n_known", "logs", "model_log"]
    schema = docs.select("doc_id").schema
    for name, kind in zip(NAMES[1:], ["long", "binary", "long", "long", "long", "double", "double"]):
        schema = schema.add(name, kind)
    parts = materialise(map_arrow(docs.select("doc_id", "text"), run, schema), "lm-parts")
    rare = parts.where("word IS NOT NULL").select("doc_id", "text_hash", "word", "times").join(counts, "word", "left")
    c = F.coalesce(F.col("n"), F.lit(0))
    rare = rare.select("doc_id", "text_hash", (F.col("times") * F.log10(c + 1.0)).alias("rare_log"),
                       F.when(c > 0, F.col("times")).otherwise(0).alias("rare_known"))
    heads = parts.where("word IS NULL").drop("word", "times").withColumn("rows", F.lit(1).cast("long"))
    both = heads.unionByName(rare, allowMissingColumns=True).groupBy("doc_id", "text_hash").agg(
        *[F.sum(x).alias(x) for x in ("rows", "n_tokens", "n_known", "logs", "model_log", "rare_log", "rare_known")])
    rows = F.col("rows")
    mean = lambda name: F.coalesce(F.col(name), F.lit(0)) / rows
    whole = lambda name: F.round(mean(name)).cast("long")
    all_log = float(np.log10(vocab.tokens + vocab.distinct + 1.0))
    return (both.select("doc_id", whole("n_tokens").alias("n_tokens"), (whole("n_known") + whole("rare_known")).alias("n_known"),
                        (mean("logs") + mean("rare_log") - mean("n_tokens") * all_log).alias("base_score"),
                        (mean("model_log") + mean("rare_log")).alias("score"),
                        F.explode(F.sequence(F.lit(1).cast("long"), rows)).alias("copy_")).drop("copy_"))


def fit_and_score(docs: DataFrame, in_training: Column) -> tuple[DataFrame, Vocabulary]:
    """Learn from the rows where ``in_training`` holds and score all rows."""
    training = docs.where(in_training)
    counts = word_counts(training)
    vocab = vocabulary(counts)
    encoded = encode(training, vocab)
    p = train(encoded, vocab)
    return score(docs, counts, vocab, normalise(p), train_units(encoded, vocab, p)), vocab
