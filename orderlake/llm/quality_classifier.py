"""Quality classifier: supervised subword embeddings.

A document is the bag of its words, their character n-grams and its pairs of equal neighbours.  Every feature is hashed into one
of ``buckets`` learned vectors; a document's vector is the mean of its features' vectors, and a
softmax over two classes gives the score.  Vectors and output weights are trained together by
numpy stochastic gradient descent on a bounded labelled sample (``per_class`` rows of each class).

Scoring needs no vectors: the output layer is linear, so each bucket is folded into one number
(its share of the logit) and a word's features into one cached pair (sum, count).  A task therefore
holds the fixed-size table and a bounded word cache, whatever the size of the corpus.
"""

from __future__ import annotations

import operator
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import class_totals, keep_rows, labelled_sample, map_arrow, map_batches, split_words, texts_of

BUCKETS = 1 << 16
DIM = 8
NGRAMS = (3, 4, 5)
PER_CLASS = 1000          # labelled rows taken of each class: the bound of the training sample
EPOCHS = 4
RATE = 0.5
CACHE_WORDS = 200_000


def word_features(word: bytes) -> list[int]:
    """Bucket of the word itself, then of each character n-gram of ``<word>``."""
    marked, crc, last = b"<" + word + b">", zlib.crc32, BUCKETS - 1
    out = [crc(marked) & last]
    if word.isascii():
        for n in NGRAMS:
            out += [crc(marked[i:i + n], n) & last for i in range(len(marked) - n + 1)]
    else:
        chars = marked.decode("utf-8", "replace")
        for n in NGRAMS:
            out += [crc(chars[i:i + n].encode(), n) & last for i in range(len(chars) - n + 1)]
    return out


#: One feature that every document has, so that an empty text has a vector, too.
END = zlib.crc32(b"</s>") % BUCKETS
#: The word pair of two equal neighbours; all such pairs share this bucket.
REPEAT = zlib.crc32(b"<=>") % BUCKETS


def repeats(words: list[bytes]) -> int:
    """Words that equal the word before them."""
    return sum(map(operator.eq, words, words[1:]))


def document_features(text: bytes, memo: dict[bytes, list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a whole text and how often each occurs; ``memo`` keeps words' features."""
    words = split_words(text)
    counts: Counter[int] = Counter({END: 1})
    counts[REPEAT] += repeats(words)
    for word, n in Counter(words).items():
        found = memo.get(word)
        if found is None:
            if len(memo) >= CACHE_WORDS // 8:
                memo.clear()
            found = memo[word] = word_features(word)
        for f in found:
            counts[f] += n
    ids = np.fromiter(counts.keys(), np.int32, len(counts))
    return ids, np.fromiter(counts.values(), np.float32, len(counts))


class _WordLogits(dict):
    """Word -> complex(sum of its features' logit shares, number of features); bounded."""

    def __init__(self, table: np.ndarray):
        super().__init__()
        self.table = table.tolist()

    def __missing__(self, word: bytes) -> complex:
        ids = word_features(word)
        value = complex(sum(map(self.table.__getitem__, ids)), len(ids))
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = value
        return value


@dataclass
class SubwordModel:
    """``table``: logit share of each bucket (a document's logit is the mean over its features)."""

    table: np.ndarray
    bias: float

    def scorer(self):
        cache = _WordLogits(self.table)
        end, repeat = complex(float(self.table[END]), 1), float(self.table[REPEAT])

        def score(text: bytes) -> float:
            words = split_words(text)
            same = repeats(words)
            total = sum(map(cache.__getitem__, words), end) + complex(same * repeat, same)
            logit = total.real / total.imag + self.bias
            return float(1.0 / (1.0 + np.exp(-np.clip(logit, -50, 50))))
        return score


def train(samples: list[tuple[np.ndarray, np.ndarray, int]], n0: int, n1: int, seed: int = 17) -> SubwordModel:
    """Stochastic gradient descent, one document at a time, over (buckets, counts, label).

    The two classes are sampled evenly, so the logit is moved back to their shares in all labels
    (``n0``, ``n1``).  With a class missing the score is the smoothed share of label 1 everywhere.
    """
    m1 = sum(y for _, _, y in samples)
    m0 = len(samples) - m1
    if not m0 or not m1:
        return SubwordModel(np.zeros(BUCKETS), float(np.log((n1 + 1) / (n0 + 1))))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    out = np.zeros((DIM, 2), np.float32)
    steps, done = EPOCHS * len(samples), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(samples)):
            ids, counts, label = samples[i]
            rate = RATE * (1 - done / steps)
            done += 1
            share = (counts / counts.sum())[:, None]
            own = vectors[ids]
            hidden = (own * share).sum(0)
            logits = hidden @ out
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[label] -= 1.0                                  # gradient of the loss by the logits
            back = out @ p
            out -= rate * np.outer(hidden, p)
            vectors[ids] = own - rate * len(ids) ** 0.5 * share * back
    table = (vectors @ (out[:, 1] - out[:, 0])).astype(np.float64)
    shift = np.log(max(n1, 1) / max(n0, 1)) - np.log(m1 / m0)
    return SubwordModel(table, float(shift))


def fit(docs: DataFrame, labels: DataFrame, fold=None, label: str = "quality", per_class: int = PER_CLASS) -> SubwordModel:
    """Train on the labelled sample; ``fold`` is a condition on ``doc_id`` that limits the rows learned from.

    Features are made in tasks; the driver receives at most ``2 * per_class`` rows of at most
    ``BUCKETS`` (bucket, count) pairs.
    """
    def featurise(batch: pa.RecordBatch) -> pa.RecordBatch:
        memo: dict[bytes, list[int]] = {}
        pairs = [document_features(t, memo) for t in texts_of(batch)]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([a.tobytes() for a, _ in pairs], pa.binary()),
             pa.array([c.tobytes() for _, c in pairs], pa.binary()), batch.column("label")],
            ["doc_id", "ids", "counts", "label"])
    sample = labelled_sample(docs, labels, label, per_class, fold).select("doc_id", "text", F.col("label").cast("int"))
    schema = sample.select("doc_id").schema.add("ids", "binary").add("counts", "binary").add("label", "integer")   # ids of any type
    rows = map_batches(sample, featurise, schema).collect()
    rows.sort(key=lambda r: r["doc_id"])
    samples = [(np.frombuffer(r["ids"], np.int32), np.frombuffer(r["counts"], np.float32), r["label"]) for r in rows]
    return train(samples, *class_totals(labels, label, fold))


def score(docs: DataFrame, model: SubwordModel) -> DataFrame:
    """(doc_id, score): probability of label 1 for every row, in one pass without a shuffle.

    NULL and empty texts score by the end feature alone; repeated rows are scored each.
    """
    def run(batches):
        one = model.scorer()
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array([one(t) for t in texts_of(batch)], pa.float64())],
                    ["doc_id", "score"])
    return map_arrow(docs.select("doc_id", "text"), run, docs.select("doc_id").schema.add("score", "double"))


def keep_good(docs: DataFrame, model: SubwordModel, threshold: float = 0.5) -> DataFrame:
    """Rows of ``docs`` (all columns) that score ``threshold`` or more."""
    holder: dict = {}

    def decide(texts: list[bytes]) -> list[bool]:
        one = holder.get("score") or holder.setdefault("score", model.scorer())
        return [one(t) >= threshold for t in texts]
    return keep_rows(docs, decide)
