"""Quality rules: gradient-boosted trees over document statistics.

Statistics are counted per whole text inside tasks.  The trees are grown in numpy on a bounded
labelled sample (logistic loss, second-order gains on binned features) with monotonic constraints:
more symbols, repeated lines, repeated windows or capitals can only lower a document's score.  For
scoring, all trees are flattened into node arrays, and every batch walks them level by level with
array operations.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import class_totals, keep_rows, labelled_sample, map_batches, materialise, split_words, texts_of

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
PER_CLASS = 4000          # labelled rows taken of each class: the bound of the training sample
TREES = 40
DEPTH = 3
BINS = 32
SHRINK = 0.2
MIN_ROWS = 10
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
COUNTS = (*BASE, "n_chars", "n_upper", "n_digits", "n_punctuation", "n_lines", "n_equal_neighbours")
#: Feature -> +1 (the score may only rise with it), -1 (only fall) or 0 (free).
FEATURES = {"words": 0, "word_length": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1,
            "upper_share": -1, "digit_share": 0, "punctuation_share": 0, "words_per_line": 0, "neighbour_share": -1}
_UPPER, _DIGITS = bytes(range(65, 91)), b"0123456789"
_PUNCTUATION = b".,;:!?\"'()-"


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more in the text, the first time included."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    k = len(number)
    if k < 2_000_000:                                    # three numbers fit one 64-bit key
        keys = (ids[:-2] * k + ids[1:-1]) * k + ids[2:]
    else:
        _, pairs = np.unique(ids[:-2] * k + ids[1:-1], return_inverse=True)
        keys = pairs * k + ids[2:]
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift:n - 2 + shift] |= twice
    return int(covered.sum())


def duplicate_lines(text: bytes) -> int:
    """Lines (cut at newlines) that hold a word and equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    return len(lines) - len(set(lines))


def _hits(text: bytes, chars: bytes) -> int:
    return len(text) - len(text.translate(None, chars))


def counts_of(text: bytes) -> tuple[int, ...]:
    """The numbers named in ``COUNTS``; lengths are in code points."""
    words = split_words(text)
    points = len(text) if text.isascii() else len(text.decode("utf-8", "replace"))
    same = sum(a == b for a, b in zip(words, words[1:]))
    return (len(words), points - _hits(text, SPACES), _hits(text, SYMBOLS), duplicate_lines(text), repeated_words(words),
            points, _hits(text, _UPPER), _hits(text, _DIGITS), _hits(text, _PUNCTUATION), text.count(b"\n") + 1, same)


def features_of(counts: np.ndarray) -> np.ndarray:
    """Rows of ``COUNTS`` to rows of ``FEATURES``."""
    c = {name: counts[:, i].astype(np.float64) for i, name in enumerate(COUNTS)}
    words, chars = np.maximum(c["n_words"], 1), np.maximum(c["word_chars"], 1)
    return np.stack([np.log1p(c["n_words"]), c["word_chars"] / words, c["n_symbols"] / chars, c["n_dup_lines"] / c["n_lines"],
                     c["n_repeat_words"] / words, c["n_upper"] / chars, c["n_digits"] / chars, c["n_punctuation"] / chars,
                     c["n_words"] / c["n_lines"], c["n_equal_neighbours"] / words], axis=1)


@dataclass
class Forest:
    """All trees as node arrays: leaves have ``feature`` -1 and point to themselves."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    base: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(DEPTH):
                f = self.feature[at]
                goes_left = x[rows, np.maximum(f, 0)] <= self.threshold[at]
                at = np.where(f < 0, at, np.where(goes_left, self.left[at], self.right[at]))
            out += self.value[at]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.logit(x), -50, 50)))


def grow(x: np.ndarray, y: np.ndarray, signs: list[int], n0: int, n1: int) -> Forest:
    """Boosted trees on (features, 0/1 labels).

    A split of a constrained feature must order its sides' values the right way, and both sides' later
    values are bounded by their middle, so the whole forest is monotonic.  The classes are sampled
    evenly, so the base logit is moved back to their shares in all labels (``n0``, ``n1``).
    """
    nodes: list[list[float]] = []      # feature, threshold, left, right, value
    m1 = int(y.sum())
    m0 = len(y) - m1
    if not m0 or not m1:
        return Forest(np.zeros(0, int), np.zeros(0, int), np.zeros(0), np.zeros(0, int), np.zeros(0, int), np.zeros(0),
                      float(np.log((n1 + 1) / (n0 + 1))))
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    bins = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    logits, roots = np.full(len(y), np.log(m1 / m0)), []

    def leaf_value(g: float, h: float, low: float, high: float) -> float:
        return float(np.clip(-g / (h + 1.0), low, high))

    def build(rows: np.ndarray, depth: int, low: float, high: float) -> int:
        me = len(nodes)
        g, h = grad[rows].sum(), hess[rows].sum()
        nodes.append([-1, 0.0, me, me, SHRINK * leaf_value(g, h, low, high)])
        if depth == DEPTH or len(rows) < 2 * MIN_ROWS:
            return me
        best = (1e-6, None)
        for j in range(x.shape[1]):
            size = len(edges[j]) + 1
            if size < 2:
                continue
            b = bins[rows, j]
            gs, hs = np.cumsum(np.bincount(b, grad[rows], size))[:-1], np.cumsum(np.bincount(b, hess[rows], size))[:-1]
            ns = np.cumsum(np.bincount(b, minlength=size))[:-1]
            lv, rv = np.clip(-gs / (hs + 1), low, high), np.clip(-(g - gs) / (h - hs + 1), low, high)
            gain = -(gs * lv + 0.5 * (hs + 1) * lv ** 2) - ((g - gs) * rv + 0.5 * (h - hs + 1) * rv ** 2)
            gain -= -(g * (v := leaf_value(g, h, low, high)) + 0.5 * (h + 1) * v ** 2)
            bad = (ns < MIN_ROWS) | (len(rows) - ns < MIN_ROWS) | (signs[j] * (rv - lv) < 0)
            gain[bad] = -np.inf
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (gain[k], (j, k, lv[k], rv[k]))
        if best[1] is None:
            return me
        j, k, lv, rv = best[1]
        middle = (lv + rv) / 2
        goes_left = bins[rows, j] <= k
        bounds = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle)), 0: ((low, high), (low, high))}[signs[j]]
        nodes[me][0], nodes[me][1] = j, edges[j][k]
        nodes[me][2] = build(rows[goes_left], depth + 1, *bounds[0])
        nodes[me][3] = build(rows[~goes_left], depth + 1, *bounds[1])
        return me

    every = np.arange(len(y))
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-logits))
        grad, hess = p - y, p * (1 - p)
        start = len(nodes)
        roots.append(build(every, 0, -np.inf, np.inf))
        part = np.array(nodes[start:])
        tree = Forest(np.array([0]), part[:, 0].astype(int), part[:, 1], part[:, 2].astype(int) - start,
                      part[:, 3].astype(int) - start, part[:, 4], 0.0)
        logits = logits + tree.logit(x)
    a = np.array(nodes)
    shift = np.log(max(n1, 1) / max(n0, 1)) - np.log(m1 / m0)
    return Forest(np.array(roots), a[:, 0].astype(int), a[:, 1], a[:, 2].astype(int), a[:, 3].astype(int), a[:, 4],
                  float(np.log(m1 / m0) + shift))


def _statistics(texts: list[bytes]) -> np.ndarray:
    return np.array([counts_of(t) for t in texts], np.int64).reshape(len(texts), len(COUNTS))


def statistics(docs: DataFrame, *carry: str) -> DataFrame:
    """The columns ``carry`` and the numbers of ``COUNTS`` of every row."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        got = _statistics(texts_of(batch))
        return pa.RecordBatch.from_arrays([*[batch.column(c) for c in carry], *[pa.array(got[:, i]) for i in range(len(COUNTS))]],
                                          [*carry, *COUNTS])
    schema = docs.select(*carry).schema
    for name in COUNTS:
        schema = schema.add(name, "long")
    return map_batches(docs.select(*carry, "text"), run, schema)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS) -> Forest:
    """Grow the forest on the labelled sample: at most ``2 * per_class`` short rows reach the driver.

    Labels of documents that are not in ``docs`` (an earlier stage rejected them) count nowhere, neither
    in the sample's limit nor in the class shares.
    """
    labels = materialise(labels.join(docs.select("doc_id"), "doc_id", "left_semi"), "gbt-labels")
    sample = labelled_sample(docs, labels, label, per_class).select("doc_id", "text", F.col("label").cast("int"))
    rows = statistics(sample, "doc_id", "label").collect()
    rows.sort(key=lambda r: r["doc_id"])
    counts = np.array([[r[c] for c in COUNTS] for r in rows], np.int64).reshape(len(rows), len(COUNTS))
    y = np.array([r["label"] for r in rows], np.float64)
    return grow(features_of(counts), y, list(FEATURES.values()), *class_totals(labels, label))


def base_failed(counts: np.ndarray) -> np.ndarray:
    """Fewer than 50 words, or more than half of them repeated."""
    return (counts[:, 0] < 50) | (100 * counts[:, 4] > 50 * counts[:, 0])


def verdicts(docs: DataFrame, forest: Forest, threshold: float = 0.5) -> DataFrame:
    """doc_id, the base counts, base_failed, kept and score of every row, in one pass without a shuffle.

    NULL and empty texts have no words and fail the base; repeated rows are judged each.
    """
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = _statistics(texts_of(batch))
        failed, score = base_failed(counts), forest.probability(features_of(counts))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(counts[:, i]) for i in range(len(BASE))], pa.array(failed),
             pa.array(~failed & (score >= threshold)), pa.array(score)],
            ["doc_id", *BASE, "base_failed", "kept", "score"])
    schema = docs.select("doc_id").schema
    for name in BASE:
        schema = schema.add(name, "long")
    return map_batches(docs.select("doc_id", "text"), run,
                       schema.add("base_failed", "boolean").add("kept", "boolean").add("score", "double"))


def keep_good(docs: DataFrame, forest: Forest, threshold: float = 0.5) -> DataFrame:
    """Rows of ``docs`` (all columns) that pass the base and the forest."""
    def decide(texts: list[bytes]) -> list[bool]:
        counts = _statistics(texts)
        return list(~base_failed(counts) & (forest.probability(features_of(counts)) >= threshold))
    return keep_rows(docs, decide)
