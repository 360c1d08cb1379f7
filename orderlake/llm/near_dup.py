"""Near-duplicate documents: improved consistent weighted sampling over TF-IDF shingles.

1. Texts with equal words (A-Z lower-cased) are one node: a 128-bit hash of the words.
2. A node's items are its 5-word shingles; the k-th occurrence of a shingle is an item of its own, so
   that shared and united weights add up term frequencies exactly.  An item weighs its shingle's inverse
   document frequency, ``ln(documents / documents with it)`` over the same of one document: 1 for a
   shingle that one document has, whatever the size of the table, and less the more documents have it.
   Frequencies are exact.  Shingles of more than a tenth of all documents (``HEAVY_SHARE``; at least
   ``HEAVY_LEAST``), which would crowd a group, are counted first and travel to the tasks: chunks of
   documents name their frequent shingles, the cluster drops those that cannot be heavy even if every
   other chunk has as many as it may without naming them, and a second pass counts the rest.  Those
   are at most ``1 / (HEAVY_SHARE - NAME_SHARE)`` documents' worth, however the input is cut.  All others
   cross one shuffle, packed by ranges of their hash, and the shared ones return to their documents.
3. A node of which less than ``SIMILARITY`` is shared with other documents has no link.  Consistent
   weighted sampling gives ``BANDS * ROWS`` samples per other node, equal for two nodes with probability
   their weighted Jaccard similarity.  A band's samples are a bucket key.  A node whose weights are not
   all 1 also gives samples and buckets with all weights 1, so that near copies meet however large
   their group is.  (Of two nodes of which one has no lighter shingle the weighted similarity is never
   below the plain one, so those need no second meeting.)
4. In each bucket every node is held against the smallest one; the pairs whose samples agree often
   enough are verified by their exact Jaccard similarity, the larger of the weighted and the plain
   one, and verified links give components.
5. Buckets that then still mix components are searched for all pairs of different components whose
   samples agree; the nodes of such pairs are held against each other, in blocks of about ``BLOCK``
   nodes a side, and the components are final.  Nothing is capped: large buckets only make more
   blocks.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import map_arrow, map_batches, materialise, ship_package, split_words, texts_of
from orderlake.llm.components import components

WIDTH = 5
BANDS, ROWS = 16, 4
SIMILARITY = 0.8
MIN_EQUAL = 37            # of 64 samples: 4.4 standard deviations below the 51 expected at 0.8
BLOCK = 1024              # nodes a side whose items are held against each other in one group
PRINT_BLOCK = 4096        # nodes a side whose samples are
BITMAP = 1 << 24          # bits of the filter of wanted nodes
HEAVY_SHARE = 0.1
HEAVY_LEAST = 1000
NAME_SHARE = 0.05         # of a chunk's documents: a shingle found in so many is named
CHUNK_DOCS = 2000         # a chunk ends at so many documents
CHUNK_BYTES = 32 << 20    # or so many bytes of their shingles, whichever comes first
LEAST_WEIGHT = 0.01
RANGE_SHINGLES = 1 << 20  # shingles whose documents are counted in one group, about
SENT_BYTES = 4 << 20      # of one batch that a group gives back, about
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, in place."""
    x ^= x >> _U(33)
    x *= _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(29)
    x *= _U(0xC4CEB9FE1A85EC53)
    x ^= x >> _U(32)
    return x


def node_of(words: list[bytes]) -> bytes:
    """128-bit hash of the words."""
    return xxhash.xxh3_128_digest(b" ".join(words))


def shingles_of(words: list[bytes]) -> np.ndarray:
    """Sorted 64-bit shingle ids, one per window of five words; a shorter text is one shingle, none if empty."""
    n = len(words)
    if not n:
        return np.empty(0, _U)
    codes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), _U, n)
    last = max(1, n - WIDTH + 1)
    value = np.full(last, min(n, WIDTH), _U)
    for k in range(min(n, WIDTH)):
        value *= _U(0x9E3779B97F4A7C15)
        value += codes[k:k + last]
    return np.sort(_mix(value))


def items_of(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(items, their shingles), sorted by item: the k-th occurrence of a shingle is its own item."""
    n = len(shingles)
    if n < 2 or not (shingles[1:] == shingles[:-1]).any():
        return shingles, shingles
    at = np.arange(n)
    first = np.concatenate(([True], shingles[1:] != shingles[:-1]))
    level = (at - np.maximum.accumulate(np.where(first, at, 0))).astype(_U)
    later = _mix(shingles + level * _U(0x9E3779B97F4A7C15))
    items = np.where(level == 0, shingles, later)
    items, where = np.unique(items, return_index=True)
    return items, shingles[where]


class Sampler:
    """Consistent weighted samples of item sets; ``heavy`` and ``weight`` are the shingles that weigh less than 1.

    The Gamma(2, 1) variates come from quantile tables made once on the driver, so that all workers
    agree on every bit.
    """

    def __init__(self, heavy: np.ndarray, weight: np.ndarray):
        self.heavy, self.weight = heavy, weight
        grid = np.concatenate((np.linspace(0, 1, 20001)[:-1], np.linspace(1, 40, 200001)))
        ranks = (np.arange(1 << 16) + 0.5) / (1 << 16)
        gamma = np.interp(ranks, 1 - np.exp(-grid) * (1 + grid), grid)
        self.gamma, self.log_gamma = gamma.astype(np.float32), np.log(gamma).astype(np.float32)
        self.seeds = _mix(np.arange(1, BANDS * ROWS + 1, dtype=_U) * _U(0x9E3779B97F4A7C15))

    def weights(self, shingles: np.ndarray) -> np.ndarray | None:
        """Weight of each shingle, None if all are 1."""
        if not len(self.heavy) or not len(shingles):
            return None
        at = np.minimum(np.searchsorted(self.heavy, shingles), len(self.heavy) - 1)
        hit = self.heavy[at] == shingles
        return np.where(hit, self.weight[at], np.float32(1)).astype(np.float32) if hit.any() else None

    def samples(self, items: np.ndarray, weights: np.ndarray | None) -> np.ndarray:
        """One 64-bit sample identity per seed."""
        size = len(self.seeds)
        best, chosen, steps = np.full(size, np.inf, np.float32), np.zeros(size, _U), np.zeros(size, np.float32)
        rows = np.arange(size)
        for at in range(0, len(items), 1024):
            part = items[at:at + 1024].astype(_U)
            # items are hashes already, so one multiplication by seed spreads them; its high half is folded down
            code = _mix(part * _U(0xD6E8FEB86659FD93))[None, :] ^ self.seeds[:, None]
            code *= _U(0xFF51AFD7ED558CCD)
            code ^= code >> _U(32)
            quarters = code.view("<u2").reshape(size, len(part), 4)
            r = np.take(self.gamma, quarters[:, :, 0])
            value = np.take(self.log_gamma, quarters[:, :, 1])
            beta = code.view("<u4").reshape(size, len(part), 2)[:, :, 1].astype(np.float32)
            beta *= np.float32(2.0 ** -32)
            if weights is None:
                beta -= np.float32(1)
                beta *= r
                value += beta
                where = value.argmin(1)
                step = np.zeros(size, np.float32)
            else:
                t = np.floor(np.log(weights[at:at + 1024])[None, :] / r + beta)
                value += r * (beta - t - np.float32(1))
                where = value.argmin(1)
                step = t[rows, where]
            got = value[rows, where]
            better = got < best
            best = np.where(better, got, best)
            chosen = np.where(better, part[where], chosen)
            steps = np.where(better, step, steps)
        return _mix(chosen + (steps.astype(np.int64).astype(_U) << _U(32)) + self.seeds)

    def bands(self, samples: np.ndarray, kind: int = 0) -> np.ndarray:
        """One 64-bit bucket key per band; the band's number and the kind of weights are part of it."""
        key = np.arange(BANDS * kind, BANDS * (kind + 1), dtype=_U)
        for column in samples.reshape(BANDS, ROWS).T:
            key = _mix(key * _U(0x9E3779B97F4A7C15) + column)
        return key.astype(np.int64)


def _nodes_and_candidates(docs: DataFrame) -> DataFrame:
    """One pass: (doc_id, node, size) rows of all documents, and (shingle, excess) rows of each chunk's frequent shingles.

    ``size`` is the number of the document's shingles, repeated ones included.
    ``excess`` is the number of the chunk's documents with the shingle beyond ``NAME_SHARE`` of them; a
    shingle that a chunk does not name has none.
    """
    names = ["doc_id", "node", "size", "shingle", "excess"]

    def run(batches):
        held: list[np.ndarray] = []

        def frequent_of_chunk():
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            spare = NAME_SHARE * len(held)
            found = counts > spare
            values, excess = values[found].view(np.int64), counts[found] - spare
            held.clear()
            return pa.RecordBatch.from_arrays([pa.nulls(len(values), id_type), pa.nulls(len(values), pa.binary()), pa.nulls(len(values), pa.int64()),
                                               pa.array(values), pa.array(excess, pa.float64())], names)
        id_type, size = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            id_type = batch.column("doc_id").type
            nodes, sizes = [], []
            for text in texts_of(batch):
                words = split_words(text.lower())
                nodes.append(node_of(words))
                own = shingles_of(words)
                sizes.append(len(own))
                held.append(np.unique(own))
                size += held[-1].nbytes
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(nodes, pa.binary()), pa.array(sizes, pa.int64()),
                                              pa.nulls(len(nodes), pa.int64()), pa.nulls(len(nodes), pa.float64())], names)
            if len(held) >= CHUNK_DOCS or size >= CHUNK_BYTES:
                yield frequent_of_chunk()
                size = 0
        if held:
            yield frequent_of_chunk()
    schema = docs.select("doc_id").schema.add("node", "binary").add("size", "long").add("shingle", "long").add("excess", "double")
    return materialise(map_arrow(docs.select("doc_id", "text"), run, schema), "dup-nodes")


def heavy_candidates(rows: DataFrame, n_docs: int) -> DataFrame:
    """(shingle): every shingle that may be heavy.

    All chunks together leave at most ``NAME_SHARE * n_docs`` of a shingle's documents out of its
    excess, so a shingle over the limit has an excess over the difference.
    """
    least = max(HEAVY_SHARE * n_docs, HEAVY_LEAST) - NAME_SHARE * n_docs
    named = rows.where("shingle IS NOT NULL").groupBy("shingle").agg(F.sum("excess").alias("excess"))
    return named.where(F.col("excess") > least - 1e-6 * n_docs).select("shingle")


def heavy_shingles(docs: DataFrame, candidates: DataFrame, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted heavy shingles and their weights; candidates (:func:`heavy_candidates`) are counted exactly over all documents.

    Weights are in units of a shingle at the limit; :func:`sampler_of` brings them to those of all others.
    """
    limit = max(HEAVY_SHARE * n_docs, HEAVY_LEAST)
    none = np.empty(0, _U), np.empty(0, np.float32)
    if n_docs <= limit:
        return none
    named = np.sort(np.array([r["shingle"] for r in candidates.distinct().collect()], np.int64).view(_U))
    if not len(named):
        return none

    def count(batches):
        total = np.zeros(len(named), np.int64)
        for batch in batches:
            for text in texts_of(batch):
                own = np.unique(shingles_of(split_words(text.lower())))
                at = np.minimum(np.searchsorted(named, own), len(named) - 1)
                total[at[named[at] == own]] += 1
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(named[hit].view(np.int64)), pa.array(total[hit])], ["shingle", "n"])
    counted = map_arrow(docs.select("text"), count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    rows = sorted((r["shingle"] % (1 << 64), r["n"]) for r in counted.where(F.col("n") > limit).collect())
    heavy = np.array([s for s, _ in rows], _U)
    weight = np.array([max(LEAST_WEIGHT, math.log(n_docs / n) / math.log(n_docs / limit)) for _, n in rows], np.float32)
    return heavy, weight


def inverse_frequency(n: np.ndarray, n_docs: int) -> np.ndarray:
    """Weight of shingles that ``n`` of the documents have: 1 for those of one document."""
    if n_docs < 2:
        return np.ones(len(n), np.float32)
    return np.maximum(LEAST_WEIGHT, np.log(n_docs / n) / math.log(n_docs)).astype(np.float32)


def sampler_of(heavy: np.ndarray, weight: np.ndarray, n_docs: int) -> Sampler:
    """The sampler of the heavy shingles, in the units of :func:`inverse_frequency`."""
    if len(heavy):
        limit = max(HEAVY_SHARE * n_docs, HEAVY_LEAST)
        weight = np.maximum(LEAST_WEIGHT, weight * (math.log(n_docs / limit) / math.log(n_docs))).astype(np.float32)
    return Sampler(heavy, weight)


def _joined(column: pa.ChunkedArray, kind) -> np.ndarray:
    """All values of a binary column without NULLs, one after another, as one array: read where they lie, copied once."""
    parts = [np.empty(0, np.uint8)]
    for chunk in column.chunks:
        if len(chunk):
            _, offsets, data = chunk.buffers()
            begin, end = np.frombuffer(offsets, np.int32)[[chunk.offset, chunk.offset + len(chunk)]]
            if end > begin:
                parts.append(np.frombuffer(data, np.uint8)[begin:end])
    return np.concatenate(parts).view(kind)


def _times(values: np.ndarray) -> np.ndarray:
    """How often each of the values is among them."""
    order = np.argsort(values)
    placed = values[order]
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(placed)), bool), placed[1:] != placed[:-1])))
    n = np.diff(np.append(first, len(placed))).astype(np.uint32)
    out = np.empty(len(values), np.uint32)
    out[order] = np.repeat(n, n)
    return out


def _in_small_batches(table: pa.Table) -> pa.Table:
    """The same rows, cut so that about ``SENT_BYTES`` at a time are handed to Spark, which keeps a batch beside its heap."""
    rows = max(1, table.num_rows * SENT_BYTES // max(1, table.nbytes))
    return pa.Table.from_batches(table.to_batches(max_chunksize=rows), table.schema)


def shared_shingles(docs: DataFrame, sampler: Sampler, n_shingles: int) -> DataFrame:
    """(node, shared, n): each document that may have a link, its shingles of two or more documents, and of how many.

    Shared shingles are sorted; heavy ones, which the sampler knows, are left out.  Left out are also documents
    of which less than ``SIMILARITY`` is shared.  A chunk of documents gives one row of packed shingles for
    each range of hash values; a range counts its shingles' documents and returns the shared ones to
    their chunk, which adds up what is shared of each document.  The number of ranges follows the shingles.
    """
    bits = max(0, math.ceil(math.log2(max(1, n_shingles) / RANGE_SHINGLES)))
    most_docs, most_bytes, heavy = min(CHUNK_DOCS, 1 << 16), CHUNK_BYTES, sampler.heavy
    names = ["range", "chunk", "at", "value", "n"]

    def packed(values: np.ndarray, edges: np.ndarray) -> list[bytes]:
        return [values[i:j].tobytes() for i, j in zip(edges[:-1], edges[1:])]

    def cut(batches):
        nodes: list[bytes] = []
        held: list[np.ndarray] = []
        chunk = TaskContext.get().partitionId() << 32

        def rows_of_chunk():
            sizes = np.array([len(x) for x in held], np.uint32)
            values, at = np.concatenate(held), np.repeat(np.arange(len(held), dtype=np.uint16), sizes)
            light = np.ones(len(values), bool)
            if len(heavy):
                where = np.minimum(np.searchsorted(heavy, values), len(heavy) - 1)
                light = heavy[where] != values
            crowd = sizes - np.bincount(at[light], minlength=len(held)).astype(np.uint32)     # heavy ones of each document
            values, at = values[light], at[light]
            own = (values >> _U(64 - bits)).astype(np.uint16 if bits <= 16 else np.int64) if bits else np.zeros(len(values), np.uint16)
            order = np.argsort(own, kind="stable")
            own, values, at = own[order], values[order], at[order]
            first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1]))) if len(own) else np.empty(0, np.int64)
            edges = np.append(first, len(own))
            # the chunk's nodes pass the count in a group of their own
            return pa.RecordBatch.from_arrays([
                pa.array([*own[first].tolist(), -1 - chunk], pa.int64()), pa.array([chunk] * (len(first) + 1), pa.int64()),
                pa.array([*packed(at, edges), None], pa.binary()), pa.array([*packed(values, edges), b"".join(nodes)], pa.binary()),
                pa.array([*[None] * len(first), np.stack((sizes, crowd)).tobytes()], pa.binary())], names)
        size = 0
        for batch in batches:
            for text in texts_of(batch):
                words = split_words(text.lower())
                if not words:
                    continue
                nodes.append(node_of(words))
                held.append(shingles_of(words))
                size += held[-1].nbytes
                if len(held) >= most_docs or size >= most_bytes:
                    yield rows_of_chunk()
                    nodes.clear()
                    held.clear()
                    chunk, size = chunk + 1, 0
        if held:
            yield rows_of_chunk()

    def count(group: pa.Table) -> pa.Table:
        if group.column("range")[0].as_py() < 0:
            return group.select(["chunk", "at", "value", "n"]).append_column("tf", pa.nulls(group.num_rows, pa.binary()))
        values, at = _joined(group.column("value"), _U), _joined(group.column("at"), np.uint16)
        ends = np.cumsum(pc.binary_length(group.column("value")).to_numpy()) // 8
        new = np.concatenate(([True], (values[1:] != values[:-1]) | (at[1:] != at[:-1])))      # a document's first of equal ones
        new[ends[:-1]] = True
        first = np.flatnonzero(new)
        n = _times(values[first])
        hit = n > 1
        n, times = n[hit], np.diff(np.append(first, len(values))).astype(np.uint32)[hit]
        first = first[hit]
        edges = np.concatenate(([0], np.searchsorted(first, ends)))
        out = [pa.array(packed(x, edges), pa.binary()) for x in (at[first], values[first], n, times)]
        got = pa.table([group.column("chunk"), *out], names=["chunk", "at", "value", "n", "tf"])
        return _in_small_batches(got)

    def gather(group: pa.Table) -> pa.Table:
        counts = group.filter(pc.is_valid(group.column("at")))
        (own,) = group.filter(pc.is_null(group.column("at"))).select(["value", "n"]).to_pylist()
        sizes, shared = np.frombuffer(own["n"], np.uint32).reshape(2, -1).astype(np.int64)
        at, values, n, times = (_joined(counts.column(c), t) for c, t in (("at", np.uint16), ("value", _U), ("n", np.uint32), ("tf", np.uint32)))
        shared = shared + np.bincount(at, times, len(sizes))
        wanted = np.flatnonzero(shared >= (SIMILARITY - 1e-6) * sizes)
        use = np.zeros(len(sizes), bool)
        use[wanted] = True
        use = use[at]                                          # only what leaves is sorted
        at, values, n = at[use], values[use], n[use]
        order = np.lexsort((values, at))
        at, values, n = at[order], values[order], n[order]
        spans = [(k, *np.searchsorted(at, [k, k + 1])) for k in wanted.tolist()]
        return pa.table([pa.array([own["value"][16 * k:16 * k + 16] for k, _, _ in spans], pa.binary()),
                         pa.array([values[i:j].tobytes() for _, i, j in spans], pa.binary()),
                         pa.array([n[i:j].tobytes() for _, i, j in spans], pa.binary())], names=["node", "shared", "n"])
    rows = map_arrow(docs.select("text"), cut, "range long, chunk long, at binary, value binary, n binary")
    counted = rows.groupBy("range").applyInArrow(count, "chunk long, at binary, value binary, n binary, tf binary")
    gathered = counted.where("length(value) > 0").groupBy("chunk").applyInArrow(gather, "node binary, shared binary, n binary")
    return materialise(gathered, "dup-shared")


def signatures(sets: DataFrame, sampler: Sampler) -> DataFrame:
    """(node, kind, print, keys) of every node of ``sets``; print holds a byte of each sample.

    Kind 0 is by the items' weights; nodes whose weights are not all 1 have a second row, kind 1, with all weights 1.
    """
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for node, items, weights in zip(*(batch.column(c).to_pylist() for c in ("node", "items", "weights"))):
            items, weights = np.frombuffer(items, _U), np.frombuffer(weights, np.float32)
            for kind, w in enumerate([weights, None] if len(weights) else [None]):
                got = sampler.samples(items, w)
                out.append((node, kind, (got & _U(0xFF)).astype(np.uint8).tobytes(), sampler.bands(got, kind).tolist()))
        nodes, kinds, prints, keys = zip(*out) if out else ((), (), (), ())
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(kinds, pa.int32()), pa.array(prints, pa.binary()),
                                           pa.array(keys, pa.list_(pa.int64()))], ["node", "kind", "print", "keys"])
    return materialise(map_batches(sets, run, "node binary, kind int, print binary, keys array<long>"), "dup-signatures")


def _equal(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many samples agree, for each row of left with each row of right."""
    out = np.zeros((len(left), len(right)), np.uint8)
    for k in range(left.shape[1]):
        out += left[:, k][:, None] == right[:, k][None, :]
    return out


def _prints(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, BANDS * ROWS)


def shared_buckets(signed: DataFrame) -> DataFrame:
    """(node, print, keys, band, key, n): the rows of buckets that hold more than one node, n their number.

    Buckets are counted on (node, kind, key) rows alone; samples join only the few rows that remain.
    A bucket holds samples of one kind.
    """
    rows = signed.select("node", "kind", F.posexplode("keys").alias("band", "key"))
    full = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").withColumnRenamed("key", "key_")
    multi = materialise(rows.join(full, F.col("key") == F.col("key_")).drop("key_"), "dup-buckets")
    prints = signed.select(F.col("node").alias("node_"), F.col("kind").alias("kind_"), "print", "keys")
    same = (F.col("node") == F.col("node_")) & (F.col("kind") == F.col("kind_"))
    return materialise(multi.join(prints, same).drop("node_", "kind", "kind_"), "dup-buckets")


def star_pairs(buckets: DataFrame) -> DataFrame:
    """(block, side, node): each node against the smallest node of its buckets, if their samples agree enough."""
    least = (buckets.groupBy("key").agg(F.min(F.struct("node", "print")).alias("least"))
             .select(F.col("key").alias("key_"), "least"))
    pairs = (buckets.join(least, F.col("key") == F.col("key_"))
             .where(F.col("node") != F.col("least.node"))
             .select(F.col("least.node").alias("block"), "node", F.col("least.print").alias("left"), F.col("print").alias("right")))

    def agree(batch: pa.RecordBatch) -> pa.RecordBatch:
        same = (_prints(batch.column("left")) == _prints(batch.column("right"))).sum(1)
        return batch.select(["block", "node"]).filter(pa.array(same >= MIN_EQUAL))
    pairs = map_batches(pairs, agree, "block binary, node binary").distinct()
    centres = pairs.select("block").distinct()
    return (pairs.select("block", F.lit(1).alias("side"), "node")
            .union(centres.select("block", F.lit(0).alias("side"), F.col("block").alias("node"))))


def mixed_nodes(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """(block, node, label): nodes of a bucket that have a near node of another component in it.

    A pair counts in the first band in which it shares a bucket, so a group whose nodes meet in many
    bands is not searched once for each.  Rows stay in proportion to the nodes: pairs are looked at
    inside the tasks, in parts of ``PRINT_BLOCK`` nodes, and only the nodes leave.
    """
    ship_package(buckets.sparkSession)
    owned = labels.select(F.col("node").alias("node_"), "label")
    placed = (buckets.join(owned, F.col("node") == F.col("node_"), "left")
              .select("node", "print", "keys", "band", "key", F.coalesce("label", "node").alias("label")))
    mixed = (placed.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("n"))
             .where("lo <> hi").select(F.col("key").alias("key_"), F.ceil(F.col("n") / PRINT_BLOCK).alias("parts")))
    members = placed.join(mixed, F.col("key") == F.col("key_")).withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")))
    spread = members.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    spread = spread.select("band", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own",
                           "node", "print", "keys", "label")

    def cross(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        nodes, labels_ = (group.column(c).to_pylist() for c in ("node", "label"))
        prints, own = _prints(group.column("print")), group.column("own").to_numpy()
        keys = group.column("keys").combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
        band, i, j = (group.column(c)[0].as_py() for c in ("band", "i", "j"))
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        number = {label: k for k, label in enumerate(dict.fromkeys(labels_))}
        codes = np.array([number[x] for x in labels_])
        active = np.zeros(len(nodes), bool)
        for at in range(0, len(left), 128):
            rows = left[at:at + 128]
            near = (_equal(prints[rows], prints[right]) >= MIN_EQUAL) & (codes[rows][:, None] != codes[right][None, :])
            for t in range(band):
                near &= keys[rows, t][:, None] != keys[right, t][None, :]
            active[rows[near.any(1)]] = True
            active[right[near.any(0)]] = True
        found = np.flatnonzero(active)
        return pa.table({"block": pa.array([group.column("key")[0].as_py()] * len(found), pa.int64()),
                         "node": pa.array([nodes[k] for k in found], pa.binary()),
                         "label": pa.array([labels_[k] for k in found], pa.binary())})
    return spread.groupBy("band", "key", "i", "j").applyInArrow(cross, "block long, node binary, label binary").distinct()


def bitmap_of(nodes: DataFrame) -> np.ndarray:
    """A bitmap with the bit of the first three bytes set for each node; 2 MB, whatever their number.

    Bits are put together by the cluster; the driver receives at most ``BITMAP / 64`` words.
    """
    at = F.conv(F.hex(F.substring("node", 1, 3)), 16, 10).cast("int")
    words = nodes.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(at & 63 AS INT))")).alias("bits"))
    out = np.zeros(BITMAP // 64, np.int64)
    for r in words.collect():
        out[r["word"]] = r["bits"]
    return out


def item_sets(docs: DataFrame, shared: DataFrame, reps: DataFrame, sampler: Sampler, n_docs: int) -> DataFrame:
    """(node, items, weights) of the nodes of ``shared`` that may have a link; empty weights mean all 1.

    Texts are read in place: a bitmap of the wanted nodes lets nearly only their texts give a row, and
    the join by node drops the rest.  A node's own copies share its shingles, too: what no other text
    has is not shared, and a node of which less than ``SIMILARITY`` is left has no row.
    """
    bits = docs.sparkSession.sparkContext.broadcast(bitmap_of(shared))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        bitmap, seen = bits.value, set()
        nodes, shingles = [], []
        for text in texts_of(batch):
            words = split_words(text.lower())
            node = node_of(words)
            at = int.from_bytes(node[:3], "big")
            if int(bitmap[at >> 6]) >> (at & 63) & 1 and node not in seen:
                seen.add(node)
                nodes.append(node)
                shingles.append(shingles_of(words).tobytes())
        return pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in (nodes, shingles)], ["node", "shingles"])

    def weigh(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for node, shingles, common, n, copies in zip(*(batch.column(c).to_pylist() for c in ("node", "shingles", "shared", "n", "copies"))):
            items, own = items_of(np.frombuffer(shingles, _U))
            common, n = np.frombuffer(common, _U), np.frombuffer(n, np.uint32)
            docs_with, heavy = np.ones(len(own), np.int64), sampler.weights(own)
            if len(common):
                at = np.minimum(np.searchsorted(common, own), len(common) - 1)
                docs_with = np.where(common[at] == own, n[at], docs_with)
            weights = inverse_frequency(docs_with, n_docs)
            met = docs_with > copies
            if heavy is not None:
                light = heavy == 1
                weights, met = np.where(light, weights, heavy), met | ~light
            if met.sum() >= (SIMILARITY - 1e-6) * len(own):
                out.append((node, items.tobytes(), weights.astype(np.float32).tobytes() if (weights != 1).any() else b""))
        return pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in (zip(*out) if out else ((), (), ()))], ["node", "items", "weights"])
    found = map_batches(docs.select("text"), run, "node binary, shingles binary").dropDuplicates(["node"])
    known = (shared.dropDuplicates(["node"]).join(reps.select(F.col("node").alias("node_"), F.col("n").alias("copies")), F.col("node") == F.col("node_"))
             .select("node_", "shared", "n", "copies"))
    joined = found.join(known, F.col("node") == F.col("node_")).drop("node_")      # each side crosses one shuffle, by node
    return materialise(map_batches(joined, weigh, "node binary, items binary, weights binary"), "dup-items")


def sets_of(sets: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of ``sets`` whose nodes are in ``wanted``, and a few others: those that its bitmap lets through."""
    bits = sets.sparkSession.sparkContext.broadcast(bitmap_of(wanted.select("node").distinct()))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = np.array([int.from_bytes(x[:3], "big") for x in batch.column("node").to_pylist()], np.int64)
        return batch.filter(pa.array(bits.value[at >> 6] >> (at & 63) & 1 == 1))
    return map_batches(sets, run, sets.schema)


def similarities(left: list[tuple], right: list[tuple]) -> np.ndarray:
    """Weighted Jaccard similarity of each left (items, weights) with each right one.

    Shared weights are a product of two 0/1 matrices over the items both sides have (scaled by the
    root of the weight), made in stretches of columns.
    """
    def stacked(side):
        rows = np.repeat(np.arange(len(side)), [len(i) for i, _ in side])
        items = np.concatenate([i for i, _ in side])
        weights = np.concatenate([np.ones(len(i), np.float32) if w is None else w for i, w in side])
        return rows, items, weights, np.bincount(rows, weights, len(side))
    (r0, i0, w0, t0), (r1, i1, w1, t1) = stacked(left), stacked(right)
    shared = np.intersect1d(i0, i1)
    inter = np.zeros((len(left), len(right)))
    c0, c1 = np.searchsorted(shared, i0), np.searchsorted(shared, i1)
    for r, c, i in ((r0, c0, i0), (r1, c1, i1)):
        c[(c == len(shared)) | (shared[np.minimum(c, max(len(shared) - 1, 0))] != i) if len(shared) else slice(None)] = -1
    for at in range(0, len(shared), 2048):
        m0, m1 = np.zeros((len(left), 2048), np.float32), np.zeros((len(right), 2048), np.float32)
        for m, r, c, w in ((m0, r0, c0, w0), (m1, r1, c1, w1)):
            here = (c >= at) & (c < at + 2048)
            m[r[here], c[here] - at] = np.sqrt(w[here])
        inter += m0 @ m1.T
    return inter / np.maximum(t0[:, None] + t1[None, :] - inter, 1e-9)


def nearness(left: list[tuple], right: list[tuple]) -> np.ndarray:
    """The larger of the weighted and the plain Jaccard similarity, so that no link depends on a group's size."""
    got = similarities(left, right)
    heavy = [np.flatnonzero([w is not None for _, w in side]) for side in (left, right)]
    if len(heavy[0]) and len(heavy[1]):          # elsewhere the weighted one is never below the plain one
        plain = similarities(*[[(side[k][0], None) for k in own] for side, own in zip((left, right), heavy)])
        at = np.ix_(*heavy)
        got[at] = np.maximum(got[at], plain)
    return got


def _sets(group: pa.Table) -> list[tuple]:
    return [(np.frombuffer(i, _U), np.frombuffer(w, np.float32) if w else None)
            for i, w in zip(group.column("items").to_pylist(), group.column("weights").to_pylist())]


def star_links(star: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): nodes of nearness ``SIMILARITY`` or more to the centre of their block.

    A block's nodes are cut into parts of about ``BLOCK`` by hash; each part gets the centre's items.
    """
    ship_package(star.sparkSession)
    counts = star.where("side = 1").groupBy("block").agg(F.count(F.lit(1)).alias("n"))
    parts = counts.select(F.col("block").alias("block_"), F.ceil(F.col("n") / BLOCK).alias("parts"))
    rows = star.join(parts, F.col("block") == F.col("block_"))
    centres = rows.where("side = 0").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    others = rows.where("side = 1").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")))
    spread = centres.unionByName(others).select("block", "part", "side", F.col("node").alias("node_"))
    loaded = spread.join(sets, F.col("node_") == F.col("node")).select("block", "part", "side", "node", "items", "weights")

    def check(group: pa.Table) -> pa.Table:
        side, nodes, found = np.array(group.column("side").to_pylist()), group.column("node").to_pylist(), _sets(group)
        centre, others = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        near = []
        if len(centre) and len(others):
            got = nearness([found[centre[0]]], [found[k] for k in others])[0]
            near = [nodes[k] for k in others[got >= SIMILARITY - 1e-6]]
        return pa.table({"a": pa.array([nodes[centre[0]]] * len(near) if near else [], pa.binary()), "b": pa.array(near, pa.binary())})
    return loaded.groupBy("block", "part").applyInArrow(check, "a binary, b binary")


def block_links(active: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): one link per pair of components that a block's nodes connect, by all pairs of the block.

    Nodes are cut into parts of about ``BLOCK`` by hash, and each pair of parts is one group.
    """
    ship_package(active.sparkSession)
    counts = active.groupBy("block").agg(F.count(F.lit(1)).alias("n"))
    parts = counts.select(F.col("block").alias("block_"), F.ceil(F.col("n") / BLOCK).alias("parts"))
    rows = active.join(parts, F.col("block") == F.col("block_")).withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")))
    spread = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    spread = spread.select("block", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own",
                           F.col("node").alias("node_"), "label")
    loaded = (spread.join(sets, F.col("node_") == F.col("node"))
              .select("block", "i", "j", "own", "label", "node", "items", "weights"))

    def check(group: pa.Table) -> pa.Table:
        nodes, labels_, found = group.column("node").to_pylist(), group.column("label").to_pylist(), _sets(group)
        own = np.array(group.column("own").to_pylist())
        i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        number = {label: k for k, label in enumerate(dict.fromkeys(labels_))}
        codes = np.array([number[x] for x in labels_])
        a, b = [], []
        if len(left) and len(right):
            got = nearness([found[k] for k in left], [found[k] for k in right])
            x, y = np.nonzero((got >= SIMILARITY - 1e-6) & (codes[left][:, None] != codes[right][None, :]))
            x, y = left[x], right[y]
            low, high = np.minimum(codes[x], codes[y]), np.maximum(codes[x], codes[y])
            _, first = np.unique(low.astype(np.int64) * len(number) + high, return_index=True)
            a, b = [nodes[k] for k in x[first]], [nodes[k] for k in y[first]]
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})
    return loaded.groupBy("block", "i", "j").applyInArrow(check, "a binary, b binary")


def near_duplicates(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members, classes): (doc_id, node) of every row, and (node, label, class_id) of every node.

    ``class_id`` is the smallest doc_id of the class (NULL if all its ids are).  NULL and empty texts
    have no words, are equal to each other and near nothing else; texts of one to four words have one
    shingle; repeated rows are members of the same node.
    """
    docs = docs.select("doc_id", "text")
    rows = _nodes_and_candidates(docs)
    members = rows.where("node IS NOT NULL").select("doc_id", "node")
    reps = rows.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("rep_id"), F.count(F.lit(1)).alias("n"),
                                                              F.sum("size").alias("size"))
    reps = materialise(reps, "dup-reps")
    n_docs, n_shingles = (x or 0 for x in reps.agg(F.sum("n"), F.sum("size")).first())
    sampler = sampler_of(*heavy_shingles(docs, heavy_candidates(rows, n_docs), n_docs), n_docs)
    sets = item_sets(docs, shared_shingles(docs, sampler, n_shingles), reps, sampler, n_docs)
    buckets = shared_buckets(signatures(sets, sampler))
    star = materialise(star_pairs(buckets), "dup-star")
    links = materialise(star_links(star, sets_of(sets, star)), "dup-links")
    mixed = materialise(mixed_nodes(buckets, components(links)), "dup-mixed")
    more = materialise(block_links(mixed, sets_of(sets, mixed)), "dup-links")
    labels = materialise(components(links.union(more)), "dup-labels").withColumnRenamed("node", "node_")
    owned = reps.join(labels, F.col("node") == F.col("node_"), "left").select("node", "rep_id", F.coalesce("label", "node").alias("label"))
    owned = materialise(owned, "dup-owned")
    ids = owned.groupBy("label").agg(F.min("rep_id").alias("class_id")).withColumnRenamed("label", "label_")
    classes = owned.join(ids, F.col("label") == F.col("label_")).select("node", "label", "rep_id", "class_id")
    return members, materialise(classes, "dup-classes")


def classify(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id) of every row."""
    members, classes = near_duplicates(docs)
    return members.join(classes.select(F.col("node").alias("node_"), "class_id"), F.col("node") == F.col("node_")).select("doc_id", "class_id")


def deduplicate(docs: DataFrame) -> DataFrame:
    """One row of each class, all columns kept: a row of the smallest doc_id (of equal ones the smallest node)."""
    _, classes = near_duplicates(docs)
    first = F.min(F.struct(F.col("rep_id").isNull().alias("no_id"), F.col("rep_id").alias("id"), F.col("node").alias("node")))
    kept = classes.groupBy("label").agg(first.alias("first")).select(F.col("first.id").alias("kept_id_"), F.col("first.node").alias("kept_node_"))
    wanted = docs.columns
    clear = docs.toDF(*[f"c{i}" for i in range(len(wanted))])
    key, text = f"c{wanted.index('doc_id')}", f"c{wanted.index('text')}"

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        nodes = [node_of(split_words(t.lower())) for t in texts_of(batch, text)]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(nodes, pa.binary())], [*batch.schema.names, "node_"])
    named = map_batches(clear, run, clear.select("*").schema.add("node_", "binary"))
    # by node alone, so that texts cross one shuffle for the join and the choice among repeated rows
    same_id = F.when(F.col("kept_id_").isNull(), F.col(key).isNull()).otherwise(F.col(key) == F.col("kept_id_"))
    hit = named.join(kept, (F.col("node_") == F.col("kept_node_")) & same_id, "left_semi")
    return hit.dropDuplicates(["node_"]).select(*clear.columns).toDF(*wanted)


#: The classes in DuckDB, by all pairs of texts that share a shingle.
CLASSES_SQL = rf"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
members AS (SELECT doc_id, md5(array_to_string(w, ' ')) AS node, w FROM texts),
nodes AS (SELECT node, min(doc_id) AS rep, count(*) AS n, any_value(w) AS w FROM members GROUP BY node),
shingles AS (
  SELECT node, n, s, count(*) AS tf FROM (
    SELECT node, n, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {WIDTH} THEN [array_to_string(w, ' ')]
                           ELSE list_transform(range(1, len(w) - {WIDTH - 2}), lambda i: array_to_string(w[i:i + {WIDTH - 1}], ' ')) END) AS s
    FROM nodes) GROUP BY ALL),
stats AS (SELECT count(*) AS n_docs, greatest({HEAVY_SHARE} * count(*), {HEAVY_LEAST}) AS most FROM members),
weights AS (
  SELECT s, CASE WHEN sum(n) <= any_value(most) THEN 1.0
                 ELSE greatest({LEAST_WEIGHT}, ln(any_value(n_docs) / sum(n)) / ln(any_value(n_docs) / any_value(most))) END AS weight
  FROM shingles, stats GROUP BY s),
sizes AS (SELECT node, sum(tf * weight) AS size FROM shingles JOIN weights USING (s) GROUP BY node),
shared AS (
  SELECT a.node AS a, b.node AS b, sum(least(a.tf, b.tf) * weight) AS common
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.node < b.node JOIN weights w ON w.s = a.s GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.node = a JOIN sizes y ON y.node = b WHERE common / (x.size + y.size - common) >= {SIMILARITY} - 1e-6),
sides AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(node, other) AS (
  SELECT node, node FROM nodes UNION SELECT r.node, l.b FROM reach r JOIN sides l ON r.other = l.a),
classes AS (SELECT r.node, min(o.rep) AS class_id FROM reach r JOIN nodes o ON o.node = r.other GROUP BY r.node)
SELECT doc_id, class_id FROM members JOIN classes USING (node)
"""
