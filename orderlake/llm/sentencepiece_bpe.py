"""SentencePiece encoding and decoding for merge-type (BPE) models with byte fallback.

The encoder is exact and linear in practice: at each position the longest piece found by an
Aho-Corasick automaton is tried; two neighbours are compatible when undoing the merges that built
them never meets a pair that would have merged earlier; a position that turned out to be a dead end
is cleared in a bitfield, the last piece is taken back and a shorter one tried.

Text is cut before each run of the space mark and at newlines that no piece holds.  No piece holds the mark after another character
(checked on loading), so no merge crosses such a cut and each part is encoded on its own; parts
repeat, so a bounded cache keeps their ids; one met for the first time is cut again between
neighbouring characters that no piece holds.  Only the vocabulary is read from the model file;
encoding and decoding are done here.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from orderlake.llm.common import map_arrow, map_batches, texts_of

MARK = "▁"
CACHE_PARTS = 150_000     # parts per generation of the cache; two generations are kept
CACHE_CHARS = 64
CACHE_PAIRS = 400_000


def _proto_fields(data: bytes):
    """(field number, value) pairs of one protocol-buffer message; values are ints or bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value
    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            value = varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            value = data[at:at + size]
            at += size
        yield key >> 3, value


class MergeModel:
    """Vocabulary, merge order and byte pieces of a model file.

    ``split[t]`` is the pair whose merge made piece ``t`` ((t, t) for a character), ``rank[t]`` its
    place in the merge order, ``pair[(a, b)]`` the piece that a and b merge into, ``shorter[t]`` the
    longest proper prefix of t that is a piece.
    """

    def __init__(self, path: str):
        import struct
        pieces, self.byte_id, self.unk = [], {}, 0
        with open(path, "rb") as f:
            for field, value in _proto_fields(f.read()):
                if field == 1:
                    got = dict(_proto_fields(value))
                    pieces.append((got[1].decode(), struct.unpack("<f", got[2])[0] if 2 in got else 0.0, got.get(3, 1)))
                elif field == 2:
                    got = dict(_proto_fields(value))
                    if got.get(3, 1) != 2 or not got.get(35):
                        raise ValueError("only merge-type models with byte fallback are supported")
                elif field == 3:
                    got = dict(_proto_fields(value))
                    if got.get(2) or not got.get(3, 1) or got.get(4, 1) or not got.get(5, 1):
                        raise ValueError("only identity normalisation with a leading space mark is supported")
        self.text = [p for p, _, _ in pieces]
        normal = {}
        for i, (p, _, kind) in enumerate(pieces):
            if kind == 6:
                self.byte_id[int(p[1:-1], 16)] = i
            elif kind == 2:
                self.unk = i
            elif kind == 1:
                normal[p] = i
            elif kind != 3:
                raise ValueError(f"piece {p!r}: user-defined and unused pieces are not supported")
        self.control = {i for i, (_, _, kind) in enumerate(pieces) if kind == 3}
        if any(MARK in p.lstrip(MARK) for p in normal):
            raise ValueError("a piece holds the space mark after another character")
        self.byte_of = {i: b for b, i in self.byte_id.items()}
        # Runs of space marks may share one score; they are merged apart (see _spaces), after all else.
        self.runs = {len(p): i for p, i in normal.items() if len(p) > 1 and not p.strip(MARK)}
        self.run_score = {n: pieces[i][1] for n, i in self.runs.items()}
        merged = sorted((p for p in normal if len(p) > 1 and p.strip(MARK)), key=lambda p: -pieces[normal[p]][1])
        scores = [pieces[normal[p]][1] for p in merged]
        if any(p.startswith(MARK * 2) for p in merged) or (scores and self.runs and max(self.run_score.values()) >= scores[-1]):
            raise ValueError("space runs must merge last")
        if len(set(scores)) != len(scores):
            raise ValueError("two pieces share a score")
        self.id = {p: i for p, i in normal.items() if len(p) == 1}
        self.rank = {i: -1 for i in self.id.values()}
        self.split = {i: (i, i) for i in self.id.values()}
        self.pair: dict[tuple[int, int], int] = {}
        self.order: list[int] = list(self.id.values())
        known = dict(self.id)
        for rank, p in enumerate(merged):
            parts = self._merge(p, known, normal)
            if len(parts) == 2:                       # else merges before its own never leave such a pair
                i = known[p] = normal[p]
                self.rank[i], self.split[i] = rank, (parts[0], parts[1])
        self.id = known
        self.chars = frozenset(p for p in known if len(p) == 1)
        for p, i in known.items():                    # any cut of a piece into two pieces is a possible merge
            for k in range(1, len(p)):
                a, b = known.get(p[:k]), known.get(p[k:])
                if a is not None and b is not None:
                    self.pair[(a, b)] = i
        self.length: list[int] = [0] * len(pieces)
        self.shorter: list[int | None] = [None] * len(pieces)
        for p, i in known.items():
            self.length[i] = len(p)
            self.shorter[i] = next((known[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in known), None)
        self._fits: dict[tuple[int, int], bool] = {}
        #: Neighbouring characters that some piece holds: no merge ever crosses any other pair.
        self.inside = {p[k:k + 2] for p in known for k in range(len(p) - 1)} | {MARK * 2}
        self.decimal = [str(i) for i in range(len(pieces))]
        self.raw = [b"" if i in self.control else bytes([self.byte_of[i]]) if i in self.byte_of else p.replace(MARK, " ").encode()
                    for i, p in enumerate(self.text)]
        # A character that no piece holds takes part in no merge, so text may be cut at newlines as well.
        self.part = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+" if "\n" in known else f"\n|{MARK}*[^{MARK}\n]+|{MARK}+")
        self.automaton = ahocorasick.Automaton()
        for p, i in known.items():
            self.automaton.add_word(p, (len(p), i))
        self.automaton.make_automaton()

    def _merge(self, text: str, known: dict[str, int], normal: dict[str, int]) -> list[int]:
        """Plain best-pair merging with the pieces known so far (only used on pieces, while loading)."""
        parts = [c for c in text]
        while True:
            best = None
            for k in range(len(parts) - 1):
                i = known.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or self.rank[i] < best[0]):
                    best = (self.rank[i], k)
            if best is None:
                return [known.get(p, -1) for p in parts]
            k = best[1]
            parts[k:k + 2] = [parts[k] + parts[k + 1]]

    def fits(self, a: int, b: int) -> bool:
        """Whether a followed by b stays so (remembered for pairs met before)."""
        known = self._fits.get((a, b))
        if known is None:
            if len(self._fits) >= CACHE_PAIRS:
                self._fits.clear()
            known = self._fits[a, b] = self._fits_by_undoing(a, b)
        return known

    def _fits_by_undoing(self, a: int, b: int) -> bool:
        """Undo merges on both sides of the border, the later one first, and look for an earlier merge across it."""
        limit = len(self.rank) + 1
        rank, split, pair = self.rank, self.split, self.pair
        while True:
            joined = pair.get((a, b))
            if joined is not None and rank[joined] < limit:
                return False
            if rank[a] > rank[b]:
                # the merge that made a came after all of b's: only merges before it are still free
                limit = rank[a]
                a = split[a][1]
            elif rank[b] >= 0:
                # equal ranks mean equal pieces; merging runs from the left, so b is undone first
                limit = rank[b] + 1
                b = split[b][0]
            else:
                return True

    def _known_chars(self, text: str) -> list[int]:
        """Ids of a stretch of known characters, by backtracking."""
        size = len(text)
        longest: list[int] = [0] * size
        for end, (length, i) in self.automaton.iter(text):
            longest[end - length + 1] = i             # ends grow, so the last one kept is the longest
        alive = bytearray(b"\1") * (size + 1)         # the bitfield of positions not yet failed
        out: list[int] = []
        length, shorter, fits = self.length, self.shorter, self._fits
        at, token, last = 0, longest[0], None
        while True:
            while token is not None:
                end = at + length[token]
                if alive[end]:
                    if last is None:
                        break
                    fit = fits.get((last, token))
                    if fit or fit is None and self.fits(last, token):
                        break
                token = shorter[token]
            if token is None:                         # nothing fits here: clear the position, step back
                alive[at] = 0
                token = out.pop()
                at -= length[token]
                last = out[-1] if out else None
                continue
            out.append(token)
            if end == size:
                return out
            at, last, token = end, token, longest[end]

    def _spaces(self, count: int) -> list[int]:
        """Merges of ``count`` single space marks: highest score first, ties from the left."""
        sizes, nxt, prev = [1] * count, list(range(1, count + 1)), list(range(-1, count - 1))
        heap: list[tuple[float, int, int, int]] = []

        def offer(left: int) -> None:
            if left >= 0 and nxt[left] < count:
                score = self.run_score.get(sizes[left] + sizes[nxt[left]])
                if score is not None:
                    heapq.heappush(heap, (-score, left, sizes[left], sizes[nxt[left]]))
        for k in range(count - 1):
            offer(k)
        while heap:
            _, left, a, b = heapq.heappop(heap)
            if sizes[left] != a or nxt[left] >= count or sizes[nxt[left]] != b:
                continue
            gone = nxt[left]
            sizes[left], sizes[gone], nxt[left] = a + b, 0, nxt[gone]
            if nxt[left] < count:
                prev[nxt[left]] = left
            offer(prev[left])
            offer(left)
        return [self.id[MARK] if n == 1 else self.runs[n] for n in sizes if n]

    def encode_part(self, part: str) -> list[int]:
        """Ids of one part (space marks, then other characters)."""
        if self.chars.issuperset(part):
            out = self._known_chars(part)
        else:
            out, start = [], 0
            for k in range(len(part) + 1):
                if k == len(part) or part[k] not in self.chars:
                    if k > start:
                        out += self._known_chars(part[start:k])
                    if k < len(part):
                        out += [self.byte_id[b] for b in part[k].encode("utf-8", "replace")]
                    start = k + 1
        mark = self.id.get(MARK)
        head = 0
        while head < len(out) and out[head] == mark:
            head += 1
        return self._spaces(head) + out[head:] if head > 1 else out

    def stretches(self, part: str) -> list[str]:
        """``part`` cut between neighbours that no piece holds; each stretch is encoded on its own."""
        inside, out, start = self.inside, [], 0
        for k in range(1, len(part)):
            if part[k - 1:k + 1] not in inside:
                out.append(part[start:k])
                start = k
        out.append(part[start:])
        return out

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text, without begin or end ids; empty for the empty text."""
        if not text:
            return []
        marked = MARK + text.replace(" ", MARK)
        return [i for part in self.part.findall(marked) for i in self.encode_part(part)]

    def piece_bytes(self, ids: list[int]) -> bytes:
        """UTF-8 of the pieces, space marks as spaces."""
        return b"".join([self.raw[i] for i in ids])

    def decode(self, ids: list[int]) -> str:
        """Text of the ids: joins pieces, drops the leading mark; bytes that are no UTF-8 become U+FFFD."""
        raw = self.piece_bytes(ids)
        return (raw[1:] if raw.startswith(b" ") else raw).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def load_model(path: str) -> MergeModel:
    """The model of a file, kept by each Python worker."""
    return MergeModel(path)


class _PartCache(dict):
    """Part -> (number of ids, ids as decimals joined by commas, decoded UTF-8).

    Bounded: a full generation becomes the old one, from which parts met again are taken over.
    """

    def __init__(self, model: MergeModel):
        super().__init__()
        self.model, self.old = model, {}

    def __missing__(self, part: str) -> tuple[int, str, bytes]:
        value = self.old.get(part)
        if value is None:
            model = self.model
            stretches = model.stretches(part)
            if len(stretches) > 1:                    # a word and its punctuation, mostly: the word may be known
                found = [self[s] for s in stretches]
                value = (sum([n for n, _, _ in found]), ",".join([s for _, s, _ in found]), b"".join([d for _, _, d in found]))
            else:
                ids = model.encode_part(part)
                decimal = model.decimal
                value = (len(ids), ",".join([decimal[i] for i in ids]), model.piece_bytes(ids))
        if len(part) <= CACHE_CHARS:
            if len(self) >= CACHE_PARTS:
                self.old = dict(self)
                self.clear()
            self[part] = value
        return value


def encode_decode(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, ids, decoded) for every row: the whole text's ids (array) and their decoded text."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = load_model(model_path)
        ids = [model.encode(t.decode("utf-8", "replace")) for t in texts_of(batch)]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32())), pa.array([model.decode(i) for i in ids])],
            ["doc_id", "ids", "decoded"])
    return map_batches(docs.select("doc_id", "text"), run,
                       docs.select("doc_id").schema.add("ids", T.ArrayType(T.IntegerType())).add("decoded", "string"))


def digests(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) for every row; NULL and empty texts have no ids.

    The same encoder and decoder as :func:`encode_decode`, part by part through the cache.  Decoding
    part by part is the same as decoding the whole: bytes of one character never leave their part.
    """
    def run(batches):
        model = load_model(model_path)
        cache = _PartCache(model)
        for batch in batches:
            if not batch.num_rows:
                continue
            counts, sums, texts = [], [], []
            for raw in texts_of(batch):
                text = raw.decode("utf-8", "replace")
                parts = [cache[p] for p in model.part.findall(MARK + text.replace(" ", MARK))] if text else []
                sizes, ids, pieces = zip(*parts) if parts else ((), (), ())
                counts.append(sum(sizes))
                sums.append(hashlib.sha256(",".join(ids).encode()).hexdigest())
                back = b"".join(pieces)
                texts.append(hashlib.sha256(back[1:] if back.startswith(b" ") else back).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(sums), pa.array(texts)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    schema = docs.select("doc_id").schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    return map_arrow(docs.select("doc_id", "text"), run, schema)
