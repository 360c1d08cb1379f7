"""Token-ID output: length-delimited binary records with a separate offset index.

File format (all numbers little-endian).  ``part-NNNNNN.rec`` holds one frame per document:

    uint64  length of the payload in bytes
    uint32  masked checksum of those 8 bytes
    payload one byte: bytes per id (2 if the vocabulary has at most 65,536 entries, else 4); the ids
    uint32  masked checksum of the payload

``part-NNNNNN.idx`` holds one 24-byte entry per frame, in file order: uint64 byte offset of the
frame, uint64 number of ids, int64 doc_id (the smallest int64 stands for NULL).  The index alone
serves shuffled reads: :func:`read_record` fetches any frame with one seek.  A checksum is zlib's
CRC-32, masked by rotating right 15 bits and adding 0xa282ead8, so that a checksum of bytes that
contain checksums stays sound.

Parts are ranges of doc_id in ascending order (NULL first; equal ids by a hash of their text), so
reading the parts in order gives the documents in order.  A task streams its sorted rows to a file
named after its attempt and renames it when complete: a lost executor leaves no half-written part,
and a second attempt replaces the file with the same bytes.
"""

from __future__ import annotations

import json
import os
import re
import struct
import sys
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlake.llm.common import map_arrow, materialise, split_words, texts_of
from orderlake.session import scratch_dir

#: Fixed values of the mask.
MASK_DELTA = 0xA282EAD8
HEAD, CHECK, INDEX = "<QI", "<I", "<QQq"
NULL_ID = -(1 << 63)
CACHE_WORDS = 300_000
CACHE_BYTES = 64
READ_BATCH = 2_000


def masked_crc(data: bytes) -> int:
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return size + struct.pack(CHECK, masked_crc(size)) + payload + struct.pack(CHECK, masked_crc(payload))


def read_frame(stream) -> bytes | None:
    """Payload of the next frame, None at the end; a damaged or cut frame raises ValueError."""
    head = stream.read(struct.calcsize(HEAD))
    if not head:
        return None
    if len(head) < struct.calcsize(HEAD):
        raise ValueError("cut frame head")
    size, check = struct.unpack(HEAD, head)
    if masked_crc(head[:8]) != check:
        raise ValueError("damaged frame length")
    payload, tail = stream.read(size), stream.read(struct.calcsize(CHECK))
    if len(payload) < size or len(tail) < struct.calcsize(CHECK) or masked_crc(payload) != struct.unpack(CHECK, tail)[0]:
        raise ValueError("damaged frame")
    return payload


def _fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder URI (a plain path is the mounted shared folder)."""
    return pafs.FileSystem.from_uri(uri if "://" in uri else "file://" + os.path.abspath(uri.replace("file:", "", 1)))


def read_record(folder: str, part: int, entry: int) -> bytes:
    """Payload of one document by its index entry, with two short reads (shuffled access)."""
    fs, path = _fs(folder)
    with fs.open_input_file(f"{path}/part-{part:06d}.idx") as f:
        f.seek(entry * struct.calcsize(INDEX))
        offset, _, _ = struct.unpack(INDEX, f.read(struct.calcsize(INDEX)))
    with fs.open_input_file(f"{path}/part-{part:06d}.rec") as f:
        f.seek(offset)
        return read_frame(f)


@lru_cache(maxsize=2)
def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"       # Spark provides the parallelism
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


def id_format(vocabulary: int) -> str:
    """struct and array code of one id."""
    if sys.byteorder != "little":
        raise ValueError("the ids are written as this machine holds them: little-endian")
    return "H" if vocabulary <= 1 << 16 else "I"


def ids_of(payload: bytes) -> np.ndarray:
    """The ids of a payload as little-endian uint32."""
    return np.frombuffer(payload, "<u2" if payload[0] == 2 else "<u4", offset=1).astype("<u4")


#: The normaliser and splitter for which plain words may be split here.
PLAIN_NORMALIZER = ["NFC", "Replace", "Lowercase"]
PLAIN_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Plain words: visible ASCII and the letters of Latin-1; the same split, written for these characters.
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
_PLAIN_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if visible, else the next unused one."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(spare)) for b in range(256)]


class WordIds(dict):
    """Word -> its ids in the format of the files, encoded by the tokenizers library.

    The tokenizer drops white space and splits before it merges, so a text's ids are those of its
    words one after another.  Plain words are lower-cased and split here and their pieces merged by the
    library's model; any other word, and one that holds an added token, goes through the whole library,
    which cuts it at the token.  Bounded: words and pieces in two generations each; long ones are not kept.
    """

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer, self.old, self.pieces, self.old_pieces = tokenizer, {}, {}, {}
        self.code = id_format(tokenizer.get_vocab_size())
        config = json.loads(tokenizer.to_str())
        steps = [n["type"] for n in (config["normalizer"] or {}).get("normalizers", [])]
        first = ((config["pre_tokenizer"] or {}).get("pretokenizers") or [{}])[0]
        self.plain = steps == PLAIN_NORMALIZER and first.get("pattern", {}).get("Regex") == PLAIN_SPLIT
        self.model, self.letters = tokenizer.model, byte_letters()
        added = [t["content"] for t in config["added_tokens"]]
        if any(len(split_words(a.encode())) != 1 or a != a.strip() for a in added):
            raise ValueError("an added token with white space: texts cannot be encoded word by word")
        # in any case: some added tokens are looked for in the normalised text
        self.added = re.compile("|".join(re.escape(a) for a in added) or r"(?!)", re.IGNORECASE)

    def piece(self, text: str) -> bytes:
        value = self.pieces.get(text)
        if value is None:
            value = self.old_pieces.get(text)
            if value is None:
                # visible ASCII letters stand for themselves
                spelled = text if text.isascii() else "".join([self.letters[b] for b in text.encode()])
                value = array(self.code, [t.id for t in self.model.tokenize(spelled)]).tobytes()
            if len(text) <= CACHE_BYTES:
                if len(self.pieces) >= CACHE_WORDS:
                    self.old_pieces = dict(self.pieces)
                    self.pieces.clear()
                self.pieces[text] = value
        return value

    def encode(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        if self.plain and _PLAIN.fullmatch(text) and not self.added.search(text):
            return b"".join([self.piece(p) for p in _PLAIN_PIECES.findall(text.lower())])
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __missing__(self, word: bytes) -> bytes:
        value = self.old.get(word)
        if value is None:
            value = self.encode(word)
        if len(word) <= CACHE_BYTES:
            if len(self) >= CACHE_WORDS:
                self.old = dict(self)
                self.clear()
            self[word] = value
        return value


def write_records(docs: DataFrame, tokenizer_path: str, end_id: int, folder: str) -> DataFrame:
    """Write all documents to ``folder``; returns (part, n_docs, n_ids) of the parts, as a written table.

    One shuffle orders the documents by range; NULL texts are empty documents of just ``end_id``.
    """
    ordered = (docs.select("doc_id", "text")
               .repartitionByRange("doc_id", F.xxhash64("text"))
               .sortWithinPartitions("doc_id", F.xxhash64("text")))

    def run(batches):
        context = TaskContext.get()
        part, attempt = context.partitionId(), context.taskAttemptId()
        ids = WordIds(load_tokenizer(tokenizer_path))
        width, end = struct.calcsize(ids.code), struct.pack(f"<{ids.code}", end_id)
        fs, path = _fs(folder)
        names = {kind: f"{path}/_part-{part:06d}-{attempt}.{kind}" for kind in ("rec", "idx")}
        rec = idx = None
        offset = n_docs = n_ids = 0
        for batch in batches:
            if rec is None and batch.num_rows:
                fs.create_dir(path, recursive=True)
                rec, idx = fs.open_output_stream(names["rec"]), fs.open_output_stream(names["idx"])
            for key, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch)):
                payload = b"".join([bytes([width]), *map(ids.__getitem__, split_words(text)), end])
                framed, count = frame(payload), len(payload) // width
                rec.write(framed)
                idx.write(struct.pack(INDEX, offset, count, NULL_ID if key is None else key))
                offset += len(framed)
                n_docs += 1
                n_ids += count
        if rec is not None:
            rec.close()
            idx.close()
            for kind, name in names.items():
                fs.move(name, f"{path}/part-{part:06d}.{kind}")
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "n_docs": pa.array([n_docs], pa.int64()),
                                              "n_ids": pa.array([n_ids], pa.int64())})
    return materialise(map_arrow(ordered, run, "part int, n_docs long, n_ids long"), "token-parts")


def read_records(parts: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read back from the files of ``parts``.

    ``start`` is the number of ids before the document: those of earlier parts (a running sum over one
    small row per part) and of earlier frames of its own part.  Every checksum is verified.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    todo = parts.select("part", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("first"))

    def run(batches):
        fs, path = _fs(folder)
        for batch in batches:
            for part, start in zip(batch.column("part").to_pylist(), batch.column("first").to_pylist()):
                rows: list[tuple] = []
                with fs.open_input_stream(f"{path}/part-{part:06d}.rec") as rec, \
                        fs.open_input_stream(f"{path}/part-{part:06d}.idx") as idx:
                    while (payload := read_frame(rec)) is not None:
                        _, count, key = struct.unpack(INDEX, idx.read(struct.calcsize(INDEX)))
                        ids = ids_of(payload)
                        if count != len(ids):
                            raise ValueError(f"part {part}: index and records differ")
                        rows.append((None if key == NULL_ID else key, start, count, zlib.crc32(ids.tobytes())))
                        start += count
                        if len(rows) >= READ_BATCH:
                            yield _rows(rows)
                            rows = []
                if rows:
                    yield _rows(rows)

    def _rows(rows):
        columns = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                          ["doc_id", "start", "n_tokens", "ids_crc32"])
    # about one file per task: the rows are few and small, so their size must not decide the number of tasks
    return map_arrow(todo.repartition(max(1, parts.count()), "part"), run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def write_and_read(spark: SparkSession, docs: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """Write ``docs`` to a new folder under the shared checkpoint folder and read every record back."""
    folder = scratch_dir(spark, "token-records")
    return read_records(write_records(docs, tokenizer_path, end_id, folder), folder)
