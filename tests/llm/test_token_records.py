import io
import random
import struct
import zlib

import public_tokenizers
import pytest

from orderlake.llm import token_records as T
from orderlake.llm.queries import QUERIES
from orderlake.session import scratch_dir
from tests.conftest import SF_TINY
from tests.llm.conftest import documents, edge_rows

PATH = public_tokenizers.path("word_bpe_49k.json")


def whole_ids(text):
    return T.load_tokenizer(PATH).encode(text.decode(), add_special_tokens=False).ids + [2]


def crc(ids):
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


def test_query_equals_the_library(spark):
    got = {r["doc_id"]: r for r in QUERIES["op9_token_records"](spark, SF_TINY).collect()}
    start = 0
    for i, text, _ in sorted(documents(SF_TINY)):
        ids = whole_ids(text)
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (start, len(ids), crc(ids))
        start += len(ids)


def test_edges(spark, edge_docs, no_docs):
    rows = sorted(T.write_and_read(spark, edge_docs, PATH).collect(), key=lambda r: r["start"])
    want = sorted(((i is not None, i or 0, len(x), crc(x)) for i, t, _ in edge_rows() for x in [whole_ids((t or "").encode())]))
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_tokens"], r["ids_crc32"]) for r in rows) == want
    order = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in rows]
    assert order == sorted(order)                           # NULL ids first, then ascending
    starts = 0
    for r in rows:
        assert r["start"] == starts
        starts += r["n_tokens"]
    assert T.write_and_read(spark, no_docs, PATH).count() == 0


def test_words_and_whole_texts_encode_alike():
    words = T.WordIds(T.load_tokenizer(PATH))
    rng = random.Random(2)
    parts = [*"'sStTreEvmMlLdD!%.#-_09 ~ÀßÿÖ÷×äéñµªº²¼", "'ll", "'re", "the", "ing", "don't", "´", "ﬁ", "́"]
    mixed = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 14))) for _ in range(4000)]
    for text in mixed + ["it's  the cat's tail, isn't it?", "é ́x ΑΣ ς", "a<|endoftext|> b\x1cc d", "１２3x", "İstanbul ẞ"]:
        got = T.ids_of(b"\2" + b"".join(words[w] for w in text.encode().split()) + struct.pack("<H", 2))
        assert got.tolist() == whole_ids(text.encode())
    assert T.id_format(65_536) == "H" and T.id_format(65_537) == "I"
    assert T.ids_of(b"\4" + struct.pack("<2I", 1, 70_000)).tolist() == [1, 70_000]


def test_frames_and_shuffled_reads(spark, edge_docs):
    folder = scratch_dir(spark, "test-records")
    parts = T.write_records(edge_docs, PATH, 2, folder).collect()
    assert sum(p["n_docs"] for p in parts) == len(edge_rows())
    part = max(parts, key=lambda p: p["n_docs"])
    seen = [T.read_record(folder, part["part"], k) for k in reversed(range(part["n_docs"]))]
    assert sum(len(T.ids_of(p)) for p in seen) == part["n_ids"] and all(T.ids_of(p)[-1] == 2 for p in seen)
    good = T.frame(b"payload")
    assert T.read_frame(io.BytesIO(good)) == b"payload" and T.read_frame(io.BytesIO(b"")) is None
    for bad in (good[:-1], good[:5], b"\x09" + good[1:], good[:14] + b"X" + good[15:]):
        with pytest.raises(ValueError):
            T.read_frame(io.BytesIO(bad))


def test_added_tokens_are_those_of_the_untouched_library(spark):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(PATH)
    texts = ["a <|endoftext|> b", "a<|endoftext|>b", "x<|startoftext|><|endoftext|>'s", "<|ENDOFTEXT|> <|EndOfText|>x", "<|endoftext|",
             "é<|endoftext|>日本 <|startoftext|>", "<|endoftext|>" * 3, " <|startoftext|>\n<|endoftext|> ", "plain text", "<|end of text|>"]
    want = [library.encode(t, add_special_tokens=False).ids + [2] for t in texts]
    assert want[0] == [320, 49407, 321, 2]
    words = T.WordIds(T.load_tokenizer(PATH))
    assert [T.ids_of(b"\2" + b"".join(words[w] for w in t.encode().split()) + struct.pack("<H", 2)).tolist() for t in texts] == want
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in T.write_and_read(spark, docs, PATH).collect()}
    assert got == {i: (sum(map(len, want[:i])), len(x), crc(x)) for i, x in enumerate(want)}
