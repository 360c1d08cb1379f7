import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from orderlake.llm import sentencepiece_bpe as B
from orderlake.llm.queries import QUERIES
from tests.conftest import SF_TINY
from tests.llm.conftest import documents, edge_rows

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return B.load_model(PATH)


def test_equals_the_library_on_mixed_characters(model, library):
    rng = random.Random(1)
    parts = ["a", "b", "the", "ing", " ", "  ", "   ", "\n", "é", "ü", "日", "😀", "▁", "%%%", "$", "Th", "tion", "er", "st", "\t", "A",
             "0", "12", "-", "́", "\x00", "<s>", "<0x0A>", "​"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 16)))
        ids = model.encode(text)
        assert ids == library.encode(text) and model.decode(ids) == library.decode(ids)


@pytest.mark.parametrize("n", [*range(1, 70), 500])
def test_runs_of_spaces(model, library, n):
    for text in (" " * n, " " * n + "x", "x" + " " * n, "a" + " " * n + "b"):
        assert model.encode(text) == library.encode(text)


def test_long_text_without_spaces(model, library):
    text = "ab日thethe" * 5000 + "x" * 30_000
    assert model.encode(text) == library.encode(text)


def expected(library, rows):
    out = []
    for i, text in rows:
        ids = library.encode(text)
        back = library.decode(ids) if ids else ""
        out.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    return sorted(out, key=str)


def test_query_equals_the_library_on_whole_texts(spark, library):
    got = QUERIES["op5_sentencepiece"](spark, SF_TINY).collect()
    assert sorted(map(tuple, got), key=str) == expected(library, [(i, t.decode()) for i, t, _ in documents(SF_TINY)])


def test_edges(edge_docs, no_docs, library):
    rows = [(i, t or "") for i, t, _ in edge_rows()]
    assert sorted(map(tuple, B.digests(edge_docs, PATH).collect()), key=str) == expected(library, rows)
    whole = B.encode_decode(edge_docs, PATH).collect()
    assert sorted((str(r["doc_id"]), r["ids"], r["decoded"]) for r in whole) == sorted(
        (str(i), library.encode(t), library.decode(library.encode(t)) if t else "") for i, t in rows)
    assert B.digests(no_docs, PATH).count() == 0


def test_unsupported_models_are_refused(tmp_path):
    path = tmp_path / "m.model"
    path.write_bytes(b"\x12\x02\x18\x01")                  # a unigram trainer spec
    with pytest.raises(ValueError, match="merge-type"):
        B.MergeModel(str(path))
