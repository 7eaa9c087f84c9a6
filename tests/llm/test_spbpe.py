import random

import pytest
import sentencepiece

from skein.llm import spbpe
from skein.llm.queries import model_path


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=model_path())


@pytest.fixture(scope="module")
def model():
    return spbpe.PieceModel(spbpe.read_model(model_path()))


EDGES = ["", " ", "  ", " a", "a ", "\n", "▁", "a▁ b", "\x00", "é", "😀a😀😀 b", "<s>", "<0x41> </s>", "a" * 5000, " " * 1000, "1234567890" * 50,
         "\r\n\t x", "日本語 漢字", " " * 33 + "x", "x" + " " * 37, "İ ſ", "#" * 77, "the " * 4000]


def test_edges_against_the_library(model, library):
    for t in EDGES:
        ids = list(model.encode(t))
        assert ids == library.encode(t, add_bos=True, add_eos=True), t[:40]
        assert model.decode(ids) == library.decode(ids), t[:40]


def test_random_texts_against_the_library(model, library):
    rng = random.Random(5)
    bits = ["a", "b", "e", "th", "er", "in", "ing", " ", "  ", "\n", "é", "ü", "▁", "1", "漢", "😀", "\x00", ".", "##", "the", "ж"]
    for _ in range(5000):
        t = "".join(rng.choices(bits, k=rng.randint(1, 40)))
        ids = list(model.encode(t))
        assert ids == library.encode(t, add_bos=True, add_eos=True), t
        assert model.decode(ids) == library.decode(ids), t


def test_memo_is_bounded(library, monkeypatch):
    monkeypatch.setattr(spbpe, "MEMO_WORDS", 10)
    m = spbpe.PieceModel(spbpe.read_model(model_path()))
    text = " ".join(f"word{i % 37}x{i}" for i in range(500))
    assert list(m.encode(text)) == library.encode(text, add_bos=True, add_eos=True)
    assert len(m.memo) <= 10 and len(m.older) <= 10


def test_documents(spark, library):
    rows = [(1, "Hello  world", "x"), (2, None, "y"), (2, None, "y"), (None, "z\n", "w"), (4, "long " * 50_000, "v")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = spbpe.encode_documents(df, model_path())
    seen = sorted(((r.doc_id, r.n_tokens, bytes(r.ids), r.decoded) for r in got.collect()), key=str)
    want = []
    for i, t, _ in rows:
        ids = library.encode(t or "", add_bos=True, add_eos=True)
        want.append((i, len(ids), b"".join(x.to_bytes(4, "little") for x in ids), library.decode(ids)))
    assert seen == sorted(want, key=str)
    assert spbpe.encode_documents(df.limit(0), model_path()).collect() == []
