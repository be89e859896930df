"""Piece encoding against the sentencepiece library, and the way back."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wardlight.llm import piece_bpe

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return piece_bpe.PieceModel(open(PATH, "rb").read())


def ids_of(model, text):
    import numpy as np

    return np.frombuffer(model.encode(text), "<i4").tolist()


TEXTS = [
    "", " ", "  ", "   a", "a   ", "\n", "\t\t", "▁", "▁▁x", " ▁ x", "x▁y", "\x00", "a\x00b", "é", "é", "ﬁ Ⅳ ½",
    "🙂🙂‍🙂", "日本語テキスト", "мама мыла раму", "�", "<0x41>", "<s></s><unk>", " " * 70 + "x" + " " * 33, "a" * 3000,
    "ab" * 700, "the" * 400, "0123456789" * 90, "Ａ　Ｂ", "​", "\r\n x\r\n", "hello<0xE2>world", "\U0010ffff",
]


@pytest.mark.parametrize("text", TEXTS)
def test_equals_library(model, library, text):
    want = library.encode(text)
    assert ids_of(model, text) == want
    assert model.decode(want) == library.decode(want)


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="ab ▁the\n\t.é日1", max_size=80))
def test_equals_library_on_any_text(text):
    text = text.encode("utf-8", "ignore").decode()
    model, library = piece_bpe._model(open(PATH, "rb").read()), _library()
    want = library.encode(text)
    assert ids_of(model, text) == want
    assert model.decode(want) == library.decode(want)


def _library(known=[]):  # noqa: B006
    if not known:
        known.append(sentencepiece.SentencePieceProcessor(model_file=PATH))
    return known[0]


def test_long_words_of_random_letters(model, library):
    deal = random.Random(5)
    for size in (65, 500, 20_000):
        text = "".join(deal.choice("abcdefghijklmnopqrstuvwxyzABCDEF0123456789+/=") for _ in range(size))
        assert ids_of(model, text) == library.encode(text)


def test_caches_are_bounded(monkeypatch, library):
    monkeypatch.setattr(piece_bpe, "CACHED_WORDS", 7)
    monkeypatch.setattr(piece_bpe, "CACHED_PAIRS", 11)
    model = piece_bpe.PieceModel(open(PATH, "rb").read())
    text = " ".join(f"word{i}x{i * 7}" for i in range(500))
    assert ids_of(model, text) == library.encode(text)
    assert len(model._words.new) <= 7 and len(model._words.old) <= 7 and sum(map(len, model._followers.values())) <= 11


def _check(spark, docs, library):
    encoded = piece_bpe.encode(docs, PATH)
    assert encoded.columns == ["doc_id", "ids"]
    rows = piece_bpe.decode(encoded, PATH).collect()
    want = [(r["doc_id"], library.encode(r["text"] or "")) for r in docs.select("doc_id", "text").collect()]
    key = repr
    assert sorted(((r["doc_id"], r["ids"]) for r in rows), key=key) == sorted(want, key=key)
    assert all(r["decoded"] == library.decode(r["ids"]) for r in rows)


def test_documents(spark, sf_dir, edge_docs, crowded, no_docs, library):
    for docs in (spark.read.parquet(f"{sf_dir}/documents.parquet"), edge_docs, crowded, no_docs):
        _check(spark, docs, library)


def test_texts_return(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where(~F.col("text").contains(piece_bpe.SPACE))
    back = piece_bpe.decode(piece_bpe.encode(docs, PATH, ("doc_id", "text")), PATH, ("doc_id", "text"))
    assert back.where(~F.col("decoded").eqNullSafe(F.coalesce("text", F.lit("")))).isEmpty()


def test_null_ids_are_empty(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (3, [28705, 13])], "doc_id long, ids array<int>")
    assert {r["doc_id"]: r["decoded"] for r in piece_bpe.decode(rows, PATH).collect()} == {1: "", 2: "", 3: "\n"}
