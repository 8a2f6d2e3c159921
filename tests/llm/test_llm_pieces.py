"""SentencePiece through distinct marked words, against the library's encoding of each whole text."""

import hashlib
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from coursemart.llm import pieces
from coursemart.session import materialise

public_tokenizers = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")

MODEL = Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes()
SP = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
ALPHABET = st.sampled_from(list("ab1 ▁\t\n.éß漢🙂") + ["  ", "the", "▁▁", "\r\n", "\x00"])


def whole(text):
    return SP.encode(text or "", add_bos=True, add_eos=True)


def by_words(text):
    lone = pieces.lone_marker(SP)
    return [SP.bos_id(), *(i for w in pieces.marked_words(text or "") for i in pieces.encode_word(SP, w, lone)), SP.eos_id()]


def test_model_splits_by_words():
    assert pieces.splits_by_words(MODEL)


@settings(max_examples=500, deadline=None)
@given(st.lists(ALPHABET, max_size=30).map("".join))
def test_words_encode_like_whole_text(text):
    assert by_words(text) == whole(text)


ODD = [None, "", " ", "a ", "  ", " a", "a  b   ", "▁x ▁ y", "tab\tand\nline", "x" * 5000, "word " * 3000, "漢字 🙂 ünï"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, {"k": i}, "clash") for i, t in enumerate(ODD)]
    rows += [(1, "other text of one", None, ""), (None, "no id", None, ""), (1, "other text of one", None, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, `a.b` map<string,int>, `row` string")
    return materialise(frame.repartition(3), "odd")


def digest(ids):
    return (
        len(ids), hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest(),
        hashlib.sha256(SP.decode(ids).encode("utf-8")).hexdigest(),
    )


def test_operator_against_library(spark, docs):
    encoded = pieces.encode(docs, "text", MODEL, ["doc_id", "row"])
    got = sorted((r["doc_id"], tuple(r["ids"])) for r in encoded.collect() if r["doc_id"] is not None)
    want = sorted((r["doc_id"], tuple(whole(r["text"]))) for r in docs.collect() if r["doc_id"] is not None)
    assert got == want
    assert encoded.count() == docs.count()
    found = pieces.digests(encoded, "ids", MODEL, ["doc_id"]).collect()
    assert sorted((r[0] is None, r[0] or 0, tuple(r[1:])) for r in found) == sorted(
        (r["doc_id"] is None, r["doc_id"] or 0, digest(whole(r["text"]))) for r in docs.collect()
    )


def test_hot_words_take_the_broadcast_path(spark, monkeypatch, docs):
    monkeypatch.setattr(pieces, "HOT_SHARE", 1 / 10)
    encoded = pieces.encode(docs, "text", MODEL, ["doc_id"])
    got = sorted((r["doc_id"] or -1, tuple(r["ids"])) for r in encoded.collect())
    assert got == sorted((r["doc_id"] or -1, tuple(whole(r["text"]))) for r in docs.collect())


def test_empty_table(spark, docs):
    assert pieces.encode(docs.limit(0), "text", MODEL, ["doc_id"]).count() == 0
