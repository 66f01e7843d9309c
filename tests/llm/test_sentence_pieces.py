"""Ids and texts against the sentencepiece library."""

import random
import struct

import numpy as np
import pytest
import sentencepiece

from tablework.llm.queries import piece_model_path
from tablework.llm.sentence_pieces import PieceModel, encode_documents


@pytest.fixture(scope="module")
def model():
    return PieceModel(piece_model_path())


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=piece_model_path())


def agree(model, library, texts):
    for text in texts:
        ids = [1, *library.encode(text), 2]
        packed = model.encode(text)
        assert np.frombuffer(packed, "<u4").tolist() == ids, repr(text)
        assert model.decode(packed) == library.decode(ids), repr(text)


def test_given_documents(model, library, given_docs):
    agree(model, library, [row["text"] for row in given_docs.select("text").collect()])


def test_odd_texts(model, library):
    pick = random.Random(4)
    texts = ["", " ", "  a", "▁x", "a▁▁b ▁", "<s>", "</s> <unk>", "\n\n", "a" * 500, "日本語 😀😀x", "\x00a", "\t", " " * 60]
    texts += ["".join(pick.choice("ab cdeinrst \n.,é😀▁0123") for _ in range(pick.randint(1, 60))) for _ in range(800)]
    texts += ["".join(chr(pick.choice([pick.randint(32, 126), pick.randint(32, 0x9FFF)])) for _ in range(50)) for _ in range(300)]
    texts += ["".join(pick.choice(model.pieces[260:]) for _ in range(8)).replace("▁", " ") for _ in range(500)]
    agree(model, library, texts)


def test_decoding_any_ids(model, library):
    pick = random.Random(5)
    for _ in range(1500):
        ids = [pick.randrange(260 if pick.random() < 0.5 else 32_000) for _ in range(10)]
        assert model.decode(struct.pack("<10I", *ids)) == library.decode(ids)


def test_a_small_memory_changes_nothing(model, monkeypatch, given_docs):
    from tablework.llm import sentence_pieces

    text = given_docs.select("text").first()["text"] * 3
    expected = model.encode(text)
    monkeypatch.setattr(sentence_pieces, "MAX_UNITS", 5)
    monkeypatch.setattr(sentence_pieces, "MAX_PAIRS", 7)
    assert PieceModel(piece_model_path()).encode(text) == expected


def test_odd_rows(odd_docs, library, keeps_columns):
    result = encode_documents(odd_docs, piece_model_path())
    keeps_columns(odd_docs.drop("token_ids", "n_tokens", "decoded"), result, "token_ids", "n_tokens", "decoded")
    rows = result.select("text", "token_ids", "n_tokens", "decoded").collect()
    assert len(rows) == odd_docs.count()
    for row in rows:
        ids = [1, *library.encode(row["text"] or ""), 2]
        assert np.frombuffer(row["token_ids"], "<u4").tolist() == ids
        assert (row["n_tokens"], row["decoded"]) == (len(ids), library.decode(ids))


def test_no_rows(no_docs):
    assert encode_documents(no_docs, piece_model_path()).count() == 0
