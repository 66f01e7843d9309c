"""Languages by held-out accuracy, and the sum over segmentations against a plain one."""

import math

import numpy as np
import pytest

from tablework.llm import language_id as lid
from tablework.llm.queries import piece_model_path


@pytest.fixture(scope="module")
def model(given_docs):
    return lid.fit(given_docs, piece_model_path())


def test_held_out_documents_are_recognised(given_docs):
    judged = lid.identify_languages(given_docs, piece_model_path())
    rows = judged.where("held_out").select("lang", "lang_pred").collect()
    assert len(rows) > 30
    assert sum(row["lang"] == row["lang_pred"] for row in rows) >= 0.97 * len(rows)


def test_labels_of_held_out_documents_do_not_matter(given_docs):
    from pyspark.sql import functions as F

    wrong = given_docs.withColumn("lang", F.when(lid.held_out(F.col("doc_id")), "xx").otherwise(F.col("lang")))
    before = lid.identify_languages(given_docs, piece_model_path()).select("doc_id", "lang_pred", "score")
    after = lid.identify_languages(wrong, piece_model_path()).select("doc_id", "lang_pred", "score")
    assert before.exceptAll(after).count() == 0


def test_forward_sums_all_segmentations(model):
    numbers = {piece: i for i, piece in enumerate(model.lattice.pieces)}

    def total(text, column):
        if not text:
            return 1.0
        found = 0.0
        for size in range(1, len(text) + 1):
            number = numbers.get(text[:size], model.lattice.unknown if size == 1 else None)
            if number is not None:
                found += model.table[number, column] * total(text[size:], column)
        return found

    words = ["the", "que", "straße", "日本", "a", "xyzzyx"]
    scores = model.word_scores(words)
    for word, row in zip(words, scores):
        for column in range(len(model.languages)):
            assert row[column] == pytest.approx(math.log(total(lid.SPACE + word, column)), rel=1e-9)
        assert model.long_word_score(word) == pytest.approx(row, rel=1e-9)


def test_pieces_of_a_language_sum_to_one(model):
    assert model.table.sum(axis=0) == pytest.approx(np.ones(len(model.languages)))


def test_odd_rows(odd_docs, keeps_columns):
    judged = lid.identify_languages(odd_docs, piece_model_path())
    keeps_columns(odd_docs, judged, "held_out", "lang_pred", "score")
    rows = judged.select("doc_id", "text", "lang_pred", "score").collect()
    assert len(rows) == odd_docs.count()
    for row in rows:
        letters = any(character.isalpha() for character in row["text"] or "")
        assert (row["lang_pred"] == "und") == (not letters)
        assert 0 <= row["score"] <= 1


def test_nothing_labelled_is_undetermined(odd_docs, no_docs):
    from pyspark.sql import functions as F

    unlabelled = odd_docs.withColumn("lang", F.lit(None).cast("string"))
    judged = lid.identify_languages(unlabelled, piece_model_path())
    assert [row[0] for row in judged.select("lang_pred").distinct().collect()] == ["und"]
    assert lid.identify_languages(no_docs, piece_model_path()).count() == 0


def test_the_sample_is_bounded(given_docs):
    small = lid.fit(given_docs, piece_model_path(), sample_per_language=1)
    assert small.languages == sorted(row[0] for row in given_docs.select("lang").distinct().collect())


def test_long_words_are_fitted_like_short_ones(model, monkeypatch):
    """Uses of pieces by sums of logarithms are those side by side, also for a word of 60 letters."""
    lattice, p = model.lattice, model.table[:, 0]
    words = ["the", "straße", "日本", "xyzzyx", "thequickbrownfoxjumpsoverthelazydogandthenrunsawaytothehills"]
    assert len(words[-1]) == 60
    counts = np.array([3.0, 1.0, 2.0, 5.0, 4.0])
    monkeypatch.setattr(lid, "LONG_WORD", 100)
    together = lid.expected_counts(lattice, words, counts, p)
    monkeypatch.setattr(lid, "LONG_WORD", 0)
    alone = lid.expected_counts(lattice, words, counts, p)
    assert alone == pytest.approx(together, rel=1e-9, abs=1e-12)
    very_long = np.zeros(len(p))
    lid.add_long_word(lattice, words[-1] * 300, 1.0, p, very_long)
    assert np.isfinite(very_long).all()
    uses = sum(n * len(piece) for n, piece in zip(very_long, lattice.pieces)) + very_long[lattice.unknown]
    assert uses == pytest.approx(60 * 300 + 1)  # every letter, and the word's start, once


def test_a_language_of_long_words_alone_is_learned(spark):
    rows = [(i, "ka" * 40 + "ro" * (i % 9), "kk") for i in range(90)]
    rows += [(100 + i, "shine" * 12 + "ly" * (i % 9), "en") for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    judged = lid.identify_languages(docs, piece_model_path())
    assert judged.where("lang <> lang_pred").count() == 0


def test_numerals_are_no_letters(spark, given_docs):
    odd = ["²", "½ Ⅷ", "① ٣ 12", "_", "́", "一", "ª", "x²"]
    extra = spark.createDataFrame([(-i - 1, text) for i, text in enumerate(odd)], "doc_id long, text string")
    docs = given_docs.unionByName(extra, allowMissingColumns=True)
    judged = lid.identify_languages(docs, piece_model_path()).where("doc_id < 0")
    und = {row["text"] for row in judged.collect() if row["lang_pred"] == "und"}
    assert und == {"²", "½ Ⅷ", "① ٣ 12", "_", "́"}
