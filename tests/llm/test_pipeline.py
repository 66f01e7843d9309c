"""Every stage on odd rows and on none, the whole on the given documents and by brute force."""

import math
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from test_line_dedup import key_of
from test_mixing import draw, poisson
from test_simhash import components, fingerprint

import corpus_pipeline
from tablework.llm import language_id as lid
from tablework.llm.queries import piece_model_path
from tablework.workspace import checkpointed

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES, ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stage_on_odd_rows_and_none(spark, sf_dir, odd_docs, no_docs, name, stage):
    for docs in (odd_docs, no_docs):
        result = stage(spark, docs, sf_dir)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert result.columns == docs.columns
        assert (checkpointed(result, "stage").count() > 0) == (docs is odd_docs)


def test_stages_pass_on_what_they_kept(spark, sf_dir, given_docs):
    docs, seen = given_docs, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = checkpointed(stage(spark, docs, sf_dir), "stage")
        seen[name] = docs
    languages, lines, groups, mixed, encoded = seen.values()
    assert languages.count() == given_docs.count()
    assert lines.count() == languages.count()
    assert lines.where("n_chars <> char_length(text)").count() == 0
    assert groups.select("doc_id").distinct().count() == groups.count() < lines.count()
    assert mixed.join(groups, "doc_id", "left_anti").count() == 0
    assert encoded.count() == mixed.count()
    assert all(part.columns == COLUMNS for part in (languages, lines, groups, mixed))


def test_run_gives_the_last_stage(spark, sf_dir):
    result = corpus_pipeline.run(spark, sf_dir)
    assert result.columns == ["doc_id", "lang", "source", "token_ids", "n_tokens", "decoded"]
    assert result.count() > 100


def letter_words(text):
    """Runs of letters by Unicode category, in lower case."""
    return "".join(c if unicodedata.category(c)[0] == "L" else " " for c in (text or "").lower()).split()


def segmentations(word, p, unknown):
    """Sums over all segmentations before and after each place, and the pieces with their ends."""
    text = lid.SPACE + word
    pieces = []
    for start in range(len(text)):
        for end in range(start + 1, len(text) + 1):
            piece = text[start:end]
            if piece not in p and end == start + 1:
                piece = unknown
            if piece in p:
                pieces.append((start, end, piece))
    before, after = [1.0] + [0.0] * len(text), [0.0] * len(text) + [1.0]
    for start, end, piece in sorted(pieces, key=lambda found: found[1]):
        before[end] += before[start] * p[piece]
    for start, end, piece in sorted(pieces, key=lambda found: -found[0]):
        after[start] += after[end] * p[piece]
    return before, after, pieces


def fitted(texts):
    """Piece probabilities by four rounds of expected uses, word by word."""
    counts = Counter(word for text in texts for word in letter_words(text))
    names = [*lid.letter_pieces(piece_model_path()), None]
    p = dict.fromkeys(names, 1.0 / len(names))
    for _ in range(lid.ROUNDS):
        uses = dict.fromkeys(names, lid.SMOOTHING)
        for word, n in counts.items():
            before, after, pieces = segmentations(word, p, None)
            for start, end, piece in pieces:
                uses[piece] += n * before[start] * p[piece] * after[end] / before[-1]
        total = sum(uses.values())
        p = {name: value / total for name, value in uses.items()}
    return p


def languages_by_brute_force(rows):
    """The rows whose likeliest language has half of the posterior."""
    learned = defaultdict(list)
    for row in rows:
        if row["lang"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 3 != 1:
            learned[row["lang"]].append(row["text"])
    models = {language: fitted(texts) for language, texts in learned.items()}
    known: dict = {}
    kept = []
    for row in rows:
        words = letter_words(row["text"])
        for word in set(words) - set(known):
            known[word] = [math.log(segmentations(word, p, None)[0][-1]) for p in models.values()]
        totals = [sum(known[word][i] for word in words) for i in range(len(models))]
        if words and 1.0 / sum(math.exp(total - max(totals)) for total in totals) >= 0.5:
            kept.append(row)
    return kept


def lines_by_brute_force(rows):
    holders = defaultdict(set)
    for row in rows:
        for line in row["text"].split("\n"):
            holders[key_of(line)].add(row["doc_id"])

    def stays(row, line):
        ids = holders[key_of(line)]
        return len(key_of(line)) < 10 or len(ids) < 2 or row["doc_id"] == min(ids)

    texts = ["\n".join(line for line in row["text"].split("\n") if stays(row, line)) for row in rows]
    return [row | {"text": text, "n_chars": len(text)} for row, text in zip(rows, texts)]


def groups_by_brute_force(rows):
    codes = [fingerprint(row["text"]) for row in rows]
    first = {}
    for row, root in zip(rows, components(codes)):
        if root not in first or row["doc_id"] < first[root]["doc_id"]:
            first[root] = row
    return list(first.values())


def mixed_by_brute_force(rows):
    sizes = Counter(row["source"] for row in rows)
    weights = {source: math.floor(math.sqrt(n) * 1000) for source, n in sizes.items()}
    total = sum(weights.values())
    rates = {source: weights[source] * len(rows) / (total * n) for source, n in sizes.items()}
    return [
        row for row in rows for _ in range(poisson(rates[row["source"]], draw(row["doc_id"], 1)))
    ]


def test_rows_of_the_whole_against_brute_force(spark):
    """Every stage again in plain Python, over the smallest tables and none of the operators."""
    small = "/root/testdata/sf0.001"
    rows = [row.asDict() for row in spark.read.parquet(f"{small}/documents.parquet").collect()]
    kept = languages_by_brute_force(rows)
    grouped = groups_by_brute_force(lines_by_brute_force(kept))
    assert len(grouped) < len(kept)
    library = sentencepiece.SentencePieceProcessor(model_file=piece_model_path())
    expected = []
    for row in mixed_by_brute_force(grouped):
        ids = [1, *library.encode(row["text"]), 2]
        expected.append((row["doc_id"], row["lang"], row["source"], ids, len(ids), library.decode(ids)))
    result = corpus_pipeline.run(spark, small)
    columns = ["doc_id", "lang", "source", "token_ids", "n_tokens", "decoded"]
    got = [
        (*row[:3], np.frombuffer(row["token_ids"], "<u4").tolist(), *row[4:])
        for row in result.select(columns).collect()
    ]
    assert sorted(got, key=str) == sorted(expected, key=str)
