"""Language identification by unigram pieces, summed over all segmentations.

A language is a distribution over the letter pieces of a fixed public vocabulary. A word's
probability is the sum over all ways to cut it into pieces, which a forward pass adds up; a
text's is the product over its words. The distributions are fitted by expectation maximisation
on word counts of a bounded sample of labelled documents.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablework.llm.columns import packed, unpacked
from tablework.workspace import checkpointed

SPACE = "▁"
UNDETERMINED = "und"
#: The bound of the training sample: documents of each language, whole texts.
SAMPLE_PER_LANGUAGE = 400
ROUNDS = 4
SMOOTHING = 0.05
#: Characters of text that are judged at a time.
CHUNK = 3_000_000
#: Longer words are scored and fitted on their own instead of side by side with others.
LONG_WORD = 40
WORD = re.compile(r"[^\W\d_]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SLOTS = 20


def words_of(text: str | None) -> list[str]:
    """Runs of letters, which are the characters of Unicode's letter categories.

    The pattern also takes numerals that are no digits (superscripts, fractions, Roman numerals), so
    the rare words with such a character are cut there.
    """
    words = WORD.findall((text or "").lower())
    if all(map(str.isalpha, words)):
        return words
    spaced = ["".join(c if c.isalpha() else " " for c in word) for word in words]
    return " ".join(spaced).split()


def letter_pieces(model_path: str) -> list[str]:
    """The vocabulary's pieces of lower-case letters, with or without a word start."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(model_path, "rb") as file:
        proto.ParseFromString(file.read())
    found = {p.piece for p in proto.pieces if p.type == 1}
    letters = {piece for piece in found if piece == SPACE or piece.removeprefix(SPACE).isalpha()}
    return sorted(piece for piece in letters if piece == piece.lower())


class Lattice:
    """Finds the pieces that end at each position of many words at once.

    Piece numbers follow ``pieces``; ``unknown`` is a single character without a piece, and
    ``none`` stands where no piece fits.
    """

    def __init__(self, pieces: list[str]):
        self.pieces = pieces
        self.numbers = {piece: i for i, piece in enumerate(pieces)}
        self.unknown, self.none = len(pieces), len(pieces) + 1
        self.longest = max(map(len, pieces))
        hashes = np.zeros(len(pieces), np.uint64)
        lengths = np.array([len(piece) for piece in pieces])
        for size in np.unique(lengths):
            at = np.flatnonzero(lengths == size)
            codes = self._codes([pieces[i] for i in at], int(size))
            hashes[at] = self._prefix_hashes(codes)[:, -1]
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.filter = np.zeros(1 << _SLOTS, bool)
        self.filter[self._slot(hashes)] = True
        powers = [np.uint64(1)]
        with np.errstate(over="ignore"):
            for _ in range(self.longest):
                powers.append(powers[-1] * _BASE)
        self.powers = np.array(powers)

    @staticmethod
    def _codes(words: list[str], size: int) -> np.ndarray:
        return np.array(words, dtype=f"U{size}").view(np.uint32).reshape(len(words), size)

    @staticmethod
    def _prefix_hashes(codes: np.ndarray) -> np.ndarray:
        sums = np.zeros((len(codes), codes.shape[1] + 1), np.uint64)
        with np.errstate(over="ignore"):
            for i in range(codes.shape[1]):
                sums[:, i + 1] = sums[:, i] * _BASE + codes[:, i].astype(np.uint64) + np.uint64(1)
        return sums

    @staticmethod
    def _slot(hashes: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            mixed = hashes * np.uint64(0xD6E8FEB86659FD93)
        return mixed >> np.uint64(64 - _SLOTS)

    def pieces_at(self, words: list[str]) -> dict[tuple[int, int], np.ndarray]:
        """Piece numbers by (end, length) for words of one length, word start included."""
        size = len(words[0]) + 1
        sums = self._prefix_hashes(self._codes([SPACE + word for word in words], size))
        found = {}
        for end in range(1, size + 1):
            for length in range(1, min(end, self.longest) + 1):
                with np.errstate(over="ignore"):
                    keys = sums[:, end] - sums[:, end - length] * self.powers[length]
                numbers = np.full(
                    len(words), self.unknown if length == 1 else self.none, np.int64
                )
                maybe = np.flatnonzero(self.filter[self._slot(keys)])
                if len(maybe):
                    at = np.searchsorted(self.hashes, keys[maybe])
                    at = np.minimum(at, len(self.hashes) - 1)
                    hit = self.hashes[at] == keys[maybe]
                    numbers[maybe[hit]] = self.order[at[hit]]
                    maybe = maybe[hit]
                if length == 1 or len(maybe):
                    found[end, length] = numbers
        return found


def by_length(words: list[str]) -> dict[int, np.ndarray]:
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    return {int(size): np.flatnonzero(lengths == size) for size in np.unique(lengths)}


@dataclass
class LanguageModel:
    languages: list[str]
    lattice: Lattice
    #: One row per piece, then ``unknown`` and ``none`` (zero); one column per language.
    table: np.ndarray

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Log-probability of each word in each language."""
        scores = np.zeros((len(words), len(self.languages)))
        for size, rows in by_length(words).items():
            if size > LONG_WORD:
                for row in rows:
                    scores[row] = self.long_word_score(words[row])
                continue
            for lo in range(0, len(rows), 50_000):
                chosen = rows[lo : lo + 50_000]
                scores[chosen] = self._side_by_side([words[i] for i in chosen])
        return scores

    def _side_by_side(self, words: list[str]) -> np.ndarray:
        found = self.lattice.pieces_at(words)
        forward = [np.ones((len(words), len(self.languages)))]
        for end in range(1, len(words[0]) + 2):
            total = 0.0
            for length in range(1, min(end, self.lattice.longest) + 1):
                numbers = found.get((end, length))
                if numbers is not None:
                    total = total + forward[end - length] * self.table[numbers]
            forward.append(total)
        return np.log(forward[-1])

    def long_word_score(self, word: str) -> np.ndarray:
        """The same sum for one word of any length, rescaled on the way."""
        text, scale = SPACE + word, 0.0
        forward = [np.ones(len(self.languages))]
        for end in range(1, len(text) + 1):
            single = self.lattice.numbers.get(text[end - 1], self.lattice.unknown)
            total = forward[-1] * self.table[single]
            for length in range(2, min(end, self.lattice.longest) + 1):
                number = self.lattice.numbers.get(text[end - length : end])
                if number is not None:
                    total = total + forward[-length] * self.table[number]
            forward = forward[-self.lattice.longest :]
            forward.append(total)
            largest = total.max()
            if largest < 1e-100:
                forward = [values / largest for values in forward]
                scale += np.log(largest)
        return np.log(np.maximum(forward[-1], 1e-300)) + scale

    def judge(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """The likeliest language of each text and its posterior under equal priors."""
        if not self.languages:
            return [UNDETERMINED] * len(texts), [0.0] * len(texts)
        names, posteriors = [], []
        lists = [words_of(text) for text in texts]
        flat = [word for words in lists for word in words]
        codes, distinct = pd.factorize(np.array(flat, dtype=object))
        scores = self.word_scores(list(distinct)) if len(distinct) else None
        start = 0
        for words in lists:
            end = start + len(words)
            if not words:
                names.append(UNDETERMINED)
                posteriors.append(0.0)
            else:
                total = scores[codes[start:end]].sum(axis=0)
                best = int(total.argmax())
                names.append(self.languages[best])
                posteriors.append(float(1.0 / np.exp(total - total[best]).sum()))
            start = end
        return names, posteriors


def log_sum(terms: list[float]) -> float:
    largest = max(terms)
    return largest + math.log(sum(math.exp(term - largest) for term in terms))


def add_long_word(
    lattice: Lattice, word: str, count: float, p: np.ndarray, expected: np.ndarray
) -> None:
    """Add the uses of pieces in one word of any length to ``expected``; the sums are logarithms."""
    text = SPACE + word
    cuts = []  # per end the lengths, piece numbers and log-probabilities of the pieces
    for end in range(1, len(text) + 1):
        pieces = [(1, lattice.numbers.get(text[end - 1], lattice.unknown))]
        for length in range(2, min(end, lattice.longest) + 1):
            number = lattice.numbers.get(text[end - length : end])
            if number is not None:
                pieces.append((length, number))
        cuts.append([(length, number, math.log(p[number])) for length, number in pieces])
    forward = [0.0]
    for end, pieces in enumerate(cuts, 1):
        forward.append(log_sum([forward[end - length] + log_p for length, _, log_p in pieces]))
    backward = [-math.inf] * len(forward)
    backward[-1] = 0.0
    for end in range(len(cuts), 0, -1):
        for length, number, log_p in cuts[end - 1]:
            after = log_p + backward[end]
            expected[number] += count * math.exp(forward[end - length] + after - forward[-1])
            before = backward[end - length]
            backward[end - length] = after if before == -math.inf else log_sum([before, after])


def expected_counts(lattice: Lattice, words: list[str], counts: np.ndarray, p: np.ndarray):
    """Expected uses of each piece, by forward and backward sums over all segmentations."""
    expected = np.zeros(len(p))
    for size, rows in by_length(words).items():
        if size > LONG_WORD:
            for row in rows:
                add_long_word(lattice, words[row], counts[row], p, expected)
            continue
        group, weight = [words[i] for i in rows], counts[rows]
        found = lattice.pieces_at(group)
        last = size + 1
        forward, backward = np.zeros((last + 1, len(group))), np.zeros((last + 1, len(group)))
        forward[0], backward[last] = 1.0, 1.0
        for end in range(1, last + 1):
            for length in range(1, min(end, lattice.longest) + 1):
                if (end, length) in found:
                    forward[end] += forward[end - length] * p[found[end, length]]
        for end in range(last, 0, -1):
            for length in range(1, min(end, lattice.longest) + 1):
                if (end, length) in found:
                    backward[end - length] += backward[end] * p[found[end, length]]
        for (end, length), numbers in found.items():
            uses = forward[end - length] * p[numbers] * backward[end] * weight / forward[last]
            np.add.at(expected, numbers, uses)
    expected[lattice.none] = 0.0
    return expected


def fit_language(lattice: Lattice, words: list[str], counts: np.ndarray) -> np.ndarray:
    """Piece probabilities of one language from its word counts."""
    size = len(lattice.pieces) + 2
    p = np.full(size, 1.0 / (size - 1))
    p[lattice.none] = 0.0
    for _ in range(ROUNDS):
        p = expected_counts(lattice, words, counts, p) + SMOOTHING
        p[lattice.none] = 0.0
        p /= p.sum()
    return p


def fit(
    docs: DataFrame,
    model_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "lang",
    sample_per_language: int = SAMPLE_PER_LANGUAGE,
) -> LanguageModel:
    """A model of every label in ``docs``, from at most ``sample_per_language`` texts of each.

    The sample is the rows whose id has the smallest hash, so it does not depend on the layout.
    Rows without label or id are left out. Words are counted in Spark; the counts of the sample
    come to the driver, where the pieces are fitted.
    """
    usable = docs.where(F.col(f"`{label_col}`").isNotNull() & F.col(f"`{id_col}`").isNotNull())
    order = Window.partitionBy("label").orderBy("place", "id")
    labelled = usable.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label")
    )
    sizes = checkpointed(
        labelled.groupBy(F.col("label").alias("of_label")).agg(F.count("*").alias("n")), "labels"
    )
    # Twice the wanted number lies below this place on average, and fewer than the wanted number
    # never in practice, so that few rows of a large label meet in one task.
    place = F.shiftrightunsigned(F.xxhash64("id"), 11) / float(2**53)
    chosen = checkpointed(
        labelled.withColumn("place", place)
        .join(sizes, F.col("label") == F.col("of_label"))
        .where(F.col("place") * F.col("n") <= 2.0 * sample_per_language + 100)
        .withColumn("number", F.row_number().over(order))
        .where(F.col("number") <= sample_per_language)
        .select(F.col("id").alias("chosen_id"))
        .distinct(),
        "language-sample",
    )

    def count(batches):
        for batch in batches:
            totals: Counter = Counter()
            for label, text in zip(batch["label"], batch["text"]):
                totals.update((label, word) for word in words_of(text))
            yield pd.DataFrame(
                [(label, word, n) for (label, word), n in totals.items()],
                columns=["label", "word", "n"],
            )

    counted = (
        usable.select(
            F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"),
            F.col(f"`{text_col}`").alias("text"),
        )
        .join(chosen, F.col("id") == F.col("chosen_id"), "left_semi")
        .select("label", "text")
        .mapInPandas(count, "label string, word string, n long")
        .groupBy("label", "word")
        .agg(F.sum("n").alias("n"))
        .toPandas()
        .sort_values(["label", "word"])
    )
    lattice = Lattice(letter_pieces(model_path))
    languages = sorted(counted["label"].unique())
    columns = []
    for language in languages:
        own = counted[counted["label"] == language]
        columns.append(fit_language(lattice, own["word"].tolist(), own["n"].to_numpy(float)))
    table = np.stack(columns, axis=1) if columns else np.zeros((len(lattice.pieces) + 2, 0))
    return LanguageModel(languages, lattice, table)


def predicted(text: Column, model: LanguageModel) -> Column:
    """A struct ``lang_pred, score`` for each text."""

    @F.pandas_udf("lang_pred string, score double")
    def judge(texts: pd.Series) -> pd.DataFrame:
        names, posteriors, waiting, chars = [], [], [], 0
        for text in texts:
            waiting.append(text)
            chars += len(text or "")
            if chars > CHUNK:
                own = model.judge(waiting)
                names, posteriors, waiting, chars = names + own[0], posteriors + own[1], [], 0
        own = model.judge(waiting)
        names, posteriors = names + own[0], posteriors + own[1]
        return pd.DataFrame({"lang_pred": names, "score": posteriors})

    return judge(text)


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id as text leaves 1 when divided by 3; false without id."""
    remainder = F.crc32(doc_id.cast("string").cast("binary")) % 3
    return F.coalesce(remainder == 1, F.lit(False))


def identify_languages(
    docs: DataFrame,
    model_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "lang",
    sample_per_language: int = SAMPLE_PER_LANGUAGE,
) -> DataFrame:
    """All columns of ``docs`` with ``held_out``, ``lang_pred`` and ``score``.

    Learns from the labelled rows that are not held out, and from their texts and labels only.
    Texts that are null or without a letter, and all texts if nothing is labelled, get ``und``
    with score 0. Texts and words may be of any length; languages that are equally likely give the
    one that sorts first, and repeated rows get equal results. Columns named like a result are replaced. Prediction is one pass without a
    shuffle; what it ships is bounded by the vocabulary and the number of labels.
    """
    learnable = docs.where(~held_out(F.col(f"`{id_col}`")))
    model = fit(learnable, model_path, id_col, text_col, label_col, sample_per_language)
    judged = packed(
        docs,
        held_out=held_out(F.col(f"`{id_col}`")),
        judged=predicted(F.col(f"`{text_col}`"), model),
    )
    return unpacked(
        judged,
        docs.columns,
        held_out=F.col("held_out"),
        lang_pred=F.col("judged.lang_pred"),
        score=F.col("judged.score"),
    )
