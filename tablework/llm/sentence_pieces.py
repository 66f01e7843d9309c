"""SentencePiece byte-pair encoding by a table of last tokens, and decoding.

The encoding of every prefix of a string ends in one token only. An automaton over the
vocabulary lists the pieces that end at a position; the one that is compatible with the last
token of the prefix before it is that position's entry. Two tokens are compatible if merging
their joined string by the model's scores gives the same two tokens again. The ids are read
backwards from the last entry, without a queue of merges over the whole string.
"""

from __future__ import annotations

import codecs
import re
import struct
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Entries kept by a Python worker; a full memory is emptied, results do not depend on it.
MAX_UNITS = 250_000
MAX_PAIRS = 400_000
MAX_UNIT_CHARS = 40
PACKED = np.dtype("<u4")

codecs.register_error(
    "one_by_one", lambda error: ("�", error.start + 1)
)


def pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Units(dict):
    """Packed ids by unit of text, filled on demand."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, unit: str) -> bytes:
        ids = self.encode(unit)
        if len(unit) <= MAX_UNIT_CHARS:
            if len(self) >= MAX_UNITS:
                self.clear()
            self[unit] = ids
        return ids


class PieceModel:
    """The vocabulary of one model file, with its encoder and decoder."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        normal = proto.normalizer_spec
        kinds = {piece.type for piece in proto.pieces}
        if (
            proto.trainer_spec.model_type != 2
            or not proto.trainer_spec.byte_fallback
            or normal.precompiled_charsmap
            or normal.remove_extra_whitespaces
            or not (normal.add_dummy_prefix and normal.escape_whitespaces)
            or kinds & {USER_DEFINED, UNUSED}
        ):
            raise ValueError(f"{path}: not a byte-fallback BPE model without normalisation")
        self.begin = next(i for i, p in enumerate(proto.pieces) if p.piece == "<s>")
        self.end = next(i for i, p in enumerate(proto.pieces) if p.piece == "</s>")
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.scores = {p.piece: p.score for p in proto.pieces if p.type == NORMAL}
        self.pieces = [p.piece for p in proto.pieces]
        self.bytes = {
            int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE
        }
        self.spellings = [self._spelling(p) for p in proto.pieces]
        self.control = {i for i, p in enumerate(proto.pieces) if p.type == CONTROL}
        self.cut = self._cut()
        self.automaton = ahocorasick.Automaton()
        for piece, number in self.ids.items():
            if self.merged(piece) == [piece]:
                self.automaton.add_word(piece, number)
        self.automaton.make_automaton()
        self.chars = [len(piece) for piece in self.pieces]
        self.pairs: dict[int, bool] = {}
        self.units = Units(lambda unit: pack(self.unit_ids(unit)))

    def _cut(self) -> re.Pattern:
        """Cuts text where no piece of the vocabulary reaches across."""
        joined = set()  # neighbouring characters within pieces
        for piece in self.ids:
            joined.update(zip(piece, piece[1:]))
        if any(b in (SPACE, "\n") and a != b for a, b in joined) or any(
            a == "\n" for a, _ in joined
        ):
            return re.compile("(?s).+")
        after_letter = {b for a, b in joined if re.match(r"[^\W\d_]", a)}
        marks = "".join(c for c in "!,.:;?" if c not in after_letter)
        words = rf"{SPACE}*[^\W\d_]+(?=[{SPACE}\n{marks}]|\Z)"
        return re.compile(f"{words}|{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")

    @staticmethod
    def _spelling(piece) -> bytes:
        if piece.type == CONTROL:
            return b""
        if piece.type == UNKNOWN:
            return " ⁇ ".encode()
        if piece.type == BYTE:
            return bytes([int(piece.piece[3:5], 16)])
        return piece.piece.replace(SPACE, " ").encode()

    def merged(self, string: str) -> list[str]:
        """Merge a short string: the best-scored neighbours first, the leftmost among equals."""
        parts = list(string)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def compatible(self, left: int, right: int) -> bool:
        if len(self.pairs) >= MAX_PAIRS:
            self.pairs.clear()
        pair = [self.pieces[left], self.pieces[right]]
        found = self.pairs[left << 20 | right] = self.merged(pair[0] + pair[1]) == pair
        return found

    def unit_ids(self, unit: str) -> list[int]:
        """Ids of a stretch of text that no piece reaches out of."""
        size, known, lengths = len(unit), self.pairs, self.chars
        last = [-1] * (size + 1)  # the last token of each prefix; -1: a character without piece
        filled = -1  # the position that has its entry already
        for at, number in self.automaton.iter(unit):
            if filled == at:
                continue
            chars = lengths[number]
            previous = last[at + 1 - chars]
            if previous >= 0:
                fits = known.get(previous << 20 | number)
                if fits is None:
                    fits = self.compatible(previous, number)
                if not fits:
                    continue
            last[at + 1], filled = number, at
        ids, at = [], size
        while at > 0:
            number = last[at]
            if number >= 0:
                ids.append(number)
                at -= lengths[number]
            else:
                at -= 1
                ids.extend(self.bytes[value] for value in reversed(unit[at].encode()))
        ids.reverse()
        return ids

    def encode(self, text: str) -> bytes:
        """All ids of a text with begin and end, packed as little-endian 32-bit numbers."""
        ends = [pack([self.begin]), pack([self.end])]
        if not text:
            return b"".join(ends)
        units = self.cut.findall(SPACE + text.replace(" ", SPACE))
        return b"".join([ends[0], *map(self.units.__getitem__, units), ends[1]])

    def decode(self, packed: bytes) -> str:
        """The text of packed ids; bytes that are no UTF-8 become U+FFFD one by one."""
        ids = np.frombuffer(packed, PACKED).tolist()
        joined = b"".join(map(self.spellings.__getitem__, ids))
        first = next((number for number in ids if number not in self.control), None)
        if first is not None and self.pieces[first].startswith(SPACE):
            joined = joined[1:]
        return joined.decode("utf-8", "one_by_one")


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    return PieceModel(path)


def encoded(text: Column, model_path: str) -> Column:
    """Packed ids of a text column; null is encoded like an empty text."""

    @F.pandas_udf("binary")
    def encode(texts: pd.Series) -> pd.Series:
        model = piece_model(model_path)
        return texts.map(lambda text: model.encode(text or ""))

    return encode(text)


def decoded(ids: Column, model_path: str) -> Column:
    """Texts of a column of packed ids; null stands for no ids."""

    @F.pandas_udf("string")
    def decode(column: pd.Series) -> pd.Series:
        model = piece_model(model_path)
        return column.map(lambda ids: model.decode(ids or b""))

    return decode(ids)


def encode_documents(
    docs: DataFrame, model_path: str, text_col: str = "text"
) -> DataFrame:
    """All columns of ``docs`` with ``token_ids`` (packed), ``n_tokens`` and ``decoded``.

    Ids carry the begin and end ids. Null and empty texts have these two only and decode to an
    empty text. One pass over the rows without a shuffle; encoder and decoder run in the same
    Arrow batches. Columns named like a result are replaced.
    """

    @F.pandas_udf("ids binary, text string")
    def round_trip(texts: pd.Series) -> pd.DataFrame:
        model = piece_model(model_path)
        ids = [model.encode(text or "") for text in texts]
        return pd.DataFrame({"ids": ids, "text": [model.decode(packed) for packed in ids]})

    results = {"token_ids", "n_tokens", "decoded", "_trip"}
    kept = [F.col(f"`{name}`") for name in docs.columns if name.lower() not in results]
    trip = docs.select(*kept, round_trip(F.col(f"`{text_col}`")).alias("_trip"))
    return trip.select(
        *kept,
        F.col("_trip.ids").alias("token_ids"),
        (F.octet_length("_trip.ids") / 4).cast("long").alias("n_tokens"),
        F.col("_trip.text").alias("decoded"),
    )
