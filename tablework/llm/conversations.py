"""Repair of the turn structure of conversations by secondary-sorted streaming.

Rows are dealt by conversation and sorted by turn within it, and one pass of ``mapInPandas`` carries
the state of a dynamic program from one Arrow batch to the next. The rows come last turn first: the
state holds, for each place in the pattern ``(system? (user assistant)+)?``, what the rows seen so
far still cost from there. So the cheapest edits can be read off forwards afterwards, taking the
ASCII-least one wherever several cost the same. Each row leaves one byte behind, two bits per place
in the pattern: the edit chosen there. Conversations that outgrow their buffer spill these bytes and
their rows, block by block, to a temporary file of the task, which is read back from its end.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"
#: Rows and code points of a conversation that are held before they go to the task's file.
HELD_ROWS, HELD_CHARS = 4096, 1 << 22

# Places in the pattern: nothing yet, after a system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The place after a row with this initial; other rows can't be kept there.
KEEPS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER,
         (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: The place after the one row that a place lets be inserted or given a new role, and that role.
NEXT = (USER, USER, ASSISTANT, USER)
NEW_ROLE = ("user", "user", "assistant", "user")
#: Costs of what is missing where no rows are left: nothing, user and assistant, assistant, nothing.
COSTS_AT_END = (0, 4, 2, 0)
DELETE, INSERT, KEEP, REROLE = range(4)
LETTERS = "DIKR"
LEGAL = ("su", "ua", "au")

ABSENT, SOUND, BLANK, DUPLICATE, TRUNCATED = range(5)
FAULTS = (None, None, "blank", "duplicate", "truncated")

EDIT_SCHEMA = "conv_id string, position long, edit string, fault string, turn string, role string, text string"
REPORT_SCHEMA = (
    "conv_id string, gaps long, blank long, duplicate long, truncated long, illegal long, "
    "cost long, audit string, repaired_sha256 string"
)


def step_back(costs: tuple, initial: str, fault: int) -> tuple[tuple, int, int]:
    """Costs before a row from those behind it: differences to the least, the least, the edits."""
    flaw = 1 if fault == TRUNCATED else 0
    best = []
    for place in range(4):
        choices = [(3 + costs[place], DELETE)]
        if fault not in (BLANK, DUPLICATE):
            if (place, initial) in KEEPS:
                choices.append((flaw + costs[KEEPS[place, initial]], KEEP))
            choices.append((2 + flaw + costs[NEXT[place]], REROLE))
        best.append(min(choices))
    for place in (USER, ASSISTANT, USER, START, SYSTEM):  # inserting may go round once
        best[place] = min(best[place], (2 + best[NEXT[place]][0], INSERT))
    least = min(cost for cost, _ in best)
    edits = sum(edit << (2 * place) for place, (_, edit) in enumerate(best))
    return tuple(cost - least for cost, _ in best), least, edits


class Conversation:
    """The rows of one conversation, last turn first, and the state of its dynamic program."""

    def __init__(self, key: str | None, steps: dict):
        self.key, self.steps = key, steps
        self.costs, self.total = COSTS_AT_END, 0
        self.faults = [0] * 5
        self.illegal = self.n_turns = 0
        self.least_turn = self.last_turn = self.later_initial = None
        self.rows, self.edits, self.chars = [], bytearray(), 0
        self.file, self.places = None, []

    def add(self, turn: str | None, role: str, text: str, fault: int) -> None:
        initial = role[:1]
        change = self.steps.get((self.costs, initial, fault))
        if change is None:
            change = self.steps[self.costs, initial, fault] = step_back(self.costs, initial, fault)
        self.costs, more, edits = change
        self.total += more
        self.faults[fault] += 1
        if self.later_initial is not None and initial + self.later_initial not in LEGAL:
            self.illegal += 1
        self.later_initial = initial
        if turn is not None and turn != self.least_turn:
            self.n_turns += 1
            self.least_turn = turn
            self.last_turn = self.last_turn or turn
        self.edits.append(edits)
        self.rows.append((turn, role, text, fault))
        self.chars += len(text)
        if len(self.rows) >= HELD_ROWS or self.chars >= HELD_CHARS:
            self.spill()

    def spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.places.append(self.file.tell())
        pickle.dump((self.rows, bytes(self.edits)), self.file, pickle.HIGHEST_PROTOCOL)
        self.rows, self.edits, self.chars = [], bytearray(), 0

    def forwards(self) -> Iterator[tuple]:
        """``(turn, role, text, fault, edits)`` from the first turn to the last."""
        yield from ((*row, edits) for row, edits in zip(self.rows[::-1], self.edits[::-1]))
        for place in reversed(self.places):
            self.file.seek(place)
            rows, edits = pickle.load(self.file)
            yield from ((*row, edit) for row, edit in zip(rows[::-1], edits[::-1]))

    def repaired(self) -> Iterator[tuple]:
        """``(letter, fault, turn, role, text)`` per edit; a deleted row keeps role and text."""
        place = START
        for turn, role, text, fault, edits in self.forwards():
            while (edit := edits >> (2 * place) & 3) == INSERT:
                yield "I", None, None, NEW_ROLE[place], ""
                place = NEXT[place]
            if edit == REROLE:
                role, place = NEW_ROLE[place], NEXT[place]
            elif edit == KEEP:
                place = KEEPS[place, role[:1]]
            yield LETTERS[edit], FAULTS[fault], turn, role, text
        while COSTS_AT_END[place]:
            yield "I", None, None, NEW_ROLE[place], ""
            place = NEXT[place]
        if self.file is not None:
            self.file.close()

    def edit_rows(self) -> Iterator[tuple]:
        for position, edit in enumerate(self.repaired()):
            yield (self.key, position, *edit)

    def report_rows(self) -> Iterator[tuple]:
        letters, digest, joint = bytearray(), hashlib.sha256(), b""
        for letter, _, _, role, text in self.repaired():
            letters += letter.encode()
            if letter != "D":
                digest.update(joint + f"{role}:{text}".encode())
                joint = b"\n"
        gaps = 0
        if self.n_turns:
            gaps = int(self.last_turn) - int(self.least_turn) + 1 - self.n_turns
        yield (
            self.key, gaps, *self.faults[BLANK:], self.illegal, self.total + self.costs[START],
            letters.decode(), digest.hexdigest(),
        )


def streamed(result: str):
    """A function for ``mapInPandas`` over sorted rows; ``result`` names the rows it gives."""
    schema = EDIT_SCHEMA if result == "edit_rows" else REPORT_SCHEMA
    names = [field.split()[0] for field in schema.split(", ")]

    def conversations(batches: Iterator[pd.DataFrame]) -> Iterator[Conversation]:
        steps: dict = {}
        current = waiting = None
        for batch in batches:
            columns = ("conv_id", "turn", "role", "text", "fault")
            for key, *row in zip(*(batch[name].tolist() for name in columns)):
                if current is None or key != current.key:
                    if waiting is not None:
                        current.add(*waiting)
                    if current is not None:
                        yield current
                    current, waiting = Conversation(key, steps), None
                if row[-1] == ABSENT:
                    continue
                if waiting is not None:
                    if waiting[:-1] == row[:-1] and waiting[-1] != BLANK:
                        waiting[-1] = DUPLICATE
                    current.add(*waiting)
                waiting = row
        if waiting is not None:
            current.add(*waiting)
        if current is not None:
            yield current

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, chars = [], 0
        for conversation in conversations(batches):
            for row in getattr(conversation, result)():
                out.append(row)
                chars += len(row[-2]) + len(row[-1])
                if len(out) >= HELD_ROWS or chars >= HELD_CHARS:
                    yield pd.DataFrame(out, columns=names, dtype=object)
                    out, chars = [], 0
        if out:
            yield pd.DataFrame(out, columns=names, dtype=object)

    return run


def judged_rows(df: DataFrame, conv_col, turn_col, role_col, text_col, present_col) -> DataFrame:
    """``conv_id, turn, role, text, fault``: every row with its first fault.

    The earliest turn of each repeated role and text comes from one aggregation, which combines
    before the shuffle, and only digests that occur again are joined back. Rows equal to another
    one of the same turn stand side by side in the sorted stream, which finds them.
    """
    present = F.lit(True)
    if present_col is not None:
        present = F.coalesce(F.col(f"`{present_col}`"), F.lit(False))
    rows = df.select(
        F.col(f"`{conv_col}`").cast("string").alias("conv_id"),
        F.col(f"`{turn_col}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(" ")).alias("text"),
        present.alias("present"),
    )
    end = F.substring(F.rtrim(F.col("text"), F.lit(BLANKS)), -1, 1)
    rows = rows.select(
        "conv_id",
        "turn",
        *[F.when(F.col("present"), F.col(c)).otherwise("").alias(c) for c in ("role", "text")],
        F.when(~F.col("present"), ABSENT)
        .when(end == "", BLANK)
        .when(end.isin(".", "!", "?"), SOUND)
        .otherwise(TRUNCATED)
        .alias("fault"),
        F.sha2(F.concat(F.length("role"), F.lit(":"), "role", "text"), 256).alias("digest"),
    )
    order = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn"))
    open_to_judge = F.col("fault").isin(SOUND, TRUNCATED)
    repeated = (
        rows.where(open_to_judge)
        .groupBy("conv_id", "digest")
        .agg(F.min(order).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select(F.col("conv_id").alias("of"), F.col("digest").alias("seen"), "first")
    )
    same = F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("seen"))
    return rows.join(repeated, same & open_to_judge, "left").select(
        "conv_id", "turn", "role", "text",
        F.when(order > F.col("first"), DUPLICATE).otherwise(F.col("fault")).alias("fault"),
    )


def _stream(df, conv_col, turn_col, role_col, text_col, present_col, result, schema) -> DataFrame:
    rows = judged_rows(df, conv_col, turn_col, role_col, text_col, present_col)
    last_first = [F.col("turn").desc_nulls_last(), F.col("role").desc(), F.col("text").desc()]
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", *last_first)
    ordered = ordered.withColumn("turn", F.col("turn").cast("string"))
    return ordered.mapInPandas(streamed(result), schema)


def repair_conversations(
    df: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    present_col: str | None = None,
) -> DataFrame:
    """``conv_id, position, edit, fault, turn, role, text``: the cheapest repair, edit by edit.

    Edits are Keep, Rerole, Delete and Insert, by their initials; without the deleted rows,
    role and text in the order of ``position`` are the repaired conversation. Keeping costs 0, a new
    role (user or assistant) 2, deleting 3, inserting an empty user or assistant row 2, and an
    undeleted truncated row 1 more. Blank and duplicate rows must go. The initials of the roles left
    form ``(s?(ua)+)?``. Among equally cheap repairs the ASCII-least one is taken.

    Rows stand by turn, unknown turns first, those of one turn by role and text. A row's first fault
    counts: blank, duplicate (role and text as in an earlier row; of equal rows the first stays) or
    truncated (no ``.``, ``!`` or ``?`` at its end). A null role or text is one space, so such a text
    is blank, and such a role is never kept; neither is an empty one. Rows without ``conv_col`` are
    one conversation. Rows whose ``present_col`` is not true only make their conversation known.
    Other columns stay out, and an empty table gives an empty result. Texts may have any length and
    conversations any number of rows: what a task holds is bounded, the rest goes to its own
    temporary file. One conversation is one task's work, as its repair is one sequence.
    """
    edits = _stream(
        df, conv_col, turn_col, role_col, text_col, present_col, "edit_rows", EDIT_SCHEMA
    )
    return edits.withColumns(
        {
            "conv_id": F.col("conv_id").cast(df.schema[conv_col].dataType),
            "turn": F.col("turn").cast("long"),
        }
    )


def conversation_reports(
    df: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    present_col: str | None = None,
) -> DataFrame:
    """One row per conversation: its faults, the cost of its repair, its edits and what is left.

    ``gaps`` are turns missing between the least and the largest, unknown ones aside; ``illegal``
    counts neighbouring rows whose roles' initials are not ``su``, ``ua`` or ``au``. ``audit`` has
    the edits' letters of :func:`repair_conversations`, by whose rules and from whose stream it
    comes, and ``repaired_sha256`` is the hash of the lines ``role:text`` left. A conversation
    without present rows has zeros, an empty audit and the hash of the empty string.
    """
    reports = _stream(
        df, conv_col, turn_col, role_col, text_col, present_col, "report_rows", REPORT_SCHEMA
    )
    return reports.withColumn("conv_id", F.col("conv_id").cast(df.schema[conv_col].dataType))
