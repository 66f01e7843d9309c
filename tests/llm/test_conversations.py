"""Conversation repair against a search over all edits."""

import hashlib
import heapq
import random
import re
import zlib

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablework.llm import conversations
from tablework.llm.conversations import conversation_reports, repair_conversations
from tablework.llm.queries import damaged, op11_conversation_repair

SCHEMA = "conv_id long, turn long, role string, text string, copy string, fault string"
WHOLE = re.compile(r"(s?(ua)+)?")
PARTIAL = re.compile(r"(s?(ua)*u?)?")


def damage(rows):
    for conv, turn, role, text in rows:
        name = [" " if value is None else str(value) for value in (conv, turn)]
        fate = zlib.crc32(":".join(name).encode()) % 20
        role, text = [" " if value is None else value for value in (role, text)]
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        yield from [(conv, turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)


def cheapest(rows):
    """The cheapest edits by uniform-cost search over (rows done, initials so far)."""
    heap, settled = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, at, initials, left = heapq.heappop(heap)
        # All that matters of the initials is whether and how they may go on.
        state = (at, len(initials) > 0, initials[-1:])
        if state in settled:
            continue
        settled.add(state)
        if at == len(rows) and WHOLE.fullmatch(initials):
            return cost, audit, left
        choices = []
        if at < len(rows):
            role, text, fault = rows[at]
            flaw = fault == "truncated"
            choices.append((3, "D", 1, "", ()))
            if fault not in ("blank", "duplicate"):
                if role:
                    choices.append((flaw, "K", 1, role[0], ((role, text),)))
                for other in ("user", "assistant"):
                    choices.append((2 + flaw, "R", 1, other[0], ((other, text),)))
        for other in ("user", "assistant"):
            choices.append((2, "I", 0, other[0], ((other, ""),)))
        for more, letter, step, initial, kept in choices:
            if PARTIAL.fullmatch(initials + initial):
                heapq.heappush(
                    heap, (cost + more, audit + letter, at + step, initials + initial, left + kept)
                )


def report(rows):
    """What the query returns for one conversation's damaged rows."""
    rows = sorted(rows, key=lambda row: (row[1] is not None, row[1] or 0, row[2], row[3]))
    seen, judged, faults = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
    for _, _, role, text in rows:
        stripped = text.rstrip(" \t\n\x0b\x0c\r")
        fault = None
        if not stripped:
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        elif stripped[-1] not in ".!?":
            fault = "truncated"
        seen.add((role, text))
        if fault:
            faults[fault] += 1
        judged.append((role, text, fault))
    turns = {row[1] for row in rows} - {None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, left = cheapest(judged)
    text = "\n".join(f"{role}:{line}" for role, line in left)
    return (gaps, *faults.values(), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def expected(rows):
    groups = {row[0]: [] for row in rows}
    for row in damage(rows):
        groups[row[0]].append(row)
    return {conv: report(group) for conv, group in groups.items()}


def got(reports):
    rows = [tuple(row) for row in reports.collect()]
    found = {row[0]: row[1:] for row in rows}
    assert len(found) == len(rows)
    return found


@pytest.fixture(scope="module")
def odd_rows():
    dice = random.Random(11)
    texts = ["Yes.", "No!", "Why?", "cut", "", " \t\n", None, "Long " * 4000 + ".", "é ▁ 😀", "a.\x0b"]
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "tool", "User", "union"]
    rows = []
    for conv in range(400):
        for turn in range(dice.randrange(9)):
            turn = dice.choice([turn, turn, turn, turn * 3, None, -turn])
            rows.append((conv, turn, dice.choice(roles), dice.choice(texts)))
    rows += [(None, turn, "user", "Who?") for turn in (0, 1, 1, None)]
    rows += rows[:200]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*row, "x", "y") for row in rows], SCHEMA).repartition(5)


def test_damaged_conversations_by_search(spark, odd_rows):
    df = frame(spark, odd_rows)
    assert got(conversation_reports(damaged(df), present_col="present")) == expected(odd_rows)


def test_given_conversations_by_search(spark, sf_dir):
    rows = [tuple(row) for row in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()]
    assert got(op11_conversation_repair(spark, sf_dir)) == expected(rows)


def test_giant_conversations_spill(monkeypatch):
    dice = random.Random(12)
    words = ["Fine.", "cut", "Really?", "Well, that is so.", " "]
    giant = [(7, t, dice.choice(["user", "assistant"]), dice.choice(words) * (t % 13)) for t in range(3000)]
    monkeypatch.setattr(conversations, "HELD_ROWS", 50)
    wanted, seen, judged = report(giant), set(), []
    for _, turn, role, text in giant:
        end = text.rstrip()[-1:]
        fault = conversations.SOUND if end and end in ".!?" else conversations.TRUNCATED
        fault = conversations.DUPLICATE if (role, text) in seen else fault
        fault = fault if end else conversations.BLANK
        seen.add((role, text))
        judged.append(("7", str(turn), role, text, fault))
    stream = pd.DataFrame(judged[::-1], columns=["conv_id", "turn", "role", "text", "fault"])
    batches = [stream[at : at + 64] for at in range(0, len(stream), 64)]
    (found,) = pd.concat(conversations.streamed("report_rows")(iter(batches))).to_numpy().tolist()
    assert tuple(found) == ("7", *wanted)
    edits = pd.concat(conversations.streamed("edit_rows")(iter(batches)))
    assert "".join(edits["edit"]) == wanted[-2]


def test_edits_give_the_repaired_rows(spark, odd_rows):
    df = frame(spark, odd_rows)
    reports = got(conversation_reports(df))
    edits = repair_conversations(df)
    assert edits.columns == ["conv_id", "position", "edit", "fault", "turn", "role", "text"]
    groups = {}
    for row in edits.orderBy("conv_id", "position").collect():
        groups.setdefault(row.conv_id, []).append(row)
    assert set(groups) <= set(reports)
    for conv, (*_, audit, digest) in reports.items():
        rows = groups.get(conv, [])
        assert [row.position for row in rows] == list(range(len(rows)))
        assert "".join(row.edit for row in rows) == audit
        text = "\n".join(f"{row.role}:{row.text}" for row in rows if row.edit != "D")
        assert hashlib.sha256(text.encode()).hexdigest() == digest


def test_absent_rows_and_empty_tables(spark, odd_rows):
    df = frame(spark, odd_rows).limit(0)
    assert conversation_reports(df).count() == repair_conversations(df).count() == 0
    only = frame(spark, [(1, 0, "user", "Hm.")]).withColumn("there", F.lit(None).cast("boolean"))
    empty = hashlib.sha256(b"").hexdigest()
    found = got(conversation_reports(only, present_col="there"))
    assert found == {1: (0, 0, 0, 0, 0, 0, "", empty)}
    assert repair_conversations(only, present_col="there").count() == 0
