"""Cheapest repair of a conversation's structure, streamed over sorted rows.

Rows go to their conversation's task and are sorted by turn (NULLs first, then role and text).
A task reads them as Arrow batches and carries, from row to row and batch to batch, one entry for
each role a repaired conversation may end with: the cost so far, the place of its edits among the
others' in text order, and a running digest of the repaired text. Of equally cheap edits the
least in text order stays. The moves of a row are one small number; they are kept to read the
edits back, in a file of the task beyond ``HELD`` rows. So a giant conversation costs its task
time, but no more memory than a small one, apart from its edits, which are one letter a row.

Edits: Keep costs 0, Rerole to user or assistant 2, Delete 3 and must be done to blank rows and
duplicates, Insert of an empty user or assistant row 2; a truncated row that stays costs 1. The
roles' initials then read ``(s?(ua)+)?``. A row whose role begins otherwise cannot be kept as is.

NULL roles and texts count as one space. A NULL conversation id is a conversation of its own.
Rows equal in all columns are duplicates after the first. Without rows, counts are 0 and the
texts empty. Gaps stop at the largest bigint. Other columns are not read, so they never clash.
"""

from __future__ import annotations

import hashlib
import tempfile
from array import array
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# What the edits cost.
DELETE, REROLE, INSERT, TRUNCATED = 3, 2, 2, 1
# Fixed value: the white space that makes a text blank.
BLANK = " \t\n\x0b\f\r"
HELD = 1 << 20
LARGEST = (1 << 63) - 1

# What a repaired conversation ends with so far.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NAMES = {USER: "user", ASSISTANT: "assistant"}
# How much dearer a state may be than another one that can do all it can, before it is given up.
LIMITS = ((NOTHING, ASSISTANT, DELETE), (SYSTEM, ASSISTANT, 0), (USER, ASSISTANT, INSERT), (ASSISTANT, USER, INSERT))
START = ((0, 0), None, None, None)
KINDS = ("plain", "truncated", "deleted")


def damaged(messages: DataFrame) -> DataFrame:
    """The rows with damage that follows a checksum of conversation and turn.

    Of twenty checksums 0 drops the row (``gone``), 1 empties its text, 2 takes its full stops,
    exclamation and question marks, 3 repeats it, and 4 makes it the user's.
    """
    code = F.crc32(F.concat(_spaced("conv_id"), F.lit(":"), _spaced("turn")).cast("binary")) % 20
    text, role = _spaced("text"), _spaced("role")
    return (
        messages.select("conv_id", F.col("turn").cast("bigint").alias("turn"), role.alias("_role"), text.alias("_text"), code.alias("_code"))
        .select(
            "conv_id",
            "turn",
            F.when(F.col("_code") == 4, "user").otherwise(F.col("_role")).alias("role"),
            F.when(F.col("_code") == 1, "").when(F.col("_code") == 2, F.translate("_text", ".!?", "")).otherwise(F.col("_text")).alias("text"),
            (F.col("_code") == 0).alias("gone"),
            F.explode(F.when(F.col("_code") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy"),
        )
        .drop("_copy")
    )


def _spaced(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def _rows(messages: DataFrame) -> DataFrame:
    """Rows of one conversation in one task, each with its fault; nothing is shuffled twice."""
    gone = F.col("gone") if "gone" in messages.columns else F.lit(False)
    rows = messages.select(
        F.col("conv_id").isNotNull().alias("known"),
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"),
        F.col("turn").cast("bigint").alias("turn"),
        _spaced("role").alias("role"),
        _spaced("text").alias("text"),
        F.coalesce(gone, F.lit(False)).alias("gone"),
    ).repartition("known", "conv")
    alike = Window.partitionBy("known", "conv", "gone", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    solid = F.rtrim(F.col("text"), F.lit(BLANK))
    fault = (
        F.when(F.col("gone"), "gone")
        .when(solid == "", "blank")
        .when(F.row_number().over(alike) > 1, "duplicate")
        .when(~F.right(solid, F.lit(1)).isin(".", "!", "?"), "truncated")
        .otherwise("")
    )
    return rows.withColumn("fault", fault)


def _candidates(role: str, fault: str) -> Iterator[tuple[int, str, int, int]]:
    """(state before, edits, state after, cost) of everything that can be done about a row.

    Inserts come in front of a row that stays. More than two only walk in a circle.
    """
    stays = TRUNCATED if fault == "truncated" else 0
    for state in (NOTHING, SYSTEM, USER, ASSISTANT):
        yield state, "D", state, DELETE
        if fault == "deleted":
            continue
        if role == "s" and state == NOTHING:
            yield state, "K", SYSTEM, stays
        at = state
        for inserts in range(3):
            after = ASSISTANT if at == USER else USER
            if role == NAMES[after][0]:
                yield state, "I" * inserts + "K", after, INSERT * inserts + stays
            yield state, "I" * inserts + "R", after, INSERT * inserts + REROLE + stays
            at = after


class Machine:
    """Steps between tuples of (cost above the least, place in text order) per state, remembered.

    No two states' edits begin alike up to the last row, so places decide between them.
    """

    def __init__(self) -> None:
        self.numbers: dict[tuple, int] = {}
        self.steps: list[tuple[tuple, int, tuple]] = []

    def step(self, state: tuple, role: str, fault: str) -> int:
        """The number of the step: (state after, cost, (state before, edits) for each state)."""
        key = (state, role, fault)
        number = self.numbers.get(key)
        if number is None:
            number = self.numbers[key] = len(self.steps)
            self.steps.append(self._computed(state, role, fault))
        return number

    def _computed(self, state: tuple, role: str, fault: str) -> tuple[tuple, int, tuple]:
        best: list[tuple | None] = [None] * 4
        for before, edits, after, cost in _candidates(role, fault):
            if state[before] is not None:
                found = (state[before][0] + cost, state[before][1], edits, before)
                if best[after] is None or found < best[after]:
                    best[after] = found
        for this, other, limit in LIMITS:
            if best[this] and best[other] and best[this][0] > best[other][0] + limit:
                best[this] = None
        order = sorted((b[1:3], s) for s, b in enumerate(best) if b)
        places = {s: place for place, (_, s) in enumerate(order)}
        least = min(b[0] for b in best if b)
        after = tuple((b[0] - least, places[s]) if b else None for s, b in enumerate(best))
        return after, least, tuple((b[3], b[2]) if b else None for b in best)


class Trail:
    """The numbers of a conversation's steps: the last ones in memory, earlier ones in a file."""

    def __init__(self) -> None:
        self.last = array("H")
        self.file, self.blocks = None, 0

    def add(self, number: int) -> None:
        self.last.append(number)
        if len(self.last) == HELD:
            if self.file is None:
                self.file = tempfile.TemporaryFile(prefix="revlens-trail-")
            self.last.tofile(self.file)
            self.last, self.blocks = array("H"), self.blocks + 1

    def back(self) -> Iterator[array]:
        """The blocks, last one first."""
        yield self.last
        for block in reversed(range(self.blocks)):
            numbers = array("H")
            self.file.seek(block * HELD * numbers.itemsize)
            numbers.fromfile(self.file, HELD)
            yield numbers
        if self.file is not None:
            self.file.close()


class Conversation:
    """All that is carried from row to row."""

    def __init__(self, machine: Machine):
        self.machine, self.trail = machine, Trail()
        self.state, self.cost = START, 0
        self.texts = [hashlib.sha256(), None, None, None]
        self.initial = None
        self.low = self.high = None
        self.turns = 0
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}

    def add(self, turn: int | None, role: str, text: str | None, fault: str) -> None:
        if turn is not None:
            if self.low is None:
                self.low = turn
            if turn != self.high:
                self.turns += 1
            self.high = turn
        if self.initial is not None and self.initial + role[:1] not in ("su", "ua", "au"):
            self.counts["illegal"] += 1
        self.initial = role[:1]
        if fault:
            self.counts[fault] += 1
        kind = "deleted" if fault in ("blank", "duplicate") else fault
        number = self.machine.step(self.state, role[:1] if role[:1] in ("s", "u", "a") else "", kind)
        self.state, cost, moves = self.machine.steps[number]
        self.cost += cost
        self.trail.add(number)
        if kind != "deleted":
            said = text.encode()
            self.texts = [self._said(s, role, said, *moves[s]) if moves[s] else None for s in range(4)]

    def _said(self, state: int, role: str, text: bytes, before: int, edits: str):
        """The digest of the text that ends in ``state``; one that stays alike is shared."""
        if edits == "D":
            return self.texts[before]
        digest = self.texts[before].copy()
        lead, at = b"" if before == NOTHING else b"\n", before
        for edit in edits:
            at = ASSISTANT if at == USER else USER
            if edit == "I":
                digest.update(lead + NAMES[at].encode() + b":")
            else:
                name = role if edit == "K" else NAMES[state]
                digest.update(lead + name.encode() + b":")
                digest.update(text)
            lead = b"\n"
        return digest

    def done(self) -> tuple:
        """(gaps, blank, duplicate, truncated, illegal, cost, audit, digest of the repaired text)."""
        endings = ((NOTHING, ""), (SYSTEM, "II"), (USER, "I"), (ASSISTANT, ""))
        found = [(self.state[s][0] + INSERT * len(e), self.state[s][1], e, s) for s, e in endings if self.state[s]]
        cost, _, ending, state = min(found)
        digest, at = self.texts[state].copy(), state
        for _ in ending:
            at = ASSISTANT if at == USER else USER
            digest.update(b"\n" + NAMES[at].encode() + b":")
        parts = [ending]
        for block in self.trail.back():
            edits = []
            for number in reversed(block):
                state, edit = self.machine.steps[number][2][state]
                edits.append(edit)
            parts.append("".join(reversed(edits)))
        gaps = 0 if self.low is None else min(self.high - self.low + 1 - self.turns, LARGEST)
        return (gaps, *self.counts.values(), self.cost + cost, "".join(reversed(parts)), digest.hexdigest())


REPORT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


def repair(messages: DataFrame) -> DataFrame:
    """One row per conversation: its faults, and the cheapest edits that give it a right structure.

    Takes conv_id, turn, role, text, and optionally a flag ``gone`` for rows that are lost already;
    a conversation of such rows only is listed too. ``audit`` has one letter for each edit.
    """
    rows = _rows(messages).sortWithinPartitions("known", "conv", F.col("turn").asc_nulls_first(), "role", "text")
    needs_text = F.col("fault").isin("", "truncated")
    streamed = rows.select(
        "known", "conv", F.col("turn").isNotNull().alias("timed"), F.coalesce("turn", F.lit(0)).alias("turn"),
        "role", F.when(needs_text, F.col("text")).otherwise("").alias("text"), "fault",
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine, key, open_one, ended = Machine(), None, None, []
        names = ["known", "conv", *(field.split(" ")[0] for field in REPORT.split(", "))]
        for batch in batches:
            for known, conv, timed, turn, role, text, fault in zip(*(batch[c].tolist() for c in batch.columns)):
                if key != (known, conv):
                    if open_one is not None:
                        ended.append((*key, *open_one.done()))
                    key, open_one = (known, conv), Conversation(machine)
                if fault != "gone":
                    open_one.add(turn if timed else None, role, text, fault)
            if ended:
                yield pd.DataFrame(ended, columns=names)
                ended = []
        if open_one is not None:
            yield pd.DataFrame([(*key, *open_one.done())], columns=names)

    report = streamed.mapInPandas(run, f"known boolean, conv string, {REPORT}")
    kind = messages.schema["conv_id"].dataType
    return report.select(F.when(F.col("known"), F.col("conv").cast(kind)).alias("conv_id"), *report.columns[2:])


def repaired_rows(messages: DataFrame, report: DataFrame) -> DataFrame:
    """(conv_id, place, role, text, edit): the conversations with the edits of ``report`` made.

    ``messages`` are those that were given to ``repair``. Inserted rows have an empty text.
    """
    order = Window.partitionBy("known", "conv").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = _rows(messages).where("not gone").select("known", "conv", F.row_number().over(order).alias("row"), "role", "text")
    edits = report.select(
        F.col("conv_id").isNotNull().alias("known"),
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"),
        "conv_id",
        F.posexplode(F.filter(F.split("audit", ""), lambda e: e != "")).alias("at", "edit"),
    )
    so_far = Window.partitionBy("known", "conv").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    numbered = edits.withColumn("row", F.count_if(F.col("edit") != "I").over(so_far).cast("int")).withColumn("place", F.count_if(F.col("edit") != "D").over(so_far))
    met = numbered.where("edit <> 'D'").join(rows, ["known", "conv", "row"], "left")
    first = Window.partitionBy("known", "conv").orderBy("place")
    system = (F.first("edit").over(first) == "K") & F.first("role").over(first).startswith("s")
    turn_of = F.when((F.col("place") - F.col("system").cast("int")) % 2 == 1, "user").otherwise("assistant")
    kept = F.col("edit") == "K"
    return met.withColumn("system", system).select(
        "conv_id", "place", F.when(kept, F.col("role")).otherwise(turn_of).alias("role"), F.when(F.col("edit") == "I", "").otherwise(F.col("text")).alias("text"), "edit"
    )
