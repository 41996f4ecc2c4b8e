"""Conversation repair against a plain search over all edits."""

import hashlib
import random
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from revlens.llm import conversation_repair as repair
from revlens.llm import queries

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
WHITE = " \t\n\x0b\f\r"


def damage(rows):
    """(conv, turn, role, text) rows after damage, and all conversations."""
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        code = zlib.crc32(key.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if code == 1:
            text = ""
        if code == 2:
            text = "".join(c for c in text if c not in ".!?")
        if code == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    return out, {r[0] for r in rows}


def in_order(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))


def cheapest(rows, faults):
    """The least (cost, edits) by trying inserts anywhere, from the end to the start."""
    roles = [r[2][:1] for r in rows]

    @lru_cache(None)
    def best(i, end, inserts):
        found = []
        if i == len(rows) and end in ("", "a"):
            found.append((0, ""))
        if i < len(rows):
            stays = 1 if faults[i] == "truncated" else 0
            rest = best(i + 1, end, 0)
            found.append((rest[0] + 3, "D" + rest[1]))
            if faults[i] not in ("blank", "duplicate"):
                allowed = {"": "su", "s": "u", "u": "a", "a": "u"}[end]
                for role in allowed:
                    if roles[i] == role:
                        rest = best(i + 1, role, 0)
                        found.append((rest[0] + stays, "K" + rest[1]))
                    if role != "s":
                        rest = best(i + 1, role, 0)
                        found.append((rest[0] + stays + 2, "R" + rest[1]))
        if inserts < 3:
            role = "a" if end == "u" else "u"
            rest = best(i, role, inserts + 1)
            found.append((rest[0] + 2, "I" + rest[1]))
        return min(found) if found else (10**9, "")

    for i in reversed(range(len(rows) + 1)):
        for end in ("", "s", "u", "a"):
            best(i, end, 0)
    return best(0, "", 0)


def apply(rows, edits):
    out, i = [], 0
    for edit in edits:
        nxt = "assistant" if out and out[-1][0][:1] == "u" else "user"
        if edit == "I":
            out.append((nxt, ""))
            continue
        if edit == "K":
            out.append((rows[i][2], rows[i][3]))
        if edit == "R":
            out.append((nxt, rows[i][3]))
        i += 1
    return out


def expected(rows):
    after, convs = damage(rows)
    result = {}
    for conv in convs:
        mine = in_order([r for r in after if r[0] == conv])
        seen, faults = set(), []
        for _, _, role, text in mine:
            solid = text.rstrip(WHITE)
            if not solid:
                faults.append("blank")
            elif (role, text) in seen:
                faults.append("duplicate")
            else:
                faults.append("" if solid[-1] in ".!?" else "truncated")
            seen.add((role, text))
        turns = {r[1] for r in mine if r[1] is not None}
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(mine, mine[1:])]
        cost, audit = cheapest(mine, faults)
        said = "\n".join(f"{r}:{t}" for r, t in apply(mine, audit))
        result[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256(said.encode()).hexdigest(),
        )
    return result


def random_rows(seed, convs=60):
    pick = random.Random(seed)
    roles = ["system", "user", "user", "assistant", "assistant", "tool", "", None, "sage", "usher"]
    texts = ["A b.", "why?", "so", "no!", "", "  \n", None, "x" * 50, "end. \t", "é日.", "A b."]
    rows = []
    for conv in [None, *range(convs)]:
        for turn in range(pick.randint(1, 9)):
            t = pick.choice([turn, turn, turn, turn * 3, None, 2])
            rows += [(conv, t, pick.choice(roles), pick.choice(texts))] * pick.choice([1, 1, 1, 2])
    return rows


def reported(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_search_over_all_edits(spark, seed):
    rows = random_rows(seed)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    extra = frame.withColumns({"known": F.lit(1), "conv": F.lit(2), "fault": F.lit("x"), "gone_by": F.lit(3)})
    assert reported(repair.repair(repair.damaged(extra))) == expected(rows)


def test_registered_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert reported(queries.QUERIES["op11_conversation_repair"](spark, folder)) == expected(rows)


def test_giant_conversation_over_many_batches(spark):
    pick = random.Random(5)
    rows = [(7, i, pick.choice(["user", "assistant", "system"]), pick.choice(["a.", "b", f"{i}.", f"{i}", ""])) for i in range(3000)]
    rows.append((8, 1, "user", "y" * 2_000_000 + "."))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        assert reported(repair.repair(repair.damaged(spark.createDataFrame(rows, SCHEMA)))) == expected(rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_moves_in_a_file_give_the_same_edits(monkeypatch):
    monkeypatch.setattr(repair, "HELD", 16)
    pick = random.Random(6)
    rows = [(1, i, pick.choice(["user", "assistant", "system"]), f"{i}" + pick.choice([".", ""])) for i in range(160)]
    faults = ["" if r[3].endswith(".") else "truncated" for r in rows]
    one = repair.Conversation(repair.Machine())
    for (_, turn, role, text), fault in zip(rows, faults):
        one.add(turn, role, text, fault)
    assert one.trail.blocks == 10
    cost, audit = cheapest(rows, faults)
    assert one.done()[5:7] == (cost, audit)


def test_repaired_rows_are_those_of_the_digest(spark):
    rows = random_rows(9)
    after = repair.damaged(spark.createDataFrame(rows, SCHEMA))
    report = repair.repair(after)
    got = {}
    for r in sorted(repair.repaired_rows(after, report).collect(), key=lambda r: r.place):
        got.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for conv, values in reported(report).items():
        assert hashlib.sha256("\n".join(got.get(conv, [])).encode()).hexdigest() == values[-1]


def test_empty_table(spark):
    assert repair.repair(repair.damaged(spark.createDataFrame([], SCHEMA))).collect() == []


def test_lost_conversation_and_lone_turns(spark):
    dropped = next(t for t in range(1000) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    kept = next(t for t in range(1000) if zlib.crc32(f"2:{t}".encode()) % 20 > 4)
    rows = [(1, dropped, "user", "a."), (2, kept, "assistant", "b.")]
    got = reported(repair.repair(repair.damaged(spark.createDataFrame(rows, SCHEMA))))
    assert got[1] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got[2][4:] == (0, 2, "IK", hashlib.sha256(b"user:\nassistant:b.").hexdigest())
