"""Reply trees to training conversations, with DataFrame functions only.

Messages form trees by their parent's id. Iterative self-joins double the reach of every message
towards its root: after k rounds a message knows its ancestor 2^k steps up and the score on the
way, so a path of n messages takes about log2(n) rounds. Leaves are ranked by the score of their
whole branch, and the paths of the chosen ones are enumerated with the same tables. Each path is
formatted as one text with turn marks. Control strings inside texts are escaped so that they can
be told from marks and read back, and the loss mask is a list of byte ranges.

A NULL text or role is empty, a NULL score 0, a NULL tree a tree of its own. A message without
parent, or whose parent does not exist, is a root. Messages on a cycle, or below one, have no
root and are in no conversation. Repeated node ids within a tree: use ``as_chain`` or number
them first. Equal branch scores: the smaller leaf id first. An empty table gives no rows.
Any other columns are ignored. One conversation becomes one row, so it must fit in one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.llm.native import let
from revlens.llm.store import Workspace

# The turn marks of the template.
START, END = "<|im_start|>", "<|im_end|>\n"


def escaped(text: Column) -> Column:
    """No ``<|`` is left: a backslash is doubled, and one is put between ``<`` and ``|``."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def as_chain(rows: DataFrame, tree: str, order: str, role: str, text: str) -> DataFrame:
    """Flat conversations as trees: each turn replies to the one before it.

    Turns with the same number, or without one, are ordered by number (NULL first), role, text.
    """
    turns = Window.partitionBy(tree).orderBy(F.col(order).asc_nulls_first(), F.col(role).asc_nulls_first(), F.col(text).asc_nulls_first())
    return rows.select(
        F.col(tree).alias("tree"), F.row_number().over(turns).cast("bigint").alias("node"), F.col(role).alias("role"), F.col(text).alias("text")
    ).withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1)).withColumn("score", F.lit(0.0))


def _climb(space: Workspace, nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """([ancestor 2^k steps up of every node that has one], (tree, node, total score of its branch))

    A node that has reached its root is put aside and only looked up from then on, so a round
    costs what still climbs and one long conversation doesn't make all others go on.
    """
    known = nodes.select("tree", F.col("node").alias("parent"), F.lit(True).alias("there"))
    state = space.put(
        nodes.join(known, ["tree", "parent"], "left").select("tree", "node", F.when(F.col("there"), F.col("parent")).alias("up"), F.col("score").alias("total"))
    )
    limit, jumps, arrived = state.count(), [], []
    while True:
        climbing = state.where("up is not null")
        arrived.append(state.where("up is null"))
        # Beyond the limit, what still climbs is on a cycle or below one.
        if climbing.isEmpty() or 1 << len(jumps) > limit:
            return jumps, reduce(DataFrame.union, arrived).select("tree", "node", "total")
        jumps.append(climbing.select("tree", "node", "up"))
        known = reduce(DataFrame.union, [climbing, *arrived])
        above = known.select("tree", F.col("node").alias("up"), F.col("up").alias("next"), F.col("total").alias("more"))
        state = space.put(
            climbing.join(above, ["tree", "up"], "left").select("tree", "node", F.col("next").alias("up"), (F.col("total") + F.coalesce("more", F.lit(0.0))).alias("total"))
        )


def conversations(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(tree, leaf, score, n_turns, formatted, loss) of the ``branches`` best branches of each tree.

    Takes columns tree, node, parent, role, text, score. ``loss`` lists the UTF-8 byte ranges
    (begin, end) of the assistant's texts in ``formatted``.
    """
    space = Workspace(messages.sparkSession)
    nodes = messages.select(
        F.coalesce(F.concat(F.lit("="), F.col("tree").cast("string")), F.lit("")).alias("tree"),
        F.col("tree").alias("given"),
        "node",
        "parent",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
    )
    nodes = space.put(nodes)
    jumps, totals = _climb(space, nodes)
    replied = nodes.select("tree", F.col("parent").alias("node")).where("node is not null")
    leaves = totals.join(replied, ["tree", "node"], "left_anti")
    best = Window.partitionBy("tree").orderBy(F.desc("total"), "node")
    chosen = leaves.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= branches)
    path = space.put(chosen.select("tree", F.col("node").alias("leaf"), "total", "node", F.lit(0).cast("bigint").alias("up_by")))
    for k in reversed(range(len(jumps))):
        higher = path.join(jumps[k], ["tree", "node"]).select("tree", "leaf", "total", F.col("up").alias("node"), F.col("up_by") + (1 << k))
        path = space.put(path.union(higher))
    role = F.replace(escaped(F.col("role")), F.lit("\n"), F.lit("\\\n"))
    head = F.concat(F.lit(START), role, F.lit("\n"))
    turns = path.join(nodes, ["tree", "node"]).select(
        "tree", "leaf", "given", "total", "up_by", head.alias("head"), escaped(F.col("text")).alias("body"), (F.col("role") == "assistant").alias("learned")
    )
    before = Window.partitionBy("tree", "leaf").orderBy(F.desc("up_by")).rowsBetween(Window.unboundedPreceding, -1)
    size = F.octet_length("head") + F.octet_length("body") + len(END)
    begin = F.coalesce(F.sum(size).over(before), F.lit(0)) + F.octet_length("head")
    placed = turns.withColumn("begin", begin).withColumn("end", F.col("begin") + F.octet_length("body"))
    parts = F.array_sort(F.collect_list(F.struct((-F.col("up_by")).alias("at"), F.concat("head", "body", F.lit(END)).alias("turn"), "learned", "begin", "end")))
    whole = placed.groupBy("tree", "leaf").agg(F.first("given").alias("given"), F.first("total").alias("score"), parts.alias("parts"))
    spans = F.transform(F.filter("parts", lambda p: p["learned"]), lambda p: F.struct(p["begin"].alias("begin"), p["end"].alias("end")))
    return whole.select(
        F.col("given").alias("tree"), "leaf", "score", F.size("parts").cast("bigint").alias("n_turns"),
        F.array_join(F.transform("parts", lambda p: p["turn"]), "").alias("formatted"), spans.alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds ``turns`` (role, text) and ``learned`` (the text under the loss mask), both unescaped."""
    pieces = F.filter(F.split("formatted", r"<\|im_end\|>\n"), lambda p: p != "")
    # The role ends at the first line feed behind an even number of backslashes.
    turn = r"(?s)^<\|im_start\|>(.*?(?<!\\)(?:\\\\)*)\n(.*)$"
    turns = F.transform(
        pieces, lambda p: F.struct(unescaped(F.regexp_extract(p, turn, 1)).alias("role"), unescaped(F.regexp_extract(p, turn, 2)).alias("text"))
    )
    cut = let(
        F.encode("formatted", "utf-8"),
        lambda raw: F.transform(F.col("loss"), lambda s: unescaped(F.decode(F.substring(raw, (s["begin"] + 1).cast("int"), (s["end"] - s["begin"]).cast("int")), "utf-8"))),
    )
    return formatted.withColumn("turns", turns).withColumn("learned", F.array_join(cut, ""))


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, from the formatted text alone: turns, digests and lengths."""
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read_back(formatted).select(
        F.col("tree").alias("conv_id"),
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.encode(spoken, "utf-8"), 256).alias("turns_sha256"),
        F.length("learned").cast("bigint").alias("loss_chars"),
        F.sha2(F.encode("learned", "utf-8"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
