"""Conversations from reply trees, formatted for training with a loss mask.

A node names the node it replies to. Jump tables, each made by joining the last one
with itself, lead 1, 2, 4, ... replies up; by them every leaf learns the score of its
branch and every chosen leaf its members, in a number of joins that grows with the
logarithm of the longest branch. Branches are ranked by mean score, ties by the
earlier leaf, and each chosen path is formatted as one conversation.

Format: each turn is ``### role: text</turn>`` and a line feed. Inside roles and texts
the characters the template is made of are written as ``\\b`` (backslash), ``\\l``
(less-than), ``\\h`` (number sign) and, in roles, ``\\c`` (colon), so no text can look
like a control string and every text comes back exactly. The loss mask is an array of
[start, end) code points of the formatted text: the texts of the trained role.

A null text or role is empty. A node whose parent is missing, null or itself is a
root; nodes on a cycle have no root and are on no path. Rows with equal ``turn`` are
ordered by role and text, repeated rows stay. Null conversation ids are one
conversation. Empty table: no conversations. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leaseload.llm.common import text_or_empty, written

HEAD = "### "
AFTER_ROLE = ": "
END = "</turn>\n"
TRAINED_ROLE = "assistant"
# Fixed escapes; the backslash goes first when writing and last when reading.
ESCAPES = (("\\", "\\b"), ("<", "\\l"), ("#", "\\h"))
ROLE_ESCAPES = (*ESCAPES, (":", "\\c"))


def escaped(text: Column, escapes: tuple = ESCAPES) -> Column:
    for plain, code in escapes:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column, escapes: tuple = ESCAPES) -> Column:
    for plain, code in reversed(escapes):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def reply_nodes(rows: DataFrame) -> DataFrame:
    """Nodes (conv_id, node, parent, role, text, score) of threads given as numbered turns.

    Each row replies to the one before it; longer texts score higher.
    """
    numbered = written(
        rows.select(
            "conv_id",
            "turn",
            text_or_empty("role").alias("role"),
            text_or_empty("text").alias("text"),
            F.monotonically_increasing_id().alias("node"),
        ),
        "chat-rows",
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text", "node")
    return numbered.select(
        "conv_id",
        "node",
        F.lag("node").over(order).alias("parent"),
        "role",
        "text",
        F.length("text").cast("double").alias("score"),
    )


def jump_tables(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Tables (node, up) leading 1, 2, 4, ... replies up, and (node, n, total) to the root.

    ``n`` counts the nodes of the branch down to ``node``, ``total`` sums their scores.
    """
    known = nodes.select(F.col("node").alias("up"), F.lit(True).alias("there"))
    linked = nodes.select("node", F.when(F.col("parent") != F.col("node"), F.col("parent")).alias("up"), "score")
    linked = linked.join(known, "up", "left")
    reach = written(
        linked.select(
            "node",
            F.when(F.col("there"), F.col("up")).alias("up"),
            F.lit(1).cast("bigint").alias("n"),
            F.col("score").alias("total"),
        ),
        "chat-jumps",
    )
    jumps = []
    # A branch without a cycle ends within as many doublings as the node count has bits.
    for _ in range(reach.count().bit_length() + 1):
        step = reach.filter("up is not null")
        if not step.limit(1).count():
            break
        jumps.append(step.select("node", "up"))
        above = reach.select(F.col("node").alias("up"), F.col("up").alias("up2"), F.col("n").alias("n2"), F.col("total").alias("total2"))
        doubled = step.join(above, "up").select(
            "node", F.col("up2").alias("up"), (F.col("n") + F.col("n2")).alias("n"), (F.col("total") + F.col("total2")).alias("total")
        )
        reach = written(doubled.unionByName(reach.filter("up is null")), "chat-jumps")
    return jumps, reach.filter("up is null").drop("up")


def chosen_paths(nodes: DataFrame, branches: int = 1) -> DataFrame:
    """(conv_id, leaf, back, role, text): members of the best branches of each conversation.

    ``back`` counts the replies between a member and the leaf.
    """
    jumps, reach = jump_tables(nodes)
    replied = nodes.filter("parent <> node").select(F.col("parent").alias("node"))
    leaves = nodes.join(replied, "node", "left_anti").select("conv_id", "node").join(reach, "node")
    ranked = leaves.withColumn(
        "place",
        F.row_number().over(
            Window.partitionBy("conv_id").orderBy((F.col("total") / F.col("n")).desc_nulls_last(), "node")
        ),
    )
    chosen = ranked.filter(F.col("place") <= branches)
    members = chosen.select("conv_id", F.col("node").alias("leaf"), "node", F.lit(0).cast("bigint").alias("back"))
    for power, jump in enumerate(jumps):
        further = members.join(jump, "node").select(
            "conv_id", "leaf", F.col("up").alias("node"), (F.col("back") + (1 << power)).alias("back")
        )
        members = written(members.unionByName(further), "chat-members")
    return members.join(nodes.select("node", "role", "text"), "node").drop("node")


def formatted(paths: DataFrame, trained_role: str = TRAINED_ROLE) -> DataFrame:
    """(conv_id, leaf, formatted, loss): one row for each path, in the module's format."""
    head = F.concat(F.lit(HEAD), escaped(F.col("role"), ROLE_ESCAPES), F.lit(AFTER_ROLE))
    body = escaped(F.col("text"))
    spelled = paths.select(
        "conv_id",
        "leaf",
        "back",
        (F.col("role") == trained_role).alias("trained"),
        F.length(head).cast("bigint").alias("head_chars"),
        F.length(body).cast("bigint").alias("body_chars"),
        F.concat(head, body, F.lit(END)).alias("spelled"),
    )
    order = Window.partitionBy("leaf").orderBy(F.col("back").desc())
    before = F.sum(F.length("spelled").cast("bigint")).over(order) - F.length("spelled")
    placed = spelled.withColumn("start", before + F.col("head_chars"))
    turn = F.struct((-F.col("back")).alias("place"), "spelled", "trained", "start", (F.col("start") + F.col("body_chars")).alias("end"))
    gathered = placed.groupBy("conv_id", "leaf").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    return gathered.select(
        "conv_id",
        "leaf",
        F.array_join(F.col("turns.spelled"), "").alias("formatted"),
        F.transform(
            F.filter("turns", lambda t: t["trained"]),
            lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end")),
        ).alias("loss"),
    )


def turns_of(text: Column) -> Column:
    """Turns (role, text) of a formatted conversation, as they were before formatting."""
    pieces = F.split(text, END, -1)

    def turn(piece: Column) -> Column:
        role_end = F.instr(piece, F.lit(AFTER_ROLE))
        role = F.substr(piece, F.lit(len(HEAD) + 1), role_end - (len(HEAD) + 1))
        return F.struct(
            unescaped(role, ROLE_ESCAPES).alias("role"),
            unescaped(F.substr(piece, role_end + len(AFTER_ROLE))).alias("text"),
        )

    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), turn)


def text_under(mask: Column, text: Column) -> Column:
    """All text under the mask, unescaped, with nothing between."""
    parts = F.transform(mask, lambda s: unescaped(F.substr(text, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    return F.array_join(parts, "")


def conversations(rows: DataFrame, trained_role: str = TRAINED_ROLE) -> DataFrame:
    """The best branch of every conversation, formatted."""
    return formatted(chosen_paths(reply_nodes(rows)), trained_role)
