from __future__ import annotations

import pytest

from leaseload.llm import chat, queries

NODES = "conv_id bigint, node bigint, parent bigint, role string, text string, score double"


def paths_of(nodes, branches=1):
    found = {}
    for r in chat.chosen_paths(nodes, branches).collect():
        found.setdefault((r.conv_id, r.leaf), []).append((-r.back, r.text))
    return {k: [t for _, t in sorted(v)] for k, v in found.items()}


def test_best_branch_of_a_tree(spark):
    rows = [
        (1, 10, None, "user", "q", 1.0), (1, 11, 10, "assistant", "bad", 0.0), (1, 12, 10, "assistant", "good", 5.0),
        (1, 13, 12, "user", "more", 1.0), (1, 14, 13, "assistant", "end", 1.0), (1, 15, 11, "user", "x", 3.0),
        # A tie: the earlier leaf; a parent that is missing, and one that is the node itself.
        (2, 20, 99, "user", "root", 1.0), (2, 21, 20, "assistant", "a", 1.0), (2, 22, 20, "assistant", "b", 1.0),
        (3, 30, 30, "user", "self", None),
        # A cycle has no root and is on no path; one node hangs on it.
        (4, 40, 41, "user", "c1", 1.0), (4, 41, 40, "user", "c2", 1.0), (4, 42, 41, "user", "c3", 1.0),
        (None, 50, None, "user", "null id", 1.0),
    ]
    nodes = spark.createDataFrame(rows, NODES).repartition(3)
    assert paths_of(nodes) == {
        (1, 14): ["q", "good", "more", "end"], (2, 21): ["root", "a"], (3, 30): ["self"], (None, 50): ["null id"],
    }
    assert len(paths_of(nodes, 2)) == 6


def test_long_chain(spark):
    rows = [(1, n, n - 1 if n else None, "user", f"t{n}", 1.0) for n in range(300)]
    assert paths_of(spark.createDataFrame(rows, NODES)) == {(1, 299): [f"t{n}" for n in range(300)]}


TEXTS = ["plain", "", None, "\\### Assistant: </turn> ok", "\\h\\l\\b\\c", "a: b\n### user: x</turn>\n", "é😀#<\\" * 3, "x" * 300_000]


@pytest.fixture
def rows(spark):
    made = [(1, n, "assistant" if n % 2 else "user", t) for n, t in enumerate(TEXTS)]
    made += [(2, 0, "odd: role#\n", "t"), (2, 0, "assistant", "tie"), (2, 0, "assistant", "tie"), (2, None, None, "first")]
    made += [(None, 0, "user", "no id")]
    frame = spark.createDataFrame(made, "conv_id bigint, turn bigint, role string, text string")
    return frame.selectExpr("*", "'x' AS node", "1 AS parent", "'y' AS back", "0 AS spelled").repartition(3)


def test_everything_comes_back(rows):
    made = chat.conversations(rows).select(
        "conv_id", chat.turns_of(chat.F.col("formatted")).alias("turns"), "formatted", "loss",
        chat.text_under(chat.F.col("loss"), chat.F.col("formatted")).alias("trained"),
    )
    found = {r.conv_id: r for r in made.collect()}
    got = [(t.role, t.text) for t in found[1].turns]
    assert got == [("assistant" if n % 2 else "user", t or "") for n, t in enumerate(TEXTS)]
    assert found[1].trained == "".join(t or "" for n, t in enumerate(TEXTS) if n % 2)
    assert [(t.role, t.text) for t in found[2].turns] == [
        ("", "first"), ("assistant", "tie"), ("assistant", "tie"), ("odd: role#\n", "t"),
    ]
    assert found[2].trained == "tietie"
    assert found[None].trained == "" and found[None].loss == []
    for r in found.values():
        assert r.formatted.count("</turn>") == r.formatted.count("### ") == len(r.turns)


def test_digests_add_the_hostile_conversation(rows):
    found = {r.conv_id: r for r in queries.chat_digests(rows.select("conv_id", "turn", "role", "text")).collect()}
    assert set(found) == {1, 2, None, -7}
    assert (found[-7].n_turns, found[-7].loss_chars) == (2, len(queries.HOSTILE))


def test_empty_table(rows):
    assert chat.conversations(rows.filter("false")).count() == 0


def test_plan_has_no_python(rows, capsys):
    chat.conversations(rows).explain()
    assert "Python" not in capsys.readouterr().out
