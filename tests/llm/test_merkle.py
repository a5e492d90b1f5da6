from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from leaseload.llm import merkle
from tests.llm.conftest import CLASHING, LONG

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    values = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(digests):
    """(top, proof steps of each leaf): plain lists of levels."""
    levels = [list(digests)]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([H(*last[i : i + 3]) for i in range(0, len(last), 3)])
    steps = []
    for place in range(len(digests)):
        own = []
        for level in levels[:-1]:
            begin = place // 3 * 3
            own.append(("".join(level[begin:place]), "".join(level[place + 1 : begin + 3])))
            place //= 3
        steps.append(own)
    return levels[-1][0], steps


def plain(rows):
    """(doc_id, leaf, claimed, subroot, root, steps) of every row, in plain Python."""
    groups = {}
    for row in rows:
        entry = (leaf_of(row, row["text"]), leaf_of(row, None if row["text"] is None else row["text"].replace("\n", "")))
        groups.setdefault(row["source"], []).append((row["doc_id"], *entry))
    made = []
    for source in sorted(groups, key=lambda s: (s is not None, (s or "").encode())):
        leaves = sorted(groups[source], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        made.append((leaves, *tree([x[1] for x in leaves])))
    root, ways = tree([top for _, top, _ in made])
    return sorted(
        ((doc_id, leaf, claimed, top, root, steps[i] + way) for (leaves, top, steps), way in zip(made, ways) for i, (doc_id, leaf, claimed) in enumerate(leaves)),
        key=repr,
    )


def found_in(docs):
    made = merkle.manifest(docs, F.replace("text", F.lit("\n"), F.lit("")))
    rows = made.withColumn("back", merkle.folded(F.col("digest"), F.col("left"), F.col("right"))).collect()
    assert all(r.back == r.root for r in rows)
    return sorted(((r.doc_id, r.digest, r.claimed, r.subroot, r.root, list(zip(r.left, r.right))) for r in rows), key=repr)


def test_equals_plain_trees_of_all_sizes(spark):
    # Sources of 1, 2, 3, 4, 9, 10, 27, 28, 729 and 730 leaves, and a hot one with half of all rows.
    sizes = {"a": 1, "b": 2, None: 3, "é": 4, "B": 9, "c": 10, "d": 27, "": 28, "e": 729, "f": 730, "hot": 2300}
    rows, n = [], 0
    for source, size in sizes.items():
        for _ in range(size):
            rows.append((n * 7919 % 10007, f"line\n{n % 50}", "en" if n % 3 else None, source, None if n % 5 == 0 else n))
            n += 1
    docs = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert found_in(docs) == plain([r.asDict() for r in docs.collect()])


def test_nulls_ties_repeats_and_clashing_columns(spark):
    rows = [
        (1, "x\ny", "en", "a", 3),
        (1, "x\ny", "en", "a", 3),
        (1, "other", "en", "a", 5),
        (None, None, None, None, None),
        (None, "", "", "", 0),
        (2, None, "en", "a", None),
        (-5, LONG, "en", "a", len(LONG)),
        (10, "-", "1:a", "a", 1),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in (*CLASHING.split(), "rank", "lo", "hi", "first", "size", "digest", "claimed", "left", "root", "level", "group"):
        docs = docs.withColumn(name, F.lit("x"))
    assert found_in(docs) == plain([r.asDict() for r in docs.collect()])


def test_changed_row_does_not_lead_to_the_root(spark):
    docs = spark.createDataFrame([(n, f"a\n{n}" if n % 2 else "a", "en", "s", 1) for n in range(20)], SCHEMA)
    made = merkle.manifest(docs, F.replace("text", F.lit("\n"), F.lit("")))
    back = merkle.folded(F.col("claimed"), F.col("left"), F.col("right"))
    assert {r.doc_id for r in made.filter(back == F.col("root")).collect()} == set(range(0, 20, 2))


def test_empty_table(spark):
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_nodes_nest(spark):
    docs = spark.range(2000).select("id", F.lit("s").alias("t"), F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    made = merkle.built(docs, ["t"], [F.col("id").asc()])
    nodes = made.all_nodes().collect()
    by_level = {}
    for n in nodes:
        by_level.setdefault(n.level, []).append((n.lo, n.hi))
    assert sorted(by_level) == list(range(1, 8))
    for level, spans in by_level.items():
        spans.sort()
        assert spans[0][0] == 0 and spans[-1][1] == 2000
        assert all(a[1] == b[0] and a[1] - a[0] == 3**level for a, b in zip(spans, spans[1:]))


def test_no_group_is_wider_than_a_bucket(spark):
    """However large a tree, what meets in one task is bounded."""
    rows = spark.range(40_000).select(
        F.lit(0).cast("bigint").alias("first"), F.lit(40_000).cast("bigint").alias("size"), F.col("id").alias("lo")
    )
    largest = rows.groupBy(merkle._group(0).alias("g")).count().agg(F.max("count")).first()[0]
    assert largest == merkle.SPAN
    alone = spark.range(9_000).select(F.col("id").alias("first"), F.lit(1).cast("bigint").alias("size"), F.lit(0).cast("bigint").alias("lo"))
    assert alone.groupBy(merkle._group(0).alias("g")).count().agg(F.max("count")).first()[0] <= merkle.PACKED


@pytest.mark.parametrize("value, spelled", [("é", "2:é"), ("", "0:"), (None, "-")])
def test_spelling_of_a_value(spark, value, spelled):
    frame = spark.createDataFrame([(value,)], "v string").select(merkle.digest_of(F.col("v")).alias("d"))
    assert frame.first().d == H(spelled)
