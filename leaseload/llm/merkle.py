"""Merkle manifest of a dataset by nested-interval labels.

Rows are the leaves of one tree per ``tree`` value, in order; the trees' tops are the
leaves of one tree above them. ``FANOUT`` consecutive nodes make a parent, whose digest
is the hash of theirs; a last run may have fewer, even one.

Each node is labelled with its level and the interval [lo, hi) of leaf ranks it covers,
so intervals nest: a node's ancestors are the nodes of higher levels whose interval
contains its own, and its siblings are what remains of its parent's interval without
it. Levels come in buckets of ``LEVELS``. All nodes of a bucket of levels that lie under
one node at its top have the same join key, and are at most ``SPAN`` wide at the bottom;
building and attaching meet them by that key, one shuffle for each bucket of levels.
Only the lowest bucket has as many rows as there are leaves, the next a 729th of them.
No tree, however large, comes to one task, and digests are shuffled, never texts.

Null values are written ``-`` and differ from empty ones. Null tree values are a tree of
their own, the first. Rows of equal order are ordered by their digest; rows repeated as a
whole are leaves each. An empty table has no leaves and no nodes. A leaf's digest covers
the named columns only; further columns, also ones named like a label, are not looked at.
Very long texts are hashed where they are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaseload.llm.common import written
from leaseload.llm.ranking import FEW, ranked

FANOUT = 3
LEVELS = 6
SPAN = FANOUT**LEVELS
# Trees of at most SPAN leaves share a group until their starts are so far apart.
PACKED = 3 * SPAN

NODE = "first long, size long, level int, lo long, hi long, digest string"
CHAIN = "left array<string>, right array<string>, subroot string, root string"
_TEXTS = pa.list_(pa.string())


def digest_of(*values: Column) -> Column:
    """Hash of the values one after the other, each with its length in bytes, null as ``-``."""

    def spelled(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[spelled(v) for v in values]), 256)


def hashed(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


@dataclass
class Manifest:
    """Leaves with their labels, nodes by bucket of levels, and the tops of the trees."""

    leaves: DataFrame
    nodes: list[DataFrame]
    tops: DataFrame

    def all_nodes(self) -> DataFrame:
        """(first, size, level, lo, hi, digest) of all nodes above the leaves."""
        return reduce(DataFrame.unionByName, self.nodes)


def _group(bucket: int) -> Column:
    """Join key of a node in a bucket of levels: where the node at its top begins.

    Trees that one bucket covers share a group with their neighbours (below zero).
    """
    width = SPAN ** (bucket + 1)
    alone = F.col("first") + F.col("lo") - F.col("lo") % width
    if bucket:
        return alone
    together = F.lit(-1).cast("bigint") - F.floor(F.col("first") / PACKED).cast("bigint")
    return F.when(F.col("size") <= SPAN, together).otherwise(alone)


def _trees(rows: pa.Table) -> list[tuple[int, int, np.ndarray]]:
    """(first, size, rows in order of lo) for each tree of a group."""
    first, size, lo = (rows[c].to_numpy() for c in ("first", "size", "lo"))
    order = np.lexsort((lo, first))
    cuts = np.flatnonzero(np.diff(first[order])) + 1
    return [(int(first[own[0]]), int(size[own[0]]), own) for own in np.split(order, cuts) if len(own)]


def _raise(rows: pa.Table, bucket: int) -> pa.Table:
    """The nodes of a bucket of levels above the nodes of one group."""
    out: list[tuple] = []
    digests = rows["digest"].to_pylist()
    los, his = rows["lo"].to_pylist(), rows["hi"].to_pylist()
    for first, size, own in _trees(rows):
        level = bucket * LEVELS
        nodes = [(los[i], his[i], digests[i]) for i in own.tolist()]
        while level < (bucket + 1) * LEVELS and not (len(nodes) == 1 and nodes[0][1] - nodes[0][0] == size):
            level += 1
            runs = [nodes[i : i + FANOUT] for i in range(0, len(nodes), FANOUT)]
            nodes = [(run[0][0], run[-1][1], hashed([n[2] for n in run])) for run in runs]
            out += [(first, size, level, *n) for n in nodes]
    columns = zip(*out) if out else [[]] * 6
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
    return pa.table([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=[f.split()[0] for f in NODE.split(", ")])


def built(leaves: DataFrame, tree: list[str], order: list[Column], parts: int | None = None) -> Manifest:
    """Manifest of ``leaves``, which have a ``digest`` and are stored. Their other columns
    stay beside the labels; none may be named like a label."""
    placed = ranked(leaves, tree, [*order, F.col("digest").asc()], parts)
    placed = placed.withColumnsRenamed({"rank": "lo"}).withColumn("hi", F.col("lo") + 1)
    largest = placed.agg(F.max("size")).first()[0] or 1
    nodes: list[DataFrame] = []
    rows = placed.select("first", "size", "lo", "hi", "digest")
    bucket = 0
    while True:
        raised = _in_groups(lambda t, b=bucket: _raise(t, b))
        nodes.append(written(rows.groupBy(_group(bucket).alias("group")).applyInArrow(raised, NODE), "merkle-nodes"))
        bucket += 1
        if SPAN**bucket >= largest:
            break
        rows = nodes[-1].filter((F.col("level") == bucket * LEVELS) & (F.col("size") > SPAN**bucket)).drop("level")
    made = Manifest(placed, nodes, placed)
    single = placed.filter("size = 1").select("first", "digest")
    made.tops = single.unionByName(made.all_nodes().filter("lo = 0 AND hi = size").select("first", "digest"))
    return made


def _in_groups(function: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    def over(rows: pa.Table) -> pa.Table:
        return function(rows)

    over.__annotations__ = {"rows": pa.Table, "return": pa.Table}
    return over


def _siblings(lo: np.ndarray, digests: list[str], up_lo: np.ndarray, up_hi: np.ndarray) -> tuple[list[str], list[str]]:
    """For nodes of a level, the digests left and right of each within its parent's interval."""
    parent = np.searchsorted(up_lo, lo, "right") - 1
    begin = np.searchsorted(lo, up_lo[parent], "left").tolist()
    end = np.searchsorted(lo, up_hi[parent], "left").tolist()
    left = ["".join(digests[b:i]) for i, b in enumerate(begin)]
    right = ["".join(digests[i + 1 : e]) for i, e in enumerate(end)]
    return left, right


def _attach(rows: pa.Table, above: pa.Table, bucket: int) -> pa.Table:
    """Rows of one group with the siblings of their ancestors, level by level, and their tops.

    ``above`` has the nodes of the bucket and one row for the node on top of it
    (level null), which brings the chain from there on.
    """
    digests = rows["digest"].to_pylist()
    lo = rows["lo"].to_numpy()
    up = {c: above[c].to_pylist() for c in ("level", "digest", "left", "right", "subroot", "root")}
    up_first, up_lo, up_hi = (above[c].to_numpy() for c in ("first", "lo", "hi"))
    level_of = np.array([-1 if x is None else x for x in up["level"]], np.int64)
    by_first = np.argsort(up_first, kind="stable")
    left: list[list[str]] = [[]] * len(digests)
    right: list[list[str]] = [[]] * len(digests)
    subroot: list[str | None] = [None] * len(digests)
    root: list[str | None] = [None] * len(digests)
    for first, _, own in _trees(rows):
        here = by_first[slice(*np.searchsorted(up_first[by_first], [first, first + 1]))]
        chain = next(i for i in here.tolist() if level_of[i] < 0)
        level, level_lo, level_digests = bucket * LEVELS, lo[own], [digests[i] for i in own.tolist()]
        steps = []
        while True:
            ups = here[level_of[here] == level + 1]
            if not len(ups):
                break
            ups = ups[np.argsort(up_lo[ups])]
            # Containment: the last interval that begins at or before the row.
            at = (np.searchsorted(level_lo, lo[own], "right") - 1).tolist()
            lefts, rights = _siblings(level_lo, level_digests, up_lo[ups], up_hi[ups])
            steps.append((at, lefts, rights))
            level, level_lo, level_digests = level + 1, up_lo[ups], [up["digest"][i] for i in ups.tolist()]
        for k, i in enumerate(own.tolist()):
            left[i] = [lefts[at[k]] for at, lefts, _ in steps] + up["left"][chain]
            right[i] = [rights[at[k]] for at, _, rights in steps] + up["right"][chain]
            subroot[i], root[i] = up["subroot"][chain], up["root"][chain]
    for name, values, kind in (("left", left, _TEXTS), ("right", right, _TEXTS), ("subroot", subroot, pa.string()), ("root", root, pa.string())):
        rows = rows.append_column(name, pa.array(values, kind))
    return rows.drop_columns(["group"])


def _chained(rows: DataFrame, nodes: DataFrame, chain: DataFrame, bucket: int) -> DataFrame:
    """``rows`` beside the ancestors' siblings: one containment join for a bucket of levels."""
    group = _group(bucket).alias("group")
    kinds = dict(f.split() for f in CHAIN.split(", "))
    within = nodes.select("first", "size", "level", "lo", "hi", "digest", *[F.lit(None).cast(k).alias(c) for c, k in kinds.items()])
    tops = chain.select("first", "size", F.lit(None).cast("int").alias("level"), "lo", "hi", F.lit(None).cast("string").alias("digest"), *kinds)
    ups = within.unionByName(tops).select("*", group)
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema], CHAIN])

    def over(left: pa.Table, right: pa.Table) -> pa.Table:
        return _attach(left, right, bucket)

    over.__annotations__ = {"left": pa.Table, "right": pa.Table, "return": pa.Table}
    return rows.select("*", group).groupBy("group").cogroup(ups.groupBy("group")).applyInArrow(over, schema)


def attached(made: Manifest, tops: DataFrame) -> DataFrame:
    """Leaves with ``left`` and ``right`` (the siblings' digests on each side, level by level
    up to the root), ``subroot`` and ``root``; ``tops`` (first, left, right, subroot, root)
    brings the way from the top of each tree on."""
    # A tree's top covers all its leaves, in the bucket where its growth ends.
    sizes = made.leaves.filter("lo = 0").select("first", "size")
    ends = sizes.join(tops, "first").select("first", "size", F.lit(0).cast("bigint").alias("lo"), F.col("size").alias("hi"), *[f.split()[0] for f in CHAIN.split(", ")])
    ends = written(ends, "merkle-tops")
    chain = None
    for bucket in reversed(range(len(made.nodes))):
        here = ends.filter((F.col("size") <= SPAN ** (bucket + 1)) & (F.col("size") > (SPAN**bucket if bucket else 0)))
        above = here if chain is None else here.unionByName(chain)
        if bucket:
            lower = made.nodes[bucket - 1]
            rows = lower.filter((F.col("level") == bucket * LEVELS) & (F.col("size") > SPAN**bucket)).drop("level")
            found = _chained(rows, made.nodes[bucket], above, bucket)
            chain = written(found.select(*ends.columns), "merkle-chains")
        else:
            rows = made.leaves
            found = _chained(rows, made.nodes[0], above, 0)
    return found


def proven(leaves: DataFrame, tree: list[str], order: list[Column]) -> DataFrame:
    """``leaves`` with ``left``, ``right``, ``subroot`` and ``root``: their proofs through
    their own tree and the tree above the trees' tops."""
    own = built(leaves, tree, order)
    members = written(own.tops.select(F.col("first").alias("member"), "digest"), "merkle-members")
    upper = built(members, [], [F.col("member").asc()], FEW)
    nothing = F.array().cast("array<string>")
    end = upper.tops.select(
        "first", nothing.alias("left"), nothing.alias("right"), F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root")
    )
    ways = attached(upper, end)
    return attached(own, ways.select(F.col("member").alias("first"), "left", "right", F.col("digest").alias("subroot"), "root"))


def proof_of(left: Column, right: Column) -> Column:
    """The siblings' digests, level by level, left to right."""
    return F.array_join(F.zip_with(left, right, lambda a, b: F.concat(a, b)), "")


def folded(digest: Column, left: Column, right: Column) -> Column:
    """The root that a leaf's digest leads to with its siblings."""
    steps = F.zip_with(left, right, lambda a, b: F.struct(a.alias("before"), b.alias("after")))
    return F.aggregate(steps, digest, lambda d, s: F.sha2(F.concat(s["before"], d, s["after"]), 256))


def document_digest(text: Column) -> Column:
    """A document's digest: doc_id, source, lang, n_chars and its text."""
    return digest_of(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)


def manifest(docs: DataFrame, claimed_text: Column | None = None) -> DataFrame:
    """(doc_id, source, digest, claimed, left, right, subroot, root) of every document.

    One tree per ``source``, leaves by ascending ``doc_id`` (null first). ``claimed`` is the
    digest of the row with ``claimed_text`` as its text: what a later copy of it would have.
    """
    text = F.col("text")
    leaves = docs.select(
        "doc_id",
        "source",
        document_digest(text).alias("digest"),
        document_digest(text if claimed_text is None else claimed_text).alias("claimed"),
    )
    leaves = written(leaves, "merkle-leaves")
    return proven(leaves, ["source"], [F.col("doc_id").asc_nulls_first()])
