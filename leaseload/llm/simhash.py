"""Near copies by SimHash fingerprints, found by pigeonring chains.

A fingerprint has 64 bits, cut into five segments that lie on a ring. If two
fingerprints differ in at most two bits, some segment starts a chain whose first
k segments together differ in at most 2k/5 bits, for every k: nothing in the first
two segments, at most one bit in the first four, at most two in all. So the first
two segments are equal, and the third or the fourth is. Those three equal segments
are the join key: five starts times two choices, ten keys for each fingerprint.
Within a bucket the chain budgets are checked segment by segment, then the whole
distance. No pair of linked fingerprints can miss all ten keys.

Buckets up to ``BUCKET`` fingerprints are compared inside one task. A larger bucket
is never gathered: its members differ in 25 or 26 free bits only, and two of them
are at most two bits apart exactly if flipping at most one free bit of each can
make them equal. Each member is dealt to those 26 or 27 centres; a centre cannot
have more members than that, so the exact rest costs rows in proportion.

Equal texts share a fingerprint and are handled once. Null and empty texts have the
fingerprint 0 and are linked like any other. Rows repeated as a whole are in one
group as well. Columns other than ``doc_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaseload.llm.common import free_name, written
from leaseload.llm.components import smallest_label

SEED = 42
SHINGLE_WORDS = 3
MAX_BITS = 2
WIDTHS = (13, 13, 13, 13, 12)
# Largest bucket that one task compares: 2,048 fingerprints are 16 KB.
BUCKET = 2_048
# Shingles turned into bits at a time, so that a very long text needs no more memory.
BLOCK = 65_536


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """SimHash of a whole text as an unsigned number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    ones = np.zeros(64, np.int64)
    total = max(1, len(words) - shingle_words + 1)
    digest = xxhash.xxh64_intdigest
    for begin in range(0, total, BLOCK):
        hashes = [digest(b" ".join(words[i : i + shingle_words]), SEED) for i in range(begin, min(total, begin + BLOCK))]
        octets = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, shingle_words: int = SHINGLE_WORDS) -> Column:
    """The fingerprint as a signed bigint, the same 64 bits."""

    def over(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle_words) for t in texts], np.uint64).view(np.int64))

    over.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return F.pandas_udf(over, "bigint")(text)


def segment_masks(widths: tuple[int, ...] = WIDTHS) -> list[int]:
    masks, low = [], 0
    for width in widths:
        masks.append(((1 << width) - 1) << low)
        low += width
    return masks


def chain_slots() -> list[tuple[int, int]]:
    """Start of the chain and bits that must be equal, for each of the ten keys."""
    masks = segment_masks()
    n = len(masks)
    return [
        (start, masks[start] | masks[(start + 1) % n] | masks[(start + skip) % n])
        for start in range(n)
        for skip in (2, 3)
    ]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def chain_holds(differing: np.ndarray, start: int, max_bits: int = MAX_BITS) -> np.ndarray:
    """Which xor values keep every prefix of the chain within its proportional budget."""
    masks = segment_masks()
    n = len(masks)
    total = np.zeros(differing.shape, np.int64)
    holds = np.ones(differing.shape, bool)
    for length in range(1, n + 1):
        mask = np.uint64(masks[(start + length - 1) % n])
        total += np.bitwise_count(differing & mask)
        holds &= total * n <= length * max_bits
    return holds


def linked_pairs(members: np.ndarray, start: int) -> np.ndarray:
    """For each member of a bucket the least member of its group, by chain and distance."""
    least = np.arange(len(members))
    order = np.sort(members.view(np.uint64))
    for i in range(len(order)):
        if least[i] != i:
            continue
        # Everything reachable inside the bucket, breadth first.
        front = np.array([i])
        while len(front):
            rest = np.flatnonzero(least == np.arange(len(order)))
            rest = rest[rest > i]
            if not len(rest):
                break
            hit = np.zeros(len(rest), bool)
            for at in front:
                differing = order[rest] ^ order[at]
                chained = chain_holds(differing, start)
                hit |= chained & (np.bitwise_count(differing) <= MAX_BITS)
            front = rest[hit]
            least[front] = i
    changed = np.flatnonzero(least != np.arange(len(order)))
    return np.stack([order[changed], order[least[changed]]], axis=1).view(np.int64)


def links(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) between distinct fingerprints; their components are those of all links.

    ``prints`` has one column ``fp`` of distinct fingerprints.
    """
    slots = F.array(
        *[
            F.struct(F.lit(i).alias("slot"), F.col("fp").bitwiseAND(F.lit(_signed(mask))).alias("key"))
            for i, (_, mask) in enumerate(chain_slots())
        ]
    )
    keyed = prints.select("fp", F.inline(slots))
    shared = keyed.groupBy("slot", "key").agg(F.count("*").alias("n")).filter("n > 1")
    dealt = keyed.join(shared, ["slot", "key"])

    gathered = dealt.filter(F.col("n") <= bucket).groupBy("slot", "key").agg(F.collect_list("fp").alias("members"))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        starts = [start for start, _ in chain_slots()]
        for batch in batches:
            found = [linked_pairs(np.array(m, np.int64), starts[s]) for s, m in zip(batch["slot"], batch["members"])]
            pairs = np.concatenate(found) if found else np.empty((0, 2), np.int64)
            yield pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    small = gathered.mapInPandas(compare, "a bigint, b bigint")

    free = [
        F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(_signed(1 << bit))) for bit in range(64) if not mask >> bit & 1])
        for _, mask in chain_slots()
    ]
    by_slot = F.coalesce(*[F.when(F.col("slot") == i, centres) for i, centres in enumerate(free)])
    around = dealt.filter(F.col("n") > bucket).select("slot", "key", "fp", F.explode(by_slot).alias("centre"))
    stars = around.groupBy("slot", "key", "centre").agg(F.collect_list("fp").alias("members")).filter(F.size("members") > 1)
    large = stars.select(F.explode("members").alias("a"), F.array_min("members").alias("b")).filter("a <> b")
    return small.unionByName(large).distinct()


def components(prints: DataFrame) -> DataFrame:
    """(fp, label, first): ``first`` is the least ``doc_id`` of the whole component."""
    edges = written(links(prints.select("fp")), "simhash-links")
    labels = smallest_label(edges)
    joined = prints.join(labels.withColumnRenamed("vertex", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("label", "fp").alias("label")
    )
    firsts = joined.groupBy("label").agg(F.min("first").alias("first_of_all"))
    return joined.join(firsts, "label").select("fp", "label", F.col("first_of_all").alias("first"))


def near_copies(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, fp and component_id of every row; no other column is looked at."""
    marked = written(docs.select("doc_id", fingerprint_column(F.col("text"), shingle_words).alias("fp")), "simhash")
    grouped = components(marked.groupBy("fp").agg(F.min("doc_id").alias("first")))
    return marked.join(grouped.select("fp", F.col("first").alias("component_id")), "fp").select(
        "doc_id", "fp", "component_id"
    )


def drop_near_copies(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """The rows of ``docs`` that stay: from each component the one with the least id.

    Rows without an id come last; equal ids are told apart by their place in the
    written table, so exactly one row of each component stays.
    """
    row, fp = free_name(docs, "row_of_table"), free_name(docs, "fp_of_text")
    marked = written(
        docs.withColumns(
            {row: F.monotonically_increasing_id(), fp: fingerprint_column(F.col("text"), shingle_words)}
        ),
        "simhash-docs",
    )
    order = F.struct(F.col("doc_id").isNull().alias("blank"), F.col("doc_id").alias("id"), F.col(row).alias("row"))
    grouped = components(marked.groupBy(F.col(fp).alias("fp")).agg(F.min(order).alias("first")))
    kept = grouped.groupBy("label").agg(F.min("first").alias("first")).select(F.col("first.row").alias(row))
    return marked.join(kept, row, "left_semi").select(docs.columns)


def hex_digits(fp: str) -> Column:
    return F.lpad(F.lower(F.hex(F.col(fp))), 16, "0")
