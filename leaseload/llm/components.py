"""Connected components over a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaseload.llm.common import written


def large_stars(pairs: DataFrame) -> DataFrame:
    """Each vertex sends its larger neighbours to the least of its neighbours and itself."""
    both = pairs.select(F.col("hi").alias("at"), F.col("lo").alias("other")).unionByName(
        pairs.select(F.col("lo").alias("at"), F.col("hi").alias("other"))
    )
    least = both.groupBy("at").agg(F.least(F.min("other"), F.col("at")).alias("least"))
    return pairs.join(least, F.col("lo") == F.col("at")).select("hi", F.col("least").alias("lo")).distinct()


def small_stars(pairs: DataFrame) -> DataFrame:
    """Each vertex sends itself and its smaller neighbours to the least of them."""
    least = pairs.groupBy(F.col("hi").alias("at")).agg(F.min("lo").alias("least"))
    moved = pairs.join(least, F.col("hi") == F.col("at")).filter("lo <> least").select(F.col("lo").alias("hi"), F.col("least").alias("lo"))
    return moved.unionByName(least.select(F.col("at").alias("hi"), F.col("least").alias("lo"))).distinct()


def smallest_label(edges: DataFrame, a: str = "a", b: str = "b", rounds: list[int] | None = None) -> DataFrame:
    """(vertex, label): the least vertex each vertex of ``edges`` can reach.

    A round joins every vertex to the least one it sees from its own place and then from
    below, also those that so far hung on a vertex that has found a smaller one. Chains fold
    up, so the number of rounds grows with the logarithm of the vertices, whatever the
    shape and the numbering; the number of links never grows. Links live in a written table
    per half round; the driver learns their number and a checksum. ``rounds`` is told each
    round's number of links. No links: an empty table.
    """
    pairs = written(
        edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct(), "component-links"
    )
    vertices = pairs.select(F.explode(F.array("hi", "lo")).alias("vertex")).distinct()
    links, before = pairs.filter("hi <> lo"), None
    while True:
        links = written(small_stars(written(large_stars(links), "component-links")), "component-links")
        seen = links.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("hi", "lo")).alias("mark")).first()
        if rounds is not None:
            rounds.append(seen.n)
        if seen == before:
            break
        before = seen
    labels = links.select(F.col("hi").alias("of"), F.col("lo").alias("label"))
    return vertices.join(labels, F.col("vertex") == F.col("of"), "left").select(
        "vertex", F.coalesce("label", "vertex").alias("label")
    )
