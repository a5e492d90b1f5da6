"""Places in a total order, without a task that sees all rows of a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leaseload.llm.common import written

# Of a frame that is small by nature; others are dealt over the session's shuffle partitions.
FEW = 4


def ranked(df: DataFrame, group: list[str], order: list[Column], parts: int | None = None) -> DataFrame:
    """``df`` with ``rank`` (from 0 in its group), ``size`` of the group and ``first``,
    the place of the group's first row among all rows, groups ascending, nulls first.

    Rows are dealt to tasks by ranges of (group, order), so a group that holds most rows
    lies over many tasks. Each task numbers its own rows; what comes before them is a
    sum over the parts of their group, one row per part. Rows that are equal in
    ``order`` get some order, the same for all readers of the result. ``df`` should be
    stored: ranges are drawn from a sample that reads it once more.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [*[F.col(c).asc_nulls_first() for c in group], *order]
    dealt = df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    placed = written(
        dealt.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_place")),
        "ranked",
    )
    # One row per part, then one row per part and group that has rows in it.
    part_sizes = placed.groupBy("_part").agg(F.min("_place").alias("_part_place"), F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    part_starts = part_sizes.select(
        "_part", "_part_place", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_part_first")
    )
    runs = placed.groupBy("_part", *group).agg(F.min("_place").alias("_start"), F.count("*").alias("_n"))
    runs = runs.join(part_starts, "_part")
    own = Window.partitionBy(*[F.col(c) for c in group]) if group else Window.partitionBy(F.lit(0))
    earlier = own.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        F.col("_part").alias("_run_part"),
        *[F.col(c).alias(f"_run_{i}") for i, c in enumerate(group)],
        "_start",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(own).alias("size"),
        F.min(F.col("_part_first") + F.col("_start") - F.col("_part_place")).over(own).alias("first"),
    )
    same = F.col("_part") == F.col("_run_part")
    for i, c in enumerate(group):
        same = same & F.col(c).eqNullSafe(F.col(f"_run_{i}"))
    return placed.join(runs, same).select(
        *df.columns, (F.col("_place") - F.col("_start") + F.col("_before")).alias("rank"), "size", "first"
    )
