"""Writing results: insert, upsert, append, surrogate ids and snapshots.

Parquet has no MERGE, so a load builds the next snapshot of a table and writes
it to a new folder. A folder that is being read is never overwritten.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leaseload.operators.keys import first_rows, without_known
from leaseload.sources.exports import ROW_ORDER, stage


def new_rows(
    target: DataFrame,
    source: DataFrame,
    key: list[str],
    order: str = ROW_ORDER,
    key_filter: Column | None = None,
) -> DataFrame:
    """Rows of ``source`` an insert that skips conflicts would add.

    The first row of a key wins, stored keys are skipped and a null key conflicts
    with nothing. ``key_filter`` limits the rule to some rows (of both sides), as a
    conditional unique key does; other rows are all added.
    """
    if key_filter is not None:
        target = target.filter(key_filter)
    winners = first_rows(source, key, [order], keep_null_keys=True, only_where=key_filter)
    return without_known(winners, target, [(k, k) for k in key], only_where=key_filter)


def insert_new(
    target: DataFrame,
    source: DataFrame,
    key: list[str],
    order: str = ROW_ORDER,
    key_filter: Column | None = None,
) -> DataFrame:
    """Next snapshot of ``target`` after an insert that skips conflicts."""
    added = new_rows(target, source, key, order, key_filter)
    return target.unionByName(added.select(*[c for c in target.columns if c in added.columns]), allowMissingColumns=True)


def upsert(
    target: DataFrame, source: DataFrame, key: list[str], update_columns: list[str], null_safe: bool = False
) -> DataFrame:
    """Next snapshot after update-or-insert; ``source`` has one row per key.

    A match takes only ``update_columns`` from the source, so creation columns
    survive. A new row takes every column the source has.
    """
    old = target.select(*[F.col(c).alias(f"o_{c}") for c in target.columns], F.lit(True).alias("_old"))
    new = source.select(*[F.col(c).alias(f"n_{c}") for c in source.columns], F.lit(True).alias("_new"))
    tests = [
        F.col(f"o_{k}").eqNullSafe(F.col(f"n_{k}")) if null_safe else F.col(f"o_{k}") == F.col(f"n_{k}") for k in key
    ]
    both = old.join(new, reduce(lambda a, b: a & b, tests), "full_outer")

    def merged(c: str) -> Column:
        if c not in source.columns:
            return F.col(f"o_{c}").alias(c)
        if c in update_columns:
            return F.when(F.col("_new"), F.col(f"n_{c}")).otherwise(F.col(f"o_{c}")).alias(c)
        return F.when(F.col("_old"), F.col(f"o_{c}")).otherwise(F.col(f"n_{c}")).alias(c)

    return both.select(*[merged(c) for c in target.columns])


def numbered(rows: DataFrame, order: list[Column | str], name: str, folder: str | None = None) -> DataFrame:
    """Rows with ``name``: 1, 2, 3 ... in the given order, without a gap.

    No task sees all rows. They are dealt by ranges of the order to as many tasks as a
    shuffle has, sorted there and stored with their place; what comes before a task's
    rows is a sum over the tasks before it, one row each. Ranges are drawn from a sample,
    so the rows are stored before they are counted (``folder``, or the shared folder).
    Rows that are equal in ``order`` get some order, the same for all readers.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = stage(
        dealt.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_place")), folder
    )
    sizes = placed.groupBy("_part").agg(F.min("_place").alias("_start"), F.count(F.lit(1)).alias("_rows"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select(
        F.col("_part").alias("_of"), "_start", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")
    )
    joined = placed.join(starts, F.col("_part") == F.col("_of"))
    return joined.select(*rows.columns, (F.col("_place") - F.col("_start") + F.col("_before") + 1).alias(name))


def assign_ids(
    source: DataFrame, target: DataFrame, key: str, id_column: str = "id", folder: str | None = None
) -> DataFrame:
    """Give new rows ids above the target's largest one, without gaps, in the order of their unique key.

    Ids are the same on every run over the same input; more tasks number more rows.
    """
    top = target.agg(F.coalesce(F.max(id_column), F.lit(0)).cast("bigint").alias("top"))
    rows = numbered(source.drop(id_column), [key], "_n", folder)
    return rows.withColumn(id_column, (top.scalar() + F.col("_n")).cast("bigint")).drop("_n")


def write_snapshot(df: DataFrame, folder: str, partition_by: list[str] | None = None) -> None:
    """Write a table snapshot; fails if the folder exists, so no reader loses its files."""
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(folder)


def append(df: DataFrame, folder: str) -> None:
    df.write.mode("append").parquet(folder)


def write_review(df: DataFrame, folder: str) -> None:
    """Transformed rows as CSV with a header, for people to read before a load, cells as they are."""
    as_is = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("errorifexists").options(**as_is).csv(folder)


def write_rejects(rejects: DataFrame, plan: str, run_ts: Column, folder: str) -> None:
    """Append rejects with plan and run time, one sub-folder per plan."""
    rejects.withColumns({"plan": F.lit(plan), "run_ts": run_ts}).write.mode("append").partitionBy("plan").parquet(folder)
