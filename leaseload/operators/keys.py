"""Lookups and winners by key.

Joins carry no broadcast hint. Spark broadcasts a side only while its own size
estimate stays below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles it
otherwise, and adaptive execution splits a hot key of the left side. Every
lookup side is first brought to one row per key, so a lookup never fans out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leaseload.sources.exports import ROW_ORDER, stage


def _same(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]], null_safe: bool) -> Column:
    tests = [
        left[a].eqNullSafe(right[b]) if null_safe else left[a] == right[b]
        for a, b in pairs
    ]
    return reduce(lambda x, y: x & y, tests)


def last_wins(df: DataFrame, key: list[str], values: list[str], order: Column) -> DataFrame:
    """One row per non-null key, holding the values of the last row in order.

    An aggregate, so map-side combine cuts a hot key to one row per task.
    """
    groups = df.dropna(subset=key).groupBy(*key)
    if len(values) == 1:
        return groups.agg(F.max_by(values[0], order).alias(values[0]))
    winner = groups.agg(F.max_by(F.struct(*values), order).alias("_winner"))
    return winner.select(*key, *[F.col(f"_winner.{v}").alias(v) for v in values])


def first_rows(
    df: DataFrame,
    key: list[str],
    order: list[Column | str],
    keep_null_keys: bool = False,
    only_where: Column | None = None,
) -> DataFrame:
    """The first row of every key. Rows with a null in the key are dropped, or all
    kept with ``keep_null_keys`` (a null never conflicts with another null); rows for
    which ``only_where`` does not hold are all kept then too.

    The rank filter runs before the shuffle too (one row per key and task), so a
    hot key never reaches one task as a whole. A row that stands alone is a key of its
    own, by a number no other row has, so none is lost whatever its order; that keeps
    the read a single one and spreads such rows.
    """
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
    if not keep_null_keys:
        rows, parts = df.filter(complete), [F.col(k) for k in key]
    else:
        held = complete if only_where is None else complete & F.coalesce(only_where, F.lit(False))
        rows = df.withColumn("_alone", F.when(~held, F.monotonically_increasing_id()))
        parts = [*[F.when(F.col("_alone").isNull(), F.col(k)) for k in key], F.col("_alone")]
    ranked = rows.withColumn("_rank", F.row_number().over(W.partitionBy(*parts).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank", "_alone")


def latest_rows(df: DataFrame, key: list[str], newest: Column, order: list[Column | str]) -> DataFrame:
    """The newest row of every key, undated rows last, ties by order."""
    return first_rows(df, key, [newest.desc_nulls_last(), *order])


# A key is hot from this share of all rows on, so there are fewer hot keys than HOT_PARTS.
HOT_PARTS = 1_000
# Rows without a key match nothing; in a shuffled join they are dealt over this many lanes.
NULL_LANES = 1_024


def hot_keys(facts: DataFrame, key: list[str], parts: int = HOT_PARTS) -> DataFrame:
    """(key, ``_lanes``) of the keys that hold more than one of ``parts`` equal shares of the rows.

    At most ``parts`` - 1 rows by that rule, whatever the table. Keys are counted in their
    tasks first, so a hot key costs one row per task.
    """
    counted = facts.dropna(subset=key).groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    total = counted.agg(F.sum("_n").alias("total")).scalar()
    share = F.col("_n") * parts / total
    return counted.filter(share > 1).select(*key, F.ceil(share).cast("int").alias("_lanes"))


# Keys a sketch follows at once. It finds every key above 1 / (0.375 * this) of the rows.
SKETCH_KEYS = 16_384
# So few rows of a key are no burden to a task, whatever their share.
HOT_ROWS = 10_000


def hot_hashes(facts: DataFrame, key: list[str], parts: int = HOT_PARTS) -> list[int]:
    """Hashes (``xxhash64``) of the keys that hold more than one of ``parts`` equal shares of the
    rows, and more than ``HOT_ROWS``.

    Fewer than ``parts`` numbers from one read of the key, by a frequency sketch of fixed size
    that tasks merge: nothing is shuffled by key. For how rows are dealt; no result hangs on it.
    """
    hashes = facts.dropna(subset=key).select(F.xxhash64(*key).alias("_hash"))
    found = hashes.agg(
        F.count(F.lit(1)).alias("total"), F.expr(f"approx_top_k(_hash, {parts}, {SKETCH_KEYS})").alias("top")
    ).first()
    return [t.item for t in found.top or [] if t["count"] > max(HOT_ROWS, found.total / parts)]


def attach(
    facts: DataFrame, dim: DataFrame, on: list[tuple[str, str]], null_safe: bool = False, hot: DataFrame | None = None
) -> DataFrame:
    """Left join to a lookup of one row per key; the lookup's key columns go away.

    Rows with a null key match nothing. They are told apart by a lane, so that a shuffle
    deals them over all its tasks. With ``hot`` (see :func:`hot_keys`) the rows of a hot key
    are dealt over its lanes as well, and its one lookup row is repeated for each lane. Both
    are in the plan and do not wait for a partition to turn out too large.
    """
    keys = [a for a, _ in on]
    right = dim.select(*[F.col(b).alias(f"_k_{b}") for _, b in on], *[c for c in dim.columns if c not in {b for _, b in on}])
    tests = [(a, f"_k_{b}") for a, b in on]
    spread = ROW_ORDER in facts.columns and not null_safe
    if not spread:
        return facts.join(right, _same(facts, right, tests, null_safe), "left").drop(*[k for _, k in tests])
    own = F.xxhash64(ROW_ORDER)
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    if hot is None:
        # Zero for every row; a plain constant would be taken out of the join's keys.
        lane, lanes = F.lit(0), F.pmod(F.xxhash64(*[k for _, k in tests]), F.lit(1)).cast("int")
        left = facts
    else:
        marked = hot.select(*[F.col(k).alias(f"_h_{n}") for n, k in enumerate(keys)], "_lanes")
        left = facts.join(marked, _same(facts, marked, [(k, f"_h_{n}") for n, k in enumerate(keys)], False), "left")
        lane = F.when(F.col("_lanes") > 1, F.pmod(own, F.col("_lanes")).cast("int")).otherwise(0)
        right = right.join(marked, _same(right, marked, [(k, f"_h_{n}") for n, (_, k) in enumerate(tests)], False), "left")
        lanes = F.explode(F.sequence(F.lit(0), F.coalesce("_lanes", F.lit(1)) - 1))
    left = left.withColumn("_lane", F.when(missing, F.pmod(own, F.lit(NULL_LANES)).cast("int")).otherwise(lane))
    right = right.withColumn("_k_lane", lanes)
    helpers = ["_lane", "_k_lane", *[k for _, k in tests]]
    if hot is not None:
        helpers += ["_lanes", *[f"_h_{n}" for n in range(len(keys))]]
        right = right.drop("_lanes", *[f"_h_{n}" for n in range(len(keys))])
    joined = left.join(right, _same(left, right, [*tests, ("_lane", "_k_lane")], False), "left")
    return joined.drop(*helpers)


# A vocabulary is repeated so often that its hottest code is dealt over as many tasks.
CODE_LANES = 256


def attach_code(facts: DataFrame, codes: DataFrame, on: list[tuple[str, str]]) -> DataFrame:
    """Left join to a vocabulary of one row per key, such as charge types or payment methods.

    Facts have few codes and very many rows of each. Shuffled by the code alone, they would
    lie in as many tasks as there are codes, whatever the cluster. The vocabulary is written
    first: then its size is known before the join is planned, and Spark sends a small one to
    the facts, which are not shuffled at all. Beside a large one they are dealt over lanes
    too, and it is repeated for each lane.
    """
    codes = stage(codes)
    own = F.xxhash64(ROW_ORDER if ROW_ORDER in facts.columns else F.struct(*facts.columns))
    lanes = F.explode(F.sequence(F.lit(0), F.lit(CODE_LANES - 1)))
    right = codes.select(
        *[F.col(b).alias(f"_k_{b}") for _, b in on], *[c for c in codes.columns if c not in {b for _, b in on}], lanes.alias("_k_lane")
    )
    left = facts.withColumn("_lane", F.pmod(own, F.lit(CODE_LANES)).cast("int"))
    tests = [*[(a, f"_k_{b}") for a, b in on], ("_lane", "_k_lane")]
    return left.join(right, _same(left, right, tests, False), "left").drop("_lane", *[k for _, k in tests])


def known_flag(
    facts: DataFrame, known: DataFrame, on: list[tuple[str, str]], flag: str = "_known", null_safe: bool = False
) -> DataFrame:
    """Left join that only marks whether the key exists already."""
    keys = known.select(*[b for _, b in on]).distinct().withColumn(flag, F.lit(True))
    return attach(facts, keys, on, null_safe).withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def without_known(
    facts: DataFrame,
    known: DataFrame,
    on: list[tuple[str, str]],
    null_safe: bool = False,
    only_where: Column | None = None,
) -> DataFrame:
    """Rows whose key does not exist yet, and those for which ``only_where`` does not hold."""
    right = known.select(*[F.col(b).alias(f"_k_{b}") for _, b in on])
    test = _same(facts, right, [(a, f"_k_{b}") for a, b in on], null_safe)
    if only_where is None:
        return facts.join(right, test, "left_anti")
    marked = facts.withColumn("_held", F.coalesce(only_where, F.lit(False)))
    test = _same(marked, right, [(a, f"_k_{b}") for a, b in on], null_safe)
    return marked.join(right, test & marked["_held"], "left_anti").drop("_held")


def only_known(facts: DataFrame, known: DataFrame, on: list[tuple[str, str]]) -> DataFrame:
    """Rows whose key exists."""
    right = known.select(*[F.col(b).alias(f"_k_{b}") for _, b in on])
    return facts.join(right, _same(facts, right, [(a, f"_k_{b}") for a, b in on], False), "left_semi")


def repeats(df: DataFrame, key: list[str], order: str) -> DataFrame:
    """Every row of a key except the first one.

    Only keys that do repeat take part in the join, and the group itself is never
    gathered: the first row is found by a combining aggregate. ``order`` must be
    stored or derived from the row, because the rows are read a second time.
    """
    firsts = (
        df.dropna(subset=key)
        .groupBy(*key)
        .agg(F.min(order).alias("_first"), F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1")
        .drop("_n")
    )
    right = firsts.select(*[F.col(k).alias(f"_k_{k}") for k in key], "_first")
    test = _same(df, right, [(k, f"_k_{k}") for k in key], False)
    return df.join(right, test, "inner").filter(F.col(order) != F.col("_first")).drop("_first", *[f"_k_{k}" for k in key])
