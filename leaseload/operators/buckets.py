"""Stored tables in hash buckets, of which an update rewrites only those it touches.

A table is a folder of versions, each holding some of the buckets:

    <folder>/rows/version=3/bucket=17/*.parquet      the rows of a bucket as of version 3
    <folder>/log/version=3/*.parquet                 which buckets version 3 holds

The current rows of a bucket are those of its newest version. A write adds a version and
changes no file that anybody reads; the log is written last, so a version that died half
way is not seen. A key lies in one bucket by its hash, so an update of some keys reads and
writes the buckets of these keys and no others.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leaseload.operators.load import upsert

BUCKETS = 1_024
MOST_BUCKETS = 1 << 16
_BUCKET, _VERSION = "bucket", "version"


def bucket_of(key: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def _log(spark: SparkSession, folder: str) -> DataFrame:
    """(bucket, version): the newest version of each bucket, one row per bucket."""
    log = spark.read.schema(f"{_BUCKET} int, {_VERSION} int").parquet(f"{folder}/log")
    return log.groupBy(_BUCKET).agg(F.max(_VERSION).alias(_VERSION))


def current_rows(spark: SparkSession, folder: str, touched: DataFrame | None = None) -> DataFrame:
    """The current rows, with their ``bucket``; of the ``touched`` buckets only, if given.

    The folders are named in a partition filter (one name per bucket, ``MOST_BUCKETS`` at
    most), so files of other buckets and versions are not read.
    """
    newest = _log(spark, folder)
    if touched is not None:
        newest = newest.join(touched, _BUCKET, "left_semi")
    names = [f"{r.version}/{r.bucket}" for r in newest.head(MOST_BUCKETS)]
    rows = spark.read.parquet(f"{folder}/rows")
    return rows.filter(F.concat_ws("/", F.col(_VERSION), F.col(_BUCKET)).isin(names)).drop(_VERSION)


def _write(rows: DataFrame, buckets: DataFrame, folder: str, version: int) -> None:
    """Rows of whole buckets as a version, then its line in the log."""
    target = f"{folder}/rows/{_VERSION}={version}"
    # Each bucket goes to one task; a bucket is what one task can sort and write.
    rows.repartition(_BUCKET).write.mode("errorifexists").partitionBy(_BUCKET).parquet(target)
    listed = buckets.select(_BUCKET, F.lit(version).alias(_VERSION))
    listed.coalesce(1).write.mode("append").parquet(f"{folder}/log")


def create(rows: DataFrame, key: list[str], folder: str, buckets: int = BUCKETS) -> None:
    """Store a table whose ``key`` is unique. ``buckets`` stays what it is for the table's life."""
    placed = rows.withColumn(_BUCKET, bucket_of(key, buckets))
    _write(placed, rows.sparkSession.range(buckets).select(F.col("id").cast("int").alias(_BUCKET)), folder, 1)


def update(
    spark: SparkSession, folder: str, source: DataFrame, key: list[str], update_columns: list[str],
    columns: list[str], buckets: int = BUCKETS,
) -> None:
    """Update or insert ``source`` (one row per key), see :func:`leaseload.operators.load.upsert`.

    ``columns`` are the table's columns. Only the buckets that the keys of ``source`` lie in
    are read and written again.
    """
    placed = source.withColumn(_BUCKET, bucket_of(key, buckets))
    touched = placed.select(_BUCKET).distinct()
    target = current_rows(spark, folder, touched).select(*columns, _BUCKET)
    merged = upsert(target, placed, [*key, _BUCKET], update_columns)
    version = 1 + spark.read.parquet(f"{folder}/log").agg(F.max(_VERSION)).first()[0]
    _write(merged, touched, folder, version)


# -- a filter over stored keys ----------------------------------------------------------

HASHES = 3
BITS_PER_KEY = 16


def key_filter(rows: DataFrame, key: list[str], bits: int) -> DataFrame:
    """(word, bits): a Bloom filter over the keys of ``rows``, as words of 64 bits.

    Filters of parts of a table merge by :func:`merged`; ``bits`` is a power of two, and the
    filter has at most ``bits`` / 64 rows however many keys there are.
    """
    slots = F.explode(F.array(*_slots(key, bits)))
    placed = rows.dropna(subset=key).select(slots.alias("slot"))
    words = placed.select(F.shiftright("slot", 6).alias("word"), F.expr("shiftleft(1L, CAST(slot & 63 AS INT))").alias("bits"))
    return words.groupBy("word").agg(F.bit_or("bits").alias("bits"))


def _slots(key: list[str], bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(*key, F.lit(n)), F.lit(bits)) for n in range(HASHES)]


def merged(filters: list[DataFrame]) -> DataFrame:
    every = reduce(DataFrame.unionByName, filters)
    return every.groupBy("word").agg(F.bit_or("bits").alias("bits"))


def may_be_stored(rows: DataFrame, stored: DataFrame, key: list[str], bits: int, flag: str = "_maybe") -> DataFrame:
    """``rows`` with a flag: false where the filter rules the key out, which is never wrong.

    The filter is bounded by its bits and joined like any lookup: sent to the tasks while
    Spark's own size estimate allows it.
    """
    for n, slot in enumerate(_slots(key, bits)):
        words = stored.select(F.col("word").alias(f"_w{n}"), F.col("bits").alias(f"_b{n}"))
        rows = rows.withColumn(f"_s{n}", slot)
        rows = rows.join(words, F.shiftright(f"_s{n}", 6) == F.col(f"_w{n}"), "left")
    tests = [F.coalesce(F.expr(f"getbit(_b{n}, CAST(_s{n} & 63 AS INT)) = 1"), F.lit(False)) for n in range(HASHES)]
    held = reduce(lambda a, b: a & b, [*tests, *[F.col(k).isNotNull() for k in key]])
    return rows.withColumn(flag, held).drop(*[f"_{c}{n}" for c in "swb" for n in range(HASHES)])


def without_stored(rows: DataFrame, stored: DataFrame, sieve: DataFrame, key: list[str], bits: int) -> DataFrame:
    """Rows whose key is not stored. Keys that ``sieve`` (see :func:`key_filter`) rules out
    skip the shuffled join; for the others the join decides, so a false alarm costs a row in
    it and no result. Rows with a null key are all kept."""
    sifted = may_be_stored(rows, sieve, key, bits)
    passed = sifted.filter("NOT _maybe").drop("_maybe")
    asked = sifted.filter("_maybe").drop("_maybe")
    return passed.unionByName(asked.join(stored.select(*key).distinct(), key, "left_anti"))
