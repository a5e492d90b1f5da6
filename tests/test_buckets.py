from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from leaseload.operators.buckets import (
    bucket_of, create, current_rows, key_filter, may_be_stored, merged, update, without_stored,
)

COLUMNS = ["id", "v", "created"]


@pytest.fixture
def table(spark, tmp_path):
    folder = str(tmp_path / "t")
    rows = spark.range(2000).select("id", F.lit("old").alias("v"), F.lit("then").alias("created"))
    create(rows, ["id"], folder, buckets=64)
    return folder


def files(tmp_path, version):
    return {p.name for p in (tmp_path / "t" / "rows" / f"version={version}").iterdir() if p.is_dir()}


def test_an_update_rewrites_the_touched_buckets_only(spark, tmp_path, table):
    source = spark.createDataFrame([(n, "new", "now") for n in (3, 700, 1999, 5000)], "id bigint, v string, created string")
    touched = {f"bucket={r.b}" for r in source.select(bucket_of(["id"], 64).alias("b")).collect()}
    update(spark, table, source, ["id"], ["v"], COLUMNS, buckets=64)
    assert files(tmp_path, 2) == touched and len(files(tmp_path, 1)) == 64
    rows = {r.id: (r.v, r.created) for r in current_rows(spark, table).collect()}
    assert len(rows) == 2001 and rows[5000] == ("new", "now")
    assert {n: rows[n] for n in (3, 700, 1999)} == dict.fromkeys((3, 700, 1999), ("new", "then"))
    assert sum(v == ("old", "then") for v in rows.values()) == 1997
    # A second update reads the newest version of each bucket.
    update(spark, table, source.withColumn("v", F.lit("newer")).filter("id = 3"), ["id"], ["v"], COLUMNS, buckets=64)
    rows = {r.id: r.v for r in current_rows(spark, table).collect()}
    assert (len(rows), rows[3], rows[700], rows[4]) == (2001, "newer", "new", "old")


def test_a_version_without_its_line_in_the_log_is_not_seen(spark, tmp_path, table):
    half = spark.range(5).select("id", F.lit("half").alias("v"), F.lit("x").alias("created"), bucket_of(["id"], 64).alias("bucket"))
    half.write.partitionBy("bucket").parquet(f"{table}/rows/version=2")
    assert {r.v for r in current_rows(spark, table).collect()} == {"old"}


def test_files_of_other_buckets_are_not_read(spark, table):
    touched = spark.createDataFrame([(7,)], "bucket int")
    rows = current_rows(spark, table, touched)
    assert [r.bucket for r in rows.select("bucket").distinct().collect()] == [7]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_filter_is_never_wrong_about_missing_keys(spark):
    stored = spark.range(0, 3000, 3).select(F.col("id").cast("string").alias("k"))
    rows = spark.range(4000).select(F.col("id").cast("string").alias("k")).unionByName(spark.createDataFrame([(None,)], "k string"))
    parts = [key_filter(part, ["k"], 1 << 14) for part in stored.randomSplit([0.5, 0.5], 1)]
    sieve = merged(parts)
    whole = key_filter(stored, ["k"], 1 << 14)
    assert sorted(map(tuple, sieve.collect())) == sorted(map(tuple, whole.collect()))
    flags = {r.k: r._maybe for r in may_be_stored(rows, sieve, ["k"], 1 << 14).collect()}
    assert all(flags[str(n)] for n in range(0, 3000, 3)) and flags[None] is False
    false = sum(flags[str(n)] for n in range(4000) if n % 3 or n >= 3000)
    assert 0 < false < 150
    left = without_stored(rows, stored, sieve, ["k"], 1 << 14)
    assert sorted((r.k or "") for r in left.collect()) == sorted(["", *[str(n) for n in range(4000) if n % 3 or n >= 3000]])


def test_ruled_out_rows_skip_the_shuffle(spark):
    """Of many new rows and few stored ones, only those the filter lets through are shuffled."""
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        stored = spark.range(100).select(F.col("id").alias("k"))
        rows = spark.range(50, 20050).select(F.col("id").alias("k"))
        sieve = key_filter(stored, ["k"], 1 << 14)
        left = without_stored(rows, stored, sieve, ["k"], 1 << 14)
        assert left.count() == 19950
        asked = may_be_stored(rows, sieve, ["k"], 1 << 14).filter("_maybe").count()
        assert 50 <= asked < 300
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
