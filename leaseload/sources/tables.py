"""Stored target and reference tables, read as snapshots with a scope predicate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leaseload.functions.numbers import whole_number
from leaseload.functions.text import squeeze
from leaseload.params import Params


def read_table(spark: SparkSession, path: str, columns: tuple[str, ...], scope: Column | None = None) -> DataFrame:
    """Parquet snapshot cut to the columns and rows a plan needs; both reach the scan."""
    table = spark.read.parquet(path)
    return (table if scope is None else table.filter(scope)).select(*columns)


JDBC_SPLIT = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")


def read_jdbc_table(
    spark: SparkSession, url: str, table: str, columns: tuple[str, ...], scope: Column | None = None, **options: str
) -> DataFrame:
    """Same over JDBC. ``options`` must name how the read is split, since one task would
    otherwise read the whole table."""
    missing = [name for name in JDBC_SPLIT if name not in options]
    if missing:
        raise ValueError(f"a JDBC read needs {', '.join(missing)}")
    rows = spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
    return (rows if scope is None else rows.filter(scope)).select(*columns)


def in_organization(params: Params) -> Column:
    return F.col("organization_id") == params.organization_id


def in_location(params: Params) -> Column:
    return F.col("location_id") == params.location_id


def _largest_id(pairs: DataFrame, key: str, name: str) -> DataFrame:
    """One id per key; where a key has several the largest wins."""
    return pairs.dropna(subset=[key]).groupBy(key).agg(F.max("id").alias(name))


def customers_by_number(customers: DataFrame) -> DataFrame:
    """Numeric external id -> customer id. Ids that are not numbers cannot match."""
    return _largest_id(customers.select(whole_number("external_id").alias("tenant_id"), "id"), "tenant_id", "customer_id")


def customers_by_text(customers: DataFrame) -> DataFrame:
    """Text external id -> customer id."""
    return _largest_id(customers.select(squeeze("external_id").alias("tenant_key"), "id"), "tenant_key", "customer_id")


def units_by_name(units: DataFrame) -> DataFrame:
    """Unit number -> unit id."""
    return _largest_id(units.select(squeeze("unit_number").alias("unit_name"), "id"), "unit_name", "unit_id")
