"""Session settings the plans are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# The settings are runtime settings of the SQL session, so they can be made on a
# session that somebody else has built.
#
# A plan derives some thirty columns in one projection. Fused into one generated
# method that is beyond the 8,000 bytes up to which the JVM compiles a method, and
# the method would run interpreted. Below this limit Spark splits it instead.
#
# Splits of this size hold about a million rows of an export, so that a task's sorts and
# partial aggregates stay within its memory without a shuffle that only deals rows.
TUNED = {
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    for name, value in TUNED.items():
        spark.conf.set(name, value)
    return spark
