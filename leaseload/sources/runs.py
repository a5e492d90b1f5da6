"""Run history: reading, counting and adding run records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leaseload.functions.dates import duration_text
from leaseload.operators.keys import latest_rows

RUN_SCHEMA = (
    "run_id string, migration_type string, label string, files array<string>, dry_run boolean, "
    "started_at string, finished_at string, status string, exit_code bigint, duration string, "
    "log_file string, skipped_file string, error_file string, summary_file string, output_file string"
)
HISTORY_SCHEMA = f"runs array<struct<{RUN_SCHEMA}>>"


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """Run records of a history file."""
    return spark.read.schema(HISTORY_SCHEMA).option("multiLine", True).json(path).select(F.inline("runs"))


def parse_runs(texts: DataFrame, column: str) -> DataFrame:
    """Run records of history documents held as text, one document per row."""
    return texts.select(F.from_json(column, HISTORY_SCHEMA).alias("history")).select(F.inline("history.runs"))


def with_duration(runs: DataFrame) -> DataFrame:
    started, finished = (F.col(c).try_cast("timestamp_ntz") for c in ("started_at", "finished_at"))
    return runs.withColumn("duration", duration_text(started, finished))


def run_statistics(runs: DataFrame) -> DataFrame:
    """Totals and the newest run, one row."""
    return runs.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") == "success").alias("success"),
        F.count_if(F.col("status") == "error").alias("errors"),
        F.max_by("run_id", F.struct("started_at", "run_id")).alias("last_run"),
    )


def newest_runs(runs: DataFrame, limit: int | None = None) -> DataFrame:
    """Newest first; with a limit Spark keeps only that many rows per task."""
    ordered = runs.orderBy(F.col("started_at").desc(), F.col("run_id").desc())
    return ordered if limit is None else ordered.limit(limit)


def record_run(history: DataFrame, run: DataFrame) -> DataFrame:
    """History with a run added, or replaced where its id is there already."""
    both = history.withColumn("_new", F.lit(0)).unionByName(run.withColumn("_new", F.lit(1)))
    return latest_rows(both, ["run_id"], F.col("_new"), ["started_at"]).drop("_new")
