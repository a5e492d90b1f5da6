"""Gate log load over a folder that exports keep arriving in.

The plan has no key, join or state, so it runs unchanged over a stream. Each run
takes the files that came since the last one and appends them once; the
checkpoint remembers which files are done, also when a run dies half way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from leaseload.params import Params
from leaseload.plans.gate import load_gate_log
from leaseload.sources.exports import READ_OPTIONS, ROW_ORDER, na_to_null


def gate_stream(spark: SparkSession, folder: str, columns: tuple[str, ...], encoding: str = "UTF-8") -> DataFrame:
    """New CSV exports of a folder, all text, read as the batch reader reads them.

    ``columns`` is the header in file order, as it is written in the files. A file with
    another header ends the run.
    """
    schema = ", ".join(f"`{c}` STRING" for c in columns)
    read = spark.readStream.options(**READ_OPTIONS).option("enforceSchema", False).option("encoding", encoding)
    rows = read.schema(schema).csv(folder)
    cells = [F.col(f"`{c}`").alias(c.strip().upper()) for c in columns]
    return na_to_null(rows.select(*cells)).withColumn(ROW_ORDER, F.lit(None).cast("bigint"))


def append_gate_events(events: DataFrame, params: Params, target: str, checkpoint: str) -> StreamingQuery:
    """Start a run that loads every file not loaded yet and then stops by itself."""
    accepted = load_gate_log(events, params).accepted
    return (
        accepted.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )
