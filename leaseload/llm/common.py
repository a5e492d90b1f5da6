"""What the text operators share: the shared folder, written tables, free column names."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leaseload.sources.exports import shared_folder

# Python workers get this many rows at a time: a text may be very long, and a batch
# of the default 10,000 texts would not fit beside a heap.
BATCH_ROWS = "1000"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table once to the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read of files that do not change,
    and row numbers taken before the write stay what they are.
    """
    spark = df.sparkSession
    target = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    # This codec works in the heap; the default one holds buffers outside it until a
    # collection finds them, and a job over many small files piles them up.
    df.write.option("compression", "zstd").parquet(target)
    return spark.read.schema(df.schema).parquet(target)


def tuned(spark: SparkSession) -> SparkSession:
    """Session settings the text operators are written for.

    Python workers import this package; where it lies outside their path, as with a
    driver started in another folder, its place is added.
    """
    environment = spark.sparkContext.environment
    root = str(Path(__file__).resolve().parents[2])
    paths = [p for p in environment.get("PYTHONPATH", "").split(":") if p]
    if root not in paths:
        environment["PYTHONPATH"] = ":".join([*paths, root])
    for name, value in {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": BATCH_ROWS,
    }.items():
        spark.conf.set(name, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tuned(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name the frame does not use yet, in any case of letters."""
    used = {c.lower() for c in df.columns}
    while wanted.lower() in used:
        wanted = f"_{wanted}"
    return wanted


def text_or_empty(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def per_text(function: Callable[[str], tuple], schema: str) -> Callable[[Column], Column]:
    """A column function that gets one text and returns the fields of a struct.

    Texts arrive in Arrow batches; the function sees each whole text once.
    """
    names = [field.split()[0] for field in schema.split(",")]

    def over(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([function(t) for t in texts], columns=names)

    over.__annotations__ = {"texts": pd.Series, "return": pd.DataFrame}
    return F.pandas_udf(over, f"struct<{','.join(f'{f.split()[0]}:{f.split()[1]}' for f in schema.split(','))}>")
