"""Labelled rows for fitting a classifier, and its folds."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, in_fit: Column, rows_per_class: int
) -> pd.DataFrame:
    """(doc_id, text, y): at most ``rows_per_class`` rows of each label, by hash of the id.

    Texts are whole. An id labelled more
    than once has its largest label; ids without a text or a label are left out.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("y")).dropna().filter(in_fit)
    known = known.groupBy("doc_id").agg(F.max("y").alias("y"))
    order = F.xxhash64(F.col("doc_id"), F.lit(label))
    picked = known.filter("y = 0").orderBy(order, "doc_id").limit(rows_per_class).unionByName(
        known.filter("y = 1").orderBy(order, "doc_id").limit(rows_per_class)
    )
    # Bounded: two classes of rows_per_class ids.
    texts = docs.select("doc_id", "text").dropna()
    found = texts.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    return found.toPandas().sort_values("doc_id", ignore_index=True)
