"""Which rows may be learned from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(id_col: str | Column, folds: int) -> Column:
    """crc32 of the id as text, by folds; a null id counts as the text of no letters."""
    key = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds


def sampled_labels(labels: DataFrame, label_col: str, train: Column, bound: int, id_col: str = "doc_id") -> DataFrame:
    """At most ``bound`` rows (doc_id, label) of the labels that may be learned from, picked by a hash of the id."""
    return (
        labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
        .filter(train & F.col("label").isin(0, 1) & F.col("doc_id").isNotNull()).distinct()
        .orderBy(F.xxhash64(F.col("doc_id").cast("string"), F.lit(29)), "doc_id", "label").limit(bound)
    )
