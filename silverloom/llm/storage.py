"""Intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from silverloom.sources.tables import ensure_checkpoint_dir


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as ``spark.checkpoint.dir`` names it."""
    ensure_checkpoint_dir(spark)
    return spark.sparkContext.getCheckpointDir()


def stored(df: DataFrame) -> DataFrame:
    """The rows written once as parquet; what follows reads files, so a lost executor costs a reread and no recomputing."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
