"""Reading named tables and seeds, writing model results, cutting lineage."""

from __future__ import annotations

import re
import tempfile
import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructField, StructType, VariantType


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A named raw table. Column pruning and filters reach the parquet scan."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def load_catalog_table(spark: SparkSession, full_name: str) -> DataFrame:
    """A table addressed by its catalog name (``catalog.schema.table``)."""
    return spark.table(full_name)


def fingerprint(spark: SparkSession, folder: str) -> str:
    """What the files below a folder are: changes when a file is added, removed, or written anew. Only their names, sizes
    and times are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    mark = F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)"))
    return "-".join(str(v) for v in files.agg(F.count(F.lit(1)), mark).first())


def load_seed(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """A small CSV reference table with a declared schema; nothing is inferred from the data."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def table_location(root: str, layer: str, alias: str) -> str:
    """Where a model of a layer lives: one folder per layer, one folder per alias."""
    return f"{root.rstrip('/')}/{layer}/{alias}"


def write_table(
    df: DataFrame,
    root: str,
    layer: str,
    alias: str,
    partition_by: list[str] | None = None,
    sort_by: list[str] | None = None,
    made: dict[str, Column] | None = None,
) -> DataFrame:
    """Full-refresh parquet sink. Returns the written table, so later models read files instead of recomputing.

    ``partition_by`` suits low-cardinality tags such as the source system: slices then prune folders. ``sort_by``
    orders rows inside each task only, which gives tight row-group statistics without a global sort. ``made`` are columns
    that are not stored but made of the stored ones whenever the table is read.
    """
    made = made or {}
    out = df.sortWithinPartitions(*sort_by) if sort_by else df
    out = out.drop(*made)
    writer = out.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    path = table_location(root, layer, alias)
    # rows are written where they are: a task keeps a file open for each of the few folders, so that rows are neither moved
    # nor sorted for them
    with setting(df.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", "16"):
        writer.parquet(path)
    # read with the model's own schema: partition values keep their type, column order stays
    stored = df.sparkSession.read.schema(StructType([StructField(f.name, f.dataType) for f in out.schema])).parquet(path)
    return stored.select(*[made[c].alias(c) if c in made else c for c in df.columns])


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for the time of a block."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def publish_view(df: DataFrame, alias: str) -> DataFrame:
    """View sink: the plan gets a name, nothing is stored."""
    df.createOrReplaceTempView(alias)
    return df.sparkSession.table(alias)


def publish_table(df: DataFrame, schema: str, alias: str) -> DataFrame:
    """Catalog sink: a full refresh of ``schema.alias`` (or ``catalog.schema.alias``) that readers never see half done.

    Rows go to a table of their own; then the name, a view, is pointed at it in one step. A reader keeps the version that
    it began with: the one before the current is kept until the refresh after the next, older ones are dropped. Tables lie
    in the shared folder. Returns the published table.
    """
    spark = df.sparkSession
    place = f"{shared_root(spark)}/catalog/{schema}"
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema} LOCATION '{place}'")
    # versions sort by their time
    version = f"{alias}__{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"
    df.write.option("path", f"{place}/{version}").saveAsTable(f"{schema}.{version}")
    point_view(spark, f"{schema}.{alias}", f"SELECT * FROM {schema}.{version}")
    names = sorted(r["tableName"] for r in spark.sql(f"SHOW TABLES IN {schema} LIKE '{alias}__*'").collect())
    for old in [n for n in names if re.fullmatch(rf"{re.escape(alias)}__\d{{20}}_[0-9a-f]{{8}}", n)][:-2]:
        spark.sql(f"DROP TABLE IF EXISTS {schema}.{old}")
    return spark.table(f"{schema}.{alias}")


def point_view(spark: SparkSession, name: str, query: str) -> DataFrame:
    """Persistent view sink: the name stands for the query from now on, in one step of the catalog."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")
    return spark.table(name)


_OWN_FOLDERS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: what ``spark.checkpoint.dir`` names.

    Where it is unset, a local session (one process) gets a temporary folder of its own; on a cluster that would leave
    every executor with its own files, so there it is an error.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not re.match(r"local(\[|$)", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if sc.applicationId not in _OWN_FOLDERS:
        _OWN_FOLDERS[sc.applicationId] = tempfile.mkdtemp(prefix="silverloom-")
    return _OWN_FOLDERS[sc.applicationId]


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder for checkpoints, unless the session has one set."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_root(spark))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of executors, and later steps start from files."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


LEAST_TASKS = 8  # tasks of ``dealt`` where the files are small


def spread_lookup(df: DataFrame, lookup: DataFrame, on: Sequence[str], salts: int = 16) -> DataFrame:
    """Left join with a lookup table whose few keys may each hold a large share of the rows.

    Rows are dealt by key and one of ``salts`` numbers, the lookup's rows once for each number, so no key meets in one
    task. Where Spark finds the lookup small enough to broadcast, it does so and nothing is dealt. The lookup has one row
    per key; null keys match nothing and are spread as well.
    """
    many = lookup.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = df.withColumn("__salt", F.pmod(F.xxhash64(*[F.col(c) for c in df.columns if _hashable(df, c)]), F.lit(salts)).cast("int"))
    return salted.join(many, [*on, "__salt"], "left").drop("__salt")


def dealt(df: DataFrame, keys: Sequence[str], source: DataFrame, each: int) -> DataFrame:
    """Rows dealt by their keys to as many tasks as the files of ``source`` hold ``each`` bytes, so a task's share stays the same
    however large they are. For rows that grow in memory far beyond their shuffled size, by which Spark would deal them."""
    tasks = tasks_for(source, each)
    return df.repartition(tasks, *keys) if tasks else df.repartition(*keys)


def tasks_for(source: DataFrame, each: int) -> int | None:
    """How many tasks get ``each`` bytes of the files that ``source`` reads; null where it reads none."""
    files = [unquote(f) for f in source.inputFiles()]
    if not files:
        return None
    size = source.sparkSession.read.format("binaryFile").load(files).agg(F.sum("length")).first()[0]
    return max(LEAST_TASKS, -(-size // each))


def _hashable(df: DataFrame, name: str) -> bool:
    return not isinstance(df.schema[name].dataType, (MapType, VariantType))
