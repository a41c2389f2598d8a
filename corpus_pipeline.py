"""The corpus pipeline: documents to packed sequences in five stages, each written as Parquet and read by the next.

Every stage but the last returns the columns of documents. A stage works on all that the one before it kept.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverloom.llm import language, mixing, odd_sketch, packing, quality
from silverloom.llm.queries import MIX_WEIGHTS, domain, held_out
from silverloom.llm.storage import shared_folder, stored
from silverloom.sources.tables import load

LEAST_QUALITY = 0.3
MIX_SHARE = 0.9  # of the tokens there are


def _filtered(docs: DataFrame, name: str, verdict, keep) -> DataFrame:
    """The rows whose verdict is to keep them, with their own columns only, in a name that none of them has."""
    own = f"_{name}_{uuid.uuid4().hex}"
    return docs.withColumn(own, verdict).filter(keep(F.col(own))).select(*docs.columns)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text scores at least LEAST_QUALITY; null texts count as empty, which the model's constant decides."""
    weights = quality.train(docs, load(spark, sf_dir, "labels"), ~held_out("quality"))
    return _filtered(docs, "quality", quality.score(weights, spark)("text"), lambda score: score >= LEAST_QUALITY)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language is told by a margin that is not narrow; texts without a letter go."""
    read = language.identify(language.train(docs, ~held_out("lang")), spark)
    return _filtered(docs, "language", read("text"), lambda r: language.is_sure(r["margin"], r["lang_pred"]))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, that with the smallest id, one without an id only where no other has one;
    five words, 0.8. Groups are found on a key of each row's own, so missing and repeated ids cost no text."""
    key = f"_row_{uuid.uuid4().hex}"
    rows = stored(docs.withColumn(key, F.monotonically_increasing_id()))
    groups = odd_sketch.near_duplicates(rows, id_col=key).select(F.col("doc_id").alias(key), "component_id")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.col(key).alias("row"))).alias("m")
    kept = rows.select(key, "doc_id").join(groups, key).groupBy("component_id").agg(first).select(F.col("m.row").alias(key))
    return rows.join(kept, key, "left_semi").drop(key)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the proportions of MIX_WEIGHTS, MIX_SHARE of the words there are, each document at most once. The
    document at which a leaf's budget ends stays whole."""
    levels = [domain(F.col("source")), F.col("lang"), F.col("source")]
    out = mixing.mix(docs, levels, mixing.word_count(F.col("text")), MIX_WEIGHTS, MIX_SHARE, max_epochs=1, seed=1)
    return out.select("_row.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces with their place in a sequence of 2048 tokens."""
    made = packing.pieces(docs)
    return packing.pack(made.withColumn("ids", F.crc32("ids")).withColumnRenamed("ids", "ids_crc32"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality), ("language", known_language), ("near_duplicates", without_near_duplicates), ("mixing", mixed), ("packing", packed),
]
#: SQL cannot train a model, compress or tokenise; the tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's rows are written to the shared folder and read again."""
    root = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = load(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{root}/{k}-{name}")
        docs = spark.read.schema(out.schema).parquet(f"{root}/{k}-{name}")
    return docs
