"""Named queries: a DataFrame function over the tables of a folder, and the SQL its result is checked against."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverloom.sources.derived import DERIVED, inputs_of, spark_sql, with_inputs
from silverloom.sources.tables import load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Raw tables and derived inputs of one folder, by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._made: dict[str, DataFrame] = {}

    def __call__(self, name: str) -> DataFrame:
        if name not in self._made:
            if name in DERIVED:
                text = DERIVED[name]
                frames = {n: self(n) for n in inputs_of(text) if n != name}
                self._made[name] = self.sql(spark_sql(name), frames)
            else:
                self._made[name] = load(self.spark, self.folder, name)
        return self._made[name]

    def sql(self, text: str, frames: dict[str, DataFrame]) -> DataFrame:
        body = text.replace("{", "{{").replace("}", "}}")
        for n in frames:
            body = re.sub(rf"\b(FROM|JOIN)(\s+){n}\b", rf"\1\2{{{n}}}", body)
        return self.spark.sql(body, **frames)


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that two engines compare values and not decimal scales."""
    cols = [F.col(n).cast("double").alias(n) if t.startswith("decimal") else F.col(n) for n, t in df.dtypes]
    return df.select(*cols)


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under a name, with its SQL where SQL can say it."""

    def add(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: plain(fn(Tables(spark, folder)))
        if sql is not None:
            ORACLES[name] = with_inputs(sql)
        return fn

    return add
