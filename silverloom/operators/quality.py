"""Data-quality checks. Each gives a DataFrame of results; an empty result or ``ok`` everywhere means the rule holds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Number of nulls per column, all rules in one pass."""
    sums = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_nulls")) for c in cols]))
    return sums.select(rows.alias("r")).select("r.*").withColumn("ok", F.col("n_nulls") == 0)


def unique(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count. Nulls are left to ``not_null``."""
    rows = df
    for c in cols:
        rows = rows.filter(F.col(c).isNotNull())
    return rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def counts_match(model: DataFrame, expected: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Row counts of a model and of its sources, overall or per tag, side by side."""
    m = model.groupBy(*by).agg(F.count(F.lit(1)).alias("n_model"), F.lit(0).cast("long").alias("n_expected"))
    e = expected.groupBy(*by).agg(F.lit(0).cast("long").alias("n_model"), F.count(F.lit(1)).alias("n_expected"))
    both = m.unionByName(e).groupBy(*by).agg(F.sum("n_model").alias("n_model"), F.sum("n_expected").alias("n_expected"))
    return both.withColumn("ok", F.col("n_model") == F.col("n_expected"))


class ContractError(ValueError):
    """A model does not have the columns it declares."""


def contract_differences(df: DataFrame, contract: StructType) -> list[str]:
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    want = {f.name: f.dataType.simpleString() for f in contract}
    out = [f"missing column {n} {t}" for n, t in want.items() if n not in have]
    out += [f"column {n} is {have[n]}, declared {t}" for n, t in want.items() if n in have and have[n] != t]
    out += [f"undeclared column {n} {t}" for n, t in have.items() if n not in want]
    return out


def check_schema(df: DataFrame, contract: StructType) -> DataFrame:
    """The frame itself, if names and types match the contract; reads no data."""
    bad = contract_differences(df, contract)
    if bad:
        raise ContractError("; ".join(bad))
    return df.select(*[f.name for f in contract])
