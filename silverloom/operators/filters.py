"""Row filters and classifications."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverloom.functions.keys import col
from silverloom.operators.windows import neighbour
from silverloom.sources.tables import spread_lookup


def drop_deleted(df: DataFrame, *flags: str | Column) -> DataFrame:
    """Keep rows whose soft-delete flags are all false; a null flag drops the row."""
    for f in flags:
        df = df.filter(~col(f))
    return df


def slice_system(df: DataFrame, system: str) -> DataFrame:
    """Rows of one source system; prunes folders where the table is partitioned by the tag."""
    return df.filter(F.col("src_sys_key") == system)


def keep_between(df: DataFrame, c: str, low, high) -> DataFrame:
    return df.filter(F.col(c).between(low, high))


def keep_matching(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    """Semi join: rows whose key occurs in ``keys``; never multiplies rows.

    Keys are made distinct first: repeats collapse map side, and the join reuses that partitioning.
    """
    return df.join(keys.distinct(), on, "left_semi")


def drop_matching(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    """Anti join: rows whose key does not occur in ``keys``. A null among the keys does not empty the result."""
    return df.join(keys.distinct(), on, "left_anti")


def class_flags(links: DataFrame, code: str, classes: dict[str, Column]) -> DataFrame:
    """One row per code with a boolean per class, from a link table that may list a code many times."""
    return links.groupBy(code).agg(
        *[F.max(F.coalesce(cond, F.lit(False))).alias(name) for name, cond in classes.items()]
    )


def classify(df: DataFrame, code: str, flags: DataFrame, flags_code: str | None = None) -> DataFrame:
    """Attach class flags to rows by code: one lookup join instead of a subquery per class.

    Codes are few and each may hold a large share of the rows, so rows that are shuffled are dealt by code and a salt.
    """
    names = [c for c in flags.columns if c != (flags_code or code)]
    right = flags.select(F.col(flags_code or code).alias("__code"), *names)
    out = spread_lookup(df.withColumn("__code", F.col(code)), right, ["__code"]).drop("__code")
    return out.withColumns({n: F.coalesce(F.col(n), F.lit(False)) for n in names})


def require_header(lines: DataFrame, header: DataFrame, on) -> DataFrame:
    """Lines with their header's columns; lines without a header are dropped."""
    return lines.join(header, on, "inner")


def changed(df: DataFrame, key: str, order: str, code: str, numeric_change: str, reasons: list[str],
            reason: str, rate_flag: str, ties: list[str] | None = None) -> DataFrame:
    """Rows that record a change: a numeric change, a rate flag, a listed reason, or a code other than the one before.

    The test keeps three-valued logic: a null part alone never keeps a row.
    """
    df = neighbour(df, [key], order, code, f"previous_{code}", ties=ties, offset=-1)
    return df.filter(
        (F.col(numeric_change) != 0)
        | F.col(rate_flag)
        | F.col(reason).isin(reasons)
        | (F.col(f"previous_{code}") != F.col(code))
    )
