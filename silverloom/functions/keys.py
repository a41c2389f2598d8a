"""Business keys, hashes and the audit envelope every conformed row starts with."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN_END = "9999-12-31"
OPEN_START = "1900-01-01"
# Metadata of a key and of its hash, each with the other's name.
HASHED_AS, HASH_OF = "hashed_as", "hash_of"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_key(*cols: str | Column, sep: str = ":") -> Column:
    """md5 of one key, or of several joined by ``sep``; null if any part is null."""
    return F.md5(composite_key(*cols, sep=sep))


def composite_key(*cols: str | Column, sep: str = ":") -> Column:
    """Text key out of several columns; null if any part is null."""
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if i and sep:
            parts.append(F.lit(sep))
        parts.append(col(c).cast("string"))
    return F.concat(*parts)


def marked_key(c: str | Column, name: str) -> Column:
    """A key as text whose hash stands beside it as ``hash_<name>``; its metadata says so."""
    return col(c).cast("string").alias(name, metadata={HASHED_AS: f"hash_{name}"})


def marked_hash(c: str | Column, name: str) -> Column:
    """The hash of the key ``name``; its metadata says of which column it can be made anew."""
    return hash_key(c).alias(f"hash_{name}", metadata={HASH_OF: name})


def first_non_null(*cols: str | Column) -> Column:
    return F.coalesce(*[col(c) for c in cols])


def with_envelope(df: DataFrame, system: str, model: str, as_of: str | Column) -> DataFrame:
    """Prefix rows with system tag, audit and effective-window columns.

    ``as_of`` replaces the wall clock, so a rerun of the same load gives the same rows.
    """
    stamp = F.lit(as_of).cast("timestamp_ntz") if isinstance(as_of, str) else as_of.cast("timestamp_ntz")
    head = [
        F.lit(system).alias("src_sys_key"),
        stamp.alias("dts_created_at"),
        F.lit(model).alias("created_by"),
        stamp.alias("dts_updated_at"),
        F.lit(model).alias("updated_by"),
        stamp.alias("dts_eff_start"),
        F.lit(OPEN_END).cast("timestamp_ntz").alias("dts_eff_end"),
        F.lit(True).alias("bln_current"),
    ]
    taken = {"src_sys_key", "dts_created_at", "created_by", "dts_updated_at", "updated_by", "dts_eff_start",
             "dts_eff_end", "bln_current"}
    return df.select(*head, *[c for c in df.columns if c not in taken])
