"""The same person or project across systems: identity resolution and golden rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverloom.operators.filters import drop_matching, slice_system
from silverloom.operators.stack import stack


def resolve_identity(rows: DataFrame, master: str, others: Sequence[str], cols: Sequence[str],
                     link: str = "hash_link") -> DataFrame:
    """Rows of the master system with the matching rows of the other systems beside them, by link.

    A null link matches nothing. Columns of each system are named ``<system>_<column>``.
    """
    def side(system: str) -> DataFrame:
        return slice_system(rows, system).select(
            F.col(link).alias(f"__{system}"), *[F.col(c).alias(f"{system}_{c}") for c in cols]
        )

    out = side(master)
    for system in others:
        right = side(system).filter(F.col(f"__{system}").isNotNull())
        out = out.join(right, F.col(f"__{master}") == F.col(f"__{system}"), "left")
    return out.drop(*[f"__{s}" for s in [master, *others]])


def golden(rows: DataFrame, master: str, others: Sequence[str], cols: Sequence[str], prefer: dict[str, Sequence[str]],
           link: str = "hash_link") -> DataFrame:
    """One row per master entity: each column takes the first non-blank value in its order of systems."""
    wide = resolve_identity(rows, master, others, cols, link)
    out = [F.col(f"{master}_key").alias("key")]
    out += [F.col(f"{s}_key").alias(f"key_{s}") for s in others]
    text = {n for n, t in wide.dtypes if t == "string"}
    for c, order in prefer.items():
        parts: list[Column] = []
        for s in order:
            name = f"{s}_{c}"
            parts.append(F.nullif(F.col(name), F.lit("")) if name in text else F.col(name))
        out.append(F.coalesce(*parts).alias(c))
    return wide.select(*out)


def master_plus_unmatched(master: DataFrame, second: DataFrame, on: Sequence[str]) -> DataFrame:
    """All rows of the master directory and those of the second that have no counterpart in it."""
    return stack(master, drop_matching(second, master.select(*on), list(on)))
