"""Ancestors to any depth: top ancestor, inherited attributes, path."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverloom.sources.tables import cut_lineage


def ancestors(df: DataFrame, key: str, parent: str, carry: Sequence[str] = ()) -> DataFrame:
    """One row per node with its whole ancestor chain, nearest first, in the array ``chain``, and ``in_cycle``.

    Each entry is a struct of key and carried columns. A parent that is not in the table ends the chain. A chain that runs
    into a cycle ends before the first node that would come twice, and ``in_cycle`` marks it. Chains are doubled: each
    round appends the far ancestor's own chain, so a depth of 1000 takes ten joins; rounds go on until no chain grows.
    They are checkpointed, which keeps the plan from doubling as well.
    """
    node = F.struct(F.col(key).alias("key"), *[F.col(c) for c in carry])
    side = df.select(F.col(key).alias("__pk"), node.alias("__node"))
    first = df.select(F.col(key).alias("key"), F.col(parent).alias("__parent"))
    hops = _without_cycle(
        first.join(side, F.col("__parent") == F.col("__pk"), "left")
        .select("key", F.when(F.col("__pk").isNotNull(), F.array("__node")).alias("chain"))
        .select("key", F.coalesce("chain", F.array().cast(_chain_type(df, key, carry))).alias("chain"), (F.size("chain") == 1).alias("grows"),
                F.lit(False).alias("in_cycle"))
    )
    while True:
        hops = cut_lineage(hops)
        if hops.filter("grows").isEmpty():
            return hops.drop("grows")
        far = hops.select(F.col("key").alias("__fk"), F.col("chain").alias("__more"), F.col("grows").alias("__on"), F.col("in_cycle").alias("__cycle"))
        # only chains that still grow go on; the others have met a root or a cycle
        ahead = F.when(F.col("grows"), F.try_element_at("chain", F.lit(-1))["key"])
        grown = (
            hops.withColumn("__far", ahead)
            .join(far, F.col("__far") == F.col("__fk"), "left")
            .select("key", F.when(F.col("__more").isNull(), F.col("chain")).otherwise(F.concat("chain", "__more")).alias("chain"),
                    F.coalesce("__on", F.lit(False)).alias("grows"), (F.col("in_cycle") | F.coalesce("__cycle", F.lit(False))).alias("in_cycle"))
        )
        hops = _without_cycle(grown)


def _without_cycle(hops: DataFrame) -> DataFrame:
    """Chains up to where a node would come twice; those grow no more."""
    keys = F.concat(F.array("key"), F.col("chain")["key"])
    once = F.size(F.array_distinct(keys)) - 1
    cycle = once < F.size("chain")
    return hops.select("key", F.slice("chain", F.lit(1), once).alias("chain"), (F.col("grows") & ~cycle).alias("grows"),
                       (F.col("in_cycle") | cycle).alias("in_cycle"))


def _chain_type(df: DataFrame, key: str, carry: Sequence[str]) -> str:
    kinds = dict(df.dtypes)
    fields = [f"key: {kinds[key]}", *[f"{c}: {kinds[c]}" for c in carry]]
    return f"array<struct<{', '.join(fields)}>>"


def hierarchy(df: DataFrame, key: str, parent: str, name: str | None = None, inherit: Sequence[str] = (),
              sep: str = "|") -> DataFrame:
    """Rows with ``top_key`` (and ``top_name``), ``hierarchy_path``, ``hierarchy_cycle`` and ``<column>_inherited``.

    The top is the farthest ancestor, null for roots and for rows that lead into a cycle, which have none and are marked
    by ``hierarchy_cycle``. The path lists ancestors from the top down, null for roots. An
    inherited column is the row's own value, else that of the nearest ancestor that has one.
    """
    carry = [*([name] if name else []), *inherit]
    chain = ancestors(df, key, parent, carry).withColumnRenamed("key", "__hk")
    out = df.join(chain, F.col(key) == F.col("__hk"), "left")
    top = F.when(~F.col("in_cycle"), F.try_element_at("chain", F.lit(-1)))
    path = F.array_join(F.reverse(F.transform("chain", lambda n: n["key"].cast("string"))), sep)
    new = {"top_key": top["key"], "hierarchy_path": F.nullif(path, F.lit("")), "hierarchy_depth": F.size("chain"), "hierarchy_cycle": F.col("in_cycle")}
    if name:
        new["top_name"] = top[name]
    for c in inherit:
        values = F.filter(F.col("chain")[c], lambda v: v.isNotNull())
        new[f"{c}_inherited"] = F.coalesce(F.col(c), F.try_element_at(values, F.lit(1)))
    return out.withColumns(new).drop("__hk", "chain", "in_cycle")
