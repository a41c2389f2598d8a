"""Mixing sources to target weights: token budgets down a tree, then seeded epochs.

The total is shared out along the tree's levels by weight. A node cannot take more than its texts give in ``max_epochs``
passes; what it lacks goes to its siblings by their weights, and only what no sibling can take goes up to the parent's
siblings. Each leaf then takes its budget as the first tokens of its epochs, every epoch in an order of its own.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANGES = 1_024  # parts of an epoch's order that are added up on their own
MAX_LEAVES = 100_000  # of the tree, which the driver holds
Path = tuple[str, ...]


def fill(total: int, wanted: dict[str, float], limits: dict[str, int]) -> dict[str, int]:
    """``total`` whole tokens by weight, none above its limit; what one cannot take the others get by their weights.
    Children of weight 0 get what is left over when all others are full. Rounding goes to the largest remainders, then by
    name."""
    out = dict.fromkeys(limits, 0)
    for group in ([n for n in limits if wanted[n] > 0], [n for n in limits if wanted[n] <= 0]):
        open_ = sorted(group)
        while open_ and total > 0:
            weight = {n: wanted[n] if wanted[n] > 0 else 1.0 for n in open_}
            whole = sum(weight.values())
            share = {n: total * weight[n] / whole for n in open_}
            full = [n for n in open_ if out[n] + share[n] >= limits[n]]
            if full:
                for n in full:
                    total -= limits[n] - out[n]
                    out[n] = limits[n]
                open_ = [n for n in open_ if n not in full]
                continue
            floor = {n: int(share[n]) for n in open_}
            spare = total - sum(floor.values())
            for n in sorted(open_, key=lambda n: (floor[n] - share[n], n)):
                extra = min(1, spare, limits[n] - out[n] - floor[n])
                out[n] += floor[n] + max(0, extra)
                spare -= max(0, extra)
            total = spare
            break
    return out


def budgets(tokens: dict[Path, int], weights: dict[Path, float], total: int, max_epochs: int) -> dict[Path, int]:
    """Tokens that each leaf gives, from the leaves' tokens and the weights of the tree's nodes (by path; 1 where none is
    named). Never more than ``total`` nor than the leaves hold in ``max_epochs`` passes; exactly the smaller of the two
    unless rounding of a node's share leaves a token with no room."""
    limits: dict[Path, int] = defaultdict(int)
    children: dict[Path, set[str]] = defaultdict(set)
    for path, n in tokens.items():
        for depth in range(len(path)):
            limits[path[:depth]] += n * max_epochs
            children[path[:depth]].add(path[depth])
        limits[path] += n * max_epochs
    out: dict[Path, int] = {}

    def share(path: Path, total: int) -> None:
        if path not in children:
            out[path] = total
            return
        names = children[path]
        got = fill(total, {n: weights.get((*path, n), 1.0) for n in names}, {n: limits[(*path, n)] for n in names})
        for n in sorted(names):
            share((*path, n), got[n])

    if tokens:
        share((), min(total, limits[()]))
    return out


def word_count(text: Column) -> Column:
    """Words between ASCII white space; null has none."""
    bare = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x09-\\x0D ]+", " "))
    return F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, " "))).cast("long")


def mix(docs: DataFrame, levels: list[Column], tokens: Column, weights: dict[Path, float], total: int | float,
        max_epochs: int = 4, seed: int = 0, id_col: str = "doc_id") -> DataFrame:
    """The rows taken: _row (a struct of all columns of ``docs``, so no name can clash), _leaf, _tokens, _epoch (from 0), _taken.

    ``levels`` give a row's path; null levels are a child of their own, named ``(null)``. ``total`` counts tokens, or is a
    share of all where it is a float. A leaf's epochs each hold all its rows once, ordered by a hash of seed, epoch and id;
    the leaf gives the first tokens of that endless list. ``_taken`` is less than ``_tokens`` only for the row at which a
    leaf's budget ends. Rows without tokens come along where they stand before it. Rows that repeat an id stand
    together, in the order of their tokens. No rows give none. ``docs`` is read three times, so it should be a table.
    """
    names = [f"_level_{k}" for k in range(len(levels))]
    marked = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *[F.coalesce(c.cast("string"), F.lit("(null)")).alias(n) for c, n in zip(levels, names)], tokens.cast("long").alias("_tokens"))
    spark = docs.sparkSession
    held = marked.groupBy(*names).agg(F.sum("_tokens").alias("n")).limit(MAX_LEAVES + 1).collect()
    if len(held) > MAX_LEAVES:
        raise ValueError(f"the tree has more than {MAX_LEAVES} leaves")
    sizes = {tuple(r[n] for n in names): r["n"] for r in held}
    whole = int(total * sum(sizes.values())) if isinstance(total, float) else total
    plan = [
        (*path, n, budget // n if n else 0, budget % n if n else 0)
        for path, budget in budgets(sizes, weights, whole, max_epochs).items() for n in (sizes[path],)]
    leaves = spark.createDataFrame(plan, ", ".join([*(f"{n} string" for n in names), "_all long", "_full long", "_rest long"]))
    joined = marked.join(F.broadcast(leaves), names)  # MAX_LEAVES rows at most
    always = joined.filter("_full > 0").withColumn("_epoch", F.explode(F.expr("sequence(0, _full - 1)"))).withColumn("_taken", F.col("_tokens"))

    # the epoch of which a part is taken: its order is cut into ranges of the hash, whose sums say where each begins
    own = F.col("_row")[id_col]
    order = F.xxhash64(F.lit(seed), F.col("_full"), own.cast("string"))
    part = joined.filter("_rest > 0").withColumn("_hash", order).withColumn("_range", F.shiftrightunsigned("_hash", 54).cast("int"))
    sums = part.groupBy(*names, "_range").agg(F.sum("_tokens").alias("_sum"))
    along = Window.partitionBy(*names).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*names, "_range", F.coalesce(F.sum("_sum").over(along), F.lit(0)).alias("_begin"))
    within = Window.partitionBy(*names, "_range").orderBy("_hash", own, "_tokens").rowsBetween(Window.unboundedPreceding, -1)
    some = (
        part.join(starts, [*names, "_range"]).filter("_begin < _rest")
        .withColumn("_before", F.col("_begin") + F.coalesce(F.sum("_tokens").over(within), F.lit(0)))
        .filter("_before < _rest")
        .withColumn("_epoch", F.col("_full")).withColumn("_taken", F.least(F.col("_tokens"), F.col("_rest") - F.col("_before")))
    )
    out = ["_row", F.concat_ws("/", *names).alias("_leaf"), "_tokens", F.col("_epoch").cast("long").alias("_epoch"), "_taken"]
    return always.select(*out).unionByName(some.select(*out))
