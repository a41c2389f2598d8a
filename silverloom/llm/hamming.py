"""Exact top-k search in binary codes by incremental multi-index hashing.

Codes are cut into segments, each with an index from its value to the codes that hold it. A query looks up the values
within a radius of its own segments, segment after segment, and then the radius grows by one bit. After segment g at
radius r every code within ``segments * r + g`` bits has been seen, so a query is done once its k-th verified distance is
that small, often before the other segments are searched at that radius.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverloom.llm.storage import stored


def sign_code(vector: Column, bits: int) -> Column:
    """A code of ``bits`` bits (at most 62): bit i is set where components i, i + bits, i + 2 * bits, ... of the vector add
    up to more than 0. Null where the vector is null or empty; null and not-a-number components count as 0."""
    at = lambda i: F.aggregate(
        F.filter(vector, lambda _, k: k % bits == i), F.lit(0.0), lambda s, x: s + F.coalesce(F.nanvl(x.cast("double"), F.lit(0.0)), F.lit(0.0)))
    total = sum((F.when(at(i) > 0, F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i in range(bits)), F.lit(0).cast("long"))
    return F.when(vector.isNotNull() & (F.size(vector) > 0), total)


def segment_count(codes: int, bits: int) -> int:
    """Segments of about log2 of the number of codes bits, so that a value is held by a code or so, and of four bits at
    least; never fewer than two."""
    return max(min(2, bits), round(bits / math.log2(max(16, codes))))


def _segments(bits: int, count: int) -> list[tuple[int, int]]:
    """(shift, width) of each segment."""
    cuts = [bits * k // count for k in range(count + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _value(code: Column, shift: int, width: int) -> Column:
    return F.shiftright(code, shift).bitwiseAND((1 << width) - 1)


def top_k(rows: DataFrame, queries: DataFrame, k: int, bits: int, segments: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, distance): the k rows nearest to each query, ties by the smaller id.

    ``rows`` has (vec_id, code), ``queries`` (query_id, code). Null codes are neither found nor searched; with fewer than k
    rows all are returned. Repeated rows count each, and an id with several codes counts with each of them. Equal codes are
    searched once, and a code stands for its k smallest ids, which are all that can be among the k nearest. Other columns
    are not looked at.
    """
    ranked = Window.partitionBy("code").orderBy("vec_id")
    ids = (
        rows.filter("code IS NOT NULL").select("code", "vec_id").withColumn("at", F.row_number().over(ranked)).filter(F.col("at") <= k)
        .groupBy("code").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))  # k ids at most
    )
    codes = stored(ids)
    total = codes.count()
    parts = _segments(bits, segments or segment_count(total, bits))
    index = stored(codes.select("code", "ids", F.explode(F.array(*[
        F.struct(F.lit(g).alias("segment"), _value(F.col("code"), *part).alias("value")) for g, part in enumerate(parts)])).alias("s"))
        .select("s.segment", "s.value", "code", "ids"))
    asked = stored(queries.filter("code IS NOT NULL").select(F.col("code").alias("query")).distinct())
    best = asked.select("query", F.lit(0).alias("distance"), F.lit(None).cast("long").alias("vec_id")).limit(0)
    probes = asked.select("query", F.explode(F.array(*[
        F.struct(F.lit(g).alias("segment"), F.lit(w).alias("width"), _value(F.col("query"), s, w).alias("value"))
        for g, (s, w) in enumerate(parts)])).alias("p")).select("query", "p.*", F.lit(-1).alias("last"))
    nearest = Window.partitionBy("query").orderBy("distance", "vec_id")
    open_queries = asked
    for radius in range(max(w for _, w in parts) + 1):
        probes = stored(probes.join(open_queries, "query", "left_semi"))
        for g, part in enumerate(parts):
            seen_before = F.lit(False)  # by an earlier segment at this radius, or by any at a smaller one
            for h, other in enumerate(parts):
                if h != g:
                    apart = F.bit_count(_value(F.col("code"), *other).bitwiseXOR(_value(F.col("query"), *other)))
                    seen_before |= apart <= radius if h < g else apart < radius
            fresh = (
                probes.filter(F.col("segment") == g).select("query", "value").join(open_queries, "query", "left_semi")
                .join(index.filter(F.col("segment") == g), "value").filter(~seen_before)
                .select("query", F.bit_count(F.col("code").bitwiseXOR(F.col("query"))).alias("distance"), F.explode("ids").alias("vec_id"))
            )
            best = stored(
                best.unionByName(fresh).withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= k)
                .select("query", "distance", "vec_id"))
            proven = len(parts) * radius + g
            done = best.groupBy("query").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("far")).filter(
                (F.col("n") >= k) & (F.col("far") <= proven)).select("query")
            open_queries = asked.join(done, "query", "left_anti")
            if open_queries.isEmpty():
                break
        # one more bit, above the last one flipped, so each value is reached once
        probes = (
            probes.join(open_queries, "query", "left_semi").filter("last < width - 1")
            .withColumn("last", F.explode(F.expr("sequence(last + 1, width - 1)")))
            .withColumn("value", F.expr("value ^ shiftleft(1L, last)"))
        )
        if probes.isEmpty():
            break
    ordered = best.withColumn("rank", F.row_number().over(nearest))
    return queries.select("query_id", F.col("code").alias("query")).join(ordered, "query").select("query_id", "rank", "vec_id", "distance")
