"""Enrichment, lookup and validity joins.

No join carries a broadcast hint: Spark and AQE broadcast a side only when its measured size is below
``spark.sql.autoBroadcastJoinThreshold``; beyond it they shuffle on the key and split hot partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverloom.functions.keys import col
from silverloom.operators.windows import latest_per_key


def enrich(df: DataFrame, lookups: Sequence[tuple[DataFrame, str, str, dict[str, str]]]) -> DataFrame:
    """Left lookups, one after another. Each is (dimension, fact key, dimension key, {dimension column: new name}).

    Dimension keys must be unique (see ``operators.quality.unique``); then the row count stays.
    """
    for i, (dim, fact_key, dim_key, cols) in enumerate(lookups):
        right = dim.select(F.col(dim_key).alias(f"__dk{i}"), *[F.col(c).alias(n) for c, n in cols.items()])
        df = df.join(right, F.col(fact_key) == F.col(f"__dk{i}"), "left").drop(f"__dk{i}")
    return df


def join_on(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str | Column, str | Column]], how: str = "left",
            normalise=None) -> DataFrame:
    """Equi join over pairs of columns; ``normalise`` is applied to both sides, and the join stays hashable."""
    f = normalise or (lambda c: c)
    lefts = {f"__l{i}": f(col(a)) for i, (a, _) in enumerate(pairs)}
    rights = {f"__r{i}": f(col(b)) for i, (_, b) in enumerate(pairs)}
    cond = reduce(lambda a, b: a & b, [F.col(f"__l{i}") == F.col(f"__r{i}") for i in range(len(pairs))])
    out = left.withColumns(lefts).join(right.withColumns(rights), cond, how)
    return out.drop(*lefts, *rights)


def interval_join(df: DataFrame, ranges: DataFrame, keys: Sequence[str], date: str, how: str = "left",
                  start: str = "date_from", end: str = "date_to") -> DataFrame:
    """Rows with the range of the same key their date falls into; both ends belong to the range.

    Ranges are first cut to the months their key really occurs in (distinct key and month of the facts, combined map
    side). Facts then meet ranges on key *and* month: a hot key spreads over its months, and each row is compared with
    the few ranges of one month instead of all ranges of the key.
    """
    keys = list(keys)
    extra = [c for c in ranges.columns if c not in keys and c not in (start, end)]
    d = F.to_date(F.col(date))
    facts = df.withColumn("__m", F.trunc(d, "month"))
    names = [f"__k{i}" for i in range(len(keys))]
    right = ranges.select(
        *[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(start).alias("__from"), F.col(end).alias("__to"), *extra
    )
    months = facts.select(*[F.col(k).alias(f"{n}m") for k, n in zip(keys, names)], F.col("__m").alias("__rm"))
    months = months.filter(F.col("__rm").isNotNull()).distinct()
    cond = (F.col("__from") <= F.last_day("__rm")) & (F.col("__to") >= F.col("__rm"))
    for n in names:
        cond = cond & (F.col(n) == F.col(f"{n}m"))
    cut = months.join(right, cond, "inner").drop(*[f"{n}m" for n in names])
    match = (F.col("__m") == F.col("__rm")) & d.between(F.col("__from"), F.col("__to"))
    for k, n in zip(keys, names):
        match = match & (F.col(k) == F.col(n))
    out = facts.join(cut, match, how)
    return out.drop("__m", "__rm", *names).withColumnsRenamed({"__from": start, "__to": end})


def match_else_generic(df: DataFrame, specific: DataFrame, specific_on: Sequence[str], generic: DataFrame,
                       generic_on: Sequence[str], values: Sequence[str], source: str = "match_type") -> DataFrame:
    """Values of the specific match; only rows without one take the generic match; the rest stay null.

    Both sides must be unique on their keys.
    """
    s = specific.select(*specific_on, *[F.col(v).alias(f"__s_{v}") for v in values], F.lit(True).alias("__s"))
    g = generic.select(*generic_on, *[F.col(v).alias(f"__g_{v}") for v in values], F.lit(True).alias("__g"))
    out = df.join(s, list(specific_on), "left").join(g, list(generic_on), "left")
    for v in values:
        out = out.withColumn(v, F.when(F.col("__s"), F.col(f"__s_{v}")).otherwise(F.col(f"__g_{v}")))
    kind = F.when(F.col("__s"), "specific").when(F.col("__g"), "generic").otherwise("none")
    drop = ["__s", "__g", *[f"__s_{v}" for v in values], *[f"__g_{v}" for v in values]]
    return out.withColumn(source, kind).drop(*drop)


def role_join(df: DataFrame, dim: DataFrame, dim_key: str, cols: dict[str, str], roles: dict[str, str]) -> DataFrame:
    """The same dimension looked up for several roles: {role: foreign key}. New columns are ``<role>_<name>``.

    The small identical dimension scans are planned once (exchange reuse), and broadcast where their size allows.
    """
    lookups = [(dim, fk, dim_key, {c: f"{role}_{n}" for c, n in cols.items()}) for role, fk in roles.items()]
    return enrich(df, lookups)


def fallback_key_join(df: DataFrame, dim: DataFrame, keys: Sequence[str | Column], dim_key: str,
                      cols: dict[str, str]) -> DataFrame:
    """Lookup by the first non-null of several keys."""
    out = df.withColumn("__fk", F.coalesce(*[col(k) for k in keys]))
    return enrich(out, [(dim, "__fk", dim_key, cols)]).drop("__fk")


def dedup_join(df: DataFrame, right: DataFrame, key: str, order: list[Column], on: str, cols: dict[str, str]) -> DataFrame:
    """Lookup into the latest row per key of the right side."""
    return enrich(df, [(latest_per_key(right, [key], order), on, key, cols)])


def eav_pivot(df: DataFrame, key: str, field: str, value: str, names: Sequence[str], prefix: str = "") -> DataFrame:
    """Attribute rows to one row per key with a column per named attribute, in one pass; names are given, not scanned."""
    picks = [F.max(F.when(F.col(field) == n, F.col(value))).alias(f"{prefix}{n}") for n in names]
    return df.filter(F.col(field).isin(list(names))).groupBy(key).agg(*picks)


def fanout(entities: DataFrame, listed: str, groups: dict[str, str], sep: str = "|") -> DataFrame:
    """One row per entity and reporting group whose id is in the entity's delimited list.

    ``groups`` maps id to name. The list is exploded and matched, so no entity meets a group it does not belong to.
    """
    names = F.create_map(*[F.lit(x) for pair in groups.items() for x in pair])
    out = entities.withColumn("group_id", F.explode(F.array_distinct(F.split(F.col(listed), "\\Q" + sep + "\\E"))))
    out = out.filter(F.col("group_id").isin(list(groups)))
    return out.withColumn("group_name", F.try_element_at(names, F.col("group_id")))


def expected_periods(people: DataFrame, start: str, end: str, first: str, last: str) -> DataFrame:
    """A row per person and week (Monday to Sunday) to expect: the week's end lies after the start and before the end.

    Weeks come from each person's own interval cut to [first, last], not from pairing people with a calendar.
    ``first`` and ``last`` bound the week ends and starts.
    """
    lo = F.lit(first).cast("date")
    hi = F.lit(last).cast("date")
    # smallest Sunday that is > start and >= first; largest Sunday < end whose Monday is <= last
    from_day = F.greatest(F.date_add(F.col(start), 1), lo)
    first_sunday = F.date_add(from_day, 6 - F.weekday(from_day))
    monday_last = F.date_sub(hi, F.weekday(hi))
    until = F.least(F.date_add(monday_last, 6), F.coalesce(F.date_sub(F.col(end), 1), F.lit("9999-12-31").cast("date")))
    rows = people.withColumns({"__a": first_sunday, "__b": until}).filter(F.col("__a") <= F.col("__b"))
    rows = rows.withColumn("week_end", F.explode(F.sequence(F.col("__a"), F.col("__b"), F.expr("INTERVAL 7 DAYS"))))
    return rows.withColumn("week_start", F.date_sub(F.col("week_end"), 6)).drop("__a", "__b")
