"""Timelines: one row per key with all its days in order, and what holds from each day on.

A timeline answers questions about a day by a binary search inside its row, so facts meet it in one equality join on the
key: they are read once, and nothing is multiplied by ranges, months or days. Changes of a key are first reduced to one
entry a day, so a timeline is no longer than the calendar, however many rows a key has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType

from silverloom.functions.keys import OPEN_END, OPEN_START, col

#: Halving steps of the search; a timeline has fewer entries than twice the first (179 years of days).
STEPS = [1 << k for k in range(15, -1, -1)]


def timelines(df: DataFrame, keys: Sequence[str], day: str | Column, values: dict[str, Column]) -> DataFrame:
    """(keys, line): ``line`` is an array of (day, values) in order; ``values`` are aggregates over the rows of a day.

    Rows without day are left out. Keys may be null here; they match nothing later.
    """
    entries = _days(df, keys, day, values)
    return _gathered(entries, keys, list(values))


def _days(df: DataFrame, keys: Sequence[str], day: str | Column, values: dict[str, Column]) -> DataFrame:
    d = F.to_date(col(day))
    return df.filter(d.isNotNull()).groupBy(*keys, d.alias("__day")).agg(*[v.alias(n) for n, v in values.items()])


def _gathered(entries: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    entry = F.struct(F.col("__day").alias("day"), *[F.col(n) for n in values])
    return entries.groupBy(*keys).agg(F.sort_array(F.collect_list(entry)).alias("line"))


def place(line: Column, day: Column) -> Column:
    """Number of entries up to and including the day; 0 where none is, and where line or day is null."""
    def halve(at: Column, step: Column) -> Column:
        inside = (at + step <= F.size(line)) & (F.get(line, at + step - 1)["day"] <= day)
        return F.when(inside, at + step).otherwise(at)

    return F.aggregate(F.array(*[F.lit(s) for s in STEPS]), F.lit(0), halve)


def with_timeline(df: DataFrame, lines: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Rows with the ``line`` of their key, null where there is none. One row per key on the right, so a hot key can be
    split on the left."""
    names = {k: f"__t{i}" for i, k in enumerate(keys)}
    right = lines.withColumnsRenamed(names)
    cond = F.lit(True)
    for k, n in names.items():
        cond = cond & (F.col(k) == F.col(n))
    return df.join(right, cond, how).drop(*names.values())


def as_of_join(df: DataFrame, changes: DataFrame, keys: Sequence[str], date: str | Column, change_date: str | Column,
               values: dict[str, Column], open_start: bool = True, bounds: bool = False) -> DataFrame:
    """Every row once, with the values of its key's last change on or before its date; null where there is none.

    ``values`` are aggregates over the changes of one key and day. With ``open_start`` the first change also holds before
    its day. ``bounds`` adds the first and last day on which the values hold, as ``date_from`` and ``date_to``.
    """
    out = with_timeline(df, timelines(changes, keys, change_date, values), keys)
    return at_day(out, date, values, open_start, bounds)


def parted_as_of_join(df: DataFrame, changes: DataFrame, keys: Sequence[str], part: str, date: str | Column, change_date: str | Column,
                      values: dict[str, Column], prefix: str) -> DataFrame:
    """Two lookups like ``as_of_join`` without open start, in one join: the values of the last change of the row's key and
    ``part``, as ``<prefix><name>``, and those of the last change of its key that has no part. ``part`` has the same type
    on both sides.

    Both sides are dealt by ``keys`` alone and meet once: a key's row on the right holds a line for each of its parts.
    """
    lines = timelines(changes, [*keys, part], change_date, values)
    entries = F.collect_list(F.struct(F.col(part).alias("part"), F.col("line").alias("line")))
    lines = lines.groupBy(*keys).agg(entries.alias("__entries")).select(
        *keys, F.get(F.filter("__entries", lambda e: e["part"].isNull()), F.lit(0))["line"].alias("__whole"),
        F.map_from_entries(F.filter("__entries", lambda e: e["part"].isNotNull())).alias("__lines"))
    out = with_timeline(df, lines, keys).withColumn("line", F.try_element_at("__lines", F.col(part))).drop("__lines")
    out = at_day(out, date, values, open_start=False).withColumnsRenamed({n: f"{prefix}{n}" for n in values})
    return at_day(out.withColumnRenamed("__whole", "line"), date, values, open_start=False)


def at_day(df: DataFrame, date: str | Column, values: Sequence[str], open_start: bool, bounds: bool = False) -> DataFrame:
    """What ``line`` holds at the date, in its place. With ``as_of_join`` for rows whose line was found on the way."""
    day = F.to_date(col(date))
    at = place(F.col("line"), day)
    if open_start:
        at = F.when(day.isNotNull() & F.col("line").isNotNull(), F.greatest(at, F.lit(1))).otherwise(F.lit(0))
    # the search is done once, its result read several times
    out = df.withColumn("__at", at)
    found = F.get("line", F.col("__at") - 1)
    out = out.withColumns({n: found[n] for n in values})
    if bounds:
        first = F.when(F.lit(open_start) & (F.col("__at") == 1), F.lit(OPEN_START).cast("date")).otherwise(found["day"])
        after = F.get("line", F.col("__at"))["day"]
        last = F.when(F.col("__at") > 0, F.coalesce(F.date_sub(after, 1), F.lit(OPEN_END).cast("date")))
        out = out.withColumns({"date_from": first, "date_to": last})
    return out.drop("line", "__at")


def sums_between(plan: DataFrame, actual: DataFrame, keys: Sequence[str], start: str, end: str, date: str | Column,
                 measures: dict[str, Column]) -> DataFrame:
    """Plan rows, each once, with the sums of the actual rows of the same key from ``start`` to ``end``, both included.

    Actuals become running totals per key and day; a plan takes the difference of two of them, so its cost doesn't depend
    on how long it is, plans may overlap, and equal plan rows stay apart. A measure without any value in the interval is
    null, and so is one of a plan without key, start or end. Measures are whole numbers or decimals, whose differences are
    exact.
    """
    sums = {m: F.sum(e) for m, e in measures.items()}
    counts = {f"__n_{m}": F.count(e) for m, e in measures.items()}
    daily = _days(actual, keys, date, sums | counts)
    kinds = {m: daily.schema[m].dataType for m in measures}
    for m, kind in kinds.items():
        if not isinstance(kind, (DecimalType, IntegralType)):
            raise TypeError(f"measure {m} is {kind.simpleString()}; cast it to a decimal")
    so_far = Window.partitionBy(*keys).orderBy("__day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = daily.withColumns({
        **{m: F.sum(F.coalesce(F.col(m), F.lit(0).cast(kind))).over(so_far) for m, kind in kinds.items()},
        **{n: F.sum(n).over(so_far) for n in counts}})
    out = with_timeline(plan, _gathered(running, keys, [*sums, *counts]), keys)
    whole = F.col(start).isNotNull() & F.col(end).isNotNull()
    out = out.withColumns({
        "__to": F.when(whole, place(F.col("line"), F.to_date(F.col(end)))),
        "__before": F.when(whole, place(F.col("line"), F.date_sub(F.to_date(F.col(start)), 1)))})

    def between(name: str) -> Column:
        upto, before = (F.coalesce(F.get("line", F.col(p) - 1)[name], F.lit(0)) for p in ("__to", "__before"))
        return upto - before

    return out.withColumns({m: F.when(between(f"__n_{m}") > 0, between(m)).cast(kind) for m, kind in kinds.items()}).drop("line", "__to", "__before")
