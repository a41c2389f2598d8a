"""Latest-row picks, neighbours, validity ranges and fills.

Windows here are safe for hot keys in one of three ways: the row-number pick is cut per map task before the shuffle
(Spark's window group limit), the input is first reduced to one row per key and day, or the key is split into time
buckets and only one summary row per bucket crosses the whole key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverloom.functions.keys import OPEN_END, OPEN_START, col


def latest_per_key(df: DataFrame, keys: list[str | Column], order: list[Column]) -> DataFrame:
    """First row of each key by ``order``. Give a total order: ties would be picked at random."""
    w = Window.partitionBy(*[col(k) for k in keys]).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def prefer_source(df: DataFrame, keys: list[str], tag: str, priority: list[str], ties: list[Column]) -> DataFrame:
    """One row per key: the source that comes first in ``priority`` wins; unlisted sources come last."""
    rank = F.when(F.lit(False), F.lit(0))
    for i, name in enumerate(priority):
        rank = rank.when(F.col(tag) == name, F.lit(i))
    return latest_per_key(df, keys, [rank.otherwise(F.lit(len(priority))).asc(), *ties])


def neighbour(df: DataFrame, keys: list[str], order: str, value: str, name: str, ties: list[str] | None = None,
              offset: int = 1, bucket: Column | None = None) -> DataFrame:
    """Value of the next (``offset=1``) or previous (``-1``) row of the same key, in order.

    A key's rows are split into time buckets (``bucket`` must not decrease as ``order`` grows; days for dates and hours
    for timestamps by default), so a key that holds much of the table is spread over many tasks. Inside a bucket the neighbour is a plain
    window; the row at a bucket's edge gets it from a summary of one row per key and bucket.
    """
    ties = ties or []
    if bucket is None:
        bucket = F.unix_date(F.to_date(F.col(order)))
        if dict(df.dtypes)[order].startswith("timestamp"):
            bucket = bucket * 24 + F.hour(F.col(order))
    df = df.withColumn("__b", bucket)
    by = [F.col(order), *[F.col(t) for t in ties]]
    inside = Window.partitionBy(*keys, "__b").orderBy(*by)
    # present tells "no row here" apart from "a row with a null value"
    near = F.struct(F.lit(True).alias("present"), F.col(value).alias("v"))
    pick = F.lead if offset > 0 else F.lag
    df = df.withColumn("__near", pick(near, 1).over(inside))

    edge_key = F.struct(*by, F.struct(F.col(value).alias("v")).alias("__v"))
    edge = df.groupBy(*keys, "__b").agg((F.min if offset > 0 else F.max)(edge_key).alias("__edge"))
    across = Window.partitionBy(*keys).orderBy("__b")
    edge = edge.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        F.col("__b").alias("__eb"),
        pick("__edge.__v.v", 1).over(across).alias("__far"),
    )
    same = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    cond = F.col("__b").eqNullSafe(F.col("__eb"))
    for s in same:
        cond = cond & s
    out = df.join(edge, cond, "left")
    out = out.withColumn(name, F.when(F.col("__near.present"), F.col("__near.v")).otherwise(F.col("__far")))
    return out.drop("__b", "__near", "__eb", "__far", *[f"__k{i}" for i in range(len(keys))])


def change_ranges(df: DataFrame, keys: list[str], date: str, open_start: bool = True,
                  values: list[Column] | None = None) -> DataFrame:
    """Validity ranges out of change dates: each lasts until the day before the next change, the last stays open.

    Rows are first reduced to one per key and day (``values`` say how), so a range never ends before it starts and a
    window holds at most one row per calendar day of a key. With ``open_start`` the first range reaches back to 1900.
    """
    d = F.to_date(F.col(date))
    per_day = df.filter(d.isNotNull()).groupBy(*keys, d.alias("__day"))
    rows = per_day.agg(*values) if values else per_day.agg(F.lit(1).alias("__one")).drop("__one")
    w = Window.partitionBy(*keys).orderBy("__day")
    begin = F.col("__day")
    if open_start:
        begin = F.when(F.lag("__day").over(w).isNull(), F.lit(OPEN_START).cast("date")).otherwise(F.col("__day"))
    end = F.coalesce(F.date_sub(F.lead("__day").over(w), 1), F.lit(OPEN_END).cast("date"))
    return rows.withColumns({"date_from": begin, "date_to": end}).drop("__day")


def scd2(df: DataFrame, key: str, created: str, ties: list[str]) -> DataFrame:
    """End stamp of each version (one second before the next one) and the current flag."""
    df = neighbour(df, [key], created, created, "__next", ties=ties)
    open_end = F.lit(OPEN_END).cast("timestamp_ntz")
    end = F.coalesce(F.col("__next").cast("timestamp_ntz") - F.expr("INTERVAL 1 SECOND"), open_end)
    return df.withColumns({"dts_eff_end": end, "bln_current": F.col("__next").isNull()}).drop("__next")


def forward_fill(df: DataFrame, keys: list[str], order: str, cols: list[str]) -> DataFrame:
    """Nulls take the last earlier value of the key. Meant for calendars: one row per key and day."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})


def fill_days(df: DataFrame, keys: list[str], date: str, until: Column) -> DataFrame:
    """Dense daily rows: every observed row repeats until the day before the key's next one, the last up to ``until``.

    Equals a grid of keys and days with a forward fill and no rows before a key's first day, without building the grid.
    """
    w = Window.partitionBy(*keys).orderBy(date)
    nxt = F.date_sub(F.lead(date).over(w), 1)
    end = F.least(F.coalesce(nxt, until), until)
    out = df.withColumn("__end", end).filter(F.col(date) <= F.col("__end"))
    return out.withColumn(date, F.explode(F.sequence(F.col(date), F.col("__end")))).drop("__end")
