"""Aggregations: period roll-ups, category slices with zero-fill, attainment, plan against actual."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, StringType, TimestampNTZType, TimestampType

from silverloom.functions.dates import within_months
from silverloom.functions.keys import col
from silverloom.functions.money import safe_ratio
from silverloom.operators.calendar import GRAINS, describe_periods, period_start, week_and_month
from silverloom.operators.timeline import sums_between


def aggregate(df: DataFrame, keys: Sequence[str], aggs: dict[str, Column]) -> DataFrame:
    """Group and aggregate; sums, counts and extremes combine map side, so a hot key reaches its task pre-reduced."""
    return df.groupBy(*keys).agg(*[a.alias(n) for n, a in aggs.items()])


def period_lattice(small: DataFrame, keys: Sequence[str], sums: Sequence[str], clustered: bool = False) -> DataFrame:
    """Sums of all period grains out of rows (keys, __week, __month, sums), as ``date_group_type_id`` and ``dte_start``.

    Weeks are summed on their own, months once; quarters and years follow from the months. All of it happens where the
    rows of a key meet, after one shuffle; none, if the caller has ``clustered`` the rows by some of the keys before.
    A key's rows are bounded by the calendar, however many facts there were.
    """
    rows = small if clustered or not keys else small.repartition(*keys)
    weeks = explode_pairs(rows, [("W", F.col("__week")), ("M", F.col("__month"))]).drop("__week", "__month")
    first = weeks.groupBy(*keys, "date_group_type_id", "dte_start").agg(*[F.sum(n).alias(n) for n in sums])
    month = F.col("date_group_type_id") == "M"
    start = F.col("dte_start")
    coarser = F.when(month, F.array(*[_period(g, period_start(start, g)) for g in GRAINS[1:]])).otherwise(F.array(_period("W", start)))
    again = first.select(*keys, *sums, F.explode(coarser).alias("__p")).select(*keys, *sums, "__p.*")
    return again.groupBy(*keys, "date_group_type_id", "dte_start").agg(*[F.sum(n).alias(n) for n in sums])


def _period(grain: str, start: Column) -> Column:
    return F.struct(F.lit(grain).alias("date_group_type_id"), start.alias("dte_start"))


def explode_pairs(df: DataFrame, periods: Sequence[tuple[str, Column]]) -> DataFrame:
    """Each row once for each (grain, first day)."""
    return df.select("*", F.explode(F.array(*[_period(g, d) for g, d in periods])).alias("__p")).select(*df.columns, "__p.*")


def rollup_periods(df: DataFrame, date: str, keys: Sequence[str], sums: dict[str, Column], grains=GRAINS) -> DataFrame:
    """Sums over all period grains at once. ``sums`` maps a name to the row expression to add up.

    Rows are first summed per key, week and month, from which all grains follow; only those sums go on. The weeks of a
    hot key spread over many tasks of the first step.
    """
    small = df.groupBy(*keys, *week_and_month(date)).agg(*[F.sum(e).alias(n) for n, e in sums.items()])
    kinds = dict(small.dtypes)
    out = describe_periods(period_lattice(small, keys, list(sums)).filter(F.col("date_group_type_id").isin(*grains)))
    # a sum of sums is as wide as the sum of the rows
    return out.withColumns({n: F.col(n).cast(kinds[n]) for n in sums})


def cents(c: Column) -> Column:
    """A money column as whole cents. Sums of longs stay exact and are far cheaper than sums of wide decimals."""
    return (c * 100).cast("long")


def from_cents(c: str | Column) -> Column:
    """Whole cents back to money. The product stays within 18 digits, which Spark keeps in a long."""
    return col(c).cast("decimal(15,0)") * F.lit("0.01").cast("decimal(2,2)")


def category_sums(categories: dict[str, Column], measures: dict[str, Column], fill: Sequence[str] = ()) -> list[Column]:
    """Conditional sums of every measure in every category as aggregate columns.

    Categories that are not filled with zeros also count their matching rows.
    """
    cols = []
    for i, (label, cond) in enumerate(categories.items()):
        hit = F.coalesce(cond, F.lit(False))
        if label not in fill:
            cols.append(F.count(F.when(hit, 1)).alias(f"__n{i}"))
        cols += [F.sum(F.when(hit, expr)).alias(f"__{m}{i}") for m, expr in measures.items()]
    return cols


def category_rows(wide: DataFrame, keys: Sequence[str], categories: Sequence[str], measures: Sequence[str],
                  name: str = "category", fill: Sequence[str] = ()) -> DataFrame:
    """Wide category sums to one row per category. Empty categories give a zero row if they are in ``fill``, else none."""
    kinds = dict(wide.dtypes)
    rows = []
    for i, label in enumerate(categories):
        values = [F.coalesce(F.col(f"__{m}{i}"), F.lit(0).cast(kinds[f"__{m}{i}"])).alias(m) for m in measures]
        keep = F.lit(True) if label in fill else F.col(f"__n{i}") > 0
        rows.append(F.struct(F.lit(label).alias(name), keep.alias("__keep"), *values))
    out = wide.select(*keys, F.explode(F.array(*rows)).alias("__r")).select(*keys, "__r.*")
    return out.filter("__keep").drop("__keep")


def slice_categories(df: DataFrame, keys: Sequence[str], categories: dict[str, Column], measures: dict[str, Column],
                     name: str = "category", fill: Sequence[str] = ()) -> DataFrame:
    """Measures per key and overlapping category, in one pass.

    Every category is a set of conditional sums of one aggregate, turned into rows afterwards. A category in ``fill``
    gives a zero row for every key that has any row at all; the others only where a row matched.
    """
    wide = df.groupBy(*keys).agg(*category_sums(categories, measures, fill))
    return category_rows(wide, keys, list(categories), list(measures), name, fill)


def zero_fill(df: DataFrame, keys: Sequence[str], category: str, labels: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """A row for every key and label; measures are zero where the data has none. One aggregate, no grid join."""
    kinds = dict(df.dtypes)
    conds = {x: F.col(category) == x for x in labels}
    sums = {m: F.coalesce(F.col(m), F.lit(0).cast(kinds[m])) for m in measures}
    return slice_categories(df, keys, conds, sums, name=category, fill=labels)


def pending(df: DataFrame, status: Column, keys: Sequence[str], qty: str) -> DataFrame:
    """Quantity and number of rows in a status, per key."""
    return df.filter(status).groupBy(*keys).agg(F.sum(qty).alias("qty_pending"), F.count(F.lit(1)).alias("n_pending"))


def discount_rollup(lines: DataFrame, header: str, gross: Column, net: Column) -> DataFrame:
    """Gross, net, discount and discount share per header."""
    sums = lines.groupBy(header).agg(F.sum(gross).alias("amt_gross"), F.sum(net).alias("amt_net"))
    return sums.withColumns({
        "amt_discount": F.col("amt_gross") - F.col("amt_net"),
        "discount_percent": safe_ratio(F.col("amt_gross") - F.col("amt_net"), "amt_gross") * 100,
    })


def price_discounts(lines: DataFrame, header: str, price: str, unit_price: str, lists: Sequence[str]) -> DataFrame:
    """Price per header against each list price: sums, discount, and discount as a share of the unit prices.

    Names of ``lists`` stand for columns ``<price>_<list>``. Nulls count as 0; shares are 0 where the price or the unit
    prices are 0. A price above its list gives a negative discount and a positive share, as the sales system shows it.
    """
    total = lambda c: F.coalesce(F.sum(F.col(c).cast("decimal(18,2)")), F.lit(0))
    sums = lines.groupBy(header).agg(total(price).alias("amt_total_price"), total(unit_price).alias("__unit"),
                                     *[total(f"{price}_{n}").alias(f"amt_total_price_{n}") for n in lists])
    for n in lists:
        off = F.col("amt_total_price") - F.col(f"amt_total_price_{n}")
        sums = sums.withColumns({f"amt_discount_{n}": -off, f"perc_discount_{n}": F.when(F.col("amt_total_price") == 0, 0.0).otherwise(safe_ratio(off, "__unit"))})
    return sums.drop("__unit")


HOT_ROWS = 10_000  # rows of a key that are gathered in one piece
PARTS = 256  # pieces of a key with more


def _as_number(df: DataFrame, order: str) -> Column:
    """A number that never falls as the column grows; texts by their first seven bytes."""
    kind = df.schema[order].dataType
    if isinstance(kind, (NumericType, DateType, TimestampType, TimestampNTZType)):
        return F.col(order)
    if isinstance(kind, StringType):
        return F.conv(F.rpad(F.hex(F.substring(F.col(order).cast("binary"), 1, 7)), 14, "0"), 16, 10).cast("bigint")
    raise TypeError(f"no pieces by {kind.simpleString()}; give a chunk")


def _pieces(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows (keys, __v, __o) with a piece number ``__c`` that never falls as ``__o`` grows. Keys of few rows have one piece;
    those of more are cut at approximate quantiles of their order, whose sketches are of fixed size and combine map side."""
    number = _as_number(rows, "__o")
    cuts = F.percentile_approx(number, [k / PARTS for k in range(1, PARTS)], 10 * PARTS)
    hot = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), cuts.alias("__cuts")).filter(F.col("__n") > HOT_ROWS)
    hot = hot.select(*[F.col(k).alias(f"__h_{k}") for k in keys], F.array_distinct("__cuts").alias("__cuts"))
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__h_{k}"))
    below = F.size(F.filter("__cuts", lambda c: c < number))
    out = rows.join(hot, cond, "left").withColumn("__c", F.when(F.col("__cuts").isNull(), 0).otherwise(below))
    return out.drop("__cuts", *[f"__h_{k}" for k in keys])


def ordered_concat(df: DataFrame, keys: Sequence[str], value: str, order: Column, sep: str = ", ",
                   distinct: bool = False, chunk: Column | None = None) -> DataFrame:
    """Values of a key joined in order, as ``values_text``.

    With ``distinct`` repeated values collapse map side first, at their first place. Parts are joined per key and piece,
    then the pieces per key, so a key with very many rows is not gathered row by row in one task. Pieces come from
    quantiles of the order column, or from ``chunk``, an expression that never decreases as ``order`` grows. Rows of equal
    order stay in one piece. Null values are left out.
    """
    chosen = [chunk.alias("__c")] if chunk is not None else []
    rows = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("string").alias("__v"), order.alias("__o"), *chosen)
    if distinct:
        rows = rows.groupBy(*keys, "__v").agg(F.min("__o").alias("__o"), *([F.min("__c").alias("__c")] if chosen else []))
    if not chosen:
        rows = _pieces(rows, keys)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__o", "__v"))), lambda x: x["__v"]), sep)
    parts = rows.groupBy(*keys, "__c").agg(joined.alias("__v")).withColumn("__o", F.col("__c"))
    return parts.groupBy(*keys).agg(joined.alias("values_text"))


def attainment(df: DataFrame, keys: Sequence[str], week_start: str, hours: str, plan: str, as_of: str) -> DataFrame:
    """Year-to-date and last-twelve-months attainment of weekly targets, from one row per key and week, in one pass.

    With the averages per week, the target of a whole year and the part of it that is done. Percentages are rounded to a
    tenth before they are compared with 100; a target of 0 counts as 1, a yearly target of 0 gives a progress of 0.
    """
    today = F.lit(as_of).cast("date")
    ytd = F.year(F.col(week_start)) == F.year(today)
    year = within_months(week_start, 12, as_of)
    pick = lambda cond, c: F.sum(F.when(cond, F.col(c)))
    per_week = F.max(F.when(ytd, F.round(F.col(plan), 1)))
    sums = df.groupBy(*keys).agg(
        per_week.cast("double").alias("billable_hours_per_week"),
        F.round(F.max(F.when(ytd, F.col(plan))) * 52, 1).cast("double").alias("billable_hours_per_year"),
        F.count(F.when(ytd, 1)).alias("ytd_weeks"),
        F.round(pick(ytd, hours), 1).cast("double").alias("ytd_actual"),
        F.round(F.try_divide(pick(ytd, hours).cast("double"), F.count(F.when(ytd, 1))), 1).alias("ytd_average_per_week"),
        F.round(F.try_divide(pick(year, hours).cast("double"), F.count(F.when(year, 1))), 1).alias("l12m_average_per_week"),
        F.count(F.when(year, 1)).alias("l12m_weeks"),
        F.round(pick(year, hours), 1).cast("double").alias("l12m_actual"),
        F.round(pick(year, plan), 1).cast("double").alias("l12m_target"),
    )
    target = F.round(F.col("billable_hours_per_week") * F.col("ytd_weeks"), 1)
    percent = lambda a, t: F.round(F.col(a) / F.when(F.col(t) == 0, F.lit(1.0)).otherwise(F.col(t)) * 100, 1)
    out = sums.filter("ytd_weeks > 0").withColumn("ytd_target", target).withColumns({
        "ytd_percentage": percent("ytd_actual", "ytd_target"),
        "l12m_percentage": percent("l12m_actual", "l12m_target"),
    })
    status = lambda c: F.when(F.col(c) >= 100, "On Track").otherwise("Off Track")
    return out.withColumns({"ytd_status": status("ytd_percentage"), "l12m_status": status("l12m_percentage"),
                            "progress": safe_ratio("ytd_actual", "billable_hours_per_year") * 100})


def plan_vs_actual(plan: DataFrame, actual: DataFrame, keys: Sequence[str], start: str, end: str, date: str,
                   measures: dict[str, Column]) -> DataFrame:
    """Plan rows with the sums of the actual rows of the same key whose date falls into the plan's interval.

    ``measures`` maps a name to the row expression to sum. Plans may overlap, each gets its own total; equal ones stay apart.
    """
    return sums_between(plan, actual, keys, start, end, date, measures)
