"""Dense daily currency-rate cube and conversions with it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverloom.functions.dates import as_date, clamp
from silverloom.functions.keys import col
from silverloom.functions.money import convert
from silverloom.operators.windows import fill_days
from silverloom.sources.tables import cut_lineage


def cross_rates(series: DataFrame, base: str = "USD") -> DataFrame:
    """Rates of one day between all quoted currencies, from a series of quotes against the base.

    ``series`` has frm_curr, date, value: units of frm_curr for one unit of the base. The size is currencies squared
    times days: bounded by the list of currencies, whatever the size of the facts. Prune the list first.
    """
    s = series.filter(F.col("to_curr") == base).select("frm_curr", "date", F.col("value").cast("double"))
    a = s.select(F.col("frm_curr"), F.col("date"), F.col("value").alias("va"))
    b = s.select(F.col("frm_curr").alias("to_curr"), F.col("date"), F.col("value").alias("vb"))
    mul = (F.lit(1.0) / F.col("va")) * F.col("vb")
    cross = a.join(b, "date").filter(F.col("frm_curr") != F.col("to_curr"))
    return cross.select("frm_curr", "to_curr", "date", (F.lit(1.0) / mul).alias("fx_rate_div"), mul.alias("fx_rate_mul"))


def base_rates(series: DataFrame, base: str = "USD") -> DataFrame:
    """Rates between each quoted currency and the base, in both directions, in one scan."""
    v = F.col("value").cast("double")
    inv = F.lit(1.0) / v
    both = F.array(
        F.struct(F.col("frm_curr").alias("f"), F.lit(base).alias("t"), v.alias("div"), inv.alias("mul")),
        F.struct(F.lit(base).alias("f"), F.col("frm_curr").alias("t"), inv.alias("div"), v.alias("mul")),
    )
    rows = series.filter((F.col("to_curr") == base) & (F.col("frm_curr") != base)).select("date", F.explode(both).alias("r"))
    return rows.select(
        F.col("r.f").alias("frm_curr"), F.col("r.t").alias("to_curr"), "date",
        F.col("r.div").alias("fx_rate_div"), F.col("r.mul").alias("fx_rate_mul"),
    )


def fx_cube(series: DataFrame, as_of: str, base: str = "USD", active: DataFrame | None = None,
            active_col: str = "currency") -> DataFrame:
    """Every pair and day from the pair's first quote to the earlier of the last quoted day and ``as_of``.

    Days without a quote repeat the last one. Only active currencies enter the pairs, if a list is given.
    """
    if active is not None:
        keep = active.select(F.col(active_col).alias("frm_curr"))
        series = series.join(keep, "frm_curr", "left_semi")
    quoted = series.filter(F.col("to_curr") == base)
    until = F.least(quoted.agg(F.max("date").alias("d")).scalar(), as_date(as_of))
    observed = cross_rates(series, base).unionByName(base_rates(series, base))
    filled = fill_days(observed, ["frm_curr", "to_curr"], "date", until)
    return filled.select("frm_curr", "to_curr", "date", "fx_rate_div", "fx_rate_mul")


@dataclass(frozen=True)
class RateBook:
    """The cube with one row a day: ``rates`` maps a currency to the rates into all others. The first and last day are
    known, so no query has to ask for them."""

    by_day: DataFrame
    first: date | None
    last: date | None


def lookup_cube(cube: DataFrame) -> RateBook:
    """The cube ready for many lookups: computed once. A row is as large as the square of the list of currencies."""
    pair = F.struct(F.col("fx_rate_div").alias("div"), F.col("fx_rate_mul").alias("mul"))
    of_currency = cube.groupBy("date", "frm_curr").agg(F.map_from_entries(F.collect_list(F.struct("to_curr", pair))).alias("into"))
    by_day = cut_lineage(of_currency.groupBy("date").agg(F.map_from_entries(F.collect_list(F.struct("frm_curr", "into"))).alias("rates")))
    return RateBook(by_day, *by_day.agg(F.min("date"), F.max("date")).first())


def with_rates(df: DataFrame, cube: DataFrame | RateBook, wanted: dict[str, tuple[str | Column, str | Column]], day: str | Column,
               on_missing: str = "one", default: str | Column | None = None, rate: str = "mul") -> DataFrame:
    """Rates of the day, moved into the days the cube covers: a column for each name of ``wanted``, which says from which
    currency into which. However many there are, the rows meet the cube once, by the day.

    ``on_missing``: 'one' gives rate 1, 'null' leaves it open, 'default' takes ``default``, and 1 where that is null too.
    Equal currencies always get 1. A null day or currency has no rate.
    """
    book = cube if isinstance(cube, RateBook) else lookup_cube(cube)
    first, last = (F.lit(d).cast("date") for d in (book.first, book.last))
    facts = df.withColumn("__day", clamp(F.to_date(col(day)), first, last))
    out = facts.join(book.by_day.select(F.col("date").alias("__cube_day"), F.col("rates").alias("__rates")), F.col("__day") == F.col("__cube_day"), "left")
    made = {}
    for name, (frm, to) in wanted.items():
        own, other = col(frm), col(to)
        found = F.when(own == other, F.lit(1.0)).otherwise(F.try_element_at(F.try_element_at("__rates", own), other)[rate])
        if on_missing == "one":
            found = F.coalesce(found, F.lit(1.0))
        elif on_missing == "default":
            found = F.coalesce(found, col(default).cast("double"), F.lit(1.0))
        made[name] = found
    return out.withColumns(made).drop("__day", "__cube_day", "__rates")


def with_rate(df: DataFrame, cube: DataFrame | RateBook, frm: str | Column, to: str | Column, date: str | Column, name: str,
              on_missing: str = "one", default: str | Column | None = None, rate: str = "mul") -> DataFrame:
    """One rate, as ``with_rates`` gives it."""
    return with_rates(df, cube, {name: (frm, to)}, date, on_missing, default, rate)


def fx_convert(df: DataFrame, cube: DataFrame | RateBook, amounts: Sequence[str], frm: str | Column,
               targets: dict[str, str | Column], date: str | Column, on_missing: str = "one",
               default: str | Column | None = None) -> DataFrame:
    """Amounts in several target currencies: ``targets`` maps a suffix to a currency column or literal column.

    The rate stays as ``fx_rate_<suffix>``; every amount gets ``<amount>_<suffix>``, rounded once.
    """
    df = with_rates(df, cube, {f"fx_rate_{s}": (frm, to) for s, to in targets.items()}, date, on_missing, default)
    return df.withColumns({f"{a}_{s}": convert(a, f"fx_rate_{s}") for s in targets for a in amounts})
