"""Money and ratio columns. Amounts and rates meet as decimals; the exact product is rounded once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverloom.functions.keys import col

MONEY = "decimal(18,2)"
RATE = "decimal(18,8)"
# exchange rates: 14 digits keep weak currencies exact to the cent, and a product with MONEY fits 38 digits
FX_RATE = "decimal(20,14)"
# Fixed value: quotes below this are turned round, so the product stays accurate.
RATE_THRESHOLD = 0.09


def money(c: str | Column) -> Column:
    return col(c).cast(MONEY)


def safe_ratio(num: str | Column, den: str | Column, default=0) -> Column:
    """num / den as double; ``default`` where the denominator is zero or either side is null."""
    ratio = F.try_divide(col(num).cast("double"), col(den).cast("double"))
    return F.coalesce(ratio, F.lit(default).cast("double"))


def neutralise(c: str | Column, implausible: Column, to=0) -> Column:
    """Keep a value unless it is implausible; then a neutral value stands in."""
    value = col(c)
    return F.when(implausible, F.lit(to)).otherwise(value)


def rate_or_derived(c: str | Column, derived: Column) -> Column:
    """A stored rate, or the one derived from another rate where it is missing or zero."""
    value = col(c)
    return F.when(value.isNull() | (value == 0), derived).otherwise(value)


def convert(amount: str | Column, rate: str | Column, to: str = MONEY) -> Column:
    """Amount times rate, rounded once to the money type."""
    return (col(amount).cast("decimal(18,4)") * col(rate).cast(FX_RATE)).cast(to)


def threshold_convert(amount: str | Column, div: str | Column, mul: str | Column,
                      threshold: float = RATE_THRESHOLD) -> Column:
    """Divide by the quote when it is at least the threshold, otherwise multiply by its inverse."""
    inverse = F.try_divide(F.lit(1.0), col(div).cast("double"))
    return convert(amount, F.when(col(div) >= F.lit(threshold), inverse).otherwise(col(mul).cast("double")))


def pick_amount(ladder: Sequence[tuple[Column, Column]], otherwise: Column) -> Column:
    """First amount whose condition holds; the last resort is usually a converted amount."""
    out = F.when(ladder[0][0], ladder[0][1])
    for cond, amount in ladder[1:]:
        out = out.when(cond, amount)
    return out.otherwise(otherwise)


def weighted_rate(rate: str | Column, qty: str | Column) -> Column:
    """Aggregate: average rate weighted by quantity; zero when the quantity sums to zero."""
    total = F.sum((col(rate) * col(qty)).cast("decimal(38,10)")).cast("double")
    return safe_ratio(total, F.sum(col(qty)).cast("double"))


def money_steps(df: DataFrame, steps: Sequence[tuple[str, Column]]) -> DataFrame:
    """Named columns added one after another, each rounded to money before the next one reads it.

    A step named like an input column replaces it for the later steps, so no step can read the unrounded value.
    """
    for name, expr in steps:
        df = df.withColumn(name, expr.cast(MONEY))
    return df


def totals(df: DataFrame, base: str, uplift: Column, bonus: str, currencies: dict[str, Column]) -> DataFrame:
    """Base with uplift, bonus and their total in several currencies.

    ``currencies`` maps a suffix to the rate from the original currency. Gives base_x, base_uplift_x, bonus_x, total_x.
    """
    out = {}
    for suffix, rate in currencies.items():
        plain = convert(base, rate)
        lifted = convert(col(base).cast(MONEY) * (F.lit(1) + uplift.cast("decimal(9,4)")), rate)
        extra = convert(bonus, rate)
        out[f"base_{suffix}"] = plain
        out[f"base_uplift_{suffix}"] = lifted
        out[f"bonus_{suffix}"] = extra
        out[f"total_{suffix}"] = (lifted + extra).cast(MONEY)
    return df.withColumns(out)


def scale_plan(weekly: str | Column, grain: str | Column, yearly: str | Column | None = None) -> Column:
    """Weekly figure scaled to a period grain: 52 weeks a year, spread over 12 months or 4 quarters."""
    week = col(weekly)
    year = col(yearly) if yearly is not None else week * 52
    g = col(grain)
    return (
        F.when(g == "W", week.cast(MONEY))
        .when(g == "M", (week * 52 / 12).cast(MONEY))
        .when(g == "Q", (week * 52 / 4).cast(MONEY))
        .when(g == "Y", year.cast(MONEY))
        .otherwise(F.lit(0).cast(MONEY))
    )
