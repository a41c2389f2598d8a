"""Pay measures of a person in several currencies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverloom.functions.money import MONEY, neutralise

AMOUNTS = ("annual_salary", "hourly_pay_rate", "period_pay_rate", "weekly_pay_rate")
EXTRAS = ("other_rate_1", "other_rate_3", "other_rate_4")
RATE, SHARE = "decimal(20,10)", "decimal(9,5)"
# A first other rate below this is old data that is no bonus; a bonus share of this or more is no share.
LEAST_BONUS, GREATEST_SHARE = 10, 1


def or_derived(amount: Column, derived: Column) -> Column:
    """The amount; where it is null or 0, the one derived from others; 0 where there is none."""
    return F.coalesce(F.when(amount != 0, amount), derived, F.lit(0)).cast(MONEY)


def with_pay(df: DataFrame, rates: dict[str, str]) -> DataFrame:
    """Adds each pay amount in the original and in further currencies, with and without the cost-of-living share, the bonus
    and both totals. ``rates`` maps a suffix to the column with the rate from the original currency.

    Read are the columns of ``AMOUNTS`` and ``EXTRAS``, ``other_rate_2`` (bonus share) and ``cola_percent``; they are
    replaced by ``<amount>_<suffix>`` but for the share. Each step is rounded to cents and the next reads the rounded value.
    """
    share = F.coalesce(neutralise(F.col("other_rate_2"), F.col("other_rate_2") >= GREATEST_SHARE), F.lit(0)).cast("decimal(4,2)")
    first = F.coalesce(neutralise(F.col("other_rate_1"), F.col("other_rate_1") < LEAST_BONUS), F.lit(0)).cast(MONEY)
    plain = {a: F.coalesce(F.col(a), F.lit(0)).cast(MONEY) for a in (*AMOUNTS, *EXTRAS)} | {"other_rate_1": first}
    out = df.withColumns({f"{a}_original": c for a, c in plain.items()} | {
        "other_rate_2_original": share, "cola_percent": F.coalesce("cola_percent", F.lit(0)).cast(SHARE),
        **{r: F.col(r).cast(RATE) for r in rates.values()}}).drop(*plain, "other_rate_2")
    out = out.withColumns({f"{a}_{s}": (F.col(f"{a}_original") * F.col(r)).cast(MONEY) for a in plain for s, r in rates.items()})
    uplift = F.lit(1) + F.col("cola_percent")
    suffixes = ("original", *rates)
    out = out.withColumns(
        {f"{a}_cola_{s}": (F.col(f"{a}_{s}") * uplift).cast(MONEY) for a in AMOUNTS for s in suffixes}
        | {f"performance_bonus_{s}": (F.col(f"annual_salary_{s}") * F.col("other_rate_2_original")).cast(MONEY) for s in suffixes})
    total = {s: F.col(f"annual_salary_cola_{s}") + F.col(f"other_rate_1_{s}") for s in suffixes}
    return out.withColumns(
        {f"total_compensation_{s}": total[s].cast(MONEY) for s in suffixes}
        | {f"total_potential_compensation_{s}": (total[s] + F.col(f"performance_bonus_{s}")).cast(MONEY) for s in suffixes})
