"""Column functions on edge values."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from silverloom.functions import dates, keys, money, text


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("raw, want", [("mary-ann o'neil", "Mary-Ann O'Neil"), ("DE LA cruz", "De La Cruz"), ("", ""), (None, None)])
def test_proper_case_starts_words_after_punctuation(spark, raw, want):
    assert value(spark, text.proper_case(F.lit(raw).cast("string"))) == want


def test_display_name_prefers_non_blank_preferred_name(spark):
    first, last = F.lit("robert "), F.lit(" stone")
    assert value(spark, text.display_name(first, last, F.lit("bob"))) == "Bob Stone"
    assert value(spark, text.display_name(first, last, F.lit(" "))) == "Robert Stone"
    assert value(spark, text.display_name(first, last, F.lit("bob"), last_first=True)) == "Stone, Bob"


@pytest.mark.parametrize("code, country, want", [
    ("12345-6789", "us", "12345"), ("K1A 0B1", "CA", "K1A"), ("SW1A 1AA", "GB", "SW1A"), ("AB", "GB", ""), ("D02", "IE", "D02"),
    ("1012 AB", "NL", "1012"), ("123", "KR", "123"), ("10 115", "DE", "10115"), ("", "US", None), (None, "US", None)])
def test_postal_rules(spark, code, country, want):
    assert value(spark, text.norm_postal(F.lit(code).cast("string"), F.lit(country))) == want


def test_delimited_membership_matches_whole_entries(spark):
    assert value(spark, text.in_delimited(F.lit("|13|30|"), 3)) is False
    assert value(spark, text.in_delimited(F.lit("|13|3|"), 3)) is True


def test_flags_and_labels_with_null(spark):
    null = F.lit(None).cast("string")
    assert value(spark, text.flag(null, "Y")) is False
    assert value(spark, text.label(null, {"a": "A"}, "none")) == "none"
    assert value(spark, text.record_label(F.lit(""), F.lit(7))) == "7"
    assert value(spark, text.record_label(F.lit("Ann"), F.lit(7))) == "Ann - 7"
    assert value(spark, text.norm_currency(F.lit(""))) == "USD"
    assert value(spark, text.norm_currency(F.lit("eur"))) == "EUR"


def test_composite_key_and_hash_propagate_null(spark):
    assert value(spark, keys.composite_key(F.lit(1), F.lit("b"))) == "1:b"
    assert value(spark, keys.composite_key(F.lit(1), F.lit(None))) is None
    assert value(spark, keys.hash_key(F.lit(None).cast("string"))) is None
    assert value(spark, keys.hash_key(F.lit(12))) == "c20ad4d76fe97759aa27a0c99bff6710"


@pytest.mark.parametrize("num, den, want", [(4, 2, 2.0), (4, 0, 0.0), (4, None, 0.0), (None, 2, 0.0)])
def test_safe_ratio(spark, num, den, want):
    assert value(spark, money.safe_ratio(F.lit(num).cast("int"), F.lit(den).cast("int"))) == want


def test_threshold_picks_direction_at_its_exact_value(spark):
    def conv(div):
        return value(spark, money.threshold_convert(F.lit(Decimal("9.00")), F.lit(div), F.lit(7.0)))

    assert conv(0.09) == Decimal("100.00")
    assert conv(0.0899) == Decimal("63.00")


def test_convert_rounds_half_up_once(spark):
    assert value(spark, money.convert(F.lit(Decimal("1.00")), F.lit(0.285))) == Decimal("0.29")
    assert value(spark, money.convert(F.lit(Decimal("1000000.00")), F.lit(0.00004))) == Decimal("40.00")


def test_money_steps_read_rounded_values(spark):
    df = spark.createDataFrame([(Decimal("1.005"), Decimal("100"))], "rate decimal(9,3), qty decimal(9,0)")
    got = money.money_steps(df, [("rate", F.col("rate")), ("amt", F.col("rate") * F.col("qty"))]).first()
    assert (got["rate"], got["amt"]) == (Decimal("1.01"), Decimal("101.00"))


@pytest.mark.parametrize("grain, want", [("W", "12.00"), ("M", "52.00"), ("Q", "156.00"), ("Y", "624.00"), ("X", "0.00")])
def test_scale_plan(spark, grain, want):
    assert value(spark, money.scale_plan(F.lit(Decimal("12.00")), F.lit(grain))) == Decimal(want)


def test_rate_or_derived_replaces_null_and_zero(spark):
    for missing in (None, 0):
        assert value(spark, money.rate_or_derived(F.lit(missing).cast("int"), F.lit(5))) == 5
    assert value(spark, money.rate_or_derived(F.lit(3), F.lit(5))) == 3


def test_monday_boundaries_counts_a_weekend_step(spark):
    day = lambda s: F.lit(s).cast("date")
    assert value(spark, dates.monday_boundaries(day("2024-01-06"), day("2024-01-08"))) == 1
    assert value(spark, dates.monday_boundaries(day("2024-01-08"), day("2024-01-14"))) == 0


def _workdays(start: dt.date, year: int) -> int:
    """The rule by counting: days left, less two per week start passed, corrected at a Sunday start and a Saturday end."""
    nxt = dt.date(year + 1, 1, 1)
    days = (nxt - start).days
    mondays = sum((start + dt.timedelta(i)).weekday() == 0 for i in range(1, days + 1))
    return min(260, days - 2 * mondays - (start.weekday() == 6) + (dt.date(year, 12, 31).weekday() == 5))


@pytest.mark.parametrize("year", [2021, 2022, 2023, 2024])
def test_work_days_in_year(spark, year):
    first = dt.date(year, 1, 1)
    days = [(first + dt.timedelta(i), year) for i in range(365)]
    df = spark.createDataFrame(days, "d date, y int")
    got = {r["d"]: r["n"] for r in df.select("d", dates.work_days_in_year("d", "y").alias("n")).collect()}
    assert [d for d, _ in days if got[d] != _workdays(d, year)] == []


def test_work_days_other_year_and_null_start(spark):
    df = spark.createDataFrame([(dt.date(2020, 5, 1), 2021), (None, 2021)], "d date, y int")
    assert [r[0] for r in df.select(dates.work_days_in_year("d", "y")).collect()] == [260, 260]


def test_active_flag_bounds(spark):
    df = spark.createDataFrame([("2024-01-15", "2024-01-16"), ("2024-01-14", "2024-01-15"), ("2024-01-16", None), ("2024-01-01", None), (None, None)], "s string, e string")
    got = [r[0] for r in df.select(dates.active_flag(F.to_date("s"), F.to_date("e"), "2024-01-15")).collect()]
    assert got == [True, False, False, True, False]
