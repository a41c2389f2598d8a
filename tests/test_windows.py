"""Latest rows, neighbours, ranges and fills."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from silverloom.operators import windows
from tests.conftest import SF, rows

D = dt.date.fromisoformat
OPEN = D("9999-12-31")


def test_latest_row_with_ties_single_rows_and_null_order(frame):
    df = frame("k int, d date, id int", (1, D("2024-01-01"), 1), (1, D("2024-01-01"), 2), (2, None, 3), (2, None, 4), (3, D("2024-01-01"), 5))
    got = windows.latest_per_key(df, ["k"], [F.desc("d"), F.desc("id")])
    assert rows(got.select("k", "id")) == [(1, 2), (2, 4), (3, 5)]


def test_priority_prefers_listed_source(frame):
    df = frame("k int, src string, v int", (1, "b", 1), (1, "a", 2), (2, "b", 3), (3, "z", 4))
    got = windows.prefer_source(df, ["k"], "src", ["a", "b"], [F.asc("v")])
    assert rows(got.select("k", "v")) == [(1, 2), (2, 3), (3, 4)]


def test_ranges_one_change_two_on_a_day_and_adjacent_days(frame):
    df = frame("k int, d date, v int", (1, D("2024-01-05"), 1), (2, D("2024-01-05"), 1), (2, D("2024-01-05"), 9), (2, D("2024-01-06"), 2), (3, None, 1))
    got = windows.change_ranges(df, ["k"], "d", values=[F.max("v").alias("v")])
    assert rows(got.select("k", "date_from", "date_to", "v")) == [
        (1, D("1900-01-01"), OPEN, 1), (2, D("1900-01-01"), D("2024-01-05"), 9), (2, D("2024-01-06"), OPEN, 2)]


def test_ranges_from_the_effective_date(frame):
    df = frame("k int, d date", (1, D("2024-01-05")),)
    assert rows(windows.change_ranges(df, ["k"], "d", open_start=False)) == [(1, D("2024-01-05"), OPEN)]


def test_ranges_never_overlap_and_cover_every_day(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    got = windows.change_ranges(orders, ["o_custkey"], "o_orderdate")
    w = Window.partitionBy("o_custkey").orderBy("date_from")
    gaps = got.withColumn("before", F.lag("date_to").over(w)).filter("before IS NOT NULL AND datediff(date_from, before) <> 1")
    assert gaps.count() == 0
    assert got.filter("date_to < date_from").count() == 0


@pytest.mark.parametrize("offset", [1, -1])
def test_neighbour_in_buckets_equals_a_plain_window(spark, offset):
    ev = spark.read.parquet(f"{SF}/events.parquet").withColumn("v", F.when(F.col("value") > 20, F.col("value")))
    # one key holds a third of the rows
    ev = ev.withColumn("k", F.when(F.col("event_id") % 3 == 0, 0).otherwise(F.col("user_id")))
    got = windows.neighbour(ev, ["k"], "ts", "v", "n", ties=["event_id"], offset=offset)
    w = Window.partitionBy("k").orderBy("ts", "event_id")
    want = ev.withColumn("n", (F.lead if offset > 0 else F.lag)("v").over(w))
    assert rows(got.select("event_id", "n")) == rows(want.select("event_id", "n"))


def test_neighbour_keeps_null_keys_and_ties(frame):
    df = frame("k int, d date, id int, v string", (None, D("2024-01-01"), 1, "a"), (None, D("2024-01-01"), 2, None), (None, D("2024-02-01"), 3, "c"))
    got = windows.neighbour(df, ["k"], "d", "v", "n", ties=["id"])
    assert rows(got.select("id", "n")) == [(1, None), (2, "c"), (3, None)]


def test_scd2_stamps(frame):
    t = dt.datetime.fromisoformat
    df = frame("k int, id int, t timestamp_ntz", (1, 1, t("2024-01-01T00:00:00")), (1, 2, t("2024-03-01T10:00:00")), (2, 3, t("2024-01-01T00:00:00")))
    got = windows.scd2(df, "k", "t", ["id"])
    assert rows(got.select("id", "dts_eff_end", "bln_current")) == [
        (1, t("2024-03-01T09:59:59"), False), (2, t("9999-12-31T00:00:00"), True), (3, t("9999-12-31T00:00:00"), True)]


def test_fill_days_equals_grid_with_forward_fill(frame):
    df = frame("k string, date date, v int", ("a", D("2024-01-02"), 1), ("a", D("2024-01-05"), 2), ("b", D("2024-01-04"), 3), ("b", D("2024-01-09"), 4))
    got = windows.fill_days(df, ["k"], "date", F.lit("2024-01-06").cast("date"))
    assert rows(got) == [("a", D("2024-01-02"), 1), ("a", D("2024-01-03"), 1), ("a", D("2024-01-04"), 1), ("a", D("2024-01-05"), 2), ("a", D("2024-01-06"), 2),
                         ("b", D("2024-01-04"), 3), ("b", D("2024-01-05"), 3), ("b", D("2024-01-06"), 3)]


def test_forward_fill_keeps_leading_nulls(frame):
    df = frame("k int, d int, v int", (1, 1, None), (1, 2, 5), (1, 3, None))
    assert rows(windows.forward_fill(df, ["k"], "d", ["v"])) == [(1, 1, None), (1, 2, 5), (1, 3, 5)]


def test_latest_row_is_cut_before_the_shuffle(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    plan = windows.latest_per_key(orders, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
