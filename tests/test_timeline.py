"""Timelines against plain loops: as-of values and sums between days."""

import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from silverloom.operators import timeline
from tests.conftest import rows

FIRST = date(2000, 1, 1)


def days(r, n, span=400):
    return [FIRST + timedelta(r.randrange(span)) for _ in range(n)]


@pytest.mark.parametrize("open_start", [True, False])
def test_as_of_equals_a_plain_search(spark, open_start):
    r = random.Random(1)
    changes = [(k, d, n) for k in (1, 2, 3, None) for n, d in enumerate(days(r, 60))] + [(4, date(2000, 3, 1), 7), (5, None, 1)]
    changes += [(6, FIRST + timedelta(k), k) for k in range(3000)]  # a change on each day of eight years
    facts = [(n, r.choice((1, 2, 3, 4, 5, 6, 9, None)), r.choice([None, date(1850, 1, 1), date(2100, 1, 1), *days(r, 8, 3300)])) for n in range(600)]
    best = {}
    for k, d, n in changes:
        if k is not None and d is not None:
            best[k, d] = max(best.get((k, d), n), n)
    want = []
    for n, k, d in facts:
        line = sorted((day, v) for (key, day), v in best.items() if key == k)
        at = [i for i, (day, _) in enumerate(line) if d is not None and day <= d]
        at = at[-1] if at else 0 if line and open_start and d is not None else None
        if at is None:
            want.append((n, k, d, None, None, None))
            continue
        frm = date(1900, 1, 1) if open_start and at == 0 else line[at][0]
        want.append((n, k, d, line[at][1], frm, line[at + 1][0] - timedelta(1) if at + 1 < len(line) else date(9999, 12, 31)))
    got = timeline.as_of_join(spark.createDataFrame(facts, "id int, k int, d date"), spark.createDataFrame(changes, "k int, c date, v int"),
                              ["k"], "d", "c", {"v": F.max("v")}, open_start, bounds=True)
    assert sorted(map(str, want)) == sorted(str(tuple(x)) for x in got.collect())


def test_as_of_reads_the_facts_once(spark, tmp_path):
    spark.range(50).select((F.col("id") % 3).alias("k"), F.date_add(F.lit(FIRST), F.col("id").cast("int")).alias("d")).write.parquet(f"{tmp_path}/facts")
    facts = spark.read.parquet(f"{tmp_path}/facts")
    changes = spark.createDataFrame([(1, FIRST, 5)], "k long, c date, v int")
    out = timeline.as_of_join(facts, changes, ["k"], "d", "c", {"v": F.max("v")})
    assert out._jdf.queryExecution().optimizedPlan().toString().count(f"parquet") == 1
    assert out.count() == 50


def test_sums_between_equal_a_plain_sum_and_keep_equal_plans(spark):
    r = random.Random(2)
    actual = [(k, d, r.choice((None, Decimal("1.25"), Decimal("-3.10"), Decimal("1000000.01"))), r.choice((None, 1, 5))) for k in (1, 2, None) for d in [*days(r, 200), None]]
    plans = [(r.choice((1, 2, 3, None)), a, r.choice([b, a, None])) for a, b in zip([*days(r, 150), None, None], days(r, 152))]
    plans += plans[:5] + [(1, date(1990, 1, 1), date(2050, 1, 1)), (1, date(2000, 6, 1), date(2000, 1, 1))]

    def total(plan, column):
        k, a, b = plan
        hit = [x[column] for x in actual if None not in (k, a, b) and x[0] == k and x[1] is not None and a <= x[1] <= b and x[column] is not None]
        return sum(hit) if hit else None

    got = timeline.sums_between(spark.createDataFrame(plans, "k int, a date, b date"), spark.createDataFrame(actual, "k int, d date, q decimal(18,2), n int"),
                                ["k"], "a", "b", "d", {"q": F.col("q"), "n": F.col("n")})
    assert rows(got) == sorted(((*p, total(p, 2), total(p, 3)) for p in plans), key=lambda r: tuple((x is None, str(x)) for x in r))
    assert dict(got.dtypes)["q"] == "decimal(28,2)"
    empty = spark.createDataFrame([], "k int, d date, q decimal(18,2)")
    assert timeline.sums_between(got.select("k", "a", "b"), empty, ["k"], "a", "b", "d", {"q": F.col("q")}).filter("q IS NOT NULL").count() == 0


def test_sums_between_refuses_inexact_measures(spark):
    plans = spark.createDataFrame([(1, FIRST, FIRST)], "k int, a date, b date")
    actual = spark.createDataFrame([(1, FIRST, 1.0)], "k int, d date, q double")
    with pytest.raises(TypeError):
        timeline.sums_between(plans, actual, ["k"], "a", "b", "d", {"q": F.col("q")})


def test_two_lookups_in_one_join_are_those_of_two(frame):
    """A key's rates by item and its rates without item, with keys, items and days that are null, unknown or repeated."""
    def day(n):
        return FIRST + timedelta(n)

    changes = frame("p int, e int, item long, day date, v int", (1, 1, 5, day(1), 10), (1, 1, 5, day(4), 11), (1, 1, 5, day(4), 12), (1, 1, 6, day(2), 20), (1, 1, None, day(3), 30),
                    (1, 1, 7, None, 40), (2, 1, None, day(1), 50), (None, 1, 5, day(1), 60), (3, 1, 5, day(1), 70))
    facts = frame("n int, p int, e int, item long, day date", (1, 1, 1, 5, day(1)), (2, 1, 1, 5, day(5)), (3, 1, 1, 6, day(1)), (4, 1, 1, 6, day(9)), (5, 1, 1, 7, day(9)), (6, 1, 1, None, day(9)),
                  (7, 2, 1, 5, day(9)), (8, None, 1, 5, day(9)), (9, 3, 1, 5, None), (10, 3, 1, 5, day(9)), (11, 4, 1, 5, day(9)), (2, 1, 1, 5, day(5)))
    value = {"v": F.max("v")}
    two = timeline.as_of_join(facts, changes.filter("item IS NOT NULL"), ["p", "e", "item"], "day", "day", value, open_start=False).withColumnRenamed("v", "item_v")
    two = timeline.as_of_join(two, changes.filter("item IS NULL").drop("item"), ["p", "e"], "day", "day", value, open_start=False)
    one = timeline.parted_as_of_join(facts, changes, ["p", "e"], "item", "day", "day", value, "item_")
    assert one.columns == two.columns and rows(one) == rows(two)
    assert one.filter("item_v IS NOT NULL").count() == 5 and one.filter("v IS NOT NULL").count() == 6
