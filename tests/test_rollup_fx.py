"""Roll-ups, categories, currency rates and reports."""

import datetime as dt
import io
from contextlib import redirect_stdout
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from silverloom.operators import calendar, fx, quality, reporting, rollup
from silverloom.sources.tables import LEAST_TASKS, dealt
from tests.conftest import SF, rows

D = dt.date.fromisoformat
N = Decimal


@pytest.fixture
def series(frame):
    q = lambda c, d, v: ("USD", c, D(d), v)
    return frame("to_curr string, frm_curr string, date date, value double",
                 q("EUR", "2024-01-02", 0.8), q("EUR", "2024-01-05", 0.5), q("JPY", "2024-01-03", 150.0), q("JPY", "2024-01-05", 100.0))


def test_cube_has_no_leading_rows_fills_gaps_and_inverts(series):
    cube = fx.fx_cube(series, "2024-01-06").cache()
    got = {(r["frm_curr"], r["to_curr"], r["date"]): r for r in cube.collect()}
    assert ("EUR", "USD", D("2024-01-01")) not in got
    assert got["EUR", "USD", D("2024-01-04")]["fx_rate_div"] == 0.8
    assert got["USD", "EUR", D("2024-01-05")]["fx_rate_mul"] == 0.5
    # the pair has its first common day on the 5th
    assert ("EUR", "JPY", D("2024-01-04")) not in got
    assert got["EUR", "JPY", D("2024-01-05")]["fx_rate_mul"] == pytest.approx(200.0)
    assert max(d for *_, d in got) == D("2024-01-05")
    for r in got.values():
        assert r["fx_rate_mul"] * r["fx_rate_div"] == pytest.approx(1.0)


def test_cube_stops_at_as_of_and_keeps_active_currencies(series, frame):
    got = fx.fx_cube(series, "2024-01-03", active=frame("currency string", ("EUR",)))
    assert rows(got.select("frm_curr", "to_curr", "date")) == [
        ("EUR", "USD", D("2024-01-02")), ("EUR", "USD", D("2024-01-03")), ("USD", "EUR", D("2024-01-02")), ("USD", "EUR", D("2024-01-03"))]


def test_rate_lookup_clamps_and_handles_missing(series, frame):
    cube = fx.fx_cube(series, "2024-01-31")
    facts = frame("id int, c string, d date", (1, "EUR", D("2020-01-01")), (2, "EUR", D("2030-01-01")), (3, "USD", D("2024-01-03")), (4, "XXX", D("2024-01-03")), (5, "EUR", None))
    one = fx.with_rate(facts, cube, "c", F.lit("USD"), "d", "r")
    assert rows(one.select("id", "r")) == [(1, 1.25), (2, 2.0), (3, 1.0), (4, 1.0), (5, 1.0)]
    null = fx.with_rate(facts.filter("id = 4"), cube, "c", F.lit("USD"), "d", "r", on_missing="null")
    assert rows(null.select("r")) == [(None,)]
    dflt = fx.with_rate(facts.filter("id = 4"), cube, "c", F.lit("USD"), "d", "r", on_missing="default", default=F.lit(3.0))
    assert rows(dflt.select("r")) == [(3.0,)]




def test_period_ids_at_a_year_boundary(frame):
    got = calendar.with_periods(frame("d date", (D("2025-01-01"),)), "d")
    assert rows(got.select("date_group_id", "dte_end", "date_group_year")) == [
        ("M2025-01-01", D("2025-01-31"), 2025), ("Q2025-01-01", D("2025-03-31"), 2025), ("W2024-12-30", D("2025-01-05"), 2024), ("Y2025-01-01", D("2025-12-31"), 2025)]


def test_rollup_sums_agree_over_grains(spark):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    got = rollup.rollup_periods(lines, "l_shipdate", ["l_suppkey"], {"q": F.col("l_quantity").cast("decimal(18,2)")})
    sums = {r[0]: r[1] for r in got.groupBy("date_group_type_id").agg(F.sum("q")).collect()}
    assert len(set(sums.values())) == 1 and set(sums) == {"W", "M", "Q", "Y"}


def test_overlapping_categories_and_zero_rows(frame):
    df = frame("p int, c string, q int", (1, "a", 5), (1, "b", 2), (2, "b", 1))
    got = rollup.slice_categories(df, ["p"], {"all": F.lit(True), "a": F.col("c") == "a", "b": F.col("c") == "b"}, {"q": F.col("q")}, fill=["a"])
    assert rows(got) == [(1, "a", 5), (1, "all", 7), (1, "b", 2), (2, "a", 0), (2, "all", 1), (2, "b", 1)]


def test_zero_fill_grid_is_complete(frame):
    df = frame("p int, c string, q decimal(9,2)", (1, "a", N("5")), (2, "zzz", N("1")), (3, None, None))
    got = rollup.zero_fill(df, ["p"], "c", ["a", "b"], ["q"])
    assert rows(got.select("p", "c", "q")) == [(p, c, N("5.00") if (p, c) == (1, "a") else N("0.00")) for p in (1, 2, 3) for c in ("a", "b")]


@pytest.mark.parametrize("chunked", [False, True])
def test_ordered_concat(frame, chunked):
    df = frame("k int, d date, v string", (1, D("2024-02-01"), "c"), (1, D("2024-01-02"), "b"), (1, D("2024-01-01"), "a"), (1, D("2024-01-02"), "b"), (1, D("2024-01-03"), None))
    chunk = F.trunc("d", "month") if chunked else None
    assert rows(rollup.ordered_concat(df, ["k"], "v", F.col("d"), "-", chunk=chunk)) == [(1, "a-b-b-c")]
    assert rows(rollup.ordered_concat(df, ["k"], "v", F.col("d"), "-", distinct=True, chunk=chunk)) == [(1, "a-b-c")]


def test_attainment_status_and_zero_target(frame):
    df = frame("p int, w date, h decimal(9,2), t decimal(9,2)", (1, D("2024-01-01"), N("40"), N("30")), (1, D("2024-01-08"), N("20"), N("30")), (1, D("2023-06-05"), N("0"), N("30")),
               (2, D("2024-01-01"), N("3"), N("0")), (3, D("2023-06-05"), N("1"), N("1")))
    got = {r["p"]: r for r in rollup.attainment(df, ["p"], "w", "h", "t", "2024-01-31").collect()}
    assert (got[1]["ytd_actual"], got[1]["ytd_target"], got[1]["ytd_status"]) == (60.0, 60.0, "On Track")
    assert got[1]["l12m_status"] == "Off Track"
    assert got[2]["ytd_percentage"] == 300.0
    assert (got[1]["ytd_average_per_week"], got[1]["l12m_average_per_week"], got[1]["billable_hours_per_year"]) == (30.0, 20.0, 1560.0)
    assert abs(got[1]["progress"] - 100 * 60 / 1560) < 1e-9 and got[2]["progress"] == 0.0
    assert 3 not in got


def test_plan_vs_actual_counts_both_ends_and_overlaps(frame):
    plan = frame("id int, k int, s date, e date", (1, 1, D("2024-01-01"), D("2024-01-10")), (2, 1, D("2024-01-10"), D("2024-01-20")), (3, 2, D("2024-01-01"), D("2024-01-10")))
    actual = frame("k int, d date, q int", (1, D("2024-01-01"), 1), (1, D("2024-01-10"), 2), (1, D("2024-01-10"), 3), (1, D("2024-01-21"), 9))
    got = rollup.plan_vs_actual(plan, actual, ["k"], "s", "e", "d", {"q": F.col("q")})
    assert rows(got.select("id", "q")) == [(1, 6), (2, 5), (3, None)]


def test_utilisation_categories(frame):
    entries = frame("person_id int, entity_person int, entity_project int, task_name string, bln_billable boolean, dte_entry date, qty decimal(18,2), amt_bill decimal(18,2), amt_cost decimal(18,2)",
                    (1, 1, 2, "DEV", True, D("2024-01-02"), N(8), N(800), N(400)), (1, 1, 2, "DEV", False, D("2024-01-02"), N(1), N(0), N(50)),
                    (1, 1, 2, "VAC", False, D("2024-01-03"), N(4), N(0), N(200)), (1, 1, 2, "TVL", True, D("2024-01-03"), N(2), N(100), N(90)))
    flags = frame("task_name string, pto boolean, internal_travel boolean, travel boolean, disfun boolean, nowork boolean, internal boolean, excluded boolean",
                  ("VAC", True, False, False, False, False, True, True), ("TVL", False, False, True, False, False, False, True))
    plan = frame("person_id int, year int, plan_hours_week decimal(18,2), plan_hours_year decimal(18,2), bill_rate decimal(18,2)", (1, 2024, N(20), N(1040), N(10)))
    out = reporting.utilisation(entries, flags, plan).filter("date_group_type_id = 'M' AND entity_grouping = 'Employee'")
    got = {r["type"]: r for r in out.collect()}
    assert {k: r["hours"] for k, r in got.items()} == {"Total": N(15), "Billable": N(8), "PTO": N(4), "Internal": N(1), "TVL": N(2), "DISFUN": N(0), "No Work": N(0)}
    assert got["Billable"]["pto_hours"] == N(4)
    assert got["Total"]["avg_bill_rate"] == pytest.approx(900 / 8)
    assert got["Total"]["planned_hours_billable"] == N("86.67") and got["PTO"]["planned_hours_billable"] == N(0)
    assert got["Billable"]["planned_bill_amount"] == N("866.67")
    assert got["No Work"]["type_sort"] == 7


def test_pay_history_drops_bad_salaries_and_never_ends_before_it_starts(frame):
    jobs = frame("person_id int, dte_effective date, change_id int, salary decimal(18,2), shift_code string, percent_change int, bln_rate_change boolean, reason_code string",
                 (1, D("2024-01-01"), 1, N(50000), "a", 1, False, "1"), (1, D("2024-01-01"), 2, N(60000), "a", 1, False, "1"), (1, D("2024-02-01"), 3, N(9), "a", 1, False, "1"),
                 (1, D("2024-03-01"), 4, N(70000), "a", 1, False, "1"))
    pay = frame("person_id int, dte_effective date, salary decimal(18,2)", (1, D("2023-01-01"), N(10)), (2, D("2023-01-01"), N(45000)))
    got = reporting.pay_history(jobs, pay, ["100"])
    assert rows(got.select("person_id", "src", "salary", "date_from", "date_to")) == [
        (1, "Job History", N("60000.00"), D("1900-01-01"), D("2024-02-29")), (1, "Job History", N("70000.00"), D("2024-03-01"), D("9999-12-31")),
        (2, "Compensation", N("45000.00"), D("1900-01-01"), D("9999-12-31"))]


def test_activity_keeps_equal_rows_apart(frame, series):
    row = ("time", 1, 7, 3, D("2024-01-05"), "EUR", "", N("10"), N("11"), N("2"))
    facts = frame("fact string, record_id int, project_id int, person_id int, dte date, currency string, base_currency string, amt_trx decimal(18,2), amt_base decimal(18,2), qty decimal(18,2)", row, row)
    projects = frame("project_id int, project_name string, project_currency string", (7, "p", "jpy"))
    got = reporting.activity(facts, projects, fx.fx_cube(series, "2024-01-31")).first()
    assert (got["curr_ind"], got["qty"], got["cost"], got["cost_project"]) == (3, N("4.00"), N("40.00"), N("8000.00"))
    assert got["cost_project_usd"] == N("80.00")


def test_quality_checks(frame):
    df = frame("a int, b string", (1, None), (1, "x"), (None, "y"))
    assert rows(quality.not_null(df, ["a", "b"])) == [("a", 1, False), ("b", 1, False)]
    assert rows(quality.unique(df, ["a"])) == [(1, 2)]
    assert rows(quality.counts_match(df, df.filter("a = 1"))) == [(3, 2, False)]
    assert rows(quality.counts_match(df, df.limit(0), ["b"])) == [("x", 1, 0, False), ("y", 1, 0, False), (None, 1, 0, False)]
    with pytest.raises(quality.ContractError, match="missing column c"):
        quality.check_schema(df, StructType([*df.schema, StructField("c", StringType())]))


def test_many_targets_meet_the_cube_once(series, frame):
    book = fx.lookup_cube(fx.fx_cube(series, "2024-01-31"))
    facts = frame("id int, c string, o string, d date", (1, "EUR", "USD", D("2024-01-03")), (2, "USD", "EUR", D("2024-01-03")), (3, None, "EUR", D("2024-01-03")), (4, "EUR", "EUR", None))
    out = fx.with_rates(facts, book, {"a": ("c", "o"), "b": ("o", "c"), "usd": ("c", F.lit("USD"))}, "d", on_missing="null")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and "subquery" not in plan
    got = {r["id"]: r for r in out.collect()}
    assert got[1]["a"] == got[1]["usd"] == got[2]["b"] and got[1]["b"] == got[2]["a"] and got[2]["usd"] == 1.0
    assert got[3]["a"] is None and (got[4]["a"], got[4]["usd"]) == (1.0, None)
    none = fx.lookup_cube(fx.fx_cube(series, "2000-01-01"))
    assert none.first is None and fx.with_rate(facts, none, "c", "o", "d", "r").filter("r <> 1").count() == 0


def test_price_discounts_against_two_lists(frame):
    df = frame("h int, p decimal(18,2), u decimal(18,2), p_a decimal(18,2), p_b decimal(18,2)", (1, N("10"), N("4"), N("12"), None), (1, N("10"), N("4"), N("12"), N("15")),
               (2, N("0"), N("4"), N("5"), N("5")), (3, N("7"), None, N("9"), N("7")), (None, N("1"), N("1"), N("1"), N("1")))
    got = {r["h"]: r.asDict() for r in rollup.price_discounts(df, "h", "p", "u", ["a", "b"]).collect()}
    assert (got[1]["amt_total_price"], got[1]["amt_total_price_a"], got[1]["amt_discount_a"], got[1]["perc_discount_a"]) == (N("20"), N("24"), N("4"), -0.5)
    assert (got[1]["amt_total_price_b"], got[1]["amt_discount_b"], got[1]["perc_discount_b"]) == (N("15"), N("-5"), 0.625)
    assert got[2]["perc_discount_a"] == 0.0 and got[3]["perc_discount_a"] == 0.0 and got[None]["amt_discount_a"] == 0


def test_utilisation_deals_by_the_size_of_its_input(spark, tmp_path, monkeypatch):
    kinds = ("person_id long, entity_person long, entity_project long, task_name string, bln_billable boolean, dte_entry date, "
             "qty decimal(18,2), amt_bill decimal(18,2), amt_cost decimal(18,2)")
    rows = [(p, p % 3, None, "DEV", True, dt.date(2001, 1 + p % 12, 2), N(1), N(2), N(3)) for p in range(200)]
    path = str(tmp_path / "entries with blanks")
    spark.createDataFrame(rows, kinds).coalesce(1).write.parquet(path)
    entries = spark.read.parquet(path)
    size = sum(f.stat().st_size for f in (tmp_path / "entries with blanks").glob("*.parquet"))
    assert dealt(entries, ["person_id"], entries, size // 40).rdd.getNumPartitions() in (40, 41)
    assert dealt(entries, ["person_id"], entries, 10 * size).rdd.getNumPartitions() == LEAST_TASKS

    flags = spark.createDataFrame([("DEV", *[False] * 7)], "task_name string, pto boolean, internal_travel boolean, travel boolean, "
                                  "disfun boolean, nowork boolean, internal boolean, excluded boolean")
    plan = spark.createDataFrame([(1, 2001, N(52), N(1), N(1))], "person_id long, year int, plan_hours_year decimal(18,2), "
                                 "plan_hours_week decimal(18,2), bill_rate decimal(18,2)")
    monkeypatch.setattr(reporting, "ENTRY_BYTES", size // 40)
    shown = io.StringIO()
    out = reporting.utilisation(entries, flags, plan)
    with redirect_stdout(shown):
        out.explain()
    assert "REPARTITION_BY_NUM" in shown.getvalue()
    assert out.filter("type = 'Billable' AND date_group_type_id = 'Y' AND entity_grouping = 'Employee'").agg({"hours": "sum"}).first()[0] == 200
