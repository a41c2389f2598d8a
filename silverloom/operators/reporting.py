"""Business reports composed of the smaller operators. Inputs are frames with named columns, outputs are frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverloom.functions import dates
from silverloom.functions.keys import col
from silverloom.functions.money import MONEY, convert, money, pick_amount, safe_ratio, scale_plan
from silverloom.functions.text import norm_currency
from silverloom.operators.calendar import GRAINS, describe_periods, week_and_month
from silverloom.operators.filters import changed, classify, drop_matching
from silverloom.operators.fx import RateBook, with_rate, with_rates
from silverloom.operators.rollup import category_rows, category_sums, cents, from_cents, period_lattice
from silverloom.operators.stack import stack
from silverloom.operators.timeline import as_of_join
from silverloom.operators.windows import change_ranges, latest_per_key, prefer_source
from silverloom.sources.tables import dealt

# Report order of the categories; project rows come 100 later.
CATEGORY_SORT = {"Total": 1, "Billable": 2, "PTO": 3, "Internal": 4, "TVL": 5, "DISFUN": 6, "No Work": 7}
# Bytes of the entries' files for each task of the utilisation's lattice.
ENTRY_BYTES = 2 * 1024 * 1024
# Salaries outside these bounds (US dollars) are treated as data errors.
SALARY_BOUNDS = (2100, 2000000)


def time_categories(billable: str = "bln_billable") -> dict[str, Column]:
    """Overlapping time categories over the class flags pto, internal_travel, travel, disfun, nowork, internal, excluded."""
    bill, f = F.col(billable), F.col
    return {
        "Total": F.lit(True),
        "Billable": ~f("excluded") & bill,
        "PTO": f("pto") & ~bill,
        "Internal": f("internal_travel") | (f("travel") & ~bill) | (~f("internal") & ~bill),
        "TVL": f("travel") & bill,
        "DISFUN": f("disfun"),
        "No Work": f("nowork") & ~bill,
    }


def utilisation(entries: DataFrame, code_flags: DataFrame, plan: DataFrame, week_hours: Column | None = None) -> DataFrame:
    """Hours, amounts and rates per person, entity, period and time category, with plan and work hours.

    ``entries``: person_id, entity_person, entity_project, task_name, bln_billable, dte_entry, qty, amt_bill, amt_cost.
    ``code_flags``: one row per task_name with the flags of ``time_categories``. ``plan``: person_id, year,
    plan_hours_week, plan_hours_year, bill_rate.

    First come category sums per person, entities, week and month, on the entries themselves. Those few rows meet by
    person once; there weeks and months are summed for both entity groupings, and quarters and years from the months. The
    entries are read and classified once, and zero rows come from the wide sums, not from a grid. Months and quarters scale the week by
    52/12 and 52/4, for planned amounts too.
    """
    cats = time_categories()
    fill = [c for c in cats if c != "Total"]
    billed = ~F.col("excluded") & F.col("bln_billable")
    hours = cents(F.coalesce(F.col("qty"), F.lit(0).cast(MONEY)))
    measures = {
        "hours": hours, "hours_billable": F.when(billed, hours).otherwise(F.lit(0).cast("long")),
        "amt_bill": cents(F.col("amt_bill")), "amt_cost": cents(F.col("amt_cost")),
    }
    rows = classify(entries, "task_name", code_flags)
    first = rows.groupBy("person_id", "entity_person", "entity_project", *week_and_month("dte_entry")).agg(
        *category_sums(cats, measures, fill))
    # a row becomes up to twelve in the hash tables of the lattice: the task's share follows the input, not the shuffled size
    first = dealt(first, ["person_id"], entries, ENTRY_BYTES)
    sums = [c for c in first.columns if c.startswith("__") and c not in ("__week", "__month")]
    groupings = F.array(
        F.struct(F.lit("Employee").alias("entity_grouping"), F.col("entity_person").alias("entity_id")),
        F.struct(F.lit("Project").alias("entity_grouping"), F.col("entity_project").alias("entity_id")),
    )
    wide = first.select("person_id", "__week", "__month", F.explode(groupings).alias("__g"), *sums)
    wide = wide.select("person_id", "__week", "__month", "__g.*", *sums)
    wide = period_lattice(wide, ["person_id", "entity_grouping", "entity_id"], sums, clustered=True)
    pto = F.col(f"__hours{list(cats).index('PTO')}")
    wide = describe_periods(wide).withColumn("pto", F.coalesce(pto, F.lit(0).cast("long")))
    # a person's plans of all years are one row, so the sums stay where they are when they meet their plan
    zero = F.lit(0).cast(MONEY)
    year = F.max(F.struct("plan_hours_year", "plan_hours_week", (F.col("bill_rate") * F.col("plan_hours_week")).cast(MONEY).alias("amount_week")))
    per = plan.filter("person_id IS NOT NULL AND year IS NOT NULL").groupBy("person_id", "year").agg(year.alias("__plan"))
    per = per.groupBy("person_id").agg(F.map_from_entries(F.collect_list(F.struct("year", "__plan"))).alias("__plans"))
    wide = wide.join(per, "person_id", "left").withColumn("__plan", F.try_element_at("__plans", F.col("date_group_year")))
    wide = wide.withColumns({
        "plan_hours": F.coalesce(scale_plan("__plan.plan_hours_week", "date_group_type_id", "__plan.plan_hours_year"), zero),
        "plan_amount": F.coalesce(scale_plan("__plan.amount_week", "date_group_type_id"), zero)}).drop("__plans", "__plan")
    keys = ["person_id", "entity_grouping", "entity_id", "date_group_type_id", "date_group_id", "date_group_year"]
    out = category_rows(wide, [*keys, "pto", "plan_hours", "plan_amount"], list(cats), list(measures), name="type", fill=fill)
    out = out.withColumns({c: from_cents(c) for c in [*measures, "pto"]})

    kind = F.col("type")
    sort = F.when(F.lit(False), F.lit(0))
    for label, n in CATEGORY_SORT.items():
        sort = sort.when(kind == label, F.lit(n))
    planned = kind.isin("Total", "Billable")
    hours_base = F.when(kind == "Total", F.col("hours_billable")).otherwise(F.col("hours"))
    return out.select(
        *keys, "type",
        (sort + F.when(F.col("entity_grouping") == "Project", 100).otherwise(0)).alias("type_sort"),
        "hours", "hours_billable", "amt_bill", "amt_cost",
        safe_ratio("amt_bill", hours_base).alias("avg_bill_rate"), safe_ratio("amt_cost", "hours").alias("avg_cost_rate"),
        F.when(kind == "Billable", F.col("pto")).otherwise(zero).alias("pto_hours"),
        scale_plan(week_hours if week_hours is not None else F.lit(dates.DEFAULT_WEEK_HOURS), "date_group_type_id").alias("work_hours"),
        F.when(planned, F.col("plan_hours")).otherwise(zero).alias("planned_hours_billable"),
        F.when(planned, F.col("plan_amount")).otherwise(zero).alias("planned_bill_amount"),
    )


def yearly_plan(plan: DataFrame, hours: str, start: str, year: str) -> DataFrame:
    """Plan rows with work days of the year, prorated hours per year and hours per week."""
    out = plan.withColumn("work_days", dates.work_days_in_year(start, year))
    out = out.withColumn("plan_hours_year", dates.prorate(hours, "work_days"))
    return out.withColumn("plan_hours_week", dates.per_week("plan_hours_year", "work_days"))


def activity(facts: DataFrame, projects: DataFrame, cube: DataFrame | RateBook) -> DataFrame:
    """Billable cost rows of all fact kinds in the record's, the project's and US currency, summed per record.

    ``facts``: fact, record_id, project_id, person_id, dte, currency, base_currency, amt_trx, amt_base, qty.
    ``projects``: project_id, project_name, project_currency. The amount already held in the project's currency is
    taken as it is; only otherwise the transaction amount is converted. Every step is rounded to cents. Rows stay
    separate: equal rows are not merged by a distinct union.
    """
    p = projects.withColumnRenamed("project_id", "__pid")
    rows = facts.join(p, F.col("project_id") == F.col("__pid"), "inner").drop("__pid")
    rows = rows.withColumns({
        "currency_project": norm_currency("project_currency"), "currency_base": norm_currency("base_currency"),
        "currency_trx": norm_currency("currency"),
    })
    rows = with_rates(rows, cube, {"__to_project": ("currency_trx", "currency_project"), "__to_usd": ("currency_project", F.lit("USD"))}, "dte")
    in_base = F.col("currency_base") == F.col("currency_project")
    in_trx = F.col("currency_trx") == F.col("currency_project")
    step = F.when(in_base, 1).when(in_trx, 2).otherwise(3)
    rows = rows.withColumns({
        "curr_ind": step,
        "rate": money(pick_amount([(in_base, F.col("amt_base"))], F.col("amt_trx"))),
        "rate_project": money(pick_amount([(in_base, F.col("amt_base")), (in_trx, F.col("amt_trx"))],
                                          convert("amt_trx", "__to_project"))),
    })
    rows = rows.withColumn("rate_project_usd", convert("rate_project", "__to_usd"))
    zero = F.lit(0).cast(MONEY)
    keys = ["fact", "record_id", "project_id", "project_name", "person_id", "dte", "currency_trx", "currency_project", "curr_ind"]
    amounts = {
        "qty": F.col("qty"), "cost": money(F.col("rate") * F.col("qty")),
        "cost_project": money(F.col("rate_project") * F.col("qty")),
        "cost_project_usd": money(F.col("rate_project_usd") * F.col("qty")),
    }
    return rows.groupBy(*keys).agg(*[F.sum(F.coalesce(e, zero)).alias(n) for n, e in amounts.items()])


def pay_history(jobs: DataFrame, pay: DataFrame, reasons: Sequence[str], unit: Sequence[str] = ("person_id",),
                carry: Sequence[str] = ()) -> DataFrame:
    """Pay history of every person as validity ranges, from job changes and pay snapshots.

    ``jobs``: person_id, dte_effective, change_id, salary, shift_code, percent_change, bln_rate_change, reason_code.
    ``pay``: person_id, dte_effective, salary. Only rows that change pay or shift, or carry one of the reasons, count;
    one per person and day. Snapshots stand in for those without any such row, by the columns of ``unit``. ``carry`` are
    further columns of both that go with the salary. Implausible salaries are dropped, and
    duplicates of a day are removed before the ranges are built, so no range ends before it starts.
    """
    rows = changed(jobs, "person_id", "dte_effective", "shift_code", "percent_change", list(reasons), "reason_code",
                   "bln_rate_change", ties=["change_id"])
    rows = latest_per_key(rows, ["person_id", "dte_effective"], [F.desc("change_id")])
    columns = list(dict.fromkeys(["person_id", *unit, "dte_effective", "salary", *carry]))
    rows = rows.select(F.lit("Job History").alias("src"), *columns)
    rest = pay.select(F.lit("Compensation").alias("src"), *columns)
    both = stack(rows, drop_matching(rest, rows.select(*unit), list(unit)))
    both = both.filter(F.col("salary").between(*SALARY_BOUNDS))
    one = prefer_source(both, ["person_id", "dte_effective"], "src", ["Job History", "Compensation"], [F.desc("salary")])
    return change_ranges(one, ["person_id"], "dte_effective",
                         values=[F.max("src").alias("src"), F.max("salary").alias("salary"), *[F.max(c).alias(c) for c in carry],
                                 F.max("dte_effective").alias("dte_effective")])


def payroll(sheets: DataFrame, entries: DataFrame, on: str, code_flags: DataFrame, classes: dict[str, str],
            code: str = "task_name") -> DataFrame:
    """Entries with their sheet and a time-type indicator: the first class whose flag is set, else '0'."""
    rows = classify(sheets.join(entries, on, "inner"), code, code_flags)
    kind = F.when(F.lit(False), F.lit(""))
    for name, indicator in classes.items():
        kind = kind.when(F.col(name), F.lit(indicator))
    return rows.withColumn("time_type_ind", kind.otherwise(F.lit("0"))).drop(*classes)


def labor_budget(people: DataFrame, plan: DataFrame, weekly: DataFrame, cube: DataFrame | RateBook, as_of: str) -> DataFrame:
    """Salary, planned and actual billing per person in original, US and entity currency.

    ``people``: person_id, salary, bonus_percent, cola_percent, currency, entity_currency. ``plan``: person_id,
    plan_hours_week, bill_rate for the year. ``weekly``: person_id, week_start, type, hours, amt. A currency
    without rate takes ``default_fx_rate_to_usd`` of ``people``, if that column is there. Rates are those of the
    last day of the previous month, moved into the days the cube covers.
    """
    today = F.lit(as_of).cast("date")
    month_end = F.date_sub(F.trunc(today, "month"), 1)
    this_year = F.year("week_start") == F.year(today)
    last_year = F.year("week_start") == F.year(today) - 1
    done = this_year & (F.col("week_start") <= F.date_sub(F.date_sub(today, F.weekday(today)), 7))
    out = []
    for kind, label in (("Billable", "bill"), ("Total", "total")):
        for when, suffix in ((done, ""), (last_year, "_previous")):
            hit = when & (F.col("type") == kind)
            hours = F.sum(F.when(hit, F.col("hours")))
            n = F.count(F.when(hit, 1))
            out.append(F.coalesce(hours, F.lit(0)).cast(MONEY).alias(f"{label}_hours{suffix}"))
            out.append(safe_ratio(hours, n).alias(f"{label}_hours_week{suffix}"))
            if kind == "Billable":
                out.append(F.coalesce(F.sum(F.when(hit, F.col("amt"))), F.lit(0)).cast(MONEY).alias(f"bill_amount{suffix}"))
    stats = weekly.groupBy("person_id").agg(*out)
    rows = people.join(plan, "person_id", "left").join(stats, "person_id", "left")
    zeros = [c for c in stats.columns if c != "person_id"]
    rows = rows.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in [*zeros, "plan_hours_week", "bill_rate", "salary"]})
    rows = rows.withColumns({"currency": norm_currency("currency"), "entity_currency": norm_currency("entity_currency"), "__d": month_end})
    rows = rows.withColumn("fx_rate_original", F.lit(1.0))
    missing, default = ("default", "default_fx_rate_to_usd") if "default_fx_rate_to_usd" in people.columns else ("one", None)
    rows = with_rate(rows, cube, "currency", F.lit("USD"), "__d", "fx_rate_usd", missing, default)
    rows = with_rate(rows, cube, "currency", "entity_currency", "__d", "fx_rate_entity")
    for suffix in ("original", "usd", "entity"):
        rate = f"fx_rate_{suffix}"
        rows = rows.withColumn(f"annual_salary_{suffix}", convert("salary", rate))
        salary = F.col(f"annual_salary_{suffix}")
        rows = rows.withColumns({
            f"performance_bonus_{suffix}": money(salary * F.col("bonus_percent")),
            f"annual_cola_{suffix}": money(salary * F.col("cola_percent")),
            f"plan_bill_amount_week_{suffix}": convert((F.col("bill_rate") * F.col("plan_hours_week")).cast(MONEY), rate),
        })
    return rows.drop("__d", "fx_rate_original")


def price_history(facts: DataFrame, changes: DataFrame, keys: Sequence[str], date: str, change_date: str,
                  values: dict[str, Column]) -> DataFrame:
    """Facts with the value that was valid on their date, and the days on which it was."""
    return as_of_join(facts, changes, keys, date, change_date, values, bounds=True)


def missing_sheets(due: DataFrame, sheets: DataFrame, on: Sequence[str]) -> DataFrame:
    """Expected periods without a sheet."""
    return drop_matching(due, sheets.select(*on), list(on))


def cost_of(amount: str, qty: str | Column) -> Column:
    return money(col(amount) * col(qty))
