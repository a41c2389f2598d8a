"""Aggregating queries and data-quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from silverloom.functions import dates, money
from silverloom.operators import calendar, quality, rollup, stack
from silverloom.plans.rows import CUSTOMER_SPEC, SUPPLIER_SPEC
from silverloom.registry import Tables, query
from silverloom.sources.derived import CALENDAR, ORDERS_AS_OF


@query("activity_sum", """
    SELECT person_id, task_name, bln_billable, CAST(sum(qty) AS DOUBLE) AS qty,
           CAST(sum(CAST(bill_rate * qty AS DECIMAL(18,2))) AS DOUBLE) AS amt FROM entry_fact GROUP BY ALL""")
def activity_sum(t: Tables):
    return rollup.aggregate(t("entry_fact"), ["person_id", "task_name", "bln_billable"], {
        "qty": F.sum("qty"), "amt": F.sum(money.money(F.col("bill_rate") * F.col("qty")))})


@query("conditional_sum", """
    SELECT person_id, CAST(sum(qty) AS DOUBLE) AS hours,
           CAST(sum(CASE WHEN bln_billable AND task_name <> 'TVL' THEN qty ELSE 0 END) AS DOUBLE) AS hours_billable
    FROM entry_fact GROUP BY person_id""")
def conditional_sum(t: Tables):
    hit = F.col("bln_billable") & (F.col("task_name") != "TVL")
    return rollup.aggregate(t("entry_fact"), ["person_id"], {
        "hours": F.sum("qty"), "hours_billable": F.sum(F.when(hit, F.col("qty")).otherwise(0))})


@query("weighted_rate", """
    SELECT person_id, task_name, CASE WHEN sum(qty) = 0 THEN 0 ELSE CAST(sum(bill_rate * qty) AS DOUBLE) / CAST(sum(qty) AS DOUBLE) END AS avg_rate
    FROM entry_fact GROUP BY 1, 2""")
def weighted_rate(t: Tables):
    return rollup.aggregate(t("entry_fact"), ["person_id", "task_name"], {"avg_rate": money.weighted_rate("bill_rate", "qty")})


@query("year_slice_stats", """
    SELECT person_id, CAST(coalesce(sum(qty) FILTER (WHERE year(dte_entry) = 2001), 0) AS DOUBLE) AS hours,
           CAST(coalesce(sum(qty) FILTER (WHERE year(dte_entry) = 2000), 0) AS DOUBLE) AS hours_previous,
           coalesce(CAST(sum(qty) FILTER (WHERE year(dte_entry) = 2001) AS DOUBLE)
             / NULLIF(count(*) FILTER (WHERE year(dte_entry) = 2001), 0), 0) AS avg_hours,
           coalesce(CAST(sum(qty) FILTER (WHERE year(dte_entry) = 2000) AS DOUBLE)
             / NULLIF(count(*) FILTER (WHERE year(dte_entry) = 2000), 0), 0) AS avg_hours_previous
    FROM entry_fact WHERE year(dte_entry) IN (2000, 2001) GROUP BY person_id""")
def year_slice_stats(t: Tables):
    now, before = dates.same_year("dte_entry", ORDERS_AS_OF), dates.same_year("dte_entry", ORDERS_AS_OF, 1)
    total = lambda c: F.sum(F.when(c, F.col("qty")))
    return rollup.aggregate(t("entry_fact").filter(now | before), ["person_id"], {
        "hours": F.coalesce(total(now), F.lit(0)), "hours_previous": F.coalesce(total(before), F.lit(0)),
        "avg_hours": money.safe_ratio(total(now), F.count(F.when(now, 1))),
        "avg_hours_previous": money.safe_ratio(total(before), F.count(F.when(before, 1)))})


@query("target_attainment", """
    WITH y AS (SELECT person_id, CAST(max(round(weekly_plan, 1)) AS DOUBLE) AS billable_hours_per_week, count(*) AS ytd_weeks,
                      CAST(round(52 * max(weekly_plan), 1) AS DOUBLE) AS billable_hours_per_year, round(CAST(sum(hours) AS DOUBLE) / count(*), 1) AS ytd_average_per_week,
                      CAST(round(sum(hours), 1) AS DOUBLE) AS ytd_actual FROM weekly_hours WHERE year(week_start) = 2001 GROUP BY 1),
         l AS (SELECT person_id, count(*) AS l12m_weeks, CAST(round(sum(hours), 1) AS DOUBLE) AS l12m_actual,
                      round(CAST(sum(hours) AS DOUBLE) / count(*), 1) AS l12m_average_per_week, CAST(round(sum(weekly_plan), 1) AS DOUBLE) AS l12m_target
               FROM weekly_hours WHERE week_start >= DATE '2000-08-01' GROUP BY 1),
         a AS (SELECT y.*, round(billable_hours_per_week * ytd_weeks, 1) AS ytd_target, coalesce(l12m_weeks, 0) AS l12m_weeks,
                      l12m_average_per_week, l12m_actual, l12m_target FROM y LEFT JOIN l ON y.person_id = l.person_id),
         b AS (SELECT *, round(ytd_actual / (CASE ytd_target WHEN 0 THEN 1 ELSE ytd_target END) * 100, 1) AS ytd_percentage,
                      round(l12m_actual / (CASE l12m_target WHEN 0 THEN 1 ELSE l12m_target END) * 100, 1) AS l12m_percentage FROM a)
    SELECT *, CASE WHEN ytd_percentage >= 100 THEN 'On Track' ELSE 'Off Track' END AS ytd_status,
           CASE WHEN l12m_percentage >= 100 THEN 'On Track' ELSE 'Off Track' END AS l12m_status,
           CASE WHEN coalesce(billable_hours_per_year, 0) = 0 THEN 0 ELSE ytd_actual / billable_hours_per_year * 100 END AS progress FROM b""")
def target_attainment(t: Tables):
    return rollup.attainment(t("weekly_hours"), ["person_id"], "week_start", "hours", "weekly_plan", ORDERS_AS_OF)


@query("ordered_listagg", """
    SELECT l_orderkey, string_agg(CAST(l_linenumber AS STRING) || l_returnflag, ', ' ORDER BY l_shipdate, CAST(l_linenumber AS STRING) || l_returnflag) AS values_text
    FROM lineitem GROUP BY l_orderkey""")
def ordered_listagg(t: Tables):
    rows = t("lineitem").withColumn("note", F.concat(F.col("l_linenumber").cast("string"), "l_returnflag"))
    return rollup.ordered_concat(rows, ["l_orderkey"], "note", F.to_date("l_shipdate"), chunk=F.trunc("l_shipdate", "month"))


@query("multi_grain_rollup", """
    WITH p AS (SELECT *, 'W' AS g, CAST(date_trunc('week', dte_entry) AS DATE) AS d FROM entry_fact UNION ALL
               SELECT *, 'M', CAST(date_trunc('month', dte_entry) AS DATE) FROM entry_fact UNION ALL
               SELECT *, 'Q', CAST(date_trunc('quarter', dte_entry) AS DATE) FROM entry_fact UNION ALL
               SELECT *, 'Y', CAST(date_trunc('year', dte_entry) AS DATE) FROM entry_fact)
    SELECT person_id, g AS date_group_type_id, g || strftime(d, '%Y-%m-%d') AS date_group_id, CAST(year(d) AS INTEGER) AS date_group_year,
           CAST(sum(qty) AS DOUBLE) AS hours, count(*) AS n FROM p GROUP BY ALL""")
def multi_grain_rollup(t: Tables):
    return rollup.rollup_periods(t("entry_fact"), "dte_entry", ["person_id"], {"hours": F.col("qty"), "n": F.lit(1).cast("long")})


@query("category_slices", """
    SELECT person_id, 'Total' AS category, CAST(sum(qty) AS DOUBLE) AS hours FROM entry_fact GROUP BY 1 UNION ALL
    SELECT person_id, 'Billable', CAST(sum(qty) AS DOUBLE) FROM entry_fact WHERE bln_billable AND task_name IN ('DEV') GROUP BY 1 UNION ALL
    SELECT person_id, 'Leave', CAST(sum(qty) AS DOUBLE) FROM entry_fact WHERE NOT bln_billable AND task_name IN ('VAC', 'ILL') GROUP BY 1 UNION ALL
    SELECT person_id, 'Travel', CAST(sum(qty) AS DOUBLE) FROM entry_fact WHERE task_name IN ('TVL', 'Internal TVL') GROUP BY 1""")
def category_slices(t: Tables):
    task, bill = F.col("task_name"), F.col("bln_billable")
    return rollup.slice_categories(t("entry_fact"), ["person_id"], {
        "Total": F.lit(True), "Billable": bill & task.isin("DEV"), "Leave": ~bill & task.isin("VAC", "ILL"),
        "Travel": task.isin("TVL", "Internal TVL")}, {"hours": F.col("qty")})


@query("zero_fill", """
    WITH k AS (SELECT DISTINCT project_id, CAST(date_trunc('month', dte_entry) AS DATE) AS month FROM entry_fact),
         c(task_name) AS (VALUES ('DEV'), ('TVL'), ('VAC'), ('ILL')),
         s AS (SELECT project_id, CAST(date_trunc('month', dte_entry) AS DATE) AS month, task_name, sum(qty) AS qty FROM entry_fact GROUP BY 1, 2, 3)
    SELECT k.project_id, k.month, c.task_name, CAST(coalesce(s.qty, 0) AS DOUBLE) AS qty FROM k CROSS JOIN c
    LEFT JOIN s ON s.project_id = k.project_id AND s.month = k.month AND s.task_name = c.task_name""")
def zero_fill(t: Tables):
    rows = t("entry_fact").select("project_id", F.trunc("dte_entry", "month").alias("month"), "task_name", "qty")
    return rollup.zero_fill(rows, ["project_id", "month"], "task_name", ["DEV", "TVL", "VAC", "ILL"], ["qty"])


@query("plan_scaling", """
    SELECT person_id, year, g.grain, CAST(CAST(CASE g.grain WHEN 'W' THEN w WHEN 'M' THEN w * 52 / 12 WHEN 'Q' THEN w * 52 / 4 ELSE plan_hours END AS DECIMAL(18,2)) AS DOUBLE) AS planned
    FROM (SELECT person_id, year, plan_hours, CAST(plan_hours / 50 AS DECIMAL(18,2)) AS w FROM year_plan)
    CROSS JOIN (VALUES ('W'), ('M'), ('Q'), ('Y')) g(grain)""")
def plan_scaling(t: Tables):
    rows = t("year_plan").select("person_id", "year", "plan_hours", (F.col("plan_hours") / 50).cast("decimal(18,2)").alias("w"),
                                 F.explode(F.array(*[F.lit(g) for g in calendar.GRAINS])).alias("grain"))
    return rows.select("person_id", "year", "grain", money.scale_plan("w", "grain", "plan_hours").alias("planned"))


@query("discount_rollup", """
    WITH s AS (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS g,
                      sum(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(9,4))) AS DECIMAL(18,2))) AS n FROM lineitem GROUP BY 1)
    SELECT l_orderkey, CAST(g AS DOUBLE) AS amt_gross, CAST(n AS DOUBLE) AS amt_net, CAST(g - n AS DOUBLE) AS amt_discount,
           CASE WHEN g = 0 THEN 0 ELSE CAST(g - n AS DOUBLE) / CAST(g AS DOUBLE) END * 100 AS discount_percent FROM s""")
def discount_rollup(t: Tables):
    gross = money.money("l_extendedprice")
    net = money.money(gross * (1 - F.col("l_discount").cast("decimal(9,4)")))
    return rollup.discount_rollup(t("lineitem"), "l_orderkey", gross, net)


@query("pending_rollup", """
    SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS qty_pending,
           count(*) AS n_pending FROM orders WHERE o_orderstatus IN ('P', 'O') GROUP BY 1, 2""")
def pending_rollup(t: Tables):
    rows = t("orders").select("o_custkey", F.trunc("o_orderdate", "month").alias("month"), "o_orderstatus",
                              money.money("o_totalprice").alias("qty"))
    return rollup.pending(rows, F.col("o_orderstatus").isin("P", "O"), ["o_custkey", "month"], "qty")


@query("calendar_dim", """
    WITH d AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS dte FROM lineitem),
         c AS (SELECT CAST(x AS DATE) AS dte FROM generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-31', INTERVAL 1 DAY) g(x))
    SELECT c.dte, 'W' || strftime(date_trunc('week', c.dte), '%Y-%m-%d') AS date_group_id_week, 'M' || strftime(date_trunc('month', c.dte), '%Y-%m-%d') AS date_group_id_month,
           'Q' || strftime(date_trunc('quarter', c.dte), '%Y-%m-%d') AS date_group_id_quarter, 'Y' || strftime(date_trunc('year', c.dte), '%Y-%m-%d') AS date_group_id_year,
           count(d.dte) AS n_ship_days FROM c LEFT JOIN d ON c.dte = d.dte GROUP BY ALL""")
def calendar_dim(t: Tables):
    days = calendar.calendar_days(t.spark, *CALENDAR)
    shipped = t("lineitem").select(F.to_date("l_shipdate").alias("dte"), F.lit(1).alias("n")).distinct()
    return days.join(shipped, "dte", "left").select(*days.columns, F.coalesce(F.col("n").cast("long"), F.lit(0)).alias("n_ship_days"))


@query("workday_proration", """
    WITH a AS (SELECT *, make_date(year + 1, 1, 1) AS nxt, make_date(year, 12, 31) AS last FROM year_plan),
         b AS (SELECT *, CASE WHEN year(dte_start) = year THEN least(260, date_diff('day', dte_start, nxt)
                 - (date_diff('day', date_trunc('week', dte_start), date_trunc('week', nxt)) // 7) * 2
                 - CASE WHEN dayofweek(dte_start) = 0 THEN 1 ELSE 0 END + CASE WHEN dayofweek(last) = 6 THEN 1 ELSE 0 END) ELSE 260 END AS wd FROM a),
         c AS (SELECT *, CASE WHEN wd >= 260 THEN plan_hours ELSE CAST(plan_hours * wd / 260 AS DECIMAL(18,2)) END AS hy FROM b)
    SELECT person_id, year, CAST(wd AS INTEGER) AS work_days, CAST(hy AS DOUBLE) AS plan_hours_year,
           CAST(CASE WHEN wd = 0 THEN 0 ELSE CAST(hy * 5 / wd AS DECIMAL(18,2)) END AS DOUBLE) AS plan_hours_week FROM c""")
def workday_proration(t: Tables):
    from silverloom.operators.reporting import yearly_plan

    out = yearly_plan(t("year_plan"), "plan_hours", "dte_start", "year")
    return out.select("person_id", "year", F.col("work_days").cast("int").alias("work_days"), "plan_hours_year", "plan_hours_week")


@query("plan_vs_actual", """
    WITH p AS (SELECT person_id, year, plan_hours, dte_start, make_date(year, 12, 31) AS dte_end FROM year_plan)
    SELECT p.person_id, p.year, CAST(p.plan_hours AS DOUBLE) AS plan_hours, p.dte_start, p.dte_end, CAST(sum(e.qty) AS DOUBLE) AS actual_hours,
           CAST(sum(CAST(e.bill_rate * e.qty AS DECIMAL(18,2))) AS DOUBLE) AS actual_amt
    FROM p LEFT JOIN entry_fact e ON e.person_id = p.person_id AND e.dte_entry BETWEEN p.dte_start AND p.dte_end GROUP BY ALL""")
def plan_vs_actual(t: Tables):
    plan = t("year_plan").select("person_id", "year", "plan_hours", "dte_start", F.make_date("year", F.lit(12), F.lit(31)).alias("dte_end"))
    return rollup.plan_vs_actual(plan, t("entry_fact"), ["person_id"], "dte_start", "dte_end", "dte_entry", {
        "actual_hours": F.col("qty"), "actual_amt": money.money(F.col("bill_rate") * F.col("qty"))})


# ---------------------------------------------------------------- data quality

@query("dq_not_null", """
    SELECT 'key' AS column_name, count(*) FILTER (WHERE key IS NULL) AS n_nulls, count(*) FILTER (WHERE key IS NULL) = 0 AS ok FROM party_stack UNION ALL
    SELECT 'link', count(*) FILTER (WHERE link IS NULL), count(*) FILTER (WHERE link IS NULL) = 0 FROM party_stack UNION ALL
    SELECT 'segment', count(*) FILTER (WHERE segment IS NULL), count(*) FILTER (WHERE segment IS NULL) = 0 FROM party_stack""")
def dq_not_null(t: Tables):
    return quality.not_null(t("party_stack"), ["key", "link", "segment"])


@query("dq_unique", """
    SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def dq_unique(t: Tables):
    return quality.unique(t("lineitem"), ["l_orderkey", "l_linenumber"])


@query("dq_count_match", """
    SELECT *, n_model = n_expected AS ok FROM (
        SELECT 'sfc' AS src_sys_key, (SELECT count(*) FROM party_stack WHERE src_sys_key = 'sfc') AS n_model, (SELECT count(*) FROM customer) AS n_expected UNION ALL
        SELECT 'int', (SELECT count(*) FROM party_stack WHERE src_sys_key = 'int'), (SELECT count(*) FROM supplier))""")
def dq_count_match(t: Tables):
    model = stack.consolidate([("sfc", t("customer"), CUSTOMER_SPEC), ("int", t("supplier"), SUPPLIER_SPEC)], "party", ORDERS_AS_OF)
    sources = t("customer").select(F.lit("sfc").alias("src_sys_key")).unionByName(t("supplier").select(F.lit("int").alias("src_sys_key")))
    return quality.counts_match(model, sources, ["src_sys_key"])


@query("dq_filtered_count_match", """
    WITH m AS (SELECT count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'F' AND l_quantity <> 0),
         e AS (SELECT count(*) AS n FROM lineitem WHERE l_quantity <> 0 AND l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F'))
    SELECT m.n AS n_model, e.n AS n_expected, m.n = e.n AS ok FROM m, e""")
def dq_filtered_count_match(t: Tables):
    live = t("orders").filter("o_orderstatus <> 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    lines = t("lineitem").filter("l_quantity <> 0").select("l_orderkey")
    return quality.counts_match(lines.join(live, "l_orderkey"), lines.join(live, "l_orderkey", "left_semi"))


@query("dq_fanout_guard", """
    WITH m AS (SELECT count(*) AS n FROM party_stack s LEFT JOIN party_stack i ON s.link = i.link AND i.src_sys_key = 'int' WHERE s.src_sys_key = 'sfc'),
         e AS (SELECT count(*) AS n FROM party_stack WHERE src_sys_key = 'sfc')
    SELECT m.n AS n_model, e.n AS n_expected, m.n = e.n AS ok FROM m, e""")
def dq_fanout_guard(t: Tables):
    from silverloom.operators.identity import resolve_identity

    gold = resolve_identity(t("party_stack"), "sfc", ["int"], ["key"], link="link")
    return quality.counts_match(gold, t("party_stack").filter("src_sys_key = 'sfc'"))
