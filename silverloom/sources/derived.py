"""Business-shaped inputs made from the raw tables.

The raw tables hold orders, lines and events; the reports need person directories, rate series, week sheets and so on.
Each input below is one SELECT over whole raw tables, in the part of SQL that Spark and DuckDB share. Three places where
the engines differ are written as ``@dow(d)`` (weekday, Sunday is 0), ``@days(a, b)`` (days from a to b) and
``@plus(d, n)`` (date plus days).
"""

from __future__ import annotations

import re

RAW = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

ORDERS_AS_OF = "2001-08-01"
EVENTS_AS_OF = "2024-01-31"
# First day of the calendar and last day it reaches.
CALENDAR = ("1995-01-01", "2001-12-31")

_SPARK = {"dow": "(dayofweek({0}) - 1)", "days": "datediff({1}, {0})", "plus": "date_add({0}, CAST({1} AS INT))"}
_DUCK = {"dow": "CAST(dayofweek({0}) AS INTEGER)", "days": "date_diff('day', {0}, {1})",
         "plus": "CAST({0} + CAST({1} AS INTEGER) AS DATE)"}

DERIVED: dict[str, str] = {
    # persons of two systems in one silver layout; positive balances carry a cross-system link
    "party_stack": """
        SELECT 'sfc' AS src_sys_key, CAST(c_custkey AS STRING) AS key,
               CASE WHEN c_acctbal > 0 THEN CAST(c_custkey AS STRING) END AS link,
               CASE WHEN c_mktsegment = 'MACHINERY' THEN '' ELSE c_name END AS name,
               c_nationkey AS nation_id, CAST(c_acctbal AS DECIMAL(18,2)) AS amt_balance, c_mktsegment AS segment
        FROM customer
        UNION ALL
        SELECT 'int', CAST(s_suppkey AS STRING), CASE WHEN s_acctbal > 0 THEN CAST(s_suppkey AS STRING) END,
               CASE WHEN s_nationkey < 3 THEN '' ELSE s_name END, s_nationkey,
               CAST(s_acctbal AS DECIMAL(18,2)), NULL
        FROM supplier""",
    # quotes per US dollar on trading days; one currency starts a week late
    "fx_series": """
        SELECT 'USD' AS to_curr, frm_curr, date, CAST(CAST(CAST(total AS DOUBLE) / n + 0.5 AS DECIMAL(18,10)) AS DOUBLE) AS value
        FROM (SELECT CASE event_type WHEN 'view' THEN 'EUR' WHEN 'signup' THEN 'GBP' WHEN 'click' THEN 'JPY'
                                     WHEN 'purchase' THEN 'CAD' ELSE 'INR' END AS frm_curr,
                     CAST(ts AS DATE) AS date, sum(CAST(value AS DECIMAL(18,2))) AS total, count(*) AS n
              FROM events GROUP BY 1, 2) q
        WHERE @dow(date) NOT IN (0, 6) AND (frm_curr <> 'INR' OR date >= DATE '2024-01-08')""",
    # orders with a currency and a date before, inside or after the rate series
    "order_currency": """
        SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DECIMAL(18,2)) AS amt, o_orderstatus,
               CASE o_orderpriority WHEN '1-URGENT' THEN '' WHEN '2-HIGH' THEN 'eur' WHEN '3-MEDIUM' THEN 'GBP'
                                    WHEN '4-NOT SPECIFIED' THEN 'JPY' ELSE 'CHF' END AS currency,
               CASE o_orderstatus WHEN 'F' THEN 'USD' WHEN 'O' THEN 'EUR' ELSE 'GBP' END AS entity_currency,
               @plus(DATE '2023-12-25', o_orderkey % 45) AS dte
        FROM orders""",
    # a week per row, Sunday first, hours per weekday
    "week_sheet": """
        SELECT user_id, week_start,
               sum(CASE WHEN d = 0 THEN v ELSE 0 END) AS h_sun, sum(CASE WHEN d = 1 THEN v ELSE 0 END) AS h_mon,
               sum(CASE WHEN d = 2 THEN v ELSE 0 END) AS h_tue, sum(CASE WHEN d = 3 THEN v ELSE 0 END) AS h_wed,
               sum(CASE WHEN d = 4 THEN v ELSE 0 END) AS h_thu, sum(CASE WHEN d = 5 THEN v ELSE 0 END) AS h_fri,
               sum(CASE WHEN d = 6 THEN v ELSE 0 END) AS h_sat
        FROM (SELECT user_id, @dow(CAST(ts AS DATE)) AS d, CAST(value AS DECIMAL(18,2)) AS v,
                     @plus(CAST(ts AS DATE), 0 - @dow(CAST(ts AS DATE))) AS week_start FROM events) q
        GROUP BY user_id, week_start""",
    # unit price of a part on each day it shipped
    "price_change": """
        SELECT l_partkey AS part_id, CAST(l_shipdate AS DATE) AS dte,
               max(CAST(l_extendedprice / l_quantity AS DECIMAL(18,8))) AS unit_price
        FROM lineitem GROUP BY 1, 2""",
    # rate agreed for a supplier and part size, only for small sizes
    "specific_rate": """
        SELECT l_suppkey AS supp_id, p_size AS size_id,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE)
                 / CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS rate
        FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size < 25 GROUP BY 1, 2""",
    # rate agreed for a supplier whatever the part, only with suppliers in credit
    "generic_rate": """
        SELECT l_suppkey AS supp_id,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE)
                 / CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS rate
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE s_acctbal >= 0 GROUP BY 1""",
    "account_tree": """
        SELECT c_custkey AS account_id,
               CASE WHEN c_custkey >= 4 THEN CAST(floor(c_custkey / 4.0) AS BIGINT) END AS parent_id,
               c_name AS name, CASE WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') THEN c_mktsegment END AS grade
        FROM customer""",
    # time entries: person, task code, billable flag, hours, rate
    "entry_fact": """
        SELECT l_suppkey AS person_id, o_custkey AS project_id, l_orderkey AS sheet_id,
               CASE l_linenumber WHEN 1 THEN 'DEV' WHEN 2 THEN 'TVL' WHEN 3 THEN 'Internal TVL' WHEN 4 THEN 'VAC'
                                 WHEN 5 THEN 'OUTAGE' WHEN 6 THEN 'IDLE' ELSE 'ILL' END AS task_name,
               (l_linestatus = 'F') AS bln_billable, CAST(l_quantity AS DECIMAL(18,2)) AS qty,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS bill_rate,
               CAST(l_shipdate AS DATE) AS dte_entry, s_nationkey % 5 AS entity_person, c_nationkey % 5 AS entity_project
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
             JOIN supplier ON l_suppkey = s_suppkey""",
    # task codes of the entries with the standard code each is linked to
    "code_links": """
        SELECT DISTINCT task_name AS phase_code,
               CASE task_name WHEN 'VAC' THEN 'PTO' WHEN 'ILL' THEN 'SICK' WHEN 'OUTAGE' THEN 'DISFUN'
                              WHEN 'IDLE' THEN 'NOWORK' ELSE task_name END AS standard_code
        FROM entry_fact""",
    # yearly plan of every supplier, for the years it has shipped in
    "year_plan": """
        SELECT person_id, year, CAST(1000 + person_id AS DECIMAL(18,2)) AS plan_hours,
               CAST(40 + s_nationkey AS DECIMAL(18,2)) AS bill_rate,
               @plus(DATE '1995-01-01', person_id * 7 % 2500) AS dte_start
        FROM (SELECT l_suppkey AS person_id, year(l_shipdate) AS year FROM lineitem GROUP BY 1, 2) y
             JOIN supplier ON s_suppkey = person_id""",
    "attr_rows": """
        SELECT user_id, event_type AS field, max(value) AS value FROM events GROUP BY 1, 2""",
    # people with the days they joined and left
    "person_dates": """
        SELECT user_id, CAST(min(ts) AS DATE) AS dte_hired,
               CASE WHEN max(value) < 250 THEN CAST(max(ts) AS DATE) END AS dte_left FROM events GROUP BY user_id""",
    # weeks (Monday start) in which a person signed something
    "sheets_seen": """
        SELECT DISTINCT user_id, @plus(CAST(ts AS DATE), 0 - (@dow(CAST(ts AS DATE)) + 6) % 7) AS week_start,
               'Submitted' AS status
        FROM events WHERE event_type = 'signup'""",
    # weekly billable hours of each supplier with the weekly plan
    "weekly_hours": """
        SELECT e.person_id, e.week_start, e.hours, p.weekly_plan
        FROM (SELECT person_id, @plus(dte_entry, 0 - (@dow(dte_entry) + 6) % 7) AS week_start, sum(qty) AS hours
              FROM entry_fact WHERE bln_billable GROUP BY 1, 2) e
        JOIN (SELECT s_suppkey AS person_id, CAST(20 + s_nationkey AS DECIMAL(18,2)) AS weekly_plan FROM supplier) p
          ON e.person_id = p.person_id""",
    # job changes of customers: each order is a change of the yearly salary
    "job_change": """
        SELECT o_custkey AS person_id, CAST(o_orderdate AS DATE) AS dte_effective, o_orderkey AS change_id,
               CAST(o_totalprice AS DECIMAL(18,2)) AS salary, o_orderstatus AS shift_code,
               CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END AS percent_change,
               (o_orderpriority = '2-HIGH') AS bln_rate_change, substring(o_orderpriority, 1, 1) AS reason_code
        FROM orders""",
    # pay snapshot of every customer
    "pay_snapshot": """
        SELECT c_custkey AS person_id, DATE '1997-01-01' AS dte_effective,
               CAST(c_acctbal * 12 AS DECIMAL(18,2)) AS salary FROM customer""",
}


def _macros(sql: str, table: dict[str, str]) -> str:
    """Replace the innermost macro until none is left."""
    pattern = re.compile(r"@(\w+)\(")
    while True:
        hits = list(pattern.finditer(sql))
        if not hits:
            return sql
        m = hits[-1]
        depth, i, args, start = 1, m.end(), [], m.end()
        while depth:
            ch = sql[i]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            if (ch == "," and depth == 1) or depth == 0:
                args.append(sql[start:i].strip())
                start = i + 1
            i += 1
        sql = sql[: m.start()] + table[m.group(1)].format(*args) + sql[i:]


def spark_sql(name: str) -> str:
    return _macros(DERIVED[name], _SPARK)


def duck_sql(name: str) -> str:
    return _macros(DERIVED[name], _DUCK)


def duck_text(sql: str) -> str:
    """A query text with its macros in DuckDB's form."""
    return _macros(sql, _DUCK)


def inputs_of(sql: str) -> list[str]:
    """Raw and derived names a query text reads."""
    read = set(re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", sql))
    return [n for n in (*RAW, *DERIVED) if n in read]


def with_inputs(sql: str) -> str:
    """DuckDB query text with the derived inputs it needs as common table expressions."""
    order: list[str] = []

    def visit(text: str) -> None:
        for n in inputs_of(text):
            if n in DERIVED and n not in order:
                visit(DERIVED[n])
                order.append(n)

    visit(sql)
    body = duck_text(sql).strip()
    if not order:
        return body
    ctes = ",\n".join(f"{n} AS ({duck_sql(n).strip()})" for n in order)
    if body[:15].upper() == "WITH RECURSIVE ":
        return f"WITH RECURSIVE {ctes},\n{body[15:]}"
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def spark_sql_text(sql: str) -> str:
    """A query text with its macros in Spark's form."""
    return _macros(sql, _SPARK)
