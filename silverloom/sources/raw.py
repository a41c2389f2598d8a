"""Stand-ins for the raw tables of the source systems, each one SELECT over whole test tables.

``RAW_TABLES`` maps "system.table" to SQL. A real installation passes its own tables to ``models.core.Warehouse``
instead; the models only rely on the column names.
"""

from __future__ import annotations

LIVE = "FALSE AS _fivetran_deleted"
# some orders and lines that the loader has marked as deleted
LIVE_ORDER = "(o_orderkey % 41 = 7) AS _fivetran_deleted"
LIVE_LINE = "(l_orderkey % 43 = 5 AND l_linenumber <> 3) AS _fivetran_deleted"


def _text(prefix: str, c: str) -> str:
    return f"'{prefix}' || CAST({c} AS STRING)"


# one shape serves all small portal dimensions: keys of every system, a name, and parents
_PORTAL_DIM = f"""
    SELECT n_nationkey AS id, {_text('R', 'n_nationkey')} AS record_id, CAST(n_nationkey AS STRING) AS ukg_id,
           {_text('D', 'n_nationkey')} AS intacct_id, {_text('S', 'n_nationkey')} AS salesforce_id, n_name AS display_name,
           n_regionkey AS region_id, n_regionkey AS entity_id, n_regionkey AS continent_id, n_regionkey AS location_id, n_regionkey AS country_id,
           n_regionkey AS practice_id, n_regionkey AS family_id, CASE n_regionkey WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'GBP' END AS currency_id,
           40 AS work_hours_per_week, CAST(n_regionkey * 0.05 AS DECIMAL(9,4)) AS shift_percent, n_regionkey AS regional_manager_user_id, {LIVE} FROM nation"""

_PORTAL_DIMS = """states contractor_companies countries departments dol_statuses shift_codes employee_types entities
    ethnic_backgrounds labor_categories genders locations_intacct locations_ukg locations location_regions location_continents
    payroll_companies pay_types positions position_families practices practice_areas termination_types base_teams job_salary_grades""".split()

# audit columns every Salesforce table has
_SF = "'U1' AS created_by_id, 'U2' AS last_modified_by_id, {when} AS created_date, {when} AS last_modified_date, {when} AS system_modstamp, ({key} % 37 = 3) AS is_deleted, "
_SF_ORDER = _SF.format(when="o_orderdate", key="o_orderkey") + LIVE_ORDER
_SF_LINE = _SF.format(when="l_shipdate", key="l_orderkey") + LIVE_LINE
_SF_PARTY, _SF_PART, _SF_NATION = (_SF.format(when="TIMESTAMP '2000-01-01 00:00:00'", key=k) + LIVE for k in ("c_custkey", "p_partkey", "n_nationkey"))
_CUR = "CASE o_orderpriority WHEN '1-URGENT' THEN '' WHEN '2-HIGH' THEN 'EUR' WHEN '3-MEDIUM' THEN 'GBP' WHEN '4-NOT SPECIFIED' THEN 'JPY' ELSE 'USD' END"
_LINES = "lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"
# lines have no key of their own: grouped to one row per order, position and part
_LINE = "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING)"
_ONE_LINE = """(SELECT l_orderkey, l_linenumber, l_partkey, min(l_suppkey) AS l_suppkey, sum(CAST(l_quantity AS DECIMAL(18,2))) AS qty,
        sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS price, max(l_returnflag) AS flag, min(l_linestatus) AS l_linestatus, min(l_shipdate) AS l_shipdate
        FROM lineitem GROUP BY l_orderkey, l_linenumber, l_partkey) l JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"""
# the same lines for Spark: dealt by their order once, which serves both the grouping and the join, and only the orders meet
# the customers
_ONE_LINE_SPARK = _ONE_LINE.replace("FROM lineitem GROUP", "FROM (SELECT /*+ REPARTITION(l_orderkey) */ * FROM lineitem) GROUP").replace(
    "JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey", "JOIN (SELECT * FROM orders JOIN customer ON o_custkey = c_custkey) o ON l_orderkey = o_orderkey")
_TASK = "CASE l_linenumber WHEN 1 THEN 'DEV' WHEN 2 THEN 'TVL' WHEN 3 THEN 'Internal TVL' WHEN 4 THEN 'VAC' WHEN 5 THEN 'OUTAGE' WHEN 6 THEN 'IDLE' ELSE 'ILL' END"


def _int_header(*cols: str) -> str:
    extra = "".join(f", {c}" for c in cols)
    return f"""SELECT o_orderkey AS recordno, CAST(o_orderkey AS STRING) AS recordid, o_custkey AS customerkey, {_text('E', 'o_custkey')} AS employeeid,
        {_CUR} AS currency, 'USD' AS basecurr, CAST(o_totalprice AS DECIMAL(18,2)) AS totalentered, CAST(o_orderdate AS DATE) AS whenposted,
        o_orderstatus AS state, c_nationkey AS locationkey{extra}, o_orderdate AS whencreated, o_orderdate AS whenmodified, {LIVE_ORDER}
        FROM orders JOIN customer ON o_custkey = c_custkey"""


def _int_line(*cols: str) -> str:
    extra = "".join(f", {c}" for c in cols)
    return f"""SELECT {_LINE} AS recordno, l_orderkey AS recordkey, l_partkey AS projectkey, {_text('E', 'o_custkey')} AS employeeid, o_custkey AS employeekey,
        {_text('D', 'c_nationkey')} AS departmentid, {_text('D', 'c_nationkey')} AS locationid, c_nationkey AS baselocation, {_CUR} AS currency,
        price AS amount, CAST(price * 0.9 AS DECIMAL(18,2)) AS trx_amount, CAST(l_shipdate AS DATE) AS entry_date, (l_linestatus = 'F') AS billable,
        TRUE AS lineitem{extra}, l_shipdate AS whencreated, l_shipdate AS whenmodified, {LIVE_LINE} FROM {_ONE_LINE}"""


RAW_TABLES: dict[str, str] = {f"portal.{d}": _PORTAL_DIM for d in _PORTAL_DIMS}
# two employee types whose people write no sheets
RAW_TABLES["portal.employee_types"] = _PORTAL_DIM.replace(
    f"{_text('R', 'n_nationkey')} AS record_id", f"CASE n_nationkey WHEN 7 THEN '1814354' WHEN 11 THEN '474084' ELSE {_text('R', 'n_nationkey')} END AS record_id")
RAW_TABLES |= {
    "portal.users": f"""SELECT c_custkey AS id, CAST(c_custkey AS STRING) AS record_id, CAST(c_custkey AS STRING) AS ukg_id, {_text('U', 'c_custkey')} AS salesforce_user_id,
        {_text('C', 'c_custkey')} AS contact_id, {_text('E', 'c_custkey')} AS intacct_employee_id, c_custkey AS intacct_employee_record_no, c_name AS display_name,
        c_nationkey AS entity_id, c_nationkey AS contractor_company_id, c_nationkey AS labor_category_id, 'n_' || CAST(c_nationkey AS STRING) AS intacct_override_entity_id,
        CASE WHEN c_nationkey < 12 THEN 'USD' ELSE 'EUR' END AS currency_id, c_mktsegment AS employee_type, {LIVE} FROM customer""",
    "portal.users_forecasts": f"""SELECT CAST(o_custkey AS STRING) AS user_id, year(o_orderdate) AS timeframe_id, CAST(1000 + count(*) AS DECIMAL(18,2)) AS plan_hours_year,
        CAST(40 + count(*) AS DECIMAL(18,2)) AS bill_rate, {LIVE} FROM orders GROUP BY 1, 2""",
    "portal.timeframes": f"""SELECT DISTINCT year(o_orderdate) AS id, make_date(year(o_orderdate), 1, 1) AS start_date, make_date(year(o_orderdate), 12, 31) AS enddate, {LIVE} FROM orders""",
    "portal.entities_benefit_rates": f"""SELECT n_nationkey AS entity_id, 2001 AS timeframe_id, CAST(n_regionkey AS DECIMAL(9,4)) AS total, {LIVE} FROM nation""",
    "portal.reporting_groups": f"""SELECT DISTINCT n_regionkey AS id, CAST(n_regionkey AS STRING) AS name, (n_regionkey <> 4) AS visible, CASE WHEN n_regionkey = 0 THEN 'INT1000' END AS parent_id,
        DATE '2000-01-01' AS start_date, CASE WHEN n_regionkey = 1 THEN DATE '2001-01-01' END AS end_date, {LIVE} FROM nation""",
    "portal.reporting_groups_locations": f"""SELECT n_nationkey AS id, n_regionkey AS group_id, n_nationkey AS location_id,
        CASE n_regionkey WHEN 0 THEN '|2|3|' WHEN 1 THEN '|3|4|5|' WHEN 2 THEN '|5|' ELSE '|2|' END AS practice_id, {LIVE} FROM nation""",
    "reference.postal_code_geolocations": f"""SELECT {_text('', 'n_nationkey')} AS postal_code, {_text('R', 'n_nationkey')} AS key_country, n_nationkey * 1.5 AS latitude,
        n_nationkey * 2.5 AS longitude FROM nation""",
    # ---- payroll system
    "ukg_pro.company": f"""SELECT CAST(n_nationkey AS STRING) AS id, {_text('CO', 'n_nationkey')} AS code, n_name AS name, CASE n_regionkey WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'GBP' END AS currency_code, {LIVE} FROM nation""",
    "ukg_pro.job": f"SELECT CAST(p_partkey AS STRING) AS id, p_name AS title, {LIVE} FROM part",
    "ukg_pro.employee": f"""SELECT CAST(c_custkey AS STRING) AS id, CAST(c_nationkey AS STRING) AS company_id, {_text('N', 'c_custkey')} AS employee_number, c_mktsegment AS first_name, c_name AS last_name,
        '' AS preferred_name, CAST(c_nationkey AS STRING) AS address_country, CAST(c_nationkey AS STRING) AS address_state, substring(c_name, 12) AS address_zip_code, CAST(c_nationkey AS STRING) AS gender,
        CAST(c_nationkey AS STRING) AS ethnic_description, c_name || '@example.com' AS email_address, TIMESTAMP '1999-01-01 00:00:00' AS date_time_created, {LIVE} FROM customer""",
    "ukg_pro.employment": f"""SELECT CAST(o_custkey AS STRING) AS employee_id, CAST(c_nationkey AS STRING) AS company_id, o_orderkey AS employment_no, CAST(o_orderdate AS DATE) AS date_in_job, o_orderdate AS date_time_created,
        CAST(o_custkey % 2000 AS STRING) AS primary_job_id, CASE WHEN o_custkey >= 4 THEN CAST(CAST(floor(o_custkey / 4.0) AS BIGINT) AS STRING) END AS supervisor_id,
        CASE o_orderstatus WHEN 'F' THEN 'A' WHEN 'O' THEN 'L' ELSE 'T' END AS employee_status_code, DATE '1998-05-04' AS original_hire_date, DATE '1999-05-03' AS last_hire_date,
        CASE WHEN o_orderstatus = 'P' THEN CAST(o_orderdate AS DATE) END AS date_of_termination, CAST(c_nationkey AS STRING) AS employee_type_code, CAST(c_nationkey AS STRING) AS pay_group,
        CAST(c_nationkey AS STRING) AS salary_or_hourly, CAST(c_nationkey AS STRING) AS full_time_or_part_time_code, CAST(c_nationkey AS STRING) AS primary_work_location_id, '' AS term_reason, {LIVE}
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "ukg_pro.compensation": f"""SELECT {_text('K', 'c_custkey')} AS _fivetran_id, CAST(c_custkey AS STRING) AS employee_id, CAST(c_nationkey AS STRING) AS company_id,
        CAST(c_acctbal * 12 AS DECIMAL(18,2)) AS annual_salary, CAST(CAST(c_acctbal AS DECIMAL(18,2)) * 0.01 AS DECIMAL(18,2)) AS hourly_pay_rate, CAST(CAST(c_acctbal AS DECIMAL(18,2)) * 0.25 AS DECIMAL(18,2)) AS weekly_pay_rate,
        CASE WHEN c_custkey % 4 <> 1 THEN CAST(CAST(c_acctbal AS DECIMAL(18,2)) * 0.5 AS DECIMAL(18,2)) END AS pay_period_pay_rate, CAST(c_custkey % 25 AS DECIMAL(9,2)) AS other_rate_1,
        CASE WHEN c_custkey % 6 = 0 THEN CAST(1.5 AS DECIMAL(9,2)) WHEN c_custkey % 6 < 5 THEN CAST(0.1 AS DECIMAL(9,2)) END AS other_rate_2,
        CAST(c_custkey % 7 * 100.25 AS DECIMAL(9,2)) AS other_rate_3, CASE WHEN c_custkey % 5 = 0 THEN CAST(12.5 AS DECIMAL(9,2)) END AS other_rate_4,
        CASE WHEN c_mktsegment = 'BUILDING' THEN NULL WHEN c_mktsegment = 'MACHINERY' THEN 'EUR' ELSE 'USD' END AS currency_code, CASE WHEN c_custkey % 3 = 0 THEN DATE '2001-03-01' ELSE DATE '1997-01-01' END AS date_in_job, 'S' AS salary_or_hourly_code,
        'F' AS full_time_or_part_time_code, CASE WHEN c_custkey % 3 > 0 THEN CAST(c_nationkey AS STRING) ELSE '' END AS primary_shift_code, CAST(c_nationkey AS STRING) AS primary_job_id, CAST(c_nationkey AS STRING) AS job_salary_grade, CASE WHEN c_custkey % 8 > 0 THEN c_mktsegment ELSE '' END AS job_title, {LIVE} FROM customer""",
    "ukg_pro.employee_job_history": f"""SELECT CAST(o_orderkey AS STRING) AS id, CAST(o_custkey AS STRING) AS employee_id, CAST(c_nationkey AS STRING) AS company_id, CAST(o_orderdate AS DATE) AS job_effective_date,
        o_orderdate AS date_time_created, CAST(o_totalprice AS DECIMAL(18,2)) AS annual_salary, CASE WHEN o_orderstatus = 'O' THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 0.02 AS DECIMAL(18,2)) WHEN o_orderstatus = 'F' THEN CAST(0 AS DECIMAL(18,2)) END AS weekly_pay_rate,
        CASE WHEN o_orderstatus <> 'P' THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 0.0005 AS DECIMAL(18,2)) END AS hourly_pay_rate,
        CASE WHEN o_orderkey % 4 = 1 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 0.04 AS DECIMAL(18,2)) END AS period_pay_rate, CAST(o_orderkey % 3 * 40 AS DECIMAL(18,2)) AS scheduled_work_hours,
        CAST(o_orderkey % 25 AS DECIMAL(9,2)) AS other_rate_1, CASE WHEN o_orderkey % 6 = 0 THEN CAST(1.5 AS DECIMAL(9,2)) WHEN o_orderkey % 6 < 5 THEN CAST(0.1 AS DECIMAL(9,2)) END AS other_rate_2,
        CAST(o_orderkey % 7 * 100.25 AS DECIMAL(9,2)) AS other_rate_3, CASE WHEN o_orderkey % 5 = 0 THEN CAST(12.5 AS DECIMAL(9,2)) END AS other_rate_4,
        CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END AS percent_change, (o_orderpriority = '2-HIGH') AS is_rate_change, (o_orderpriority = '3-MEDIUM') AS is_promotion, substring(o_orderpriority, 1, 1) || '00' AS reason_code,
        CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN '2' ELSE '' END AS shift_code, CAST(c_nationkey AS STRING) AS organization_level_1_id, CAST(c_nationkey AS STRING) AS organization_level_2_id, CAST(c_nationkey AS STRING) AS organization_level_3_id,
        CASE WHEN o_orderkey % 9 > 0 THEN CAST(c_nationkey AS STRING) END AS organization_level_4_id, CAST(c_nationkey AS STRING) AS salary_grade, CAST(o_custkey % 2000 AS STRING) AS job_id, c_mktsegment AS job_title, 'S' AS salary_or_hourly, 'F' AS full_time_or_part_time, {LIVE}
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "ukg_pro.employee_change": f"""SELECT CAST(c_custkey AS STRING) AS employee_id, CAST(c_nationkey AS STRING) AS company_id, TIMESTAMP '2001-01-01 00:00:00' AS date_time_changed, {LIVE} FROM customer""",
    "ukg_pro.employment_field_row": f"""SELECT CAST(c_custkey AS STRING) || ':CO' || CAST(c_nationkey AS STRING) AS key_value, 'PMQualified' AS field_name, c_mktsegment AS field_value, {LIVE} FROM customer
        UNION ALL SELECT CAST(c_custkey AS STRING) || ':CO' || CAST(c_nationkey AS STRING), CASE WHEN c_acctbal > 0 THEN 'VestSize' ELSE 'DietaryNeeds' END, CAST(c_nationkey AS STRING), FALSE FROM customer""",
    "ukg_pro.earning_history_base_element": f"""SELECT {_LINE} AS _fivetran_id, CAST(o_custkey AS STRING) AS employee_id, CAST(c_nationkey AS STRING) AS company_id, CAST(l_orderkey AS STRING) AS employment_id,
        price AS current_amount, CAST(price * 0.8 AS DECIMAL(18,2)) AS base_amount, qty AS current_hours, CAST(l_shipdate AS DATE) AS pay_date, (flag = 'R') AS is_voided, {LIVE_LINE} FROM {_ONE_LINE}""",
    "ukg_pro.payroll_deduction_history": f"""SELECT {_LINE} AS _fivetran_id, CAST(o_custkey AS STRING) AS employee_id, CAST(c_nationkey AS STRING) AS company_id, CAST(price * 0.1 AS DECIMAL(18,2)) AS employee_amount,
        CAST(price * 0.2 AS DECIMAL(18,2)) AS employer_amount, CAST(l_shipdate AS DATE) AS pay_date, CASE WHEN flag = 'A' THEN 'Y' ELSE 'N' END AS is_cafeteria_plan, CASE WHEN l_linestatus = 'O' THEN 'Y' ELSE 'N' END AS is_voided, {LIVE_LINE} FROM {_ONE_LINE}""",
    # ---- accounting system
    "sage_intacct.location": f"SELECT n_nationkey AS recordno, {_text('D', 'n_nationkey')} AS locationid, n_regionkey AS parentkey, n_name AS name, CASE WHEN n_regionkey > 2 THEN 'active' ELSE '' END AS status, CASE n_regionkey WHEN 0 THEN 'C' WHEN 1 THEN 'E' WHEN 2 THEN 'N' ELSE '' END AS locationtype, {LIVE} FROM nation",
    "sage_intacct.department": f"SELECT n_nationkey AS recordno, {_text('D', 'n_nationkey')} AS departmentid, n_name AS title, {LIVE} FROM nation",
    "sage_intacct.item": f"SELECT p_partkey AS recordno, {_text('I', 'p_partkey')} AS itemid, p_name AS name, {LIVE} FROM part",
    "sage_intacct.task": f"SELECT p_partkey AS recordno, {_text('T', 'p_partkey')} AS taskid, p_partkey AS projectkey, p_name AS name, {_text('M', 'p_partkey')} AS sfdc_milestone_id, TIMESTAMP '2000-01-01 00:00:00' AS whencreated, {LIVE} FROM part",
    "sage_intacct.contact": f"SELECT c_custkey AS recordno, c_name AS contactname, c_name AS printas, c_name || '@example.com' AS email1, {LIVE} FROM customer",
    "sage_intacct.customer": f"SELECT c_custkey AS recordno, {_text('CU', 'c_custkey')} AS customerid, c_name AS name, CASE WHEN c_acctbal < 0 THEN '' ELSE c_mktsegment END AS comments, CASE WHEN c_acctbal > 0 THEN 'T' ELSE 'F' END AS onhold, CAST(c_acctbal AS DECIMAL(18,2)) AS totaldue, {LIVE} FROM customer",
    "sage_intacct.employee": f"""SELECT c_custkey AS recordno, {_text('E', 'c_custkey')} AS employeeid, {_text('D', 'c_nationkey')} AS locationid, c_nationkey AS locationkey, {_text('D', 'c_nationkey')} AS departmentid, c_nationkey AS departmentkey,
        c_name AS contact_name, c_name AS personalinfo_printas, CAST(c_custkey AS STRING) AS ukg_employee_number, 'USD' AS currency, {_text('D', 'c_nationkey')} AS home_region, c_mktsegment AS earningtypename, (c_acctbal > 0) AS mst_member, {LIVE} FROM customer""",
    "sage_intacct.project": f"""SELECT p_partkey AS recordno, {_text('P', 'p_partkey')} AS projectid, p_name AS name, {_text('E', 'p_partkey')} AS managerid, {_text('D', 'p_size % 25')} AS departmentid, {_text('D', 'p_size % 25')} AS locationid, p_size % 25 AS locationkey,
        CASE p_type WHEN 'ECONOMY' THEN 'EUR' WHEN 'SMALL' THEN 'GBP' ELSE 'USD' END AS currency, CAST(p_retailprice AS DECIMAL(18,2)) AS po_amount, CASE WHEN p_size % 17 = 4 THEN 'Client Site' ELSE 'Project' END AS projecttype, DATE '2000-01-03' AS begindate, {LIVE} FROM part""",
    "sage_intacct.project_resources": f"""SELECT l_partkey AS projectkey, o_custkey AS employeekey, CASE WHEN l_returnflag <> 'N' THEN l_linenumber ELSE l_linenumber + 100 END AS itemkey, min(CAST(l_shipdate AS DATE)) AS startdate, CAST(max(l_extendedprice) AS DECIMAL(18,2)) AS billingrate, {LIVE}
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3""",
    "sage_intacct.timesheet": f"""SELECT o_orderkey AS recordno, {_text('E', 'o_custkey')} AS employeeid, o_custkey AS employeekey, CAST(o_custkey AS STRING) || ':' || CAST(CAST(o_orderdate AS DATE) AS STRING) AS link, CAST(o_orderdate AS DATE) AS begindate,
        CASE WHEN o_orderkey % 29 <> 11 THEN o_orderstatus END AS state, {_text('D', 'c_nationkey')} AS employeelocationid, {_text('D', 'c_nationkey')} AS employeedepartmentid, o_orderdate AS whencreated, {LIVE_ORDER} FROM orders JOIN customer ON o_custkey = c_custkey""",
    "sage_intacct.timesheetentry": f"""SELECT {_LINE} AS recordno, l_orderkey AS timesheetkey, l_partkey AS projectkey, {_text('P', 'l_partkey')} AS projectid, o_custkey AS employeedimkey, {_text('E', 'o_custkey')} AS employeeid, l_linenumber AS itemkey,
        l_partkey AS taskkey, {_TASK} AS taskname, CAST(l_shipdate AS DATE) AS entrydate, qty, (l_linestatus = 'F') AS billable, {_text('D', 'c_nationkey')} AS departmentid, {_text('D', 'c_nationkey')} AS locationid, c_nationkey AS locationkey,
        {_LINE} AS salesforce_id, l_shipdate AS whenmodified, {LIVE_LINE} FROM {_ONE_LINE}""",
    "sage_intacct.ap_bill": _int_header("c_nationkey AS entitykey"),
    "sage_intacct.cc_transaction": _int_header("c_nationkey AS entitykey"),
    "sage_intacct.eexpenses": _int_header(f"CASE WHEN o_orderstatus <> 'P' THEN {_text('ER', 'o_orderkey')} END AS psa_id"),
    "sage_intacct.ar_invoice": _int_header(
        "CASE WHEN o_orderstatus = 'F' THEN '' ELSE o_orderpriority END AS description", "c_nationkey AS megaentitykey",
        "CASE WHEN o_orderstatus = 'F' THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 0.25 AS DECIMAL(18,2)) END AS totaldue",
        "CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 0.75 AS DECIMAL(18,2)) AS totalpaid",
        "CASE WHEN o_orderstatus <> 'F' THEN @plus(CAST(o_orderdate AS DATE), 9) END AS exch_rate_date"),
    "sage_intacct.ap_bill_item": _int_line(),
    "sage_intacct.cc_transaction_entry": _int_line(),
    "sage_intacct.eexpenses_item": _int_line(f"{_LINE} AS sfdc_expense_item_id", "currency AS org_currency").replace("currency AS org_currency", f"{_CUR} AS org_currency"),
    "sage_intacct.ar_invoice_item": _int_line("CASE WHEN flag = 'A' THEN '' ELSE flag END AS memo"),
    "sage_intacct_gl.gl_account": f"SELECT p_partkey AS recordno, {_text('GL', 'p_partkey')} AS accountno, p_name AS title, CASE WHEN p_size < 10 THEN '' ELSE p_type END AS category, CAST(NULL AS BOOLEAN) AS requiredept, {LIVE} FROM part",
    # ---- CRM
    "salesforce.contact": f"""SELECT {_text('C', 'c_custkey')} AS id, {_text('U', 'c_custkey')} AS user_c, CAST(c_custkey AS STRING) AS ukg_employee_id_c, {_text('A', 'c_custkey')} AS account_id, c_name AS name, c_mktsegment AS first_name, c_name AS last_name, {_text('S', 'c_nationkey')} AS practice_c, c_name || '@example.com' AS email,
        CASE WHEN c_custkey % 61 = 17 THEN '012OTHER' ELSE '0124W000001bI6LQAU' END AS record_type_id, {_SF_PARTY} FROM customer""",
    "salesforce.user": f"SELECT {_text('U', 'c_custkey')} AS id, {_text('C', 'c_custkey')} AS contact_id, CAST(c_custkey - c_custkey % 2 AS STRING) AS ukg_employee_id_c, CASE WHEN c_custkey % 4 = 0 THEN {_text('U', 'c_custkey + 1')} END AS delegated_approver_id, c_name AS name, c_name || '@example.com' AS email, (c_acctbal > 0) AS is_active, {_SF_PARTY} FROM customer",
    "salesforce.account": f"""SELECT {_text('A', 'c_custkey')} AS id, CASE WHEN c_custkey >= 4 THEN 'A' || CAST(CAST(floor(c_custkey / 4.0) AS BIGINT) AS STRING) END AS parent_id, c_name AS name, CASE WHEN c_mktsegment = 'BUILDING' THEN 'A' END AS grade_c,
        CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'N30' END AS payment_terms_c, {_text('U', 'c_custkey')} AS owner_id, {_text('C', 'c_custkey')} AS client_manager_c, CAST(c_nationkey AS STRING) || '-' || substring(c_name, 16) AS billing_postal_code,
        {_text('S', 'c_nationkey')} AS billing_country_code, {_text('S', 'c_nationkey')} AS billing_state_code, {_text('S', 'c_nationkey')} AS location_c, {_text('S', 'c_nationkey')} AS practice_c, {_text('RS', 'c_nationkey')} AS rate_card_set_c, CAST(c_acctbal AS DECIMAL(18,2)) AS annual_revenue, {_SF_PARTY} FROM customer""",
    "salesforce.account_team_member": f"SELECT {_text('AT', 'o_orderkey')} AS id, {_text('A', 'o_custkey')} AS account_id, {_text('U', 'o_custkey')} AS user_id, o_orderpriority AS team_member_role, {_SF_ORDER} FROM orders",
    "salesforce.opportunity": f"""SELECT {_text('O', 'o_orderkey')} AS id, CASE WHEN o_orderkey >= 4 THEN 'O' || CAST(CAST(floor(o_orderkey / 4.0) AS BIGINT) AS STRING) END AS parent_opportunity_c, {_text('A', 'o_custkey')} AS account_id, {_text('U', 'o_custkey')} AS owner_id,
        {_CUR} AS currency_iso_code, CAST(o_totalprice AS DECIMAL(18,2)) AS amount, o_orderstatus AS stage_name, CAST(o_orderdate AS DATE) AS close_date, {_text('S', 'c_nationkey')} AS practice_c, {_text('S', 'c_nationkey')} AS location_c, o_orderpriority AS name,
        CASE WHEN o_orderkey % 3 = 1 THEN 'SP' || CAST(o_custkey + 1 AS STRING) END AS pse_project_c, CASE o_orderstatus WHEN 'F' THEN 'Fixed' ELSE 'Time' END AS contract_type_c, CASE WHEN o_orderkey % 4 > 1 THEN DATE '1995-06-01' END AS proposal_submitted_date_c, {_SF_ORDER} FROM orders JOIN customer ON o_custkey = c_custkey""",
    "salesforce.opportunity_line_item": f"SELECT {_LINE} AS id, {_text('O', 'l_orderkey')} AS opportunity_id, {_text('PR', 'l_partkey')} AS product_2_id, {_text('S', 'c_nationkey')} AS practice_c, qty AS quantity, price AS total_price, CAST(price * 1.1 AS DECIMAL(18,2)) AS list_price, {_SF_LINE} FROM {_ONE_LINE}",
    "salesforce.opportunity_team_member": f"SELECT {_text('OT', 'o_orderkey')} AS id, {_text('O', 'o_orderkey')} AS opportunity_id, {_text('U', 'o_custkey')} AS user_id, o_orderpriority AS team_member_role, {_SF_ORDER} FROM orders",
    "salesforce.quote": f"""SELECT {_text('Q', 'o_orderkey')} AS id, {_text('O', 'o_orderkey')} AS opportunity_id, {_text('A', 'o_custkey')} AS account_id, {_text('U', 'o_custkey')} AS owner_id, {_text('S', 'c_nationkey')} AS practice_c, o_orderpriority AS name, {_CUR} AS currency_iso_code,
        {_text('SP', 'o_custkey')} AS pse_project_c, {_text('QN', 'o_orderkey')} AS quote_number, o_orderstatus AS status, CASE WHEN o_orderkey % 4 = 1 THEN CAST(o_orderdate AS DATE) END AS internal_approval_date_c,
        """ + ", ".join(f"{_text('U', f'o_custkey + {i}')} AS approver_{i}_c" for i in range(1, 11)) + ", " + ", ".join(f"{_text('U', f'o_custkey + {10 + i}')} AS reviewer_{i}_c" for i in range(1, 6)) + f", {_SF_ORDER} FROM orders JOIN customer ON o_custkey = c_custkey",
    "salesforce.quote_line_item": f"SELECT {_LINE} AS id, {_text('Q', 'l_orderkey')} AS quote_id, {_text('PR', 'l_partkey')} AS product_2_id, {_text('S', 'c_nationkey')} AS practice_c, qty AS quantity, price AS total_price, CAST(price * 1.1 AS DECIMAL(18,2)) AS list_price, CAST(price * 1.2 AS DECIMAL(18,2)) AS total_price_location, CASE WHEN l_linenumber <> 2 THEN CAST(price * 1.5 AS DECIMAL(18,2)) END AS total_price_opportunity, CASE WHEN l_orderkey % 5 = 0 THEN CAST(0 AS DECIMAL(18,2)) ELSE CAST(price * 0.5 AS DECIMAL(18,2)) END AS unit_price, {_SF_LINE} FROM {_ONE_LINE}",
    "salesforce.purchase_order_c": f"SELECT {_text('PO', 'o_orderkey')} AS id, {_text('A', 'o_custkey')} AS account_c, {_text('O', 'o_orderkey')} AS opportunity_c, {_CUR} AS currency_iso_code, CAST(o_totalprice AS DECIMAL(18,2)) AS amount_c, CAST(o_orderdate AS DATE) AS received_date_c, {_SF_ORDER} FROM orders",
    "salesforce.product_2": f"SELECT {_text('PR', 'p_partkey')} AS id, p_name AS name, p_type AS family, 'USD' AS currency_iso_code, (p_size < 40) AS is_active, {_SF_PART} FROM part",
    "salesforce.pricebook_entry": f"SELECT {_text('PE', 'p_partkey')} AS id, {_text('PR', 'p_partkey')} AS product_2_id, CAST(p_retailprice AS DECIMAL(18,2)) AS unit_price, 'USD' AS currency_iso_code, {_SF_PART} FROM part",
    "salesforce.lead": f"SELECT {_text('L', 'o_orderkey')} AS id, {_text('U', 'o_custkey')} AS owner_id, {_text('S', 'c_nationkey')} AS country_code, {_text('S', 'c_nationkey')} AS state_code, {_text('S', 'c_nationkey')} AS practice_c, {_text('S', 'c_nationkey')} AS location_c, {_text('O', 'o_orderkey')} AS converted_opportunity_id, o_orderstatus AS status, {_SF_ORDER} FROM orders JOIN customer ON o_custkey = c_custkey",
    "salesforce.pse_rate_card_c": f"SELECT {_text('RC', 'p_partkey')} AS id, {_text('U', 'p_partkey')} AS owner_id, {_text('S', 'p_size % 25')} AS pse_practice_c, {_text('S', 'p_size % 25')} AS pse_region_c, {_text('A', 'p_partkey')} AS pse_account_c, CAST(p_retailprice AS DECIMAL(18,2)) AS pse_suggested_bill_rate_c, DATE '2000-01-01' AS pse_start_date_c, {_SF_PART} FROM part",
    "salesforce.pse_rate_card_set_c": f"SELECT {_text('RS', 'n_nationkey')} AS id, {_text('U', 'n_nationkey')} AS owner_id, n_name AS name, {_SF_NATION} FROM nation",
    "salesforce.pse_rate_card_set_junction_c": f"SELECT {_text('J', 'p_partkey')} AS id, {_text('RC', 'p_partkey')} AS pse_rate_card_c, {_text('RS', 'p_size % 25')} AS pse_rate_card_set_c, {_SF_PART} FROM part",
    "salesforce.pse_proj_c": f"SELECT {_text('SP', 'p_partkey')} AS id, p_partkey AS intacct_record_no_c, {_text('A', 'p_partkey')} AS pse_account_c, {_text('O', 'p_partkey')} AS pse_opportunity_c, {_text('C', 'p_partkey')} AS pse_project_manager_c, {_text('S', 'p_size % 25')} AS pse_practice_c, {_text('S', 'p_size % 25')} AS pse_group_c, p_name AS name, {_SF_PART} FROM part",
    "salesforce.pse_practice_c": f"SELECT {_text('S', 'n_nationkey')} AS id, n_name AS name, {_SF_NATION} FROM nation",
    "salesforce.pse_grp_c": f"SELECT {_text('S', 'n_nationkey')} AS id, n_name AS name, {_SF_NATION} FROM nation",
    "salesforce.pse_milestone_c": f"SELECT {_text('M', 'p_partkey')} AS id, {_text('SP', 'p_partkey')} AS pse_project_c, {_text('U', 'p_partkey')} AS pse_approver_c, {_text('S', 'p_size % 25')} AS practice_area_c, p_name AS name, {_SF_PART} FROM part",
    "salesforce.pse_project_task_c": f"""SELECT {_text('PT', 'p_partkey')} AS id, {_text('M', 'p_partkey')} AS pse_milestone_c, {_text('SP', 'p_partkey')} AS pse_project_c, {_text('Q', 'p_partkey')} AS proposal_c, {_text('U', 'p_partkey')} AS owner_id, (p_size % 3 <> 0) AS is_project_task_c, p_name AS name,
        CAST(p_retailprice AS DECIMAL(18,2)) AS original_proposal_budget_c, CAST(p_size - 1 AS DECIMAL(18,2)) AS original_proposal_hrs_or_units_c, {_SF_PART} FROM part""",
    "salesforce.project_task_milestone_c": f"SELECT {_text('PM', 'p_partkey')} AS id, {_text('PT', 'p_partkey')} AS project_task_c, {_text('M', 'p_partkey')} AS phase_code_c, {_text('SP', 'p_partkey')} AS project_c, CAST(p_retailprice AS DECIMAL(18,2)) AS earned_value_c, CASE WHEN p_size % 2 = 0 THEN 'EUR' ELSE '' END AS currency_iso_code, DATE '2024-01-10' AS milestone_date_c, {_SF_PART} FROM part",
    "salesforce.pse_timecard_header_c": f"SELECT {_text('TH', 'o_orderkey')} AS id, {_text('C', 'o_custkey')} AS pse_resource_c, CAST(o_custkey AS STRING) || ':' || CAST(CAST(o_orderdate AS DATE) AS STRING) AS link, CAST(o_orderdate AS DATE) AS pse_start_date_c, CAST(o_orderdate AS DATE) + 6 AS pse_end_date_c, CASE WHEN o_orderkey % 3 = 0 THEN 'Approved' ELSE o_orderstatus END AS pse_status_c, 'CA' AS state_worked_c, {_SF_ORDER} FROM orders",
    "salesforce.pse_task_time_c": f"""SELECT {_text('TT', 'l_orderkey')} AS id, {_text('TH', 'l_orderkey')} AS pse_timecard_c, {_text('PT', 'min(l_partkey)')} AS pse_project_task_c, CAST(min(l_shipdate) AS DATE) AS pse_start_date_c,
        CAST(sum(CASE l_linenumber WHEN 1 THEN l_quantity END) AS DECIMAL(18,2)) AS pse_sunday_hours_c, CAST(sum(CASE l_linenumber WHEN 2 THEN l_quantity END) AS DECIMAL(18,2)) AS pse_monday_hours_c, CAST(sum(CASE l_linenumber WHEN 3 THEN l_quantity END) AS DECIMAL(18,2)) AS pse_tuesday_hours_c,
        CAST(sum(CASE l_linenumber WHEN 4 THEN l_quantity END) AS DECIMAL(18,2)) AS pse_wednesday_hours_c, CAST(sum(CASE l_linenumber WHEN 5 THEN l_quantity END) AS DECIMAL(18,2)) AS pse_thursday_hours_c, CAST(sum(CASE l_linenumber WHEN 6 THEN l_quantity END) AS DECIMAL(18,2)) AS pse_friday_hours_c,
        CAST(sum(CASE l_linenumber WHEN 7 THEN l_quantity END) AS DECIMAL(18,2)) AS pse_saturday_hours_c, max('DEV') AS phase_code_name_c, (l_orderkey % 37 = 3) AS is_deleted, (l_orderkey % 41 = 7) AS _fivetran_deleted FROM lineitem GROUP BY l_orderkey""",
    "salesforce.pse_expense_report_c": f"SELECT {_text('ER', 'o_orderkey')} AS id, CAST(o_orderkey AS STRING) AS intacct_expense_c, {_text('C', 'o_custkey')} AS pse_resource_c, {_text('SP', 'o_custkey')} AS pse_project_c, o_orderstatus AS pse_status_c, {_SF_ORDER} FROM orders",
    "salesforce.pse_expense_c": f"SELECT {_LINE} AS id, {_text('ER', 'l_orderkey')} AS pse_expense_report_c, {_text('C', 'o_custkey')} AS pse_resource_c, flag AS pse_type_c, {_text('GM', 'flag')} AS gla_mapping_c, price AS pse_amount_c, (l_linestatus = 'F') AS pse_billable_c, {_SF_LINE} FROM {_ONE_LINE}",
    # a type may have several accounts; an expense names the one that holds
    "salesforce.expense_type_gla_mapping_c": f"""SELECT DISTINCT {_text('GM', 'l_returnflag')} AS id, l_returnflag AS expense_type_c, {_text('GL', 'l_returnflag')} AS gl_account_c,
        {_text('Account ', 'l_returnflag')} AS name, {_text('I', 'l_returnflag')} AS intacct_item_id_c, {LIVE} FROM lineitem
        UNION ALL SELECT DISTINCT {_text('GN', 'l_returnflag')}, l_returnflag, {_text('GX', 'l_returnflag')}, {_text('Old account ', 'l_returnflag')}, {_text('J', 'l_returnflag')}, FALSE FROM lineitem""",
    "salesforce.pse_est_vs_actuals_c": f"""SELECT {_text('EV', 'o_orderkey')} AS id, {_text('AS', 'o_orderkey')} AS pse_assignment_c, {_text('SP', 'o_custkey')} AS pse_project_c, {_text('RR', 'o_orderkey')} AS pse_resource_request_c, {_text('C', 'o_custkey')} AS pse_resource_c, CAST(o_orderdate AS DATE) AS pse_start_date_c,
        @plus(CAST(o_orderdate AS DATE), 60) AS pse_end_date_c, CAST(o_custkey % 40 AS DECIMAL(18,2)) AS pse_estimated_hours_c, CAST(50 AS DECIMAL(18,2)) AS pse_resource_request_bill_rate_c, {_CUR} AS currency_iso_code, {_SF_ORDER} FROM orders""",
    "salesforce.pse_assignment_c": f"SELECT {_text('AS', 'o_orderkey')} AS id, {_text('SC', 'o_orderkey')} AS pse_schedule_c, CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey % 90 AS DECIMAL(18,2)) END AS pse_bill_rate_c, CASE WHEN o_orderstatus = 'F' THEN 'EUR' END AS currency_iso_code, (o_orderkey % 29 = 4) AS pse_exclude_from_planners_c, (o_orderkey % 37 = 5) AS is_deleted, {LIVE_ORDER} FROM orders",
    "salesforce.pse_resource_request_c": f"SELECT {_text('RR', 'o_orderkey')} AS id, {_text('O', 'o_orderkey')} AS pse_opportunity_c, (o_orderkey % 37 = 6) AS is_deleted, {LIVE_ORDER} FROM orders",
    # ---- project and estimate tools
    "psatools.projects": f"SELECT p_partkey AS id, p_partkey AS int_record_no, {_text('P', 'p_partkey')} AS int_project_id, {_text('', 'p_partkey')} AS assistant_project_manager_id, p_name AS name, {LIVE} FROM part",
    "psatools.projects_phase_codes": f"SELECT p_partkey AS id, p_partkey AS project_id, {_text('PT', 'p_partkey')} AS sfc_task_id, {_text('T', 'p_partkey')} AS int_task_id, {_text('M', 'p_partkey')} AS milestone_id, p_name AS name, {LIVE} FROM part",
    "psatools.project_personnel_exceptions": f"SELECT CASE WHEN l_returnflag = 'N' THEN l_partkey ELSE -l_partkey END AS project_id, o_custkey AS user_id, max(CAST(l_shipdate AS DATE)) AS effective_date, CAST(max(l_extendedprice) AS DECIMAL(18,2)) AS rate, CAST(NULL AS STRING) AS item_id, {LIVE} FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2",
    "psatools.standard_phase_codes_product_links": f"""SELECT DISTINCT {_TASK} AS phase_code, CASE l_linenumber WHEN 4 THEN 'PTO' WHEN 7 THEN 'SICK' WHEN 5 THEN 'DISFUN' WHEN 6 THEN 'NOWORK' ELSE 'WORK' END AS standard_phase_code_id, l_linenumber AS product_id, 1 AS created_by, 2 AS verified_by, {LIVE} FROM lineitem
        UNION ALL SELECT DISTINCT {_TASK}, CASE WHEN l_linenumber < 3 THEN 'FIELD' ELSE 'REMOTE' END, l_linenumber + 10, 2, 1, FALSE FROM lineitem""",
    "psatools.standard_phase_codes": f"""SELECT DISTINCT CASE l_linenumber WHEN 1 THEN 'WORK' WHEN 2 THEN 'FIELD' WHEN 3 THEN 'REMOTE' WHEN 4 THEN 'PTO' WHEN 5 THEN 'DISFUN' WHEN 6 THEN 'NOWORK' ELSE 'SICK' END AS id,
        CASE WHEN l_linenumber <> 2 THEN {_text('Product ', 'l_linenumber')} END AS product_id, (l_linenumber < 4) AS bln_is_billable, l_linenumber AS family_id, {LIVE} FROM lineitem""",
    "psatools.phase_code_families": f"SELECT DISTINCT l_linenumber AS id, {_text('Family ', 'l_linenumber')} AS name, {LIVE} FROM lineitem",
    "psatools.phase_code_families_links": f"SELECT DISTINCT l_linenumber AS family_id, {_TASK} AS phase_code, {LIVE} FROM lineitem",
    "psatools.estimate": f"SELECT o_orderkey AS estimateid, CASE WHEN o_orderkey % 5 <> 2 THEN {_text('Q', 'o_orderkey')} END AS sfproposalid, {_CUR} AS currencyid, CAST(o_orderdate AS DATE) AS created_on, {LIVE_ORDER} FROM orders",
    "psatools.estimatetotals": f"SELECT o_orderkey AS estimatetotalid, o_orderkey AS estimateid, CAST(o_totalprice AS DECIMAL(18,2)) AS total, {LIVE} FROM orders",
    "psatools.estimatetotals_phasecodes": f"SELECT {_LINE} AS recordid, l_orderkey AS estimatetotalid, {_TASK} AS name, qty AS hours, price AS budget, {LIVE_LINE} FROM {_ONE_LINE}",
    "psatools.currency": f"SELECT DISTINCT frm_curr AS currencyid, frm_curr AS code, 'Currency ' || frm_curr AS name, {LIVE} FROM fx_series",
    # ---- seeds: small code tables an installation keeps as files
    "seed.time_type_phase_codes": f"""SELECT DISTINCT CASE l_linenumber WHEN 7 THEN 'sicktime' WHEN 4 THEN 'vacholtime' WHEN 5 THEN 'dulltime' WHEN 2 THEN 'tvltime'
        WHEN 6 THEN 'excludepayroll' ELSE 'billable' END AS time_type, {_TASK} AS phase_code FROM lineitem""",
    "seed.currencies_active": "SELECT DISTINCT frm_curr AS currency, 1.0 AS default_fx_rate_to_usd FROM fx_series UNION SELECT DISTINCT to_curr, 1.0 FROM fx_series",
    "finance_economics.fx_rates_timeseries": "SELECT to_curr, frm_curr, date, value FROM fx_series",
}


def spark_form(sql: str) -> str:
    """A raw table's SQL in the form that moves the fewest rows in Spark; the rows are the same."""
    return sql.replace(_ONE_LINE, _ONE_LINE_SPARK)
