"""Silver models: one table per business object, all systems stacked in one layout.

System tags: ukg payroll, int accounting, sfc CRM, por portal, psa and pts project tools. Columns a raw table has beyond
the ones named here come through by the naming rule of ``models.core``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from silverloom.functions.keys import composite_key, first_non_null
from silverloom.functions.money import safe_ratio
from silverloom.functions.text import blank_to_null, display_name
from silverloom.models.core import Warehouse, conform_by_rule, look, model, silver
from silverloom.operators.joins import eav_pivot
from silverloom.operators.stack import blanks_to_null, stack, stack_distinct, unpivot_week
from silverloom.operators.timeline import as_of_join, parted_as_of_join
from silverloom.operators.windows import latest_per_key, scd2
from silverloom.sources.tables import tasks_for

LAYER = "consolidation"
# Custom payroll fields that become columns, by field name.
CUSTOM_FIELDS = {"PMQualified": "pm_qualified", "MissionSupportTeam": "mission_support_team", "MetricBonus": "metric_bonus_type",
                 "VestSize": "vest_size", "DietaryNeeds": "dietary_needs"}
# Fixed value: the record type of CRM contacts that are the company's own people.
STAFF = "0124W000001bI6LQAU"
TASK_BYTES = 2 << 20  # of the files of people's changes, for each task that looks for the last one
WEEK_HOURS = [f"pse_{d}_hours_c" for d in ("sunday", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday")]


def simple(name: str, system: str, table: str, **spec) -> None:
    """Register a silver model that conforms a single raw table."""

    @model(name, LAYER)
    def build(w: Warehouse) -> DataFrame:
        return silver(w, name, system, table, **spec)


# ---------------------------------------------------------------- CRM objects of one table

simple("sales_account", "sfc", "salesforce.account", foreign={
    "parent_id": "parent_account", "owner_id": "owner", "client_manager_c": "client_manager", "location_c": "location",
    "practice_c": "practice", "rate_card_set_c": "rate_card_set"}, columns={"bln_is_key_account": "grade_c = 'A'"})
simple("sales_account_team_member", "sfc", "salesforce.account_team_member", foreign={"account_id": "account", "user_id": "user"})
simple("sales_contact", "sfc", "salesforce.contact", foreign={"user_c": "user", "account_id": "account", "practice_c": "practice"})
simple("sales_lead", "sfc", "salesforce.lead", foreign={
    "owner_id": "owner", "practice_c": "practice", "location_c": "location", "converted_opportunity_id": "opportunity"})
simple("sales_opportunity_line_item", "sfc", "salesforce.opportunity_line_item", foreign={
    "opportunity_id": "opportunity", "product_2_id": "product", "practice_c": "practice"})
simple("sales_opportunity_team_member", "sfc", "salesforce.opportunity_team_member", foreign={"opportunity_id": "opportunity", "user_id": "user"})
simple("sales_price_book_entry", "sfc", "salesforce.pricebook_entry", foreign={"product_2_id": "product"})
simple("sales_product", "sfc", "salesforce.product_2")
simple("sales_proposal", "sfc", "salesforce.quote", foreign={
    "opportunity_id": "opportunity", "account_id": "account", "owner_id": "owner", "practice_c": "practice", "pse_project_c": "project"})
simple("sales_proposal_line_item", "sfc", "salesforce.quote_line_item", foreign={
    "quote_id": "proposal", "product_2_id": "product", "practice_c": "practice"})
simple("sales_purchase_order", "sfc", "salesforce.purchase_order_c", foreign={"account_c": "account", "opportunity_c": "opportunity"},
       names={"amount_c": "amt_po"})
simple("sales_rate_card_set", "sfc", "salesforce.pse_rate_card_set_c", foreign={"owner_id": "owner"})
simple("sales_user", "sfc", "salesforce.user", foreign={"contact_id": "contact", "delegated_approver_id": "delegated_approver"})
simple("project_task_milestone", "sfc", "salesforce.project_task_milestone_c", foreign={
    "phase_code_c": "milestone", "project_task_c": "project_task", "project_c": "project"})

# ---------------------------------------------------------------- accounting objects of one table

simple("apbill", "int", "sage_intacct.ap_bill", key="recordno", foreign={"entitykey": "entity"})
simple("apbillitem", "int", "sage_intacct.ap_bill_item", key="recordno", foreign={
    "recordkey": "ap_bill", "projectkey": "project", "employeekey": "employee"}, names={
    "lineitem": "bln_line_item", "amount": "amt", "trx_amount": "amt_trx", "departmentid": "department_id", "locationid": "location_id",
    "employeeid": "employee_id"})
simple("cc_transaction", "int", "sage_intacct.cc_transaction", key="recordno", foreign={"entitykey": "entity"})
simple("employee_earning", "ukg", "ukg_pro.earning_history_base_element", key="_fivetran_id", foreign={
    "company_id": "company", "employee_id": "employee", "employment_id": "employment"}, names={
    "base_amount": "amt_base", "current_amount": "amt_current", "current_hours": "hours_current"})
simple("employee_payroll_deductions", "ukg", "ukg_pro.payroll_deduction_history", key="_fivetran_id", foreign={
    "company_id": "company", "employee_id": "employee"}, names={"employee_amount": "amt_employee", "employer_amount": "amt_employer"}, columns={
    "bln_is_cafeteria_plan": "coalesce(is_cafeteria_plan = 'Y', false)", "bln_is_voided": "coalesce(is_voided = 'Y', false)"})


@model("invoice", LAYER)
def invoice(w: Warehouse) -> DataFrame:
    """Blanks become null; flags keep false (a false flag is a value, not a blank)."""
    raw = blanks_to_null(w.source("sage_intacct", "ar_invoice"))
    return conform_by_rule(raw, "int", "invoice", w.as_of, key="recordno", foreign={"megaentitykey": "entity", "customerkey": "customer"},
                           names={"totalentered": "amt_total", "totaldue": "amt_total_due", "totalpaid": "amt_total_paid", "currency": "currency_iso_code", "whenposted": "dte_posted"})


@model("invoice_item", LAYER)
def invoice_item(w: Warehouse) -> DataFrame:
    raw = blanks_to_null(w.source("sage_intacct", "ar_invoice_item"))
    return conform_by_rule(raw, "int", "invoice_item", w.as_of, key="recordno", foreign={
        "recordkey": "invoice", "projectkey": "project", "employeekey": "employee"}, names={
        "amount": "amt", "trx_amount": "amt_trx", "departmentid": "department_id", "locationid": "location_id", "currency": "currency_iso_code"})


@model("cc_transaction_entry", LAYER)
def cc_transaction_entry(w: Warehouse) -> DataFrame:
    """Card lines; the entity is the parent of the line's location, or the location itself."""
    raw = look(w.source("sage_intacct", "cc_transaction_entry"), w.source("sage_intacct", "location"), "locationid", "locationid",
               "parentkey:parent_key recordno:location_record")
    raw = raw.withColumn("entity_key", first_non_null("parent_key", "location_record")).drop("parent_key", "location_record")
    return conform_by_rule(raw, "int", "cc_transaction_entry", w.as_of, key="recordno", foreign={
        "recordkey": "cc_transaction", "projectkey": "project", "employeekey": "employee", "entity_key": "entity"}, names={
        "lineitem": "bln_line_item",
        "amount": "amt", "trx_amount": "amt_trx", "departmentid": "department_id", "locationid": "location_id", "employeeid": "employee_id"})


# ---------------------------------------------------------------- people

@model("employee", LAYER)
def employee(w: Warehouse) -> DataFrame:
    """Persons of payroll, accounting, CRM and portal, linked by the payroll id."""
    pair = ["employee_id", "company_id"]
    emp = w.source("ukg_pro", "employee")

    # rows of people are moved before they are sorted: a task that read them would sort its whole part of a file, which may
    # be any. Without a pair a row belongs to nobody
    changes = {t: w.source("ukg_pro", t).dropna(subset=pair) for t in ("employment", "compensation", "employee_job_history")}
    tasks = tasks_for(reduce(DataFrame.union, [c.select(*[F.col(k).cast("string") for k in pair]) for c in changes.values()]), TASK_BYTES)
    changes = {t: c.repartition(tasks, *pair) if tasks else c.repartition(*pair) for t, c in changes.items()}

    def by_pair(df: DataFrame, dim: DataFrame, take: str) -> DataFrame:
        return look(df, dim, ["id", "company_id"], pair, take)

    employment = latest_per_key(changes["employment"], pair, [F.desc("date_in_job"), F.desc("date_time_created"), F.desc("employment_no")])
    employment = look(employment, w.source("ukg_pro", "job"), "primary_job_id", "id", "title:__title")
    pay = latest_per_key(changes["compensation"], pair, [F.desc("date_in_job"), F.desc("_fivetran_id")])
    by_date = [F.desc("job_effective_date"), F.desc("date_time_created"), F.desc("id")]
    # the last change of pay is found where the last change of all is
    whole = Window.partitionBy(*pair).orderBy(*by_date).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rise = F.max(F.when(F.col("is_rate_change"), F.col("job_effective_date"))).over(whole)
    job = latest_per_key(changes["employee_job_history"].withColumn("__rise", rise), pair, by_date)
    fields = eav_pivot(w.source("ukg_pro", "employment_field_row"), "key_value", "field_name", "field_value", list(CUSTOM_FIELDS))
    fields = fields.withColumnsRenamed(CUSTOM_FIELDS)
    # what has another key comes first, while rows are narrow; then all that has the pair as its key meets at once
    ukg = look(emp, w.source("ukg_pro", "company"), "company_id", "id", "code:company_code currency_code:company_currency")
    ukg = ukg.withColumn("__field_key", composite_key("id", "company_code"))
    ukg = look(ukg, fields, "__field_key", "key_value", " ".join(f"{c}:{c}" for c in CUSTOM_FIELDS.values())).drop("__field_key")
    ukg = by_pair(ukg, employment, "supervisor_id:supervisor_id employee_status_code:status_code original_hire_date:dte_src_start "
                  "last_hire_date:dte_last_hire date_of_termination:dte_src_end employee_type_code:employee_type_id pay_group:payroll_company_id "
                  "salary_or_hourly:pay_type_id full_time_or_part_time_code:dol_status_id primary_work_location_id:location_id_ukg "
                  "primary_job_id:position_id term_reason:termination_type_id __title:job_title")
    ukg = by_pair(ukg, pay, "annual_salary:annual_salary hourly_pay_rate:hourly_pay_rate other_rate_1:other_rate_1 "
                  "other_rate_2:other_rate_2 primary_shift_code:pay_shift job_salary_grade:job_salary_grade currency_code:pay_currency")
    ukg = by_pair(ukg, job, "shift_code:job_shift organization_level_1_id:practice_id organization_level_2_id:department_id "
                  "organization_level_3_id:base_team_id organization_level_4_id:location_id_intacct weekly_pay_rate:weekly_pay_rate "
                  "__rise:dte_pay_last_changed")
    ukg = by_pair(ukg, w.source("ukg_pro", "employee_change"), "date_time_changed:dts_src_modified")
    late = ["company_code", "company_currency", "dts_src_modified", "job_title", *CUSTOM_FIELDS.values()]
    ukg = ukg.select(*[c for c in ukg.columns if c not in late], *late)
    preferred, first, last = "preferred_name", "first_name", "last_name"
    ukg = ukg.withColumns({
        "display_name": display_name(first, last, preferred), "display_name_lf": display_name(first, last, preferred, last_first=True),
        "currency_code": F.upper(first_non_null(blank_to_null("pay_currency"), "company_currency")),
        "shift_code": first_non_null(blank_to_null("pay_shift"), blank_to_null("job_shift")),
        "bln_is_active": F.col("status_code").isin("A", "L", "O"),
    }).drop("pay_currency", "company_currency", "pay_shift", "job_shift")
    parts = [conform_by_rule(ukg, "ukg", "employee", w.as_of, foreign={"company_id": "entity"}, names={
        "gender": "gender_id", "ethnic_description": "ethnic_background_id", "address_state": "state_id", "email_address": "email_address_work"})]

    acc = look(w.source("sage_intacct", "employee"), w.source("sage_intacct", "contact"), "contact_name", "contactname", "email1:email_address_work")
    parts.append(conform_by_rule(acc, "int", "employee", w.as_of, key="recordno", link="ukg_employee_number", foreign={"locationkey": "entity"}, names={
        "employeeid": "intacct_employee_id", "personalinfo_printas": "display_name", "contact_name": "display_name_lf"},
        columns={"intacct_location_key": "locationkey"}))
    crm = look(w.source("salesforce", "contact").filter(F.col("record_type_id") == STAFF), w.source("salesforce", "user"), "user_c", "id", "is_active:user_is_active")
    parts.append(conform_by_rule(crm, "sfc", "employee", w.as_of, link="ukg_employee_id_c", names={
        "user_c": "salesforce_user_id", "name": "display_name", "email": "email_address_work"}))
    portal = w.source("portal", "users")
    parts.append(conform_by_rule(portal, "por", "employee", w.as_of, key="record_id", link="ukg_id", foreign={"entity_id": "entity"},
                                 names={"id": "portal_id", "intacct_employee_id": "por_intacct_employee_id"}))
    # text identifiers differ in type between systems; one layout needs one type
    numeric = {"portal_id", "contractor_company_id", "labor_category_id", "intacct_location_key", "departmentkey", "intacct_employee_record_no"}
    parts = [p.withColumns({c: F.col(c).cast("bigint") for c in numeric if c in p.columns}) for p in parts]
    return stack(*parts)


@model("employee_compensation", LAYER)
def employee_compensation(w: Warehouse) -> DataFrame:
    raw = look(w.source("ukg_pro", "compensation"), w.source("ukg_pro", "company"), "company_id", "id", "code:company_code currency_code:company_currency")
    raw = raw.withColumn("currency_code", first_non_null("currency_code", "company_currency")).drop("company_currency")
    return conform_by_rule(raw, "ukg", "employee_compensation", w.as_of, key="_fivetran_id", foreign={"company_id": "company", "employee_id": "employee"}, columns={
        "key_employee_company": "employee_id || ':' || company_id", "hash_key_employee_company": "md5(employee_id || ':' || company_id)",
        "bln_is_salary": "coalesce(salary_or_hourly_code = 'S', false)", "bln_is_full_time": "coalesce(full_time_or_part_time_code = 'F', false)"})


@model("employee_job_history", LAYER)
def employee_job_history(w: Warehouse) -> DataFrame:
    """Job changes with the pay currency that was valid on the day."""
    jobs = look(w.source("ukg_pro", "employee_job_history"), w.source("ukg_pro", "company"), "company_id", "id", "code:company_code currency_code:company_currency")
    rows = as_of_join(jobs, w.source("ukg_pro", "compensation"), ["employee_id"], "job_effective_date", "date_in_job",
                      {"pay_currency": F.max(F.upper("currency_code"))})
    rows = rows.withColumn("currency_code", first_non_null("pay_currency", F.upper("company_currency"))).drop("pay_currency", "company_currency")
    return conform_by_rule(rows, "ukg", "employee_job_history", w.as_of, foreign={
        "employee_id": "employee", "company_id": "company", "organization_level_1_id": "practice", "organization_level_2_id": "department",
        "organization_level_3_id": "base_team", "organization_level_4_id": "intacct_location"}, columns={
        "key_employee_company": "employee_id || ':' || company_id", "hash_key_employee_company": "md5(employee_id || ':' || company_id)",
        "bln_is_salary": "coalesce(salary_or_hourly = 'S', false)", "bln_is_full_time": "coalesce(full_time_or_part_time = 'F', false)"})


@model("employment_details", LAYER)
def employment_details(w: Warehouse) -> DataFrame:
    """Versions of a person's job: each ends a second before the next one begins."""
    jobs = scd2(w.source("ukg_pro", "employee_job_history"), "employee_id", "date_time_created", ["id"])
    jobs = jobs.withColumnsRenamed({"dts_eff_end": "__end", "bln_current": "__current"}).withColumn("__pair", composite_key("employee_id", "company_id"))
    emp = w.source("ukg_pro", "employment").withColumn("__pair", composite_key("employee_id", "company_id"))
    emp = latest_per_key(emp, ["__pair"], [F.desc("date_in_job"), F.desc("date_time_created"), F.desc("employment_no")])
    rows = look(jobs, emp, "__pair", "__pair", "supervisor_id:supervisor_id employee_status_code:ukg_status original_hire_date:dte_src_start date_of_termination:dte_src_end")
    rows = look(rows, w.source("ukg_pro", "company"), "company_id", "id", "currency_code:currency_code")
    rows = look(rows, w.source("ukg_pro", "job"), "job_id", "id", "title:__title")
    rows = rows.withColumns({"job_title": first_non_null("job_title", "__title"), "bln_is_active": F.col("ukg_status").isin("A", "L", "O"),
                             "__start": F.col("date_time_created")}).drop("__title", "__pair")
    out = conform_by_rule(rows, "ukg", "employment_details", w.as_of, link="employee_id", foreign={"company_id": "entity", "employee_id": "employee"},
                          names={"__end": "__end", "__current": "__current", "__start": "__start"})
    known = {c for c in out.columns if c.endswith(("__end", "__current", "__start"))}
    end, cur, start = (next(c for c in known if c.endswith(x)) for x in ("__end", "__current", "__start"))
    return out.withColumns({"dts_eff_start": F.col(start).cast("timestamp_ntz"), "dts_eff_end": F.col(end), "bln_current": F.col(cur)}).drop(*known)


# ---------------------------------------------------------------- expenses, timesheets

@model("expense", LAYER)
def expense(w: Warehouse) -> DataFrame:
    """Expense reports of accounting and CRM; accounting reports carry the CRM id as link."""
    acc = look(w.source("sage_intacct", "eexpenses"), w.source("sage_intacct", "employee"), "employeeid", "employeeid", "contact_name:employee_name")
    a = conform_by_rule(acc, "int", "expense", w.as_of, key="recordno", link="psa_id", names={"employeeid": "employee_id", "totalentered": "amt_total"})
    crm = look(w.source("salesforce", "pse_expense_report_c"), w.source("salesforce", "contact"), "pse_resource_c", "id", "name:employee_name")
    crm = look(crm, w.source("salesforce", "pse_proj_c"), "pse_project_c", "id", "name:project_name")
    b = conform_by_rule(crm, "sfc", "expense", w.as_of, foreign={"pse_resource_c": "resource", "pse_project_c": "project"},
                        names={"pse_status_c": "state"})
    return stack(a, b)


@model("expenseitem", LAYER)
def expenseitem(w: Warehouse) -> DataFrame:
    acc = w.source("sage_intacct", "eexpenses_item")
    a = conform_by_rule(acc, "int", "expenseitem", w.as_of, key="recordno", link="sfdc_expense_item_id", foreign={
        "recordkey": "expense", "projectkey": "project", "employeekey": "employee"}, names={
        "lineitem": "bln_line_item", "billable": "bln_billable", "amount": "amt", "trx_amount": "amt_trx", "departmentid": "department_id",
        "locationid": "location_id", "employeeid": "employee_id"})
    crm = look(w.source("salesforce", "pse_expense_c"), w.source("salesforce", "pse_expense_report_c"), "pse_expense_report_c", "id",
               "pse_status_c:state pse_project_c:report_project")
    crm = look(crm, w.source("salesforce", "contact"), "pse_resource_c", "id", "name:employee_name")
    crm = look(crm, w.source("salesforce", "pse_proj_c"), "report_project", "id", "name:project_name")
    crm = look(crm, w.source("salesforce", "expense_type_gla_mapping_c"), "gla_mapping_c", "id", "gl_account_c:gl_account_no name:gl_account_title intacct_item_id_c:item_id")
    b = conform_by_rule(crm, "sfc", "expenseitem", w.as_of, foreign={"pse_expense_report_c": "expense", "report_project": "project"},
                        names={"pse_amount_c": "amt_org", "pse_billable_c": "bln_billable"})
    return stack(a, b)


@model("timesheet", LAYER)
def timesheet(w: Warehouse) -> DataFrame:
    """Timesheets of both systems; the link is the person and the sheet's first day."""
    a = conform_by_rule(w.source("sage_intacct", "timesheet"), "int", "timesheet", w.as_of, key="recordno", link="link", foreign={"employeekey": "employee"},
                        names={"begindate": "dte_src_start", "employeeid": "employee_id", "state": "status",
                               "employeelocationid": "employee_location_id", "employeedepartmentid": "employee_department_id"})
    crm = look(w.source("salesforce", "pse_timecard_header_c"), w.source("salesforce", "contact"), "pse_resource_c", "id",
               "name:employee_name ukg_employee_id_c:employee_ukg_id")
    b = conform_by_rule(crm, "sfc", "timesheet", w.as_of, link="link", foreign={"pse_resource_c": "employee"},
                        names={"pse_start_date_c": "dte_src_start", "pse_end_date_c": "dte_src_end", "pse_status_c": "status"})
    return stack(a, b)


@model("timesheet_entry", LAYER)
def timesheet_entry(w: Warehouse) -> DataFrame:
    """Time entries. Accounting: latest row per business key, with the bill rate of the project, person and item that
    was valid on the day, else the rate without item. CRM: week sheets turned into a row per day."""
    sheets = w.source("sage_intacct", "timesheet").select(F.col("recordno").alias("timesheetkey"))
    rows = w.source("sage_intacct", "timesheetentry").join(sheets, "timesheetkey", "left_semi")
    rows = latest_per_key(rows, ["projectid", "employeeid", "entrydate", "taskkey"], [F.desc("whenmodified"), F.desc("recordno")])

    people = w.source("portal", "users").select(F.col("id").alias("user_id"), F.col("intacct_employee_record_no").alias("employeekey"))
    projects = w.source("psatools", "projects").select(F.col("id").alias("project_id"), F.col("int_record_no").alias("projectkey"))
    own = w.source("psatools", "project_personnel_exceptions").join(people, "user_id", "left").join(projects, "project_id", "left")
    own = look(own, w.source("sage_intacct", "item"), "item_id", "itemid", "recordno:itemkey")
    cols = ["projectkey", "employeekey", "itemkey", "startdate", "billingrate"]
    own = own.select("projectkey", "employeekey", "itemkey", F.col("effective_date").alias("startdate"), F.col("rate").alias("billingrate"))
    agreed = w.source("sage_intacct", "project_resources").select(*cols)
    agreed, own = (look(r, w.source("sage_intacct", "project"), "projectkey", "recordno", "currency:rate_currency")
                   for r in (agreed.withColumn("itemkey", F.col("itemkey").cast("bigint")), own))
    # rates are dealt by project and person once, which serves all that is made of them and the entries' only join with them
    pair = ["projectkey", "employeedimkey"]
    rates = stack_distinct(*[r.withColumnRenamed("employeekey", "employeedimkey") for r in (agreed, own)], dealt_by=pair)
    rates = rates.withColumn("startdate", F.coalesce("startdate", F.lit("1900-01-01").cast("date"))).withColumnRenamed("itemkey", "__item")

    # both rates are looked up on the way; the one without item only counts where there is none with the item
    facts = rows.withColumn("__item", F.col("itemkey").cast("bigint"))
    priced = parted_as_of_join(facts, rates, pair, "__item", "entrydate", "startdate", {"rate": F.max(F.struct("billingrate", "rate_currency"))}, "item_")
    priced = priced.withColumns({
        "rate_match": F.when(F.col("item_rate").isNotNull(), "specific").when(F.col("rate").isNotNull(), "generic").otherwise("none"),
        "rate": F.coalesce("item_rate", "rate")})
    priced = priced.select(*rows.columns, "rate.billingrate", "rate.rate_currency", "rate_match")
    a = conform_by_rule(priced, "int", "timesheet_entry", w.as_of, key="recordno", link="salesforce_id", foreign={
        "timesheetkey": "timesheet", "projectkey": "project", "employeedimkey": "employee"}, names={
        "billingrate": "bill_rate", "rate_currency": "currency_iso_code", "entrydate": "dte_entry", "billable": "bln_billable", "taskname": "task_name",
        "taskkey": "task_key", "locationkey": "location_key", "employeeid": "employee_id_intacct", "departmentid": "department_id", "locationid": "location_id"})

    week = w.source("salesforce", "pse_task_time_c").join(
        w.source("salesforce", "pse_timecard_header_c").select(F.col("id").alias("pse_timecard_c"), "pse_resource_c"), "pse_timecard_c", "inner")
    days = unpivot_week(week, "pse_start_date_c", WEEK_HOURS)
    task = look(days, w.source("salesforce", "pse_project_task_c"), "pse_project_task_c", "id", "pse_project_c:project_sfc")
    b = conform_by_rule(task, "sfc", "timesheet_entry", w.as_of, key="id || '-' || date_format(dte_entry, 'yyyyMMdd')", foreign={
        "pse_timecard_c": "timesheet", "project_sfc": "project", "pse_resource_c": "employee"},
        names={"id": "task_time_id", "dte_entry": "dte_entry", "phase_code_name_c": "task_name"})
    return stack(a, b)


# ---------------------------------------------------------------- projects, planning

@model("estimates_vs_actuals", LAYER)
def estimates_vs_actuals(w: Warehouse) -> DataFrame:
    """Planned hours with the assignment's bill rate, else the resource request's."""
    rows = look(w.source("salesforce", "pse_est_vs_actuals_c"), w.source("salesforce", "pse_assignment_c"), "pse_assignment_c", "id",
                "pse_schedule_c:schedule pse_bill_rate_c:assignment_rate currency_iso_code:assignment_currency pse_exclude_from_planners_c:bln_exclude_from_planners")
    rows = look(rows, w.source("salesforce", "pse_resource_request_c"), "pse_resource_request_c", "id", "id:opportunity")
    return conform_by_rule(rows, "sfc", "estimates_vs_actuals", w.as_of, foreign={
        "pse_assignment_c": "assignment", "schedule": "schedule", "pse_project_c": "project", "pse_resource_request_c": "resource_request",
        "pse_resource_c": "resource", "opportunity": "opportunity"}, names={
        "pse_start_date_c": "dte_start", "pse_end_date_c": "dte_end", "pse_estimated_hours_c": "planned_hours"}, columns={
        "currency_iso_code_bill_rate": "coalesce(assignment_currency, currency_iso_code)",
        "planned_bill_rate": "coalesce(assignment_rate, pse_resource_request_bill_rate_c)",
        "planned_bill_amount": "cast(coalesce(assignment_rate, pse_resource_request_bill_rate_c) * pse_estimated_hours_c as decimal(18,2))"})


@model("project", LAYER)
def project(w: Warehouse) -> DataFrame:
    """Projects of accounting, project tool and CRM, linked by the accounting record."""
    acc = look(blanks_to_null(w.source("sage_intacct", "project")), w.source("sage_intacct", "location"), "locationid", "locationid", "parentkey:entity_parent recordno:entity_own")
    acc = acc.withColumn("entity", first_non_null("entity_parent", "entity_own")).drop("entity_parent", "entity_own")
    a = conform_by_rule(acc, "int", "project", w.as_of, key="recordno", foreign={"entity": "entity"}, names={
        "projectid": "project_id", "managerid": "project_manager_id", "departmentid": "department_id", "locationid": "location_id",
        "locationkey": "project_location_key", "currency": "currency_iso_code", "po_amount": "amt_po", "projecttype": "project_type", "begindate": "dte_src_start"})
    b = conform_by_rule(w.source("psatools", "projects"), "psa", "project", w.as_of, link="int_record_no", names={"int_project_id": "project_id"})
    crm = look(w.source("salesforce", "pse_proj_c"), w.source("salesforce", "account"), "pse_account_c", "id", "name:account_name client_manager_c:client_manager_id")
    crm = look(crm, w.source("salesforce", "opportunity"), "pse_opportunity_c", "id", "name:opportunity_name")
    crm = look(crm, w.source("salesforce", "contact"), "pse_project_manager_c", "id", "name:project_manager_name")
    crm = look(crm, w.source("salesforce", "pse_practice_c"), "pse_practice_c", "id", "name:practice_name")
    crm = look(crm, w.source("salesforce", "pse_grp_c"), "pse_group_c", "id", "name:group_name")
    c = conform_by_rule(crm, "sfc", "project", w.as_of, link="intacct_record_no_c", names={
        "pse_account_c": "account_id", "pse_group_c": "group_id", "pse_practice_c": "practice_id"})
    return stack(a, b, c)


@model("project_phase_code", LAYER)
def project_phase_code(w: Warehouse) -> DataFrame:
    """Phase codes of four tables; equal rows are merged. CRM tasks without accounting task have no link."""
    name = "project_phase_code"
    a = conform_by_rule(w.source("sage_intacct", "task"), "int", name, w.as_of, key="recordno", link="sfdc_milestone_id", foreign={"projectkey": "project"})
    b = conform_by_rule(w.source("salesforce", "pse_milestone_c"), "sfc_milestones", name, w.as_of, foreign={
        "pse_project_c": "project", "pse_approver_c": "approver", "practice_area_c": "practice_area"})
    c = conform_by_rule(w.source("salesforce", "pse_project_task_c").filter(~F.col("is_project_task_c")).drop("original_proposal_budget_c", "original_proposal_hrs_or_units_c"),
                        "sfc_project_task", name, w.as_of, link="pse_milestone_c", foreign={"pse_project_c": "project"}, columns={"key_milestone": "pse_milestone_c"})
    d = conform_by_rule(w.source("psatools", "projects_phase_codes"), "pts", name, w.as_of, link="milestone_id", foreign={"project_id": "project"})
    return stack_distinct(a, b, c, d)


@model("project_task", LAYER)
def project_task(w: Warehouse) -> DataFrame:
    raw = w.source("salesforce", "pse_project_task_c").filter("is_project_task_c").withColumn(
        "rate_original", safe_ratio("original_proposal_budget_c", "original_proposal_hrs_or_units_c").cast("decimal(18,6)"))
    return conform_by_rule(raw, "sfc", "project_task", w.as_of, foreign={
        "proposal_c": "proposal", "pse_milestone_c": "phase_code", "pse_project_c": "project"}, names={
        "original_proposal_budget_c": "budget_original", "original_proposal_hrs_or_units_c": "hours_original"})


@model("sales_opportunity", LAYER)
def sales_opportunity(w: Warehouse) -> DataFrame:
    raw = w.source("salesforce", "opportunity")
    rows = look(raw, raw, "parent_opportunity_c", "id", "name:parent_name")
    return conform_by_rule(rows, "sfc", "sales_opportunity", w.as_of, foreign={
        "parent_opportunity_c": "parent_opportunity", "account_id": "account", "owner_id": "owner", "practice_c": "practice", "location_c": "location", "pse_project_c": "project"},
        names={"amount": "amt"})


@model("sales_rate_card", LAYER)
def sales_rate_card(w: Warehouse) -> DataFrame:
    cards = w.source("salesforce", "pse_rate_card_c")
    pairs = w.source("salesforce", "pse_rate_card_set_junction_c").select(F.col("pse_rate_card_c").alias("id"), "pse_rate_card_set_c")
    return conform_by_rule(cards.join(pairs, "id", "inner"), "sfc", "sales_rate_card", w.as_of, foreign={
        "owner_id": "owner", "pse_rate_card_set_c": "rate_card_set", "pse_practice_c": "practice", "pse_account_c": "account", "pse_region_c": "location"},
        names={"pse_suggested_bill_rate_c": "rate_suggested"})
