"""Gold views: projections, pay history, targets, missing and unapproved timesheets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverloom.functions.text import flag, label, norm_currency
from silverloom.models.core import Warehouse, look, model
from silverloom.models.gold import as_money, money_in, portal
from silverloom.operators import joins, reporting, rollup
from silverloom.operators.stack import blanks_to_null, fill_defaults
from silverloom.sources.tables import spread_lookup

LAYER = "dataconsumption"
# Change reasons that always count as a pay change, and the state of an approved sheet.
PAY_REASONS = ["101", "100"]
APPROVED = "Approved"
# Employee types whose people write no sheets.
NO_SHEETS = ["1814354", "1814355", "474084", "1815351", "1833005", "1833006", "1143543"]


def view(name: str):
    return model(name, LAYER, "view")


@view("vw_employee_pay_history")
def vw_employee_pay_history(w: Warehouse) -> DataFrame:
    """Pay as validity ranges. Of several changes of a day the one created last counts; snapshots stand in for people of a
    company without any change that counts."""
    hourly = F.col("hourly_pay_rate_usd")
    jobs = w.ref("dim_employee_job_history").select(
        F.col("key_employee").alias("person_id"), "key_employee_company", F.col("dte_job_effective").alias("dte_effective"),
        F.struct("dts_src_created", "key").alias("change_id"), F.col("annual_salary_usd").alias("salary"), hourly, "shift_code", "percent_change",
        F.col("bln_is_rate_change").alias("bln_rate_change"), "reason_code")
    paid = w.ref("dim_employee_compensation").select(
        F.col("key_employee").alias("person_id"), "key_employee_company", F.col("dte_in_job").alias("dte_effective"), F.col("annual_salary_usd").alias("salary"), hourly)
    out = reporting.pay_history(jobs, paid, PAY_REASONS, ["key_employee_company"], ["hourly_pay_rate_usd"]).withColumnsRenamed({
        "person_id": "key_employee", "dte_effective": "dte_job_effective", "salary": "annual_salary_usd"})
    return look(out, w.system("employee", "ukg"), "key_employee", "key",
                "display_name:employee_name display_name_lf:employee_name_lf email_address_work:employee_email status_code:status")


@view("vw_employee_targets")
def vw_employee_targets(w: Warehouse) -> DataFrame:
    weeks = w.ref("dim_timesheet_entry_aggregates").filter("entity_grouping = 'Employee' AND type = 'Billable' AND date_group_type_id = 'W'")
    weeks = weeks.select("ukg_employee_number", F.to_date(F.substring("date_group_id", 2, 10)).alias("week_start"), "hours", "planned_hours_billable")
    return rollup.attainment(weeks, ["ukg_employee_number"], "week_start", "hours", "planned_hours_billable", w.as_of)


@view("vw_estimate_phase_code_products")
def vw_estimate_phase_code_products(w: Warehouse) -> DataFrame:
    """Estimated phase codes of proposals, once for each billable standard code and product that the code is linked to.

    Cost is converted at the day of the internal approval, else of the submission, else of the close.
    """
    out = look(w.source("psatools", "estimatetotals_phasecodes"), w.source("psatools", "estimatetotals"), "estimatetotalid", "estimatetotalid", "estimateid:key_estimate")
    out = out.withColumnsRenamed({"recordid": "key", "estimatetotalid": "key_estimate_total", "name": "phase_code"}).join(
        w.source("psatools", "estimate").select(F.col("estimateid").alias("key_estimate"), "sfproposalid", "currencyid"), "key_estimate")
    out = look(out, w.source("psatools", "currency"), "currencyid", "currencyid", "code:currency_iso_code")
    out = out.join(w.ref("dim_sales_proposal").select(
        F.col("key").alias("key_proposal"), F.col("name").alias("proposal_name"), F.col("quote_number").alias("proposal_number"), "key_opportunity", "key_project",
        "project_id", "project_name", "dte_internal_approval", F.col("status").alias("proposal_status")), F.col("sfproposalid") == F.col("key_proposal"))
    out = look(out, w.ref("dim_sales_opportunity"), "key_opportunity", "key",
               "key_account:key_account key_location:key_location location_name:location_name key_practice:key_practice practice_name:practice_name name:opportunity_name "
               "stage_name:opportunity_status contract_type:contract_type dte_proposal_submitted:dte_proposal_submitted dte_close:dte_close")
    out = look(out, w.ref("dim_sales_account"), "key_account", "key",
               "name:client_site_name key_top_level_parent_account:key_top_level_parent_account top_level_parent_account_name:client_name")
    billable = w.source("psatools", "standard_phase_codes").filter("bln_is_billable").select(F.col("id").alias("standard_phase_code_id"), F.col("product_id").alias("product"))
    links = w.source("psatools", "standard_phase_codes_product_links").select("phase_code", "standard_phase_code_id")
    # both are short lists; a code holds a large share of the lines, so those are dealt by code and a salt
    codes = links.join(billable, "standard_phase_code_id").groupBy("phase_code").agg(F.collect_list(F.struct("standard_phase_code_id", "product")).alias("__links"))
    out = spread_lookup(out, codes, ["phase_code"]).withColumn("__link", F.explode_outer("__links"))
    out = out.withColumns({
        "standard_phase_code": F.coalesce("__link.standard_phase_code_id", F.lit("OTHER")), "product": F.coalesce("__link.product", F.lit("Regular Labor Sales")),
        "cost_original": F.col("budget").cast("decimal(18,2)"), "dte_currency_conversion": F.coalesce("dte_internal_approval", "dte_proposal_submitted", "dte_close")})
    out = money_in(out.withColumn("cost", F.col("cost_original")), w, ["cost"], norm_currency("currency_iso_code"), {"usd": F.lit("USD")}, "dte_currency_conversion")
    return out.drop("__links", "__link", "sfproposalid", "currencyid", "budget", "cost")


@view("vw_finance_customers")
def vw_finance_customers(w: Warehouse) -> DataFrame:
    out = blanks_to_null(w.source("sage_intacct", "customer")).withColumn("bln_on_hold", flag("onhold", "T")).drop("onhold")
    return out.withColumnsRenamed({"recordno": "key", "customerid": "customer_id", "totaldue": "amt_total_due"})


@view("vw_finance_gl_accounts")
def vw_finance_gl_accounts(w: Warehouse) -> DataFrame:
    out = fill_defaults(blanks_to_null(w.source("sage_intacct_gl", "gl_account")), {"requiredept": False})
    return out.withColumnsRenamed({"recordno": "key", "accountno": "account_no", "requiredept": "bln_require_department"})


@view("vw_finance_locations")
def vw_finance_locations(w: Warehouse) -> DataFrame:
    # The accounting system's location types.
    out = blanks_to_null(w.source("sage_intacct", "location")).withColumn(
        "location_type", label("locationtype", {"C": "Location", "E": "Entity", "N": "Non-Active"})).drop("locationtype")
    return out.withColumnsRenamed({"recordno": "key", "locationid": "location_id", "parentkey": "key_parent"})


@view("vw_phase_code_products")
def vw_phase_code_products(w: Warehouse) -> DataFrame:
    return w.source("psatools", "phase_code_families").select(F.col("id").alias("key"), F.col("name").alias("family_name"))


@view("vw_phase_code_products_links")
def vw_phase_code_products_links(w: Warehouse) -> DataFrame:
    """Links between codes and products with who made and who checked them."""
    links = w.source("psatools", "standard_phase_codes_product_links")
    return joins.role_join(links, portal(w, "users").withColumn("id", F.col("id").cast("int")), "id", {"display_name": "name"},
                           {"creator": "created_by", "verifier": "verified_by"})


def _sheet_people(df: DataFrame, w: Warehouse) -> DataFrame:
    """The person of a sheet with supervisor, regional manager, and the places and dates of the person."""
    out = look(df, w.ref("dim_employee"), "key_employee", "key",
               "key:key_employee display_name:employee_name display_name_lf:employee_name_lf email_address_work:employee_email intacct_employee_id:intacct_id key_supervisor:key_supervisor "
               "supervisor_name:supervisor_name supervisor_name_lf:supervisor_name_lf supervisor_email:supervisor_email key_entity:key_entity entity_name:entity_name key_region:key_region region_name:region_name "
               "key_location:key_location location_name:location_name key_department:key_department department_name:department_name key_employee_type:key_employee_type "
               "employee_type_name:employee_type_name dte_src_start:dte_original_hire_date dte_last_hire:dte_last_hire_date dte_src_end:dte_termination_date")
    regions = look(portal(w, "location_regions").withColumn("__user", F.col("regional_manager_user_id").cast("string")), w.system("employee", "por"), "__user", "key", "link:__person")
    regions = look(regions, w.ref("dim_employee"), "__person", "key", "display_name:manager_name display_name_lf:manager_name_lf email_address_work:manager_email")
    return look(out, regions, "key_region", "record_id", "record_id:key_region regional_manager_user_id:regional_manager_user_id manager_name:regional_manager_name "
                "manager_name_lf:regional_manager_name_lf manager_email:regional_manager_email")


@view("vw_timesheet_missing")
def vw_timesheet_missing(w: Warehouse) -> DataFrame:
    """Weeks between a person's hire and leave for which no sheet exists, or only one without a state, with its hours.

    People whose type writes no sheets, and people without a type, are not expected to have any.
    """
    kind = F.lower("key_employee_type")
    who = w.ref("dim_employee").filter(kind.isNotNull() & ~kind.isin(NO_SHEETS)).select(F.col("key").alias("key_employee"), "dte_last_hire", "dte_src_end")
    due = joins.expected_periods(who, "dte_last_hire", "dte_src_end", w.first_week, w.as_of).select("key_employee", "week_start", "week_end")
    sheets = w.ref("dim_timesheet").select(F.col("key").alias("key_timesheet"), F.col("key_employee_ukg").alias("key_employee"), F.col("dte_src_start").alias("week_start"), "status")
    open_sheets = sheets.filter("status IS NULL")
    hours = w.ref("dim_timesheet_entry").join(open_sheets.select("key_timesheet"), "key_timesheet", "left_semi").groupBy("key_timesheet").agg(F.sum("qty").alias("qty"))
    out = due.join(sheets, ["key_employee", "week_start"], "left").filter("status IS NULL")
    out = look(out, hours, "key_timesheet", "key_timesheet", "key_timesheet:__sheet qty:qty").drop("__sheet")
    out = out.withColumnsRenamed({"week_start": "timesheet_start_date", "week_end": "timesheet_end_date"}).withColumn("qty", F.coalesce("qty", F.lit(0)).cast("decimal(18,2)"))
    return _sheet_people(out, w)


@view("vw_timesheet_unapproved")
def vw_timesheet_unapproved(w: Warehouse) -> DataFrame:
    """CRM sheets that are not yet approved, with their hours; the name of the sheet stands in for people unknown to payroll."""
    sheets = w.system("timesheet", "sfc").filter(F.col("status") != APPROVED).select(
        F.col("key").alias("key_timesheet"), F.col("key_employee").alias("__contact"), F.col("employee_name").alias("__name"),
        F.col("dte_src_start").alias("timesheet_start_date"), F.col("dte_src_end").alias("timesheet_end_date"), F.col("status").alias("timesheet_status"))
    hours = w.system("timesheet_entry", "sfc").groupBy("key_timesheet").agg(F.sum("qty").cast("decimal(18,2)").alias("qty"))
    out = look(sheets.withColumn("__sheet", F.col("key_timesheet")), hours, "__sheet", "key_timesheet", "qty:qty").drop("__sheet")
    out = _sheet_people(look(out, w.system("employee", "sfc"), "__contact", "key", "link:key_employee"), w)
    return out.withColumns({"employee_name": F.coalesce("employee_name", "__name"), "employee_name_lf": F.coalesce("employee_name_lf", "__name")}).drop("__contact", "__name")
