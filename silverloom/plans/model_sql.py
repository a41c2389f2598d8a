"""SQL of warehouse models over the test tables, written apart from the models, for comparison in DuckDB.

Column lists lean on DuckDB's star modifiers: EXCLUDE, REPLACE and RENAME.
"""

from __future__ import annotations

from silverloom.plans.relations import _CUBE
from silverloom.models.core import deletion_flags
from silverloom.sources import raw

#: Raw tables without the rows that the loader has marked as deleted.
RAW_TABLES = {t: f"SELECT * FROM ({text}) WHERE NOT _fivetran_deleted" if "AS _fivetran_deleted" in text else text for t, text in raw.RAW_TABLES.items()}


def live(model: str, table: str) -> str:
    """A raw table without the rows that are deleted for the model."""
    flags = [f for f in deletion_flags(model, table) if f"AS {f}" in raw.RAW_TABLES[table]]
    return f"SELECT * FROM ({raw.RAW_TABLES[table]})" + (f" WHERE {' AND '.join(f'NOT {f}' for f in flags)}" if flags else "")


STAMP = "TIMESTAMP '2001-08-01 00:00:00'"
SF_AUDIT = {"created_by_id": "src_created_by_id", "last_modified_by_id": "src_modified_by_id", "created_date": "dts_src_created",
            "last_modified_date": "dts_src_modified", "system_modstamp": "dts_system_modstamp"}
INT_AUDIT = {"whencreated": "dts_src_created", "whenmodified": "dts_src_modified"}


def envelope(system: str, model: str) -> str:
    return (f"'{system}' AS src_sys_key, {STAMP} AS dts_created_at, '{model}' AS created_by, {STAMP} AS dts_updated_at, '{model}' AS updated_by, "
            f"{STAMP} AS dts_eff_start, TIMESTAMP '9999-12-31 00:00:00' AS dts_eff_end, TRUE AS bln_current")


def audit(model: str) -> str:
    return f"{STAMP} AS dts_created_at, '{model}' AS created_by, {STAMP} AS dts_updated_at, '{model}' AS updated_by"


GOLD_DROP = "src_sys_key, dts_created_at, created_by, dts_updated_at, updated_by, dts_eff_start, dts_eff_end, bln_current"


def silver(name: str, system: str, table: str, key: str, foreign: dict[str, str], rename: dict[str, str], doubles: tuple[str, ...] = (),
           extra: str = "", drop: tuple[str, ...] = (), frm: str | None = None, link: str | None = None) -> str:
    """SELECT of one conformed table: envelope, keys and hashes, then the renamed rest."""
    sf = table.startswith("salesforce")
    rename = {**(SF_AUDIT if sf else {}), **rename}
    text = lambda c: f"CAST({c} AS STRING)"
    cols = [envelope(system, name), f"{text(key)} AS key, md5({text(key)}) AS hash_key, {text(link or key)} AS link, md5({text(link or key)}) AS hash_link"]
    cols += [f"{text(c)} AS key_{e}, md5({text(c)}) AS hash_key_{e}" for c, e in foreign.items()]
    if extra:
        cols.append(extra)
    for d in [d for d in doubles if d in rename]:
        cols.append(f"CAST({d} AS DOUBLE) AS {rename.pop(d)}")
        drop = (*drop, d)
    doubles = tuple(d for d in doubles if d not in drop)
    gone = [key, *foreign, *drop, "_fivetran_deleted"] + (["is_deleted"] if sf else [])
    star = f"* EXCLUDE ({', '.join(dict.fromkeys(gone))})"
    if doubles:
        star += f" REPLACE ({', '.join(f'CAST({d} AS DOUBLE) AS {d}' for d in doubles)})"
    if rename:
        star += f" RENAME ({', '.join(f'{a} AS {b}' for a, b in rename.items())})"
    return f"SELECT {', '.join(cols)}, {star} FROM ({frm or live(name, table)}) r"


def _models() -> dict[str, str]:
    s = "salesforce."
    out = {
        "sales_account": silver("sales_account", "sfc", s + "account", "id", {
            "parent_id": "parent_account", "owner_id": "owner", "client_manager_c": "client_manager", "location_c": "location", "practice_c": "practice",
            "rate_card_set_c": "rate_card_set"}, {"grade_c": "grade", "payment_terms_c": "payment_terms"}, ("annual_revenue",), "grade_c = 'A' AS bln_is_key_account"),
        "sales_account_team_member": silver("sales_account_team_member", "sfc", s + "account_team_member", "id", {"account_id": "account", "user_id": "user"}, {}),
        "sales_contact": silver("sales_contact", "sfc", s + "contact", "id", {"user_c": "user", "account_id": "account", "practice_c": "practice"},
                                {"ukg_employee_id_c": "ukg_employee_id"}),
        "sales_lead": silver("sales_lead", "sfc", s + "lead", "id", {"owner_id": "owner", "practice_c": "practice", "location_c": "location",
                                                                     "converted_opportunity_id": "opportunity"}, {}),
        "sales_opportunity_line_item": silver("sales_opportunity_line_item", "sfc", s + "opportunity_line_item", "id", {
            "opportunity_id": "opportunity", "product_2_id": "product", "practice_c": "practice"}, {}, ("quantity", "total_price", "list_price")),
        "sales_opportunity_team_member": silver("sales_opportunity_team_member", "sfc", s + "opportunity_team_member", "id",
                                                {"opportunity_id": "opportunity", "user_id": "user"}, {}),
        "sales_price_book_entry": silver("sales_price_book_entry", "sfc", s + "pricebook_entry", "id", {"product_2_id": "product"}, {}, ("unit_price",)),
        "sales_product": silver("sales_product", "sfc", s + "product_2", "id", {}, {"is_active": "bln_is_active"}),
        "sales_proposal": silver("sales_proposal", "sfc", s + "quote", "id", {"opportunity_id": "opportunity", "account_id": "account", "owner_id": "owner", "practice_c": "practice", "pse_project_c": "project"},
                                 {"internal_approval_date_c": "dte_internal_approval", **{f"approver_{i}_c": f"approver_{i}" for i in range(1, 11)}, **{f"reviewer_{i}_c": f"reviewer_{i}" for i in range(1, 6)}}),
        "sales_proposal_line_item": silver("sales_proposal_line_item", "sfc", s + "quote_line_item", "id", {
            "quote_id": "proposal", "product_2_id": "product", "practice_c": "practice"}, {},
            ("quantity", "total_price", "list_price", "total_price_location", "total_price_opportunity", "unit_price")),
        "sales_purchase_order": silver("sales_purchase_order", "sfc", s + "purchase_order_c", "id", {"account_c": "account", "opportunity_c": "opportunity"},
                                       {"amount_c": "amt_po", "received_date_c": "dte_received"}, ("amount_c",)),
        "sales_rate_card_set": silver("sales_rate_card_set", "sfc", s + "pse_rate_card_set_c", "id", {"owner_id": "owner"}, {}),
        "sales_user": silver("sales_user", "sfc", s + "user", "id", {"contact_id": "contact", "delegated_approver_id": "delegated_approver"}, {"ukg_employee_id_c": "ukg_employee_id", "is_active": "bln_is_active"}),
        "sales_rate_card": silver("sales_rate_card", "sfc", s + "pse_rate_card_c", "id", {
            "owner_id": "owner", "pse_rate_card_set_c": "rate_card_set", "pse_practice_c": "practice", "pse_account_c": "account", "pse_region_c": "location"},
            {"pse_suggested_bill_rate_c": "rate_suggested", "pse_start_date_c": "dte_start"}, ("pse_suggested_bill_rate_c",),
            frm=f"SELECT c.*, j.pse_rate_card_set_c FROM ({RAW_TABLES[s + 'pse_rate_card_c']}) c JOIN ({RAW_TABLES[s + 'pse_rate_card_set_junction_c']}) j ON j.pse_rate_card_c = c.id"),
        "sales_opportunity": silver("sales_opportunity", "sfc", s + "opportunity", "id", {
            "parent_opportunity_c": "parent_opportunity", "account_id": "account", "owner_id": "owner", "practice_c": "practice", "location_c": "location", "pse_project_c": "project"},
            {"amount": "amt", "close_date": "dte_close", "contract_type_c": "contract_type", "proposal_submitted_date_c": "dte_proposal_submitted"}, ("amount",),
            frm=f"SELECT a.*, b.name AS parent_name FROM ({RAW_TABLES[s + 'opportunity']}) a LEFT JOIN ({RAW_TABLES[s + 'opportunity']}) b ON a.parent_opportunity_c = b.id"),
        "project_task_milestone": silver("project_task_milestone", "sfc", s + "project_task_milestone_c", "id", {
            "project_task_c": "project_task", "phase_code_c": "milestone", "project_c": "project"},
            {"earned_value_c": "earned_value", "milestone_date_c": "dte_milestone"}, ("earned_value_c",)),
        "project_task": silver("project_task", "sfc", s + "pse_project_task_c", "id", {"proposal_c": "proposal", "pse_milestone_c": "phase_code", "pse_project_c": "project"},
                               {"original_proposal_budget_c": "budget_original", "original_proposal_hrs_or_units_c": "hours_original", "is_project_task_c": "bln_is_project_task"},
                               ("original_proposal_budget_c", "original_proposal_hrs_or_units_c"),
                               "CASE WHEN coalesce(original_proposal_hrs_or_units_c, 0) = 0 THEN 0.0 ELSE CAST(CAST(CAST(original_proposal_budget_c AS DOUBLE) / CAST(original_proposal_hrs_or_units_c AS DOUBLE) AS DECIMAL(18,6)) AS DOUBLE) END AS rate_original",
                               frm=f"SELECT * FROM ({RAW_TABLES[s + 'pse_project_task_c']}) t WHERE is_project_task_c"),
        "estimates_vs_actuals": silver("estimates_vs_actuals", "sfc", s + "pse_est_vs_actuals_c", "id", {
            "pse_assignment_c": "assignment", "schedule": "schedule", "pse_project_c": "project", "pse_resource_request_c": "resource_request",
            "pse_resource_c": "resource", "opportunity": "opportunity"},
            {"pse_start_date_c": "dte_start", "pse_end_date_c": "dte_end", "pse_estimated_hours_c": "planned_hours", "pse_resource_request_bill_rate_c": "resource_request_bill_rate"},
            ("pse_estimated_hours_c", "pse_resource_request_bill_rate_c", "assignment_rate"),
            "coalesce(assignment_currency, currency_iso_code) AS currency_iso_code_bill_rate, CAST(coalesce(assignment_rate, pse_resource_request_bill_rate_c) AS DOUBLE) AS planned_bill_rate, "
            "CAST(coalesce(assignment_rate, pse_resource_request_bill_rate_c) * pse_estimated_hours_c AS DOUBLE) AS planned_bill_amount",
            frm=f"SELECT e.*, a.pse_schedule_c AS schedule, a.pse_bill_rate_c AS assignment_rate, a.currency_iso_code AS assignment_currency, a.pse_exclude_from_planners_c AS bln_exclude_from_planners, q.id AS opportunity "
                f"FROM ({live('estimates_vs_actuals', s + 'pse_est_vs_actuals_c')}) e LEFT JOIN ({live('estimates_vs_actuals', s + 'pse_assignment_c')}) a ON e.pse_assignment_c = a.id LEFT JOIN ({live('estimates_vs_actuals', s + 'pse_resource_request_c')}) q ON e.pse_resource_request_c = q.id"),
    }
    i = "sage_intacct."
    head = {**INT_AUDIT, "whenposted": "dte_whenposted"}
    line = {**INT_AUDIT, "lineitem": "bln_line_item", "amount": "amt", "trx_amount": "amt_trx", "departmentid": "department_id", "locationid": "location_id",
            "entry_date": "dte_entry", "billable": "bln_billable"}
    out |= {
        "apbill": silver("apbill", "int", i + "ap_bill", "recordno", {"entitykey": "entity"}, head, ("totalentered",)),
        "cc_transaction": silver("cc_transaction", "int", i + "cc_transaction", "recordno", {"entitykey": "entity"}, head, ("totalentered",)),
        "invoice": silver("invoice", "int", i + "ar_invoice", "recordno", {"megaentitykey": "entity", "customerkey": "customer"},
                          {**INT_AUDIT, "totalentered": "amt_total", "totaldue": "amt_total_due", "totalpaid": "amt_total_paid", "exch_rate_date": "dte_exch_rate", "whenposted": "dte_posted"},
                          ("totalentered", "totaldue", "totalpaid"),
                          "NULLIF(currency, '') AS currency_iso_code, NULLIF(description, '') AS description", ("currency", "description")),
        "invoice_item": silver("invoice_item", "int", i + "ar_invoice_item", "recordno", {"recordkey": "invoice", "projectkey": "project", "employeekey": "employee"},
                               {**{k: v for k, v in line.items() if k != "lineitem"}, "lineitem": "bln_lineitem", "employeeid": "employeeid_"}, ("amount", "trx_amount"),
                               "NULLIF(currency, '') AS currency_iso_code, NULLIF(memo, '') AS memo", ("currency", "memo")).replace(", employeeid AS employeeid_", ""),
        "apbillitem": silver("apbillitem", "int", i + "ap_bill_item", "recordno", {"recordkey": "ap_bill", "projectkey": "project", "employeekey": "employee"},
                             {**line, "employeeid": "employee_id"}, ("amount", "trx_amount")),
        "cc_transaction_entry": silver("cc_transaction_entry", "int", i + "cc_transaction_entry", "recordno", {
            "recordkey": "cc_transaction", "projectkey": "project", "employeekey": "employee", "entity_key": "entity"}, {**line, "employeeid": "employee_id"}, ("amount", "trx_amount"),
            frm=f"SELECT c.*, coalesce(l.parentkey, l.recordno) AS entity_key FROM ({RAW_TABLES[i + 'cc_transaction_entry']}) c LEFT JOIN ({RAW_TABLES[i + 'location']}) l ON c.locationid = l.locationid"),
        "employee_earning": silver("employee_earning", "ukg", "ukg_pro.earning_history_base_element", "_fivetran_id", {
            "company_id": "company", "employee_id": "employee", "employment_id": "employment"},
            {"current_amount": "amt_current", "base_amount": "amt_base", "current_hours": "hours_current", "pay_date": "dte_pay", "is_voided": "bln_is_voided"},
            ("current_amount", "base_amount", "current_hours")),
        "employee_payroll_deductions": silver("employee_payroll_deductions", "ukg", "ukg_pro.payroll_deduction_history", "_fivetran_id", {
            "company_id": "company", "employee_id": "employee"}, {"employee_amount": "amt_employee", "employer_amount": "amt_employer", "pay_date": "dte_pay"},
            ("employee_amount", "employer_amount"), "is_cafeteria_plan = 'Y' AS bln_is_cafeteria_plan, is_voided = 'Y' AS bln_is_voided"),
        "employee_compensation": silver("employee_compensation", "ukg", "ukg_pro.compensation", "_fivetran_id", {"company_id": "company", "employee_id": "employee"},
                                        {"date_in_job": "dte_in_job"}, ("annual_salary", "hourly_pay_rate", "weekly_pay_rate", "pay_period_pay_rate", "other_rate_1", "other_rate_2", "other_rate_3", "other_rate_4"),
                                        "employee_id || ':' || company_id AS key_employee_company, md5(employee_id || ':' || company_id) AS hash_key_employee_company, "
                                        "salary_or_hourly_code = 'S' AS bln_is_salary, full_time_or_part_time_code = 'F' AS bln_is_full_time",
                                        frm=f"SELECT p.* REPLACE (coalesce(p.currency_code, c.currency_code) AS currency_code), c.code AS company_code FROM ({RAW_TABLES['ukg_pro.compensation']}) p "
                                            f"LEFT JOIN ({RAW_TABLES['ukg_pro.company']}) c ON p.company_id = c.id"),
    }
    def stacked(*parts: str) -> str:
        return " UNION ALL BY NAME ".join(f"({p})" for p in parts)

    ukg_jobs = RAW_TABLES["ukg_pro.employee_job_history"]
    job_names = {"job_effective_date": "dte_job_effective", "date_time_created": "dts_src_created", "is_rate_change": "bln_is_rate_change", "is_promotion": "bln_is_promotion"}
    pay = ("annual_salary", "weekly_pay_rate", "hourly_pay_rate", "period_pay_rate", "scheduled_work_hours", "other_rate_1", "other_rate_2", "other_rate_3", "other_rate_4")
    out |= {
        "timesheet": stacked(
            silver("timesheet", "int", i + "timesheet", "recordno", {"employeekey": "employee"}, {
                "begindate": "dte_src_start", "employeeid": "employee_id", "state": "status", "employeelocationid": "employee_location_id",
                "employeedepartmentid": "employee_department_id", "whencreated": "dts_src_created"}, drop=("link",), link="link"),
            silver("timesheet", "sfc", s + "pse_timecard_header_c", "id", {"pse_resource_c": "employee"}, {
                "pse_start_date_c": "dte_src_start", "pse_end_date_c": "dte_src_end", "pse_status_c": "status", "state_worked_c": "state_worked"}, drop=("link",), link="link",
                frm=f"SELECT h.*, c.name AS employee_name, c.ukg_employee_id_c AS employee_ukg_id FROM ({RAW_TABLES[s + 'pse_timecard_header_c']}) h LEFT JOIN ({RAW_TABLES[s + 'contact']}) c ON h.pse_resource_c = c.id")),
        "expense": stacked(
            silver("expense", "int", i + "eexpenses", "recordno", {}, {**head, "employeeid": "employee_id", "totalentered": "amt_total"}, ("totalentered",), link="psa_id",
                   frm=f"SELECT h.*, e.contact_name AS employee_name FROM ({RAW_TABLES[i + 'eexpenses']}) h LEFT JOIN ({RAW_TABLES[i + 'employee']}) e ON h.employeeid = e.employeeid"),
            silver("expense", "sfc", s + "pse_expense_report_c", "id", {"pse_resource_c": "resource", "pse_project_c": "project"}, {
                "pse_status_c": "state", "intacct_expense_c": "intacct_expense"},
                frm=f"SELECT h.*, c.name AS employee_name, p.name AS project_name FROM ({RAW_TABLES[s + 'pse_expense_report_c']}) h LEFT JOIN ({RAW_TABLES[s + 'contact']}) c ON h.pse_resource_c = c.id "
                    f"LEFT JOIN ({RAW_TABLES[s + 'pse_proj_c']}) p ON h.pse_project_c = p.id")),
        "expenseitem": stacked(
            silver("expenseitem", "int", i + "eexpenses_item", "recordno", {"recordkey": "expense", "projectkey": "project", "employeekey": "employee"},
                   {**line, "employeeid": "employee_id"}, ("amount", "trx_amount"), link="sfdc_expense_item_id"),
            silver("expenseitem", "sfc", s + "pse_expense_c", "id", {"pse_expense_report_c": "expense", "report_project": "project"}, {
                "pse_resource_c": "resource", "pse_type_c": "type", "gla_mapping_c": "gla_mapping", "pse_amount_c": "amt_org", "pse_billable_c": "bln_billable"}, ("pse_amount_c",),
                frm=f"SELECT x.*, r.pse_status_c AS state, r.pse_project_c AS report_project, c.name AS employee_name, p.name AS project_name, m.gl_account_c AS gl_account_no, m.name AS gl_account_title, "
                    f"m.intacct_item_id_c AS item_id FROM ({RAW_TABLES[s + 'pse_expense_c']}) x LEFT JOIN ({RAW_TABLES[s + 'pse_expense_report_c']}) r ON x.pse_expense_report_c = r.id "
                    f"LEFT JOIN ({RAW_TABLES[s + 'contact']}) c ON x.pse_resource_c = c.id LEFT JOIN ({RAW_TABLES[s + 'pse_proj_c']}) p ON r.pse_project_c = p.id "
                    f"LEFT JOIN ({RAW_TABLES[s + 'expense_type_gla_mapping_c']}) m ON x.gla_mapping_c = m.id")),
        "project": stacked(
            silver("project", "int", i + "project", "recordno", {"entity": "entity"}, {
                "projectid": "project_id", "managerid": "project_manager_id", "departmentid": "department_id", "locationid": "location_id", "locationkey": "project_location_key",
                "currency": "currency_iso_code", "po_amount": "amt_po", "projecttype": "project_type", "begindate": "dte_src_start"}, ("po_amount",),
                frm=f"SELECT p.*, coalesce(l.parentkey, l.recordno) AS entity FROM ({RAW_TABLES[i + 'project']}) p LEFT JOIN ({RAW_TABLES[i + 'location']}) l ON p.locationid = l.locationid"),
            silver("project", "psa", "psatools.projects", "id", {}, {"int_project_id": "project_id"}, link="int_record_no"),
            silver("project", "sfc", s + "pse_proj_c", "id", {}, {
                "pse_account_c": "account_id", "pse_group_c": "group_id", "pse_practice_c": "practice_id", "intacct_record_no_c": "intacct_record_no", "pse_opportunity_c": "opportunity",
                "pse_project_manager_c": "project_manager"}, link="intacct_record_no_c",
                frm=f"SELECT p.*, a.name AS account_name, a.client_manager_c AS client_manager_id, o.name AS opportunity_name, c.name AS project_manager_name, t.name AS practice_name, g.name AS group_name "
                    f"FROM ({RAW_TABLES[s + 'pse_proj_c']}) p LEFT JOIN ({RAW_TABLES[s + 'account']}) a ON p.pse_account_c = a.id LEFT JOIN ({RAW_TABLES[s + 'opportunity']}) o ON p.pse_opportunity_c = o.id "
                    f"LEFT JOIN ({RAW_TABLES[s + 'contact']}) c ON p.pse_project_manager_c = c.id LEFT JOIN ({RAW_TABLES[s + 'pse_practice_c']}) t ON p.pse_practice_c = t.id "
                    f"LEFT JOIN ({RAW_TABLES[s + 'pse_grp_c']}) g ON p.pse_group_c = g.id")),
        "project_phase_code": "SELECT DISTINCT * FROM (" + stacked(
            silver("project_phase_code", "int", i + "task", "recordno", {"projectkey": "project"}, {"whencreated": "dts_src_created"}, link="sfdc_milestone_id"),
            silver("project_phase_code", "sfc_milestones", s + "pse_milestone_c", "id", {"pse_project_c": "project", "pse_approver_c": "approver", "practice_area_c": "practice_area"}, {}),
            silver("project_phase_code", "sfc_project_task", s + "pse_project_task_c", "id", {"pse_project_c": "project"}, {
                "pse_milestone_c": "milestone", "proposal_c": "proposal", "is_project_task_c": "bln_is_project_task"}, extra="pse_milestone_c AS key_milestone", link="pse_milestone_c",
                frm=f"SELECT * FROM ({live('project_phase_code', s + 'pse_project_task_c')}) t WHERE NOT is_project_task_c", drop=("original_proposal_budget_c", "original_proposal_hrs_or_units_c")),
            silver("project_phase_code", "pts", "psatools.projects_phase_codes", "id", {"project_id": "project"}, {}, link="milestone_id")) + ")",
        "employee_job_history": silver(
            "employee_job_history", "ukg", "ukg_pro.employee_job_history", "id", {
                "employee_id": "employee", "company_id": "company", "organization_level_1_id": "practice", "organization_level_2_id": "department",
                "organization_level_3_id": "base_team", "organization_level_4_id": "intacct_location"}, job_names, pay,
            "employee_id || ':' || company_id AS key_employee_company, md5(employee_id || ':' || company_id) AS hash_key_employee_company, "
            "salary_or_hourly = 'S' AS bln_is_salary, full_time_or_part_time = 'F' AS bln_is_full_time",
            frm=f"SELECT j.*, c.code AS company_code, coalesce(upper(p.currency_code), upper(c.currency_code)) AS currency_code FROM ({ukg_jobs}) j "
                f"LEFT JOIN ({RAW_TABLES['ukg_pro.company']}) c ON j.company_id = c.id LEFT JOIN ({RAW_TABLES['ukg_pro.compensation']}) p ON p.employee_id = j.employee_id"),
        "employment_details": "SELECT * EXCLUDE (v_end) REPLACE (dts_src_created AS dts_eff_start, coalesce(v_end - INTERVAL 1 SECOND, TIMESTAMP '9999-12-31 00:00:00') AS dts_eff_end, "
            "v_end IS NULL AS bln_current) FROM (" + silver(
            "employment_details", "ukg", "ukg_pro.employee_job_history", "id", {"company_id": "entity", "employee_id": "employee"}, job_names, pay, link="employee_id",
            frm=f"SELECT j.*, e.supervisor_id, e.employee_status_code AS ukg_status, e.original_hire_date AS dte_src_start, e.date_of_termination AS dte_src_end, c.currency_code, "
                f"e.employee_status_code IN ('A', 'L', 'O') AS bln_is_active, lead(j.date_time_created) OVER (PARTITION BY j.employee_id ORDER BY j.date_time_created, j.id) AS v_end "
                f"FROM ({ukg_jobs}) j LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY employee_id, company_id ORDER BY date_in_job DESC, date_time_created DESC, employment_no DESC) AS rn "
                f"FROM ({RAW_TABLES['ukg_pro.employment']})) WHERE rn = 1) e ON e.employee_id = j.employee_id AND e.company_id = j.company_id "
                f"LEFT JOIN ({RAW_TABLES['ukg_pro.company']}) c ON j.company_id = c.id") + ")",
    }
    # ---- gold, from the silver SQL and the test tables
    who = "upper(c_mktsegment[1]) || lower(substring(c_mktsegment, 2))"
    person = (f"(SELECT 'U' || CAST(c_custkey AS STRING) AS sfc_user_id, CAST(c_custkey AS STRING) AS pkey, {who} || ' ' || c_name AS nm, "
              f"c_name || ', ' || {who} AS lf, c_name || '@example.com' AS mail FROM customer)")

    def member(model: str, base: str, fk: str, role: str, joins: str = "", cols: str = "") -> str:
        return (f"SELECT {audit(model)}, b.* EXCLUDE ({GOLD_DROP}, {fk}), b.{fk} AS {fk}_sfc, p.pkey AS key_{role}, p.nm AS {role}_name, p.lf AS {role}_name_lf, p.mail AS {role}_email{cols} "
                f"FROM ({out[base]}) b LEFT JOIN {person} p ON b.{fk} = p.sfc_user_id {joins}")

    def plain_gold(model: str, base: str, joins: str = "", cols: str = "", drop: str = "") -> str:
        return f"SELECT {audit(model)}, b.* EXCLUDE ({GOLD_DROP}{drop}){cols} FROM ({out[base]}) b {joins}"

    opp = f"LEFT JOIN ({out['sales_opportunity']}) o ON b.key_opportunity = o.key"
    acc = f"LEFT JOIN ({out['sales_account']}) a ON b.key_account = a.key"
    prod = f"LEFT JOIN ({out['sales_product']}) d ON b.key_product = d.key"
    prac = "LEFT JOIN nation n ON b.key_practice = 'S' || CAST(n.n_nationkey AS STRING)"
    prac_cols = ", 'R' || CAST(n.n_nationkey AS STRING) AS key_practice, n.n_name AS practice_name"
    gold = {
        "dim_sales_product": plain_gold("dim_sales_product", "sales_product"),
        "dim_sales_price_book_entry": plain_gold("dim_sales_price_book_entry", "sales_price_book_entry", prod, ", d.name AS product_name"),
        "dim_sales_rate_card_set": member("dim_sales_rate_card_set", "sales_rate_card_set", "key_owner", "owner"),
        "dim_sales_account_team_member": member("dim_sales_account_team_member", "sales_account_team_member", "key_user", "member", acc, ", a.name AS account_name"),
        "dim_sales_opportunity_team_member": member("dim_sales_opportunity_team_member", "sales_opportunity_team_member", "key_user", "member",
                                                    opp + f" LEFT JOIN ({out['sales_account']}) a ON o.key_account = a.key",
                                                    ", o.name AS opportunity_name, o.key_account AS key_account, a.name AS account_name"),
        "dim_sales_proposal_line_item": plain_gold("dim_sales_proposal_line_item", "sales_proposal_line_item",
                                                   f"LEFT JOIN ({out['sales_proposal']}) q ON b.key_proposal = q.key {prod} LEFT JOIN ({out['sales_account']}) a ON q.key_account = a.key "
                                                   f"LEFT JOIN ({out['sales_opportunity']}) o ON q.key_opportunity = o.key {prac}",
                                                   ", q.name AS proposal_name, q.key_account AS key_account, q.key_opportunity AS key_opportunity, d.name AS product_name, a.name AS account_name, "
                                                   "o.name AS opportunity_name" + prac_cols, ", key_practice"),
    }
    # places of a CRM code: country, state (only where nation and region coincide), location and its region
    place = ("(SELECT 'S' || CAST(a.n_nationkey AS STRING) AS sk, 'R' || CAST(a.n_nationkey AS STRING) AS nk, a.n_name AS nn, "
             "CASE WHEN a.n_nationkey = a.n_regionkey THEN 'R' || CAST(a.n_nationkey AS STRING) END AS stk, CASE WHEN a.n_nationkey = a.n_regionkey THEN a.n_name END AS stn, "
             "'R' || CAST(a.n_regionkey AS STRING) AS rk, b.n_name AS rn FROM nation a LEFT JOIN nation b ON b.n_nationkey = a.n_regionkey)")
    state_cols = ", g.nk AS key_country, g.nn AS country_name, g.stk AS key_state, g.stn AS state_name"
    loc_cols = ", h.nk AS key_location, h.nn AS location_name, h.rk AS key_region, h.rn AS region_name"
    account_place = f"LEFT JOIN {place} g ON a.billing_country_code = g.sk LEFT JOIN {place} h ON a.key_location = h.sk"
    gold |= {
        "dim_sales_opportunity_line_item": plain_gold(
            "dim_sales_opportunity_line_item", "sales_opportunity_line_item",
            f"{opp} {prod} LEFT JOIN ({out['sales_account']}) a ON o.key_account = a.key {account_place} {prac}",
            ", o.name AS opportunity_name, o.key_account AS key_account, o.stage_name AS stage_name, d.name AS product_name, d.family AS product_family, a.name AS account_name"
            + state_cols + loc_cols + prac_cols, ", key_practice"),
        "dim_sales_lead": member("dim_sales_lead", "sales_lead", "key_owner", "owner", f"{opp} LEFT JOIN {place} g ON b.country_code = g.sk LEFT JOIN {place} h ON b.key_location = h.sk {prac}",
                                 ", o.name AS opportunity_name" + state_cols + loc_cols + prac_cols).replace("key_owner), b.", "key_owner, key_practice, key_location), b."),
        "dim_sales_rate_card": member("dim_sales_rate_card", "sales_rate_card", "key_owner", "owner",
                                      f"LEFT JOIN ({out['sales_rate_card_set']}) t ON b.key_rate_card_set = t.key {acc} LEFT JOIN {place} h ON b.key_location = h.sk {prac}",
                                      ", t.name AS rate_card_set_name, a.name AS account_name" + loc_cols + prac_cols).replace("key_owner), b.", "key_owner, key_practice, key_location), b."),
        "dim_sales_user": f"SELECT {audit('dim_sales_user')}, b.* EXCLUDE ({GOLD_DROP}), p.pkey AS key_person, p.nm AS person_name, p.lf AS person_name_lf, p.mail AS person_email, "
                          f"c.key AS key_contact_user, c.key_account AS key_account, a.name AS account_name, coalesce(v.nm, vu.name) AS delegated_approver_name "
                          f"FROM ({out['sales_user']}) b LEFT JOIN {person} p ON b.ukg_employee_id = p.pkey "
                          f"LEFT JOIN ({out['sales_contact']}) c ON b.key = c.key_user LEFT JOIN ({out['sales_account']}) a ON c.key_account = a.key "
                          f"LEFT JOIN {person} v ON b.key_delegated_approver = v.sfc_user_id LEFT JOIN ({out['sales_user']}) vu ON b.key_delegated_approver = vu.key",
        "dim_sales_contact": f"SELECT {audit('dim_sales_contact')}, b.* EXCLUDE ({GOLD_DROP}, key_practice), u.ukg_employee_id AS user_employee_id, u.name AS user_name, p.nm AS employee_name, "
                             f"q.nm AS supervisor_name, q.mail AS supervisor_email, a.name AS account_name{prac_cols} FROM ({out['sales_contact']}) b "
                             f"LEFT JOIN ({out['sales_user']}) u ON b.key_user = u.key LEFT JOIN {person} p ON u.ukg_employee_id = p.pkey "
                             "LEFT JOIN (SELECT DISTINCT CAST(o_custkey AS STRING) AS e, CAST(CAST(floor(o_custkey / 4.0) AS BIGINT) AS STRING) AS sup FROM orders WHERE o_custkey >= 4) v ON v.e = p.pkey "
                             f"LEFT JOIN {person} q ON v.sup = q.pkey {acc} {prac}",
    }
    cur = "upper(coalesce(NULLIF(b.currency_iso_code, ''), 'USD'))"

    def converted(model: str, base: str, amounts: tuple[str, ...], date: str, joins: str, cols: str, targets: dict[str, str], drop: str = "", whole: str = "b.{0}") -> str:
        """Amounts in further currencies by the cube, at the rate of the date moved into its days."""
        made, extra = "", ""
        for k, (suffix, to) in enumerate(targets.items()):
            rate = f"CASE WHEN {cur} = {to} THEN 1.0 ELSE coalesce(x{k}.fx_rate_mul, 1.0) END"
            made += f", {rate} AS fx_rate_{suffix}" + "".join(
                f", CAST(CAST(CAST({whole.format(a)} AS DECIMAL(18,2)) * CAST({rate} AS DECIMAL(20,14)) AS DECIMAL(18,2)) AS DOUBLE) AS {a}_{suffix}" for a in amounts)
            extra += f" LEFT JOIN cube x{k} ON x{k}.frm_curr = {cur} AND x{k}.to_curr = {to} AND x{k}.date = CASE WHEN {date} IS NOT NULL THEN greatest(least({date}, hi), lo) END"
        return (_CUBE + f" SELECT {audit(model)}, b.* EXCLUDE ({GOLD_DROP}, currency_iso_code{drop}){cols}, {cur} AS currency_iso_code{made} "
                f"FROM ({out[base]}) b CROSS JOIN lim {joins} {extra}")

    entity = "CASE e.n_regionkey WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'GBP' END"
    gold |= {
        "ref_fx_rates_timeseries": _CUBE + f" SELECT {audit('ref_fx_rates_timeseries')}, * FROM cube",
        "dim_invoice": converted(
            "dim_invoice", "invoice", ("amt_total", "amt_total_due", "amt_total_paid"), "coalesce(b.dte_exch_rate, b.dte_posted)",
            "LEFT JOIN nation e ON b.key_entity = CAST(e.n_nationkey AS STRING)",
            f", 'R' || CAST(e.n_nationkey AS STRING) AS key_entity_record, e.n_name AS entity_name, CASE WHEN e.n_nationkey IS NOT NULL THEN {entity} END AS currency_code_entity, "
            "coalesce(b.dte_exch_rate, b.dte_posted) AS dte_exch_rate, coalesce(b.amt_total, 0) AS amt_total, coalesce(b.amt_total_due, 0) AS amt_total_due, coalesce(b.amt_total_paid, 0) AS amt_total_paid",
            {"usd": "'USD'"}, ", dte_exch_rate, amt_total, amt_total_due, amt_total_paid", "coalesce(b.{0}, 0)"),
        "dim_sales_purchase_order": converted(
            "dim_sales_purchase_order", "sales_purchase_order", ("amt_po",), "b.dte_received",
            f"{acc} {account_place} {opp} LEFT JOIN nation l ON a.key_location = 'S' || CAST(l.n_nationkey AS STRING)",
            ", a.name AS account_name, o.name AS opportunity_name, o.currency_iso_code AS currency_iso_code_opportunity, le.name AS entity_name, le.cur AS currency_iso_code_entity" + state_cols + loc_cols,
            {"usd": "'USD'", "opportunity": "o.currency_iso_code", "entity": "le.cur"}).replace(
                "ON a.key_location = 'S' || CAST(l.n_nationkey AS STRING)",
                "ON a.key_location = 'S' || CAST(l.n_nationkey AS STRING) LEFT JOIN (SELECT n_nationkey AS id, n_name AS name, "
                "CASE n_regionkey WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'GBP' END AS cur FROM nation) le ON le.id = l.n_regionkey"),
    }
    # people of payroll: names, own currency (pay, else company), and the entity their accounting location belongs to
    nation_cur = "CASE n_regionkey WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'GBP' END"
    payroll = (f"(SELECT CAST(c.c_custkey AS STRING) AS pkey, {who} || ' ' || c_name AS nm, c_name || ', ' || {who} AS lf, "
               f"CASE c_mktsegment WHEN 'BUILDING' THEN {nation_cur.replace('n_regionkey', 'n.n_regionkey')} WHEN 'MACHINERY' THEN 'EUR' ELSE 'USD' END AS cur, "
               "'R' || CAST(l.n_nationkey AS STRING) AS entity, l.n_name AS entity_name, "
               f"{nation_cur.replace('n_regionkey', 'l.n_regionkey')} AS entity_cur "
               "FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey LEFT JOIN nation l ON l.n_nationkey = n.n_regionkey)")

    def amounts_in(amounts: tuple[str, ...], frm: str, targets: dict[str, str], date: str) -> tuple[str, str]:
        """Columns and joins of amounts in further currencies, by the cube at the rate of the date."""
        made, joins = "", ""
        for k, (suffix, to) in enumerate(targets.items()):
            rate = f"CASE WHEN {frm} = {to} THEN 1.0 ELSE coalesce(x{k}.fx_rate_mul, 1.0) END"
            made += f", {rate} AS fx_rate_{suffix}" + "".join(
                f", CAST(CAST(CAST(b.{a} AS DECIMAL(18,2)) * CAST({rate} AS DECIMAL(20,14)) AS DECIMAL(18,2)) AS DOUBLE) AS {a}_{suffix}" for a in amounts)
            joins += f" LEFT JOIN cube x{k} ON x{k}.frm_curr = {frm} AND x{k}.to_curr = {to} AND x{k}.date = CASE WHEN {date} IS NOT NULL THEN greatest(least({date}, hi), lo) END"
        return made, joins

    def pay_lines(model: str, base: str, amounts: tuple[str, ...]) -> str:
        made, joins = amounts_in(amounts, "p.cur", {"entity": "p.entity_cur", "usd": "'USD'"}, "b.dte_pay")
        return (_CUBE + f" SELECT {audit(model)}, b.* EXCLUDE ({GOLD_DROP}), p.entity AS key_entity, p.entity_name, p.entity_cur AS currency_code_entity, 'CO' || b.key_company AS company_code, "
                f"n.n_name AS company_name, p.nm AS employee_name, p.lf AS employee_name_lf, p.cur AS currency_code{made} FROM ({out[base]}) b CROSS JOIN lim "
                f"LEFT JOIN {payroll} p ON b.key_employee = p.pkey LEFT JOIN nation n ON CAST(n.n_nationkey AS STRING) = b.key_company {joins}")

    line_made, line_joins = amounts_in(("amt_trx",), cur, {"usd": "'USD'", "entity": "le.cur"}, "coalesce(v.dte_exch_rate, v.dte_posted)")
    line_usd = f"CASE WHEN {cur} = 'USD' THEN 1.0 ELSE coalesce(x0.fx_rate_mul, 1.0) END"
    stone = "upper(coalesce(NULLIF(b.currency_iso_code, ''), NULLIF(j.cur, ''), 'USD'))"
    stone_made, stone_joins = amounts_in(("earned_value",), stone, {"project": "upper(coalesce(NULLIF(j.cur, ''), 'USD'))", "usd": "'USD'"}, "coalesce(b.dte_milestone, j.start)")
    gold |= {
        "dim_employee_earning": pay_lines("dim_employee_earning", "employee_earning", ("amt_base", "amt_current")),
        "dim_employee_payroll_deductions": pay_lines("dim_employee_payroll_deductions", "employee_payroll_deductions", ("amt_employee", "amt_employer")),
        "dim_invoice_item": _CUBE + f" SELECT {audit('dim_invoice_item')}, b.* EXCLUDE ({GOLD_DROP}, currency_iso_code), {cur} AS currency_iso_code, v.recordid AS invoice_record, v.key_entity AS invoice_entity, "
            "coalesce(v.dte_exch_rate, v.dte_posted) AS dte_invoice, le.cur AS currency_code_entity, le.name AS entity_name, d.n_name AS department_name, o.n_name AS location_name, "
            f"p.p_name AS project_name, 'P' || CAST(p.p_partkey AS STRING) AS project_id, c.c_name AS employee_name{line_made}, b.amt AS amt_entity, "
            f"CAST(CAST(CAST(b.amt AS DECIMAL(18,2)) * CAST({line_usd} AS DECIMAL(20,14)) AS DECIMAL(18,2)) AS DOUBLE) AS amt_usd "
            f"FROM ({out['invoice_item']}) b CROSS JOIN lim LEFT JOIN ({out['invoice']}) v ON b.key_invoice = v.key "
            f"LEFT JOIN (SELECT CAST(n_nationkey AS STRING) AS id, n_name AS name, {nation_cur} AS cur FROM nation) le ON le.id = v.key_entity "
            "LEFT JOIN nation d ON b.department_id = 'D' || CAST(d.n_nationkey AS STRING) LEFT JOIN nation o ON b.location_id = 'D' || CAST(o.n_nationkey AS STRING) "
            f"LEFT JOIN part p ON b.key_project = CAST(p.p_partkey AS STRING) LEFT JOIN customer c ON b.key_employee = CAST(c.c_custkey AS STRING) {line_joins}",
        "dim_project_task_milestone": _CUBE + f" SELECT {audit('dim_project_task_milestone')}, b.* EXCLUDE ({GOLD_DROP}, earned_value), b.earned_value AS earned_value_original, j.name AS project_name, "
            "upper(coalesce(NULLIF(j.cur, ''), 'USD')) AS project_currency, m.name AS phase_code_name, t.name AS task_name, coalesce(f.nm, fu.name) AS created_by_name, coalesce(g.nm, gu.name) AS modified_by_name, "
            f"{stone} AS currency_original{stone_made} FROM ({out['project_task_milestone']}) b CROSS JOIN lim "
            "LEFT JOIN (SELECT 'SP' || CAST(p_partkey AS STRING) AS sk, p_name AS name, CASE p_type WHEN 'ECONOMY' THEN 'EUR' WHEN 'SMALL' THEN 'GBP' ELSE 'USD' END AS cur, DATE '2000-01-03' AS start FROM part) j ON j.sk = b.key_project "
            f"LEFT JOIN ({live('project_phase_code', s + 'pse_milestone_c')}) m ON m.id = b.key_milestone LEFT JOIN ({out['project_task']}) t ON t.key = b.key_project_task "
            f"LEFT JOIN {person} f ON f.sfc_user_id = b.src_created_by_id LEFT JOIN {person} g ON g.sfc_user_id = b.src_modified_by_id "
            f"LEFT JOIN ({out['sales_user']}) fu ON fu.key = b.src_created_by_id LEFT JOIN ({out['sales_user']}) gu ON gu.key = b.src_modified_by_id {stone_joins}",
        "dim_timesheet": f"SELECT {audit('dim_timesheet')}, b.* EXCLUDE ({GOLD_DROP}, employee_name), b.employee_id AS employee_id_intacct, 'R' || CAST(d.n_nationkey AS STRING) AS key_department, d.n_name AS department_name, "
            "'R' || CAST(o.n_nationkey AS STRING) AS key_location, o.n_name AS location_name, 'R' || CAST(r.n_nationkey AS STRING) AS key_entity_record, r.n_name AS entity_name, "
            f"{nation_cur.replace('n_regionkey', 'r.n_regionkey')} AS currency_code_entity, p.pkey AS key_employee_ukg, p.nm AS employee_name, p.lf AS employee_name_lf "
            f"FROM ({out['timesheet']}) b LEFT JOIN nation d ON b.employee_department_id = 'D' || CAST(d.n_nationkey AS STRING) LEFT JOIN nation o ON b.employee_location_id = 'D' || CAST(o.n_nationkey AS STRING) "
            f"LEFT JOIN nation r ON r.n_nationkey = o.n_regionkey LEFT JOIN {person} p ON b.employee_id = 'E' || p.pkey WHERE b.src_sys_key = 'int'",
    }
    # pay in several currencies: every amount rounded, then the cost-of-living share, the bonus and the totals on rounded ones
    amounts, others = ("annual_salary", "hourly_pay_rate", "period_pay_rate", "weekly_pay_rate"), ("other_rate_1", "other_rate_3", "other_rate_4")
    money = lambda c: f"CAST({c} AS DECIMAL(18,2))"
    shown = lambda c, n: f"CAST({c} AS DOUBLE) AS {n}"

    def cents_over(amount: str, n: str) -> str:
        """A positive amount divided by a whole number and rounded to cents, in whole numbers throughout."""
        return f"(CAST((CAST({amount} * 100 AS BIGINT) * 2 + {n}) // (2 * {n}) AS DECIMAL(16,0)) * CAST(0.01 AS DECIMAL(3,2)))"

    def paid(rows: str, targets: tuple[str, ...], model: str) -> str:
        """``rows`` has the four amounts, the other rates, ``cola``, ``cur`` and a currency ``to_<target>`` for each target, and ``day``."""
        suffixes = ("original", *targets)
        rates = ", ".join(f"CAST(CASE WHEN cur = to_{t} THEN 1.0 ELSE coalesce(x_{t}.fx_rate_mul, 1.0) END AS DECIMAL(20,10)) AS conversion_rate_{t}" for t in targets)
        found = " ".join(f"LEFT JOIN cube x_{t} ON x_{t}.frm_curr = cur AND x_{t}.to_curr = to_{t} AND x_{t}.date = greatest(least(day, hi), lo)" for t in targets)
        own = ", ".join([f"{money(f'coalesce({a}, 0)')} AS {a}_original" for a in (*amounts, *others[1:])] + [
            f"{money('CASE WHEN coalesce(other_rate_1, 0) < 10 THEN 0 ELSE other_rate_1 END')} AS other_rate_1_original",
            "CAST(CASE WHEN coalesce(other_rate_2, 0) < 1 THEN coalesce(other_rate_2, 0) ELSE 0 END AS DECIMAL(4,2)) AS other_rate_2_original",
            "CAST(coalesce(cola, 0) AS DECIMAL(9,5)) AS cola_percent"])
        far = ", ".join(f"{money(f'{a}_original * conversion_rate_{t}')} AS {a}_{t}" for a in (*amounts, *others) for t in targets)
        cola = ", ".join([f"{money(f'{a}_{t} * (1 + cola_percent)')} AS {a}_cola_{t}" for a in amounts for t in suffixes]
                         + [f"{money(f'annual_salary_{t} * other_rate_2_original')} AS performance_bonus_{t}" for t in suffixes])
        made = [f"{a}_{t}" for a in (*amounts, *others) for t in suffixes] + [f"{a}_cola_{t}" for a in amounts for t in suffixes] + [f"performance_bonus_{t}" for t in suffixes]
        made += ["cola_percent", "other_rate_2_original", *[f"conversion_rate_{t}" for t in targets]]
        out = ", ".join([shown(c, c) for c in made]
                        + [shown(f"annual_salary_cola_{t} + other_rate_1_{t}", f"total_compensation_{t}") for t in suffixes]
                        + [shown(f"annual_salary_cola_{t} + other_rate_1_{t} + performance_bonus_{t}", f"total_potential_compensation_{t}") for t in suffixes])
        gone = ", ".join(dict.fromkeys([*amounts, *others, "other_rate_2", "cola", "cur", "day", *[f"to_{t}" for t in targets], *made, "lo", "hi"]))
        return (_CUBE + f", p0 AS ({rows}), p1 AS (SELECT p0.*, lo, hi, {own}, {rates} FROM p0 CROSS JOIN lim {found}), p2 AS (SELECT *, {far} FROM p1), p3 AS (SELECT *, {cola} FROM p2) "
                f"SELECT {audit(model)}, * EXCLUDE ({gone}), {out} FROM p3")

    entity_cols = lambda e, s="": f"'R' || CAST({e}.n_nationkey AS STRING) AS key_entity{s}, {e}.n_name AS entity_name{s}"
    cur_of = lambda e: f"CASE WHEN {e}.n_nationkey IS NOT NULL THEN {nation_cur.replace('n_regionkey', e + '.n_regionkey')} END"
    raw_decimal = lambda cols: ", ".join(f"CAST(b.{c} AS DECIMAL(18,2)) AS {c}" for c in cols)
    pay_in = ("annual_salary", "hourly_pay_rate", "weekly_pay_rate", "other_rate_1", "other_rate_2", "other_rate_3", "other_rate_4")
    acc_emp = f"LEFT JOIN ({RAW_TABLES['sage_intacct.employee']}) i ON i.ukg_employee_number = b.key_employee"
    gold["dim_employee_compensation"] = paid(
        f"SELECT b.* EXCLUDE ({GOLD_DROP}, pay_period_pay_rate, {', '.join(pay_in)}, currency_code, company_code, job_title), b.company_code, {raw_decimal(pay_in)}, CAST(b.pay_period_pay_rate AS DECIMAL(18,2)) AS period_pay_rate, "
        f"b.dte_in_job AS day, upper(b.currency_code) AS cur, upper(b.currency_code) AS currency_code_original, 'USD' AS to_usd, {cur_of('e')} AS to_entity, {cur_of('e')} AS currency_code_entity, {entity_cols('e')}, "
        "s.n_regionkey * CAST(0.05 AS DECIMAL(9,4)) AS cola, 'R' || CAST(s.n_nationkey AS STRING) AS key_shift_code, s.n_name AS shift_code_name, 'R' || CAST(g.n_nationkey AS STRING) AS key_salary_grade, "
        "g.n_name AS salary_grade_name, 'R' || CAST(q.n_nationkey AS STRING) AS key_position, q.n_name AS position_name, coalesce(NULLIF(b.job_title, ''), q.n_name) AS job_title, "
        "CAST(CASE WHEN year(b.dte_in_job) = 2001 THEN coalesce(e.n_regionkey, 0) ELSE 0 END AS DOUBLE) AS benefits_rate, j.key AS key_job_history, c.n_name AS company_name, "
        "p.nm AS employee_name, p.lf AS employee_name_lf, p.mail AS employee_email "
        f"FROM ({out['employee_compensation']}) b {acc_emp} LEFT JOIN nation e ON e.n_nationkey = i.locationkey LEFT JOIN nation s ON CAST(s.n_nationkey AS STRING) = b.primary_shift_code "
        "LEFT JOIN nation g ON CAST(g.n_nationkey AS STRING) = b.job_salary_grade LEFT JOIN nation q ON CAST(q.n_nationkey AS STRING) = b.primary_job_id "
        f"LEFT JOIN nation c ON CAST(c.n_nationkey AS STRING) = b.key_company LEFT JOIN {person} p ON p.pkey = b.key_employee "
        f"LEFT JOIN (SELECT * FROM ({out['employee_job_history']}) WHERE bln_is_rate_change QUALIFY row_number() OVER (PARTITION BY key_employee_company, dte_job_effective ORDER BY annual_salary DESC, key DESC) = 1) j "
        "ON j.key_employee_company = b.key_employee_company AND j.dte_job_effective = b.dte_in_job", ("entity", "usd"), "dim_employee_compensation")
    hours = "CAST(coalesce(b.scheduled_work_hours, 0) AS DECIMAL(18,2))"
    salary, hour = money("b.annual_salary"), "CASE WHEN coalesce(b.hourly_pay_rate, 0) <> 0 THEN CAST(b.hourly_pay_rate AS DECIMAL(18,2)) ELSE " + cents_over(money("b.annual_salary"), "2080") + " END"
    others_in = ("other_rate_1", "other_rate_2", "other_rate_3", "other_rate_4")
    gold["dim_employee_job_history"] = paid(
        f"SELECT b.* EXCLUDE ({GOLD_DROP}, {', '.join(amounts)}, {', '.join(others_in)}, currency_code, key_practice, key_department, key_base_team, job_title), {raw_decimal(others_in)}, {salary} AS annual_salary, "
        f"{hour} AS hourly_pay_rate, CASE WHEN coalesce(b.weekly_pay_rate, 0) <> 0 THEN CAST(b.weekly_pay_rate AS DECIMAL(18,2)) ELSE {cents_over(salary, '52')} END AS weekly_pay_rate, "
        f"CASE WHEN coalesce(b.period_pay_rate, 0) <> 0 THEN CAST(b.period_pay_rate AS DECIMAL(18,2)) ELSE CAST(({hour}) * {hours} AS DECIMAL(18,2)) END AS period_pay_rate, "
        f"b.dte_job_effective AS day, upper(b.currency_code) AS cur, upper(b.currency_code) AS currency_code_original, 'USD' AS to_usd, {cur_of('e')} AS to_entity, {cur_of('e')} AS currency_code_entity, {entity_cols('e')}, "
        f"{cur_of('f')} AS to_entity_current, {cur_of('f')} AS currency_code_entity_current, {entity_cols('f', '_current')}, s.n_regionkey * CAST(0.05 AS DECIMAL(9,4)) AS cola, "
        "'R' || CAST(s.n_nationkey AS STRING) AS key_shift_code, s.n_name AS shift_code_name, 'R' || CAST(g.n_nationkey AS STRING) AS key_salary_grade, g.n_name AS salary_grade_name, "
        "'R' || CAST(q.n_nationkey AS STRING) AS key_position, q.n_name AS position_name, coalesce(b.job_title, q.n_name) AS job_title, c.n_name AS company_name, "
        "b.key_practice AS ukg_practice_id, b.key_department AS ukg_department_id, b.key_base_team AS ukg_base_team_id, 'R' || CAST(c.n_nationkey AS STRING) AS key_practice, c.n_name AS practice_name, "
        "'R' || CAST(c.n_nationkey AS STRING) AS key_department, c.n_name AS department_name, 'R' || CAST(c.n_nationkey AS STRING) AS key_base_team, c.n_name AS base_team_name, "
        "'R' || CAST(l.n_nationkey AS STRING) AS key_location_intacct, l.n_name AS intacct_location_name, "
        "CAST(CASE WHEN year(b.dte_job_effective) = 2001 THEN coalesce(e.n_regionkey, 0) ELSE 0 END AS DOUBLE) AS benefits_rate, p.nm AS employee_name, p.lf AS employee_name_lf, p.mail AS employee_email "
        f"FROM ({out['employee_job_history']}) b {acc_emp} LEFT JOIN nation l ON CAST(l.n_nationkey AS STRING) = b.key_intacct_location LEFT JOIN nation i2 ON 'D' || CAST(i2.n_nationkey AS STRING) = i.locationid "
        "LEFT JOIN nation f ON f.n_nationkey = i2.n_regionkey LEFT JOIN nation c ON CAST(c.n_nationkey AS STRING) = b.key_company LEFT JOIN nation e ON e.n_nationkey = coalesce(l.n_regionkey, i2.n_regionkey, c.n_nationkey) "
        "LEFT JOIN nation s ON CAST(s.n_nationkey AS STRING) = b.shift_code LEFT JOIN nation g ON CAST(g.n_nationkey AS STRING) = b.salary_grade LEFT JOIN nation q ON CAST(q.n_nationkey AS STRING) = b.job_id "
        f"LEFT JOIN {person} p ON p.pkey = b.key_employee", ("entity", "entity_current", "usd"), "dim_employee_job_history")
    blank = lambda c: f"NULLIF({c}, '')"
    views = {
        "vw_finance_customers": f"SELECT recordno AS key, {blank('customerid')} AS customer_id, {blank('name')} AS name, {blank('comments')} AS comments, "
                                f"CAST(totaldue AS DOUBLE) AS amt_total_due, onhold = 'T' AS bln_on_hold FROM ({RAW_TABLES[i + 'customer']}) r",
        "vw_finance_gl_accounts": f"SELECT recordno AS key, accountno AS account_no, title, {blank('category')} AS category, coalesce(requiredept, FALSE) AS bln_require_department "
                                  f"FROM ({RAW_TABLES['sage_intacct_gl.gl_account']}) r",
        "vw_finance_locations": f"SELECT recordno AS key, locationid AS location_id, parentkey AS key_parent, name, {blank('status')} AS status, "
                                f"CASE locationtype WHEN 'C' THEN 'Location' WHEN 'E' THEN 'Entity' WHEN 'N' THEN 'Non-Active' END AS location_type FROM ({RAW_TABLES[i + 'location']}) r",
        "vw_phase_code_products": f"SELECT id AS key, name AS family_name FROM ({RAW_TABLES['psatools.phase_code_families']}) r",
        "vw_phase_code_products_links": f"SELECT l.* EXCLUDE (_fivetran_deleted), a.c_name AS creator_name, b.c_name AS verifier_name FROM ({RAW_TABLES['psatools.standard_phase_codes_product_links']}) l "
                                        "LEFT JOIN customer a ON a.c_custkey = l.created_by LEFT JOIN customer b ON b.c_custkey = l.verified_by",
    }
    views["vw_employee_pay_history"] = f"""
        WITH j AS (SELECT *, lag(shift_code) OVER (PARTITION BY key_employee ORDER BY dte_job_effective, dts_src_created, key) AS prev FROM ({gold['dim_employee_job_history']})),
        k AS (SELECT *, row_number() OVER (PARTITION BY key_employee, dte_job_effective ORDER BY dts_src_created DESC, key DESC) AS rn FROM j
              WHERE percent_change <> 0 OR bln_is_rate_change OR reason_code IN ('100', '101') OR prev <> shift_code),
        h AS (SELECT 'Job History' AS src, key_employee, key_employee_company, dte_job_effective, annual_salary_usd, hourly_pay_rate_usd FROM k WHERE rn = 1),
        a AS (SELECT * FROM h UNION ALL SELECT 'Compensation', key_employee, key_employee_company, dte_in_job, annual_salary_usd, hourly_pay_rate_usd FROM ({gold['dim_employee_compensation']}) c
              WHERE key_employee_company NOT IN (SELECT key_employee_company FROM h)),
        o AS (SELECT * FROM a WHERE annual_salary_usd BETWEEN 2100 AND 2000000
              QUALIFY row_number() OVER (PARTITION BY key_employee, dte_job_effective ORDER BY src DESC, annual_salary_usd DESC) = 1),
        e AS (SELECT employee_id, company_id, employee_status_code FROM ({RAW_TABLES['ukg_pro.employment']})
              QUALIFY row_number() OVER (PARTITION BY employee_id, company_id ORDER BY date_in_job DESC, date_time_created DESC, employment_no DESC) = 1)
        SELECT o.src, o.key_employee, dte_job_effective, annual_salary_usd, hourly_pay_rate_usd,
               CASE WHEN lag(dte_job_effective) OVER w IS NULL THEN DATE '1900-01-01' ELSE dte_job_effective END AS date_from,
               coalesce(CAST(lead(dte_job_effective) OVER w - 1 AS DATE), DATE '9999-12-31') AS date_to,
               p.nm AS employee_name, p.lf AS employee_name_lf, p.mail AS employee_email, e.employee_status_code AS status
        FROM o LEFT JOIN {person} p ON p.pkey = o.key_employee LEFT JOIN ({RAW_TABLES['ukg_pro.employee']}) u ON u.id = o.key_employee
        LEFT JOIN e ON e.employee_id = u.id AND e.company_id = u.company_id WINDOW w AS (PARTITION BY o.key_employee ORDER BY dte_job_effective)"""
    org_cols = (", 'R' || CAST(d.n_nationkey AS STRING) AS key_department, d.n_name AS department_name, 'R' || CAST(o.n_nationkey AS STRING) AS key_location, o.n_name AS location_name, "
                f"'R' || CAST(r.n_nationkey AS STRING) AS key_entity_record, r.n_name AS entity_name, {nation_cur.replace('n_regionkey', 'r.n_regionkey')} AS currency_code_entity, "
                "j.project_id, j.name AS project_name, j.currency_iso_code AS currency_code_project, p.pkey AS key_employee_ukg, p.nm AS employee_name, p.lf AS employee_name_lf")
    org_joins = ("LEFT JOIN nation d ON b.department_id = 'D' || CAST(d.n_nationkey AS STRING) LEFT JOIN nation o ON b.location_id = 'D' || CAST(o.n_nationkey AS STRING) "
                 "LEFT JOIN nation r ON r.n_nationkey = o.n_regionkey "
                 f"LEFT JOIN (SELECT * FROM ({out['project']}) WHERE src_sys_key = 'int') j ON j.key = b.key_project LEFT JOIN {person} p ON b.employee_id = 'E' || p.pkey")

    def header_lines(model: str, lines: str, head: str, fk: str, names: dict[str, str], joins: str = "", cols: str = "", drop: str = "") -> str:
        head_cols = ", ".join(f"h.{c} AS {n}" for c, n in names.items())
        return (f"SELECT {audit(model)}, b.* EXCLUDE ({GOLD_DROP}{drop}), {head_cols}{org_cols}{cols} FROM ({out[lines]}) b JOIN ({out[head]}) h ON h.key = b.{fk} AND h.src_sys_key = 'int' "
                f"{org_joins} {joins} WHERE b.src_sys_key = 'int' AND b.bln_line_item")

    gold["dim_ap_bill_item"] = header_lines("dim_ap_bill_item", "apbillitem", "apbill", "key_ap_bill", {
        "key": "key_bill", "recordid": "ap_record_id", "basecurr": "base_currency", "currency": "currency_code", "dte_whenposted": "dte_posted", "state": "bill_state"})
    gold["dim_cc_transaction_entry"] = header_lines("dim_cc_transaction_entry", "cc_transaction_entry", "cc_transaction", "key_cc_transaction", {
        "key": "key_transaction", "recordid": "cc_record_id", "basecurr": "base_currency", "currency": "currency_code", "dte_whenposted": "dte_posted", "state": "cc_state"})
    gold["dim_expense_item"] = header_lines("dim_expense_item", "expenseitem", "expense", "key_expense", {
        "key": "key_report", "recordid": "exp_record_id", "basecurr": "exp_base_currency", "currency": "exp_currency", "dte_whenposted": "exp_dte_when_posted", "state": "exp_state"},
        f"LEFT JOIN (SELECT * FROM ({out['expenseitem']}) WHERE src_sys_key = 'sfc') x ON x.hash_link = b.hash_link LEFT JOIN (SELECT * FROM ({out['expense']}) WHERE src_sys_key = 'sfc') y ON y.hash_link = h.hash_link",
        ", x.key AS sfc_key_expense_item, x.state AS sfc_item_status, x.gl_account_no AS gl_account, y.key AS sfc_key_expense, y.project_name AS sfc_project_name", ", employee_name, project_name")
    who_as = lambda role, p: f"{p}.pkey AS key_{role}, {p}.nm AS {role}_name, {p}.lf AS {role}_name_lf, {p}.mail AS {role}_email"
    gold["dim_project_task"] = (
        f"SELECT {audit('dim_project_task')}, b.* EXCLUDE ({GOLD_DROP}), sp.name AS project_name, sp.account_id, ip.key AS key_project_int, ip.currency_iso_code AS project_currency, "
        f"m.name AS phase_code_name, {who_as('owner', 'p')}, q.name AS proposal_name, a.name AS account_name{state_cols}{loc_cols} FROM ({out['project_task']}) b "
        f"LEFT JOIN (SELECT * FROM ({out['project']}) WHERE src_sys_key = 'sfc') sp ON sp.hash_key = b.hash_key_project "
        f"LEFT JOIN (SELECT * FROM ({out['project']}) WHERE src_sys_key = 'int') ip ON ip.hash_link = sp.hash_link "
        f"LEFT JOIN ({live('project_phase_code', s + 'pse_milestone_c')}) m ON m.id = b.key_phase_code LEFT JOIN {person} p ON p.sfc_user_id = b.owner_id "
        f"LEFT JOIN ({out['sales_proposal']}) q ON q.key = b.key_proposal LEFT JOIN ({out['sales_account']}) a ON a.key = sp.account_id {account_place}")
    gold["dim_sales_account"] = f"""
        WITH RECURSIVE acc AS ({out['sales_account']}),
        up(key, above, lvl) AS (SELECT key, key_parent_account, 1 FROM acc WHERE key_parent_account IS NOT NULL
            UNION ALL SELECT up.key, a.key_parent_account, lvl + 1 FROM up JOIN acc a ON a.key = up.above WHERE a.key_parent_account IS NOT NULL),
        chain AS (SELECT up.key, string_agg(up.above, '|' ORDER BY lvl DESC) AS path, count(*) AS depth, arg_max(up.above, lvl) AS top, arg_max(a.name, lvl) AS top_name,
                  arg_min(a.grade, lvl) FILTER (WHERE a.grade IS NOT NULL) AS grade, arg_min(a.payment_terms, lvl) FILTER (WHERE a.payment_terms IS NOT NULL) AS terms
                  FROM up JOIN acc a ON a.key = up.above GROUP BY up.key)
        SELECT {audit('dim_sales_account')}, a.* EXCLUDE ({GOLD_DROP}, grade, payment_terms, key_client_manager, key_owner, key_location, key_practice),
               c.top AS key_top_level_parent_account, c.path AS hierarchy_path, CAST(coalesce(c.depth, 0) AS INTEGER) AS hierarchy_depth, FALSE AS hierarchy_cycle, c.top_name AS top_level_parent_account_name,
               coalesce(a.grade, c.grade) AS grade, coalesce(a.payment_terms, c.terms) AS payment_terms, {who_as('client_manager', 'm')}, {who_as('owner', 'w')}, t.name AS rate_card_set_name
               {state_cols}{loc_cols}{prac_cols}, replace(replace(a.billing_postal_code, '-', ''), ' ', '') AS geo_postal_code,
               CAST(z.latitude AS DOUBLE) AS geo_latitude, CAST(z.longitude AS DOUBLE) AS geo_longitude
        FROM acc a LEFT JOIN chain c ON c.key = a.key LEFT JOIN {person} m ON a.key_client_manager = 'C' || m.pkey LEFT JOIN {person} w ON w.sfc_user_id = a.key_owner
        LEFT JOIN ({out['sales_rate_card_set']}) t ON t.key = a.key_rate_card_set {account_place} {prac.replace('b.key_practice', 'a.key_practice')}
        LEFT JOIN ({RAW_TABLES['reference.postal_code_geolocations']}) z ON z.postal_code = replace(replace(a.billing_postal_code, '-', ''), ' ', '') AND z.key_country = g.nk"""
    near = "CASE WHEN {0} = 'USD' THEN 1.0 ELSE coalesce(x.{1}, 1.0) END"
    cur_p = "upper(coalesce(NULLIF(b.currency_iso_code, ''), 'USD'))"
    div, mul = near.format(cur_p, "fx_rate_div"), near.format(cur_p, "fx_rate_mul")
    gold["dim_project"] = _CUBE + f"""
        SELECT {audit('dim_project')}, b.* EXCLUDE ({GOLD_DROP}, currency_iso_code, assistant_project_manager_id, account_id, client_manager_id, group_id, practice_name, project_manager_name, group_name),
               {cur_p} AS currency_iso_code, t.assistant_project_manager_id, s.key AS key_sfc_project, s.account_id, s.client_manager_id, s.group_id, s.practice_id AS sfc_practice_id, s.account_name AS customer_name,
               {who_as('project_manager', 'm')}, {who_as('client_manager', 'c')}, u.c_name AS assistant_project_manager_name, 'R' || CAST(d.n_nationkey AS STRING) AS key_department, d.n_name AS department_name,
               gr.n_name AS group_name, 'R' || CAST(d.n_nationkey AS STRING) AS key_practice_area, d.n_name AS practice_area_name, coalesce(pa.n_name, ps.n_name) AS practice_name,
               'R' || CAST(l.n_nationkey AS STRING) AS key_location, l.n_name AS location_name, r.n_name AS region_name, v.c_name AS regional_manager_name, e.n_name AS entity_name, {cur_of('e')} AS currency_code_entity,
               CAST(CAST(CAST(b.amt_po AS DECIMAL(18,2)) * CAST(CASE WHEN {div} >= 0.09 THEN 1.0 / {div} ELSE {mul} END AS DECIMAL(20,14)) AS DECIMAL(18,2)) AS DOUBLE) AS amt_po_usd
        FROM ({out['project']}) b CROSS JOIN lim LEFT JOIN (SELECT * FROM ({out['project']}) WHERE src_sys_key = 'psa') t ON t.hash_link = b.hash_link
        LEFT JOIN (SELECT * FROM ({out['project']}) WHERE src_sys_key = 'sfc') s ON s.hash_link = b.hash_link LEFT JOIN {person} m ON b.project_manager_id = 'E' || m.pkey
        LEFT JOIN {person} c ON s.client_manager_id = 'C' || c.pkey AND CAST(c.pkey AS BIGINT) % 61 <> 17 LEFT JOIN customer u ON t.assistant_project_manager_id = CAST(u.c_custkey AS STRING)
        LEFT JOIN nation d ON b.department_id = 'D' || CAST(d.n_nationkey AS STRING) LEFT JOIN nation gr ON s.group_id = 'S' || CAST(gr.n_nationkey AS STRING)
        LEFT JOIN nation pa ON pa.n_nationkey = d.n_regionkey LEFT JOIN nation ps ON s.practice_id = 'S' || CAST(ps.n_nationkey AS STRING)
        LEFT JOIN nation l ON b.location_id = 'D' || CAST(l.n_nationkey AS STRING) LEFT JOIN nation r ON r.n_nationkey = l.n_regionkey LEFT JOIN customer v ON v.c_custkey = r.n_regionkey
        LEFT JOIN nation e ON b.key_entity = CAST(e.n_nationkey AS STRING) LEFT JOIN cube x ON x.frm_curr = {cur_p} AND x.to_curr = 'USD' AND x.date = greatest(least(b.dte_src_start, hi), lo)
        WHERE b.src_sys_key = 'int' AND lower(b.project_type) <> 'client site'"""
    role_names = [f"approver_{i}" for i in range(1, 11)] + [f"reviewer_{i}" for i in range(1, 6)]
    lists = ("location", "opportunity")
    gold["dim_sales_proposal"] = f"""
        WITH d AS (SELECT key_proposal, coalesce(sum(CAST(total_price AS DECIMAL(18,2))), 0) AS total, CAST(coalesce(sum(CAST(unit_price AS DECIMAL(18,2))), 0) AS DOUBLE) AS unit,
                   {', '.join(f"coalesce(sum(CAST(total_price_{n} AS DECIMAL(18,2))), 0) AS list_{n}" for n in lists)} FROM ({out['sales_proposal_line_item']}) GROUP BY 1)
        SELECT {audit('dim_sales_proposal')}, b.* EXCLUDE ({GOLD_DROP}, key_owner, key_practice, key_project), b.key_project AS sfc_project_id, {who_as('owner', 'w')},
               {', '.join(f"{r}_p.nm AS {r}_name" for r in role_names)}, o.name AS opportunity_name, ip.key AS key_project, ip.project_id, ip.name AS project_name,
               a.name AS account_name{state_cols}{loc_cols}{prac_cols}, CAST(d.total AS DOUBLE) AS amt_total_price,
               {', '.join(f"CAST(d.list_{n} AS DOUBLE) AS amt_total_price_{n}, CAST(d.list_{n} - d.total AS DOUBLE) AS amt_discount_{n}, CASE WHEN d.total IS NOT NULL THEN CASE WHEN d.total = 0 OR d.unit = 0 THEN 0.0 ELSE CAST(d.total - d.list_{n} AS DOUBLE) / d.unit END END AS perc_discount_{n}" for n in lists)}
        FROM ({out['sales_proposal']}) b LEFT JOIN d ON d.key_proposal = b.key LEFT JOIN {person} w ON w.sfc_user_id = b.key_owner
        {' '.join(f"LEFT JOIN {person} {r}_p ON {r}_p.sfc_user_id = b.{r}" for r in role_names)} LEFT JOIN ({out['sales_opportunity']}) o ON o.key = b.key_opportunity
        LEFT JOIN (SELECT * FROM ({out['project']}) WHERE src_sys_key = 'sfc') sp ON sp.key = coalesce(o.key_project, b.key_project)
        LEFT JOIN (SELECT * FROM ({out['project']}) WHERE src_sys_key = 'int') ip ON ip.hash_link = sp.hash_link
        LEFT JOIN ({out['sales_account']}) a ON a.key = b.key_account {account_place} {prac}"""
    gold["dim_sales_opportunity"] = f"""
        WITH RECURSIVE {_CUBE.strip().removeprefix('WITH ')}, opp AS ({out['sales_opportunity']}),
        up(key, above, lvl) AS (SELECT key, key_parent_opportunity, 1 FROM opp WHERE key_parent_opportunity IS NOT NULL
            UNION ALL SELECT up.key, a.key_parent_opportunity, lvl + 1 FROM up JOIN opp a ON a.key = up.above WHERE a.key_parent_opportunity IS NOT NULL),
        chain AS (SELECT up.key, string_agg(up.above, '|' ORDER BY lvl DESC) AS path, count(*) AS depth, arg_max(up.above, lvl) AS top, arg_max(a.name, lvl) AS top_name
                  FROM up JOIN opp a ON a.key = up.above GROUP BY up.key),
        d AS (SELECT key_opportunity, sum(CAST(list_price AS DECIMAL(18,2))) AS g, sum(CAST(total_price AS DECIMAL(18,2))) AS n FROM ({out['sales_opportunity_line_item']}) GROUP BY 1)
        SELECT {audit('dim_sales_opportunity')}, b.* EXCLUDE ({GOLD_DROP}, amt, currency_iso_code, key_owner, key_practice, key_location), b.amt, {cur_p} AS currency_iso_code,
               CAST(d.g AS DOUBLE) AS amt_gross, CAST(d.n AS DOUBLE) AS amt_net, CAST(d.g - d.n AS DOUBLE) AS amt_discount,
               CASE WHEN d.g IS NOT NULL THEN CASE WHEN d.g = 0 THEN 0.0 ELSE CAST(d.g - d.n AS DOUBLE) / CAST(d.g AS DOUBLE) END * 100 END AS discount_percent,
               c.top AS key_top_level_opportunity, c.top_name AS top_level_opportunity_name, c.path AS hierarchy_path, CAST(coalesce(c.depth, 0) AS INTEGER) AS hierarchy_depth, FALSE AS hierarchy_cycle,
               a.name AS account_name, a.key_top_level_parent_account, {who_as('owner', 'w')}{prac_cols}{loc_cols},
               CASE WHEN {cur_p} = 'USD' THEN 1.0 ELSE coalesce(x.fx_rate_mul, 1.0) END AS fx_rate_usd,
               CAST(CAST(CAST(b.amt AS DECIMAL(18,2)) * CAST(CASE WHEN {cur_p} = 'USD' THEN 1.0 ELSE coalesce(x.fx_rate_mul, 1.0) END AS DECIMAL(20,14)) AS DECIMAL(18,2)) AS DOUBLE) AS amt_usd
        FROM opp b CROSS JOIN lim LEFT JOIN chain c ON c.key = b.key LEFT JOIN d ON d.key_opportunity = b.key LEFT JOIN ({gold['dim_sales_account']}) a ON a.key = b.key_account
        LEFT JOIN {person} w ON w.sfc_user_id = b.key_owner {prac} LEFT JOIN {place} h ON h.sk = b.key_location
        LEFT JOIN cube x ON x.frm_curr = {cur_p} AND x.to_curr = 'USD' AND x.date = greatest(least(b.dte_close, hi), lo)"""
    e = "psatools."
    cur_e = "upper(coalesce(NULLIF(c.code, ''), 'USD'))"
    day = "coalesce(p.dte_internal_approval, o.dte_proposal_submitted, o.dte_close)"
    views["vw_estimate_phase_code_products"] = _CUBE + f""", b AS (
            SELECT pc.recordid AS key, pc.estimatetotalid AS key_estimate_total, et.estimateid AS key_estimate, p.key_opportunity, p.key AS key_proposal, a.key AS key_account, o.key_location, o.key_practice, p.key_project,
                   a.key_top_level_parent_account, a.top_level_parent_account_name AS client_name, a.name AS client_site_name, o.name AS opportunity_name, p.project_id, p.project_name, o.practice_name, o.location_name,
                   p.name AS proposal_name, p.quote_number AS proposal_number, o.contract_type, pc.name AS phase_code, coalesce(k.id, 'OTHER') AS standard_phase_code,
                   coalesce(k.product_id, 'Regular Labor Sales') AS product, CAST(pc.hours AS DOUBLE) AS hours, CAST(pc.budget AS DOUBLE) AS cost_original, c.code AS currency_iso_code,
                   p.dte_internal_approval, o.dte_proposal_submitted, o.dte_close, {day} AS dte_currency_conversion, o.stage_name AS opportunity_status, p.status AS proposal_status,
                   CASE WHEN {cur_e} = 'USD' THEN 1.0 ELSE coalesce(x.fx_rate_mul, 1.0) END AS fx_rate_usd
            FROM ({RAW_TABLES[e + 'estimatetotals_phasecodes']}) pc CROSS JOIN lim LEFT JOIN ({RAW_TABLES[e + 'estimatetotals']}) et ON pc.estimatetotalid = et.estimatetotalid
            JOIN ({RAW_TABLES[e + 'estimate']}) q ON et.estimateid = q.estimateid LEFT JOIN ({RAW_TABLES[e + 'currency']}) c ON q.currencyid = c.currencyid
            JOIN ({gold['dim_sales_proposal']}) p ON q.sfproposalid = p.key LEFT JOIN ({gold['dim_sales_opportunity']}) o ON p.key_opportunity = o.key
            LEFT JOIN ({gold['dim_sales_account']}) a ON o.key_account = a.key
            LEFT JOIN (SELECT l.phase_code, spc.id, spc.product_id FROM ({RAW_TABLES[e + 'standard_phase_codes_product_links']}) l
                       JOIN ({RAW_TABLES[e + 'standard_phase_codes']}) spc ON l.standard_phase_code_id = spc.id WHERE spc.bln_is_billable) k ON k.phase_code = pc.name
            LEFT JOIN cube x ON x.frm_curr = {cur_e} AND x.to_curr = 'USD' AND x.date = greatest(least({day}, hi), lo))
        SELECT *, CAST(CAST(CAST(cost_original AS DECIMAL(18,2)) * CAST(fx_rate_usd AS DECIMAL(20,14)) AS DECIMAL(18,2)) AS DOUBLE) AS cost_usd FROM b"""
    ukg = "ukg_pro."
    latest = "QUALIFY row_number() OVER (PARTITION BY employee_id, company_id ORDER BY"
    staff = f"""staff AS (
            SELECT CAST(c.c_custkey AS STRING) AS key_employee, {who} || ' ' || c_name AS employee_name, c_name || ', ' || {who} AS employee_name_lf, c_name || '@example.com' AS employee_email,
                   'E' || CAST(c.c_custkey AS STRING) AS intacct_id, s.pkey AS key_supervisor, s.nm AS supervisor_name, s.lf AS supervisor_name_lf, s.mail AS supervisor_email,
                   'R' || CAST(e.n_nationkey AS STRING) AS key_entity, e.n_name AS entity_name, 'R' || CAST(r.n_nationkey AS STRING) AS key_region, r.n_name AS region_name,
                   'R' || CAST(e.n_nationkey AS STRING) AS key_location, e.n_name AS location_name, 'R' || CAST(d.n_nationkey AS STRING) AS key_department, d.n_name AS department_name,
                   t.record_id AS key_employee_type, t.display_name AS employee_type_name, m.original_hire_date AS dte_original_hire_date, m.last_hire_date AS dte_last_hire_date,
                   m.date_of_termination AS dte_termination_date, r.n_regionkey AS regional_manager_user_id, g.nm AS regional_manager_name, g.lf AS regional_manager_name_lf, g.mail AS regional_manager_email
            FROM customer c LEFT JOIN (SELECT * FROM ({RAW_TABLES[ukg + 'employment']}) {latest} date_in_job DESC, date_time_created DESC, employment_no DESC) = 1) m ON m.employee_id = CAST(c.c_custkey AS STRING)
            LEFT JOIN (SELECT * FROM ({RAW_TABLES[ukg + 'employee_job_history']}) {latest} job_effective_date DESC, date_time_created DESC, id DESC) = 1) j ON j.employee_id = CAST(c.c_custkey AS STRING)
            LEFT JOIN {person} s ON s.pkey = m.supervisor_id LEFT JOIN ({RAW_TABLES['portal.employee_types']}) t ON t.ukg_id = m.employee_type_code
            LEFT JOIN nation d ON CAST(d.n_nationkey AS STRING) = j.organization_level_2_id LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
            LEFT JOIN nation e ON e.n_nationkey = n.n_regionkey LEFT JOIN nation r ON r.n_nationkey = e.n_regionkey LEFT JOIN {person} g ON g.pkey = CAST(r.n_regionkey AS STRING))"""
    name = "timesheet_entry"
    views["vw_timesheet_missing"] = f"""
        WITH {staff}, weeks AS (SELECT CAST(d AS DATE) AS dte_start, CAST(d AS DATE) + 6 AS dte_end FROM generate_series(TIMESTAMP '2001-01-01', TIMESTAMP '2001-08-01', INTERVAL 7 DAY) g(d)),
        sheet AS (SELECT key, employee_id, dte_src_start, status FROM ({out['timesheet']}) WHERE src_sys_key = 'int'),
        entry AS (SELECT * FROM ({live(name, 'sage_intacct.timesheetentry')}) WHERE timesheetkey IN (SELECT recordno FROM ({live(name, 'sage_intacct.timesheet')}))
                  QUALIFY row_number() OVER (PARTITION BY projectid, employeeid, entrydate, taskkey ORDER BY whenmodified DESC, recordno DESC) = 1),
        hours AS (SELECT CAST(timesheetkey AS STRING) AS sheet, sum(CAST(qty AS DECIMAL(18,2))) AS qty FROM entry GROUP BY 1)
        SELECT s.key AS key_timesheet, w.dte_start AS timesheet_start_date, w.dte_end AS timesheet_end_date, CAST(coalesce(h.qty, 0) AS DOUBLE) AS qty, s.status, p.*
        FROM weeks w JOIN staff p ON w.dte_end > p.dte_last_hire_date AND (w.dte_end < p.dte_termination_date OR p.dte_termination_date IS NULL)
        LEFT JOIN sheet s ON s.employee_id = p.intacct_id AND s.dte_src_start = w.dte_start LEFT JOIN hours h ON h.sheet = s.key
        WHERE lower(p.key_employee_type) NOT IN ('1814354', '1814355', '474084', '1815351', '1833005', '1833006', '1143543') AND s.status IS NULL"""
    hours = " + ".join(f"coalesce(t.pse_{d}_hours_c, 0)" for d in ("sunday", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday"))
    views["vw_timesheet_unapproved"] = f"""
        WITH {staff}, hours AS (SELECT t.pse_timecard_c AS sheet, sum({hours}) AS qty FROM ({live(name, 'salesforce.pse_task_time_c')}) t
                                JOIN ({live(name, 'salesforce.pse_timecard_header_c')}) h ON h.id = t.pse_timecard_c WHERE {hours} <> 0 GROUP BY 1)
        SELECT s.key AS key_timesheet, s.dte_src_start AS timesheet_start_date, s.dte_src_end AS timesheet_end_date, CAST(h.qty AS DOUBLE) AS qty, s.status AS timesheet_status,
               p.* REPLACE (coalesce(p.employee_name, s.employee_name) AS employee_name, coalesce(p.employee_name_lf, s.employee_name) AS employee_name_lf)
        FROM (SELECT * FROM ({out['timesheet']}) WHERE src_sys_key = 'sfc') s LEFT JOIN hours h ON h.sheet = s.key
        LEFT JOIN (SELECT * FROM ({RAW_TABLES['salesforce.contact']}) WHERE record_type_id = '0124W000001bI6LQAU') c ON c.id = s.key_employee
        LEFT JOIN staff p ON p.key_employee = c.ukg_employee_id_c WHERE s.status <> 'Approved'"""
    return {**out, **gold, **views}


MODEL_SQL = _models()
