"""Every query against its SQL, and every model's size and keys, on the smallest test data."""

import duckdb
import pytest

import __spark_entry__ as entry
from silverloom.models.core import MODELS
from silverloom.plans.catalogue import stored
from tests.conftest import SF
from tools.check_queries import TABLES, compare

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    out = compare(QUERIES[name](spark, SF), ORACLES[name], duck)
    assert out.startswith("ok"), out


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_model_is_a_query():
    assert len(MODELS) == 84
    assert {f"model_{m}" for m in MODELS} <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(m for m, x in MODELS.items() if x.layer == "consolidation"))
def test_silver_keys_are_unique_within_a_system(spark, name):
    df = stored(spark, SF).ref(name)
    dup = df.groupBy("src_sys_key", "key").count().filter("count > 1")
    assert dup.count() == 0
    assert df.filter("key IS NULL OR hash_key <> md5(key)").count() == 0


@pytest.mark.parametrize("gold, silver, tag", [
    ("dim_employee", "employee", "ukg"), ("dim_employee_compensation", "employee_compensation", "ukg"), ("dim_employee_earning", "employee_earning", "ukg"),
    ("dim_employee_payroll_deductions", "employee_payroll_deductions", "ukg"), ("dim_employee_job_history", "employee_job_history", "ukg"),
    ("dim_invoice", "invoice", "int"), ("dim_invoice_item", "invoice_item", "int"), ("dim_timesheet", "timesheet", "int"), ("dim_timesheet_entry", "timesheet_entry", "int"),
    ("dim_project_task", "project_task", "sfc"),
    ("dim_project_task_milestone", "project_task_milestone", "sfc"), ("dim_sales_account", "sales_account", "sfc"),
    ("dim_sales_account_team_member", "sales_account_team_member", "sfc"), ("dim_sales_contact", "sales_contact", "sfc"), ("dim_sales_lead", "sales_lead", "sfc"),
    ("dim_sales_opportunity", "sales_opportunity", "sfc"), ("dim_sales_opportunity_line_item", "sales_opportunity_line_item", "sfc"),
    ("dim_sales_opportunity_team_member", "sales_opportunity_team_member", "sfc"), ("dim_sales_price_book_entry", "sales_price_book_entry", "sfc"),
    ("dim_sales_product", "sales_product", "sfc"), ("dim_sales_proposal", "sales_proposal", "sfc"), ("dim_sales_proposal_line_item", "sales_proposal_line_item", "sfc"),
    ("dim_sales_purchase_order", "sales_purchase_order", "sfc"), ("dim_sales_rate_card", "sales_rate_card", "sfc"), ("dim_sales_rate_card_set", "sales_rate_card_set", "sfc"),
    ("dim_sales_user", "sales_user", "sfc")])
def test_gold_rows_equal_silver_rows(spark, gold, silver, tag):
    w = stored(spark, SF)
    assert w.ref(gold).count() == w.system(silver, tag).count()


@pytest.mark.parametrize("gold, silver, head, key", [
    ("dim_ap_bill_item", "apbillitem", "apbill", "key_ap_bill"), ("dim_cc_transaction_entry", "cc_transaction_entry", "cc_transaction", "key_cc_transaction"),
    ("dim_expense_item", "expenseitem", "expense", "key_expense")])
def test_lines_are_those_whose_header_is_not_deleted(spark, gold, silver, head, key):
    w = stored(spark, SF)
    lines = w.system(silver, "int").filter("bln_line_item")
    with_header = lines.join(w.system(head, "int").selectExpr(f"key AS {key}"), key, "left_semi")
    assert w.ref(gold).count() == with_header.count() < lines.count()


@pytest.mark.parametrize("gold, silver, tag, left_out", [
    ("dim_estimates_vs_actuals", "estimates_vs_actuals", "sfc", "bln_exclude_from_planners"), ("dim_project", "project", "int", "lower(project_type) = 'client site'")])
def test_gold_leaves_out_what_its_rule_says(spark, gold, silver, tag, left_out):
    w = stored(spark, SF)
    rows = w.system(silver, tag)
    assert w.ref(gold).count() == rows.filter(f"NOT coalesce({left_out}, true)").count() < rows.count()


@pytest.mark.parametrize("name", sorted(m for m, x in MODELS.items() if x.layer == "dataconsumption"))
def test_gold_model_has_rows(spark, name):
    assert stored(spark, SF).ref(name).limit(1).count() == 1
