"""Row-count rules: counts come with the build, broken rules show, deletion flags are read per model."""

import pytest
from pyspark.sql import functions as F

from silverloom.models import rules
from silverloom.models.core import MODELS, Warehouse, deletion_flags
from silverloom.plans.catalogue import warehouse
from tests.conftest import SF


def build(spark, tmp_path, name, change=None):
    w = warehouse(spark, SF, str(tmp_path))
    if change:
        plain = w._source
        w._source = lambda system, table: change(plain(system, table)) if table == change.table else plain(system, table)
    w.ref(name)
    return w


def test_counts_arrive_with_the_write_and_no_second_read(spark, tmp_path, monkeypatch):
    read = []
    w = warehouse(spark, SF, str(tmp_path))
    plain = w._source
    monkeypatch.setattr(w, "_source", lambda system, table: read.append(table) or plain(system, table))
    w.ref("timesheet")
    assert w.counts.of_source["timesheet", "int"] == w.counts.of_model["timesheet", "src_sys_key = 'int'"] > 0
    assert sorted(read) == ["contact", "pse_timecard_header_c", "timesheet"]  # each once: nothing was counted anew


def test_a_model_that_loses_rows_breaks_its_rule(spark, tmp_path, monkeypatch):
    lossy = rules.SourceRule("apbill", "int", "sage_intacct.ap_bill", "TRUE")  # deleted rows are asked for as well
    monkeypatch.setattr(rules, "SOURCE_RULES", (lossy,))
    monkeypatch.setattr(rules, "MODEL_RULES", ())
    row = rules.check(warehouse(spark, SF, str(tmp_path))).collect()
    raw = warehouse(spark, SF)._source("sage_intacct", "ap_bill")
    assert [tuple(r) for r in row] == [("apbill.int", "source rows", raw.filter("NOT _fivetran_deleted").count(), raw.count(), False)]
    assert row[0]["n_model"] < row[0]["n_expected"]


def test_a_part_the_plan_does_without_is_counted_directly(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(rules, "WAIT", 0.5)
    monkeypatch.setattr(rules.Counts, "watch_source", lambda self, df, model, table: df)
    w = build(spark, tmp_path, "apbill")
    assert w.counts.of_source["apbill", "int"] == w.ref("apbill").count()


@pytest.mark.parametrize("required", [False, True])
def test_fanout_equals_the_joins(spark, required):
    left = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), (None,), (None,)], "k string")
    one = spark.createDataFrame([("a",), ("a",), ("c",), ("z",), (None,)], "x string")
    two = spark.createDataFrame([("a",), ("b",), ("b",), ("b",)], "y string")
    how = "inner" if required else "left"
    want = left.join(one, left.k == one.x, how).join(two, left.k == two.y, how).count()
    assert rules.fanout_count(left, "k", [(one, "x"), (two, "y")], required) == want
    assert rules.fanout_count(left.limit(0), "k", [(one, "x")], required) == 0


def test_each_model_reads_its_own_flags(spark):
    rows = spark.createDataFrame([(1, False, False), (2, True, False), (3, False, True), (4, None, False), (5, False, None)],
                                 "id int, _fivetran_deleted boolean, is_deleted boolean")
    w = Warehouse(spark, lambda system, table: rows, "2001-08-01")

    def kept(model, table):
        w._building.append(model)
        out = w.source(*table.split("."))
        w._building.pop()
        assert out.columns == ["id"]
        return sorted(r["id"] for r in out.collect())

    assert kept("sales_lead", "salesforce.lead") == [1, 3, 5]
    assert kept("estimates_vs_actuals", "salesforce.pse_assignment_c") == [1]
    assert kept("timesheet_entry", "salesforce.pse_task_time_c") == [1, 2, 4]
    assert kept("invoice_item", "sage_intacct.ar_invoice_item") == [1, 2, 3, 4, 5]
    assert deletion_flags(None, "portal.users") == ("_fivetran_deleted",)


def test_rules_name_models_that_exist():
    assert len(rules.SOURCE_RULES) == 25 and len(rules.MODEL_RULES) == 27
    assert {r.model for r in (*rules.SOURCE_RULES, *rules.MODEL_RULES)} <= set(MODELS)
    names = [(type(r).__name__, r.name) for r in (*rules.SOURCE_RULES, *rules.MODEL_RULES)]
    assert len(set(names)) == len(names)
    assert F.expr(rules.SOURCE_RULES[0].rows) is not None
