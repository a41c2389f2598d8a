"""Contracts at the write, stores that follow their input, the catalog sink, text aggregation of a hot key."""

import os
import re
import shutil
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from silverloom.functions.keys import hash_key
from silverloom.models import core, silver
from silverloom.models.core import Model, Warehouse
from silverloom.operators import rollup
from silverloom.operators.quality import ContractError
from silverloom.operators.stack import marked, stack
from silverloom.plans import catalogue
from silverloom.registry import Tables
from silverloom.sources import raw, tables
from tests.conftest import SF, rows


def broken(monkeypatch, spark, tmp_path, change):
    """A warehouse whose model ``apbill`` is changed after it is made."""
    plain = core.MODELS["apbill"]
    monkeypatch.setitem(core.MODELS, "apbill", Model("apbill", plain.layer, plain.sink, lambda w: change(plain.build(w))))
    return catalogue.warehouse(spark, SF, str(tmp_path))


@pytest.mark.parametrize("change, says", [
    (lambda df: df.drop("hash_link"), "hash_link holds nothing"),
    (lambda df: df.withColumn("bln_current", F.lit("yes")), "bln_current holds text, declared flag"),
    (lambda df: df.withColumn("amt_total", F.lit("9")), "amt_total holds text, declared number"),
    (lambda df: df.withColumn("notes", F.array(F.lit(1))), "notes holds array<int>, declared a plain value"),
    (lambda df: df.select("*", F.lit(1).alias("state")), "state is there 2 times"),
])
def test_a_model_that_breaks_its_contract_starts_no_job(spark, tmp_path, monkeypatch, change, says):
    with pytest.raises(ContractError, match=says):
        broken(monkeypatch, spark, tmp_path, change).ref("apbill")
    assert not os.path.exists(f"{tmp_path}/consolidation")


def test_nulls_in_filled_columns_are_found_by_the_write(spark, tmp_path, monkeypatch):
    holes = broken(monkeypatch, spark, tmp_path, lambda df: df.withColumn("key", F.when(F.col("key") > "2", F.col("key"))))
    with pytest.raises(ContractError, match="null_key"):
        holes.ref("apbill")


def test_contract_query_binds_every_column_of_every_model(spark):
    import __spark_entry__ as entry

    out = entry.queries()["model_contracts"](spark, SF)
    assert out.select("model").distinct().count() == 84
    assert out.filter("NOT ok").count() == 0 and out.filter("declared = 'number'").count() > 50
    w = catalogue.stored(spark, SF)
    assert out.filter("model = 'invoice'").count() == len(w.ref("invoice").columns)


def test_a_store_follows_its_input(spark, tmp_path):
    folder = f"{tmp_path}/in"
    shutil.copytree(SF, folder)
    os.chmod(folder, 0o755)
    first = catalogue.stored(spark, folder)
    assert catalogue.stored(spark, folder) is first
    n = first.ref("vw_finance_locations").count(), first.ref("sales_product").count()
    part = spark.read.parquet(f"{SF}/part.parquet")
    os.remove(f"{folder}/part.parquet")
    part.filter("p_partkey % 2 = 0").coalesce(1).write.parquet(f"{folder}/part.parquet")
    second = catalogue.stored(spark, folder)
    assert second is not first
    assert (second.ref("vw_finance_locations").count(), second.ref("sales_product").count()) == (n[0], part.filter("p_partkey % 2 = 0").count())


def test_readers_never_see_a_refresh_half_done(spark):
    schema = "published_here"
    old = tables.publish_table(spark.range(3), schema, "numbers")
    view = tables.point_view(spark, f"{schema}.vw_sum", f"SELECT sum(id) AS s FROM {schema}.numbers")
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        tables.publish_table(spark.range(5).select((1 / (F.col("id") - 4).cast("int")).alias("id"), F.expr("1 div (id - 4)").alias("x")), schema, "numbers")
    assert spark.table(f"{schema}.numbers").count() == 3  # the failed refresh changed nothing
    tables.publish_table(spark.range(10), schema, "numbers")
    assert old.count() == 3  # a reader keeps what it began with
    assert tables.load_catalog_table(spark, f"spark_catalog.{schema}.numbers").count() == 10
    assert spark.table(f"{schema}.vw_sum").first()[0] == 45 and view.first()[0] in (3, 45)
    tables.publish_table(spark.range(1), schema, "numbers_too")
    for n in (11, 12):
        tables.publish_table(spark.range(n), schema, "numbers")
    kept = [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {schema} LIKE 'numbers__*'").collect()]
    assert len([n for n in kept if n.startswith("numbers__")]) == 2 and spark.table(f"{schema}.numbers_too").count() == 1


@pytest.mark.parametrize("order", ["d", "n", "s"])
@pytest.mark.parametrize("distinct", [False, True])
def test_one_key_with_all_rows_is_joined_in_pieces(spark, monkeypatch, order, distinct):
    monkeypatch.setattr(rollup, "HOT_ROWS", 50)
    data = [(1 if k % 10 else 2, f"v{k * 7919 % 600:04d}", date(2000, 1, 1) + timedelta(k * 31 % 997), k * 31 % 997, f"o{k * 31 % 997:05d}") for k in range(1200)]
    data += [(None, "x", date(2000, 1, 1), 1, "a"), (3, None, date(2000, 1, 1), 1, "a")]
    at = {"d": 2, "n": 3, "s": 4}[order]
    want = {}
    for key in (1, 2, None):
        rows = sorted((r[at], r[1]) for r in data if r[0] == key)
        if distinct:
            first = {}
            for o, v in rows:
                first.setdefault(v, o)
            rows = sorted((o, v) for v, o in first.items())
        want[key] = ",".join(v for _, v in rows)
    df = spark.createDataFrame(data, "k int, v string, d date, n int, s string")
    got = rollup.ordered_concat(df, ["k"], "v", F.col(order), ",", distinct)
    assert {r["k"]: r["values_text"] for r in got.collect()} == want
    most = rollup._pieces(df.filter("v IS NOT NULL").select("k", F.col("v").alias("__v"), F.col(order).alias("__o")), ["k"]).groupBy("k", "__c").count()
    assert most.agg(F.max("count")).first()[0] <= 50


def test_warehouse_without_root_checks_contracts_too(spark):
    w = Warehouse(spark, lambda s, t: spark.createDataFrame([(1, False)], "recordno int, _fivetran_deleted boolean").withColumn("entitykey", F.lit(1)), "2001-08-01")
    assert w.ref("apbill").count() == 1


def test_rows_are_written_where_they_are(spark, tmp_path):
    """Every task writes its own rows, unmoved and unsorted, packed tightly; folders and setting are as before."""
    df = spark.range(0, 900, 1, 3).select(F.lit("a").alias("src_sys_key"), "id").unionByName(
        spark.range(0, 400, 1, 2).select(F.lit("b").alias("src_sys_key"), "id"))
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", None)
    out = tables.write_table(df, str(tmp_path), "consolidation", "m", ["src_sys_key"])
    files = {k: [f for f in os.listdir(f"{tmp_path}/consolidation/m/src_sys_key={k}") if f.endswith(".zstd.parquet")] for k in "ab"}
    assert {k: len(f) for k, f in files.items()} == {"a": 3, "b": 2}
    assert rows(out) == rows(df)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", None) == before


@pytest.mark.parametrize("table", ["ukg_pro.earning_history_base_element", "sage_intacct.ap_bill_item"])
def test_raw_lines_are_dealt_by_order_once(spark, frame, tmp_path, table):
    """Lines move once, for grouping and join; the rows are those of the plain text, with repeated and missing keys too."""
    frame("c_custkey bigint, c_nationkey bigint", (1, 3), (2, 4), (2, 5), (None, 1)).write.parquet(f"{tmp_path}/customer.parquet")
    frame("o_orderkey bigint, o_custkey bigint, o_orderpriority string", (1, 1, "2-HIGH"), (2, 2, "5-LOW"), (2, 1, None), (3, None, "5-LOW"), (None, 1, "5-LOW")).write.parquet(
        f"{tmp_path}/orders.parquet")
    frame("l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
          *[(o, n, 7, 1, 2.0, 10.5, "R", "F", None) for o in (1, 2, 3, None) for n in (1, 1, 2)]).write.parquet(f"{tmp_path}/lineitem.parquet")
    given = Tables(spark, str(tmp_path))
    plain, once = (given.sql(text, {n: given(n) for n in ("lineitem", "orders", "customer")}) for text in (raw.RAW_TABLES[table], raw.spark_form(raw.RAW_TABLES[table])))
    assert rows(once) == rows(plain) and once.count() == 8
    moves = [x for x in once._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning(l_orderkey" in x]
    assert moves and not [x for x in moves if "l_linenumber" in x]


def test_hashes_are_made_anew_in_their_old_places(frame):
    plain = frame("key string, hash_key string, a int, key_p string, hash_key_p string, hash_other string", ("1", "", 5, "7", "", "x"), (None, "", 6, None, "", "y")).withColumns(
        {"hash_key": hash_key("key"), "hash_key_p": hash_key("key_p")})
    bare, of = core.lean(plain)
    assert of == {"hash_key": "key", "hash_key_p": "key_p"}
    assert bare.filter("hash_key IS NULL AND hash_key_p IS NULL").count() == 2
    moved = core.hashed(bare.withColumnRenamed("key_p", "key_q"), of, hash_key_p="key_q")
    assert rows(moved) == rows(plain)


def test_hashes_keep_their_names_where_the_key_has_another(frame):
    plain = frame("key string, hash_key string, key_owner string, hash_key_owner string", ("1", "", "7", ""), ("2", "", None, "")).withColumns(
        {"hash_key": hash_key("key"), "hash_key_owner": hash_key("key_owner")})
    bare, of = core.lean(plain)
    out = core.hashed(bare.withColumnRenamed("key_owner", "key_owner_sfc"), {**of, "hash_key_owner": "key_owner_sfc"})
    assert out.columns == ["key", "hash_key", "key_owner_sfc", "hash_key_owner"] and rows(out) == rows(plain)
    assert marked(out) == {"hash_key": "key"}


def test_accounting_lines_carry_no_hashes_through_their_joins(spark):
    """Rows of a reporting model are shuffled without the hashes of the conformed model, and have them in the end."""
    w = catalogue.warehouse(spark, SF)
    out = w.ref("dim_cc_transaction_entry")
    assert out.filter(~F.col("hash_key").eqNullSafe(hash_key("key")) | ~F.col("hash_key_project").eqNullSafe(hash_key("key_project"))).isEmpty()
    assert out.filter("hash_key_cc_transaction IS NOT NULL").count() == out.count() > 0


def test_every_hash_follows_from_the_key_beside_it(spark):
    """What ``lean`` relies on, for all models of which it takes the hashes off."""
    w = catalogue.warehouse(spark, SF)
    for name, system in (("cc_transaction_entry", "int"), ("apbillitem", "int"), ("expenseitem", "int"), ("invoice_item", "int"), ("timesheet_entry", "int"),
                         ("sales_opportunity", "sfc"), ("sales_opportunity_line_item", "sfc"), ("sales_proposal", "sfc"), ("sales_proposal_line_item", "sfc"),
                         ("sales_purchase_order", "sfc"), ("sales_account_team_member", "sfc"), ("sales_opportunity_team_member", "sfc"), ("sales_lead", "sfc"),
                         ("sales_rate_card", "sfc"), ("sales_rate_card_set", "sfc"), ("employee_earning", "ukg"), ("employee_payroll_deductions", "ukg")):
        df = w.system(name, system)
        _, of = core.lean(df)
        assert {"hash_key", "hash_link"} <= set(of)
        wrong = df.agg(*[F.count_if(~F.col(h).eqNullSafe(hash_key(c))).alias(h) for h, c in of.items()]).first().asDict()
        assert not any(wrong.values()), (name, wrong)


def test_hashes_of_stored_keys_are_made_when_they_are_read(spark, frame, tmp_path):
    """No hash of a key beside it takes room in a stored table; rows, columns and their order are those of the plain model."""
    root = catalogue.warehouse(spark, SF, str(tmp_path))
    for name, layer in (("project_phase_code", "consolidation"), ("sales_opportunity_line_item", "consolidation"), ("dim_sales_opportunity_line_item", "dataconsumption"),
                        ("dim_invoice_item", "dataconsumption")):
        plain, stored = catalogue.warehouse(spark, SF).ref(name), root.ref(name)
        kept = spark.read.parquet(f"{tmp_path}/{layer}/{name}").columns
        assert stored.columns == plain.columns and rows(stored) == rows(plain)
        assert {"hash_key", "hash_link"} & set(plain.columns) and not {"hash_key", "hash_link"} & set(kept)
    # the practice's key is another one by then, its hash is still the old key's
    assert "hash_key_practice" in spark.read.parquet(f"{tmp_path}/dataconsumption/dim_sales_opportunity_line_item").columns


def test_a_hash_that_some_source_lacks_is_stored(frame):
    a = core.conform_by_rule(frame("id int, p int", (1, 5)), "x", "m", "2001-08-01", foreign={"p": "project"})
    b = core.conform_by_rule(frame("id int, key_project string", (2, "7")), "y", "m", "2001-08-01")
    assert marked(a) == {"hash_key": "key", "hash_link": "link", "hash_key_project": "key_project"}
    assert marked(stack(a, b)) == marked(stack(b, a)) == {"hash_key": "key", "hash_link": "link"}
    assert marked(a.drop("key_project").withColumn("key_project", F.lit("9"))) == {"hash_key": "key", "hash_link": "link"}


@pytest.mark.parametrize("model, key, not_yet", [
    ("dim_sales_opportunity_line_item", "key_product", "stage_name"), ("dim_sales_proposal_line_item", "key_product", "proposal_name"),
    ("dim_invoice_item", "key_project", "department_name"), ("dim_sales_proposal", "key_opportunity", "amt_total_price_location")])
def test_lines_are_moved_before_they_are_widened(spark, model, key, not_yet):
    """Where rows are dealt by a key, they do not yet carry what another dimension adds."""
    with tables.setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        out = catalogue.warehouse(spark, SF).ref(model)
        text = out._jdf.queryExecution().explainString(out._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    moves = [x for x in text.split("\n\n") if f"hashpartitioning({key}#" in x]
    assert moves and not [x for x in moves if f"{not_yet}#" in x]


def test_changes_of_people_are_moved_before_they_are_sorted(spark, monkeypatch):
    """No task sorts its part of a file for the last change: rows are dealt by the person first, to as many tasks as the files
    have shares, and all that has the person as its key meets there without another move."""
    monkeypatch.setattr(silver, "TASK_BYTES", 1 << 10)
    with tables.setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        out = catalogue.warehouse(spark, SF).ref("employee")
        text = out._jdf.queryExecution().explainString(out._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    blocks = [x for x in text.split("\n\n") if "Arguments: hashpartitioning(employee_id#" in x]
    dealt = [int(re.search(r", (\d+)\), REPARTITION_BY_NUM", x)[1]) for x in blocks if "REPARTITION_BY_NUM" in x]
    assert len(dealt) == 3 and len(set(dealt)) == 1 and dealt[0] > tables.LEAST_TASKS
    assert len(blocks) == 3 and "hashpartitioning(__pair#" not in text


def test_last_changes_belong_to_a_person_and_a_company(spark, frame):
    base = catalogue.warehouse(spark, SF)
    jobs = base._source("ukg_pro", "employee_job_history")

    def change(id, who, company, day, rise, shift):  # noqa: A002
        return jobs.limit(1).withColumns({
            "id": F.lit(id), "employee_id": F.lit(who), "company_id": F.lit(company), "job_effective_date": F.lit(day).cast("date"), "is_rate_change": F.lit(rise),
            "shift_code": F.lit(shift)})

    mine = base._source("ukg_pro", "employee").filter("id IN ('1', '2')").select("id", "company_id").collect()
    (one, home), (two, other) = sorted(tuple(r) for r in mine)
    own = [change("a", one, home, "2030-01-01", True, "A"), change("b", one, home, "2030-01-03", False, "B"), change("c", one, home, "2030-01-02", None, "C"),
           change("d", one, "no company", "2030-01-09", True, "D"), change("e", None, home, "2030-01-09", True, "E"), change("f", one, None, "2030-01-09", True, "F"),
           change("g", two, other, None, True, "G")]
    all_jobs = own[0]
    for x in own[1:]:
        all_jobs = all_jobs.union(x)
    w = Warehouse(spark, lambda s, t: all_jobs if t == "employee_job_history" else base._source(s, t).withColumn("primary_shift_code", F.lit("")) if t == "compensation" else base._source(s, t), "2001-08-01")
    got = w.system("employee", "ukg").filter("key IN ('1', '2', '3')").select("key", "shift_code", F.col("dte_pay_last_changed").cast("string"))
    assert rows(got) == [("1", "B", "2030-01-01"), ("2", "G", None), ("3", None, None)]


@pytest.mark.parametrize("model, never", [
    ("dim_project", ("assistant_project_manager_id", "client_manager_id", "regional_manager_user_id")),
    ("dim_project_task", ("account_id",)), ("dim_project_task_milestone", ())])
def test_projects_are_not_moved_for_what_smaller_sides_can_find(spark, model, never):
    """Rows of the model carry no hashes through their joins, and are not dealt by what a smaller side asks for."""
    with tables.setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        out = catalogue.warehouse(spark, SF).ref(model)
        text = out._jdf.queryExecution().explainString(out._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    moves = [x for x in text.split("\n\n") if "Arguments: hashpartitioning(" in x]
    mine = [x for x in moves if re.search(r"\b(amt_po|budget_original|earned_value)#", x)]
    assert mine and not [x for x in mine if re.search(r"\bhash_(key|link)", x)]
    assert not [x for x in mine for key in never if f"hashpartitioning({key}#" in x or f"hashpartitioning(__{key}#" in x]


def moves_of(out, column: str) -> list[str]:
    """Keys by which rows that carry the column are dealt."""
    text = out._jdf.queryExecution().explainString(out._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    blocks = [re.sub(r"#\d+L?", "", x) for x in text.split("\n\n") if "Arguments: hashpartitioning(" in x and re.search(rf"\b{column}#", x)]
    return [re.search(r"hashpartitioning\((.*), \d+\)", x)[1] for x in blocks]


def test_time_entries_are_moved_once_for_both_rates(spark):
    with tables.setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        out = catalogue.warehouse(spark, SF).ref("timesheet_entry")
        assert moves_of(out, "salesforce_id") == ["projectid, employeeid, entrydate, taskkey", "projectkey, employeedimkey"]
        assert moves_of(out, "billingrate").count("projectkey, employeedimkey") == 1


@pytest.mark.parametrize("model, growth", [("dim_project_phase_code", 32), ("dim_sales_opportunity_line_item", 4), ("dim_sales_proposal_line_item", 4)])
def test_files_are_not_taken_for_rows_where_many_are_looked_up(spark, tmp_path, monkeypatch, model, growth):
    """What is broadcast to a model is judged by the size of its rows in memory, not by that of their files."""
    seen, before = {}, core.write_table
    name = "spark.sql.sources.fileCompressionFactor"

    def write(df, root, layer, alias, *rest, **more):
        seen[alias] = float(spark.conf.get(name))
        return before(df, root, layer, alias, *rest, **more)

    monkeypatch.setattr(core, "write_table", write)
    was = spark.conf.get(name)
    catalogue.warehouse(spark, SF, str(tmp_path)).ref(model)
    assert seen[model] == growth and seen["sales_account"] == 1 and spark.conf.get(name) == was


def test_time_entries_are_not_moved_for_the_pay_of_their_person(spark):
    with tables.setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        moves = moves_of(catalogue.warehouse(spark, SF).ref("dim_timesheet_entry"), "task_key")
    # what small tables add comes last
    assert [m for m in moves if m.startswith(("link", "key_timesheet", "key_project", "employee_id_intacct"))] == moves[:4]
    assert "key_employee_ukg" not in moves


@pytest.mark.parametrize("model", ["dim_expense_item", "dim_ap_bill_item", "dim_cc_transaction_entry"])
def test_accounting_lines_are_moved_before_small_tables_widen_them(spark, model):
    """Lines are not moved with their department's and entity's names, nor by what their header asks for."""
    with tables.setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        moves = moves_of(catalogue.warehouse(spark, SF).ref(model), "amt_trx")
    small = [k for k, m in enumerate(moves) if m.startswith(("department_id", "location_id", "__entity"))]
    large = [k for k, m in enumerate(moves) if m.startswith(("key_project", "employee_id", "link"))]
    assert large and small and "__report_link" not in moves
    assert max(large) < min(small)


def test_job_changes_carry_no_hashes_through_their_joins(spark):
    with tables.setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        out = catalogue.warehouse(spark, SF).ref("dim_employee_job_history")
        text = out._jdf.queryExecution().explainString(out._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    moves = [x for x in text.split("\n\n") if "Arguments: hashpartitioning(" in x and "dte_job_effective#" in x]
    assert moves and not [x for x in moves if re.search(r"\bhash_(key|link)", x)]
    wrong = out.agg(F.count_if(~F.col("hash_key_practice").eqNullSafe(hash_key("ukg_practice_id"))), F.count_if(~F.col("hash_key").eqNullSafe(hash_key("key")))).first()
    assert tuple(wrong) == (0, 0)
