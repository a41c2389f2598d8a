"""Row-count rules that the build of a model carries with it.

Rows are counted while they pass: of a raw table on its way into a model, of a model on its way to its files. No rule reads
a table a second time. A task that runs twice can count rows twice, so where two sides differ both are counted anew
before the rule is called broken.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from concurrent.futures import TimeoutError as TooLong
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from silverloom.operators.quality import ContractError

WAIT = 20.0  # seconds for a count of a finished job to arrive


@dataclass(frozen=True)
class SourceRule:
    """As many rows of a system in a conformed model as its raw table has where ``rows`` holds."""

    model: str
    system: str
    table: str
    rows: str = "NOT _fivetran_deleted"

    @property
    def name(self) -> str:
        return f"{self.model}.{self.system}"


@dataclass(frozen=True)
class ModelRule:
    """As many rows in a reporting model as its conformed table has where ``rows`` holds."""

    model: str
    base: str
    rows: str

    @property
    def name(self) -> str:
        return self.model


@dataclass(frozen=True)
class FanoutRule:
    """As many rows in a reporting model as its conformed rows have partners: left joins that must neither drop nor
    multiply rows beyond what the keys say. ``partners`` are (table, condition, its key); ``required`` asks for one."""

    model: str
    base: str
    rows: str
    key: str
    partners: tuple[tuple[str, str, str], ...] = ()
    required: bool = False

    @property
    def name(self) -> str:
        return self.model


def _plain(model: str, base: str, system: str = "sfc") -> ModelRule:
    return ModelRule(model, base, f"src_sys_key = '{system}'")


SOURCE_RULES = (
    SourceRule("employee", "por", "portal.users"),
    SourceRule("employee", "int", "sage_intacct.employee"),
    SourceRule("employee", "sfc", "salesforce.contact", "NOT _fivetran_deleted AND record_type_id = '0124W000001bI6LQAU'"),
    SourceRule("employee", "ukg", "ukg_pro.employee"),
    SourceRule("employee_compensation", "ukg", "ukg_pro.compensation"),
    SourceRule("employee_earning", "ukg", "ukg_pro.earning_history_base_element"),
    SourceRule("employee_job_history", "ukg", "ukg_pro.employee_job_history"),
    SourceRule("employee_payroll_deductions", "ukg", "ukg_pro.payroll_deduction_history"),
    SourceRule("apbill", "int", "sage_intacct.ap_bill"),
    SourceRule("apbillitem", "int", "sage_intacct.ap_bill_item", "TRUE"),
    SourceRule("cc_transaction", "int", "sage_intacct.cc_transaction"),
    SourceRule("cc_transaction_entry", "int", "sage_intacct.cc_transaction_entry"),
    SourceRule("expense", "int", "sage_intacct.eexpenses"),
    SourceRule("expense", "sfc", "salesforce.pse_expense_report_c"),
    SourceRule("expenseitem", "int", "sage_intacct.eexpenses_item", "TRUE"),
    SourceRule("expenseitem", "sfc", "salesforce.pse_expense_c"),
    SourceRule("invoice", "int", "sage_intacct.ar_invoice"),
    SourceRule("invoice_item", "int", "sage_intacct.ar_invoice_item", "TRUE"),
    SourceRule("timesheet", "int", "sage_intacct.timesheet"),
    SourceRule("timesheet", "sfc", "salesforce.pse_timecard_header_c"),
    SourceRule("estimates_vs_actuals", "sfc", "salesforce.pse_est_vs_actuals_c", "NOT is_deleted AND NOT _fivetran_deleted"),
    SourceRule("project", "psa", "psatools.projects"),
    SourceRule("project", "int", "sage_intacct.project"),
    SourceRule("project", "sfc", "salesforce.pse_proj_c"),
    SourceRule("project_task_milestone", "sfc", "salesforce.project_task_milestone_c"),
)

_links = (("int", "link"), ("por", "link"), ("sfc", "link"))
MODEL_RULES: tuple[ModelRule | FanoutRule, ...] = (
    FanoutRule("dim_employee", "employee", "src_sys_key = 'ukg'", "link", tuple(("employee", f"src_sys_key = '{s}'", k) for s, k in _links)),
    _plain("dim_employee_compensation", "employee_compensation", "ukg"),
    _plain("dim_employee_earning", "employee_earning", "ukg"),
    _plain("dim_employee_job_history", "employee_job_history", "ukg"),
    _plain("dim_employee_payroll_deductions", "employee_payroll_deductions", "ukg"),
    FanoutRule("dim_ap_bill_item", "apbillitem", "src_sys_key = 'int' AND bln_line_item", "key_ap_bill", (("apbill", "TRUE", "key"),), True),
    _plain("dim_invoice", "invoice", "int"),
    _plain("dim_invoice_item", "invoice_item", "int"),
    _plain("dim_timesheet", "timesheet", "int"),
    _plain("dim_timesheet_entry", "timesheet_entry", "int"),
    ModelRule("dim_estimates_vs_actuals", "estimates_vs_actuals", "src_sys_key = 'sfc' AND NOT bln_exclude_from_planners"),
    FanoutRule("dim_project", "project", "src_sys_key = 'int' AND lower(project_type) <> 'client site'", "hash_link",
               (("project", "src_sys_key = 'psa'", "hash_link"), ("project", "src_sys_key = 'sfc'", "hash_link"))),
    _plain("dim_project_task_milestone", "project_task_milestone"),
    _plain("dim_sales_account", "sales_account"),
    _plain("dim_sales_account_team_member", "sales_account_team_member"),
    _plain("dim_sales_contact", "sales_contact"),
    _plain("dim_sales_lead", "sales_lead"),
    _plain("dim_sales_opportunity", "sales_opportunity"),
    _plain("dim_sales_opportunity_line_item", "sales_opportunity_line_item"),
    _plain("dim_sales_opportunity_team_member", "sales_opportunity_team_member"),
    _plain("dim_sales_product", "sales_product"),
    _plain("dim_sales_proposal", "sales_proposal"),
    _plain("dim_sales_proposal_line_item", "sales_proposal_line_item"),
    _plain("dim_sales_purchase_order", "sales_purchase_order"),
    _plain("dim_sales_rate_card", "sales_rate_card"),
    _plain("dim_sales_rate_card_set", "sales_rate_card_set"),
    _plain("dim_sales_user", "sales_user"),
)


def fanout_count(left: DataFrame, key: str, partners: list[tuple[DataFrame, str]], required: bool = False) -> int:
    """Rows of the left joins of ``left`` with all partners on the key, without joining: rows per key are counted on all
    sides at once and multiplied. A null key has no partner."""
    sides = [left.select(F.col(key).cast("string").alias("k"), F.lit(0).alias("side"))]
    sides += [p.select(F.col(c).cast("string").alias("k"), F.lit(n + 1).alias("side")).filter(F.col("k").isNotNull()) for n, (p, c) in enumerate(partners)]
    rows = sides[0]
    for side in sides[1:]:
        rows = rows.unionByName(side)
    n = [F.count_if(F.col("side") == k).alias(f"n{k}") for k in range(len(sides))]
    product = F.col("n0")
    for k in range(1, len(sides)):
        product = product * (F.col(f"n{k}") if required else F.greatest(F.col(f"n{k}"), F.lit(1)))
    return rows.groupBy("k").agg(*n).agg(F.coalesce(F.sum(product), F.lit(0))).first()[0]


class Counts:
    """Counts of what passed while models were built."""

    def __init__(self):
        self._pending: dict[str, dict[str, tuple[Observation, str]]] = {}
        self.of_source: dict[tuple[str, str], int] = {}  # by model and system
        self.of_model: dict[tuple[str, str], int] = {}  # by model and condition
        self._wait = ThreadPoolExecutor(max_workers=1, thread_name_prefix="counts")

    def watch_source(self, df: DataFrame, model: str, table: str) -> DataFrame:
        """The raw rows, counted for the rules of the model on this table the first time it reads it."""
        for rule in SOURCE_RULES:
            mine = self._pending.setdefault(model, {})
            if (rule.model, rule.table) == (model, table) and rule.system not in mine:
                seen = Observation()
                mine[rule.system] = seen, rule.rows
                return df.observe(seen, F.count_if(F.expr(rule.rows)).alias("n"))
        return df

    def watch_model(self, df: DataFrame, model: str, more: dict[str, Column] | None = None) -> DataFrame:
        """The rows of a model, counted for all rules that ask for them. ``more`` are counts that must be 0."""
        conditions = sorted(_conditions(model))
        seen = Observation()
        self._pending.setdefault(model, {})["rows of the model"] = seen, ""
        return df.observe(seen, *[F.count_if(F.expr(c)).alias(f"n{k}") for k, c in enumerate(conditions)],
                          *[c.alias(n) for n, c in (more or {}).items()])

    def _arrived(self, seen: Observation) -> dict[str, int]:
        try:
            return self._wait.submit(lambda: seen.get).result(WAIT)
        except TooLong:  # the plan did without the counted part
            self._wait = ThreadPoolExecutor(max_workers=1, thread_name_prefix="counts")
            return {}

    def settle(self, model: str, written: DataFrame, source: Callable[[str, str], DataFrame]) -> None:
        """Takes over the counts of a model that was just written, and makes sure of those that do not fit."""
        pending = self._pending.pop(model, {})
        conditions = sorted(_conditions(model))
        got = self._arrived(pending.pop("rows of the model")[0])
        wrong = {n: v for n, v in got.items() if n.startswith("null_") and v}
        if wrong:
            raise ContractError(f"{model}: nulls in columns that must be filled: {wrong}")
        for k, c in enumerate(conditions):
            self.of_model[model, c] = got[f"n{k}"] if got else written.filter(c).count()
        for rule in SOURCE_RULES:
            if rule.model != model:
                continue
            got = self._arrived(pending[rule.system][0]) if rule.system in pending else {}
            tag = f"src_sys_key = '{rule.system}'"
            if not got or got["n"] != self.of_model[model, tag]:
                got = {"n": source(*rule.table.split(".")).filter(rule.rows).count()}
                self.of_model[model, tag] = written.filter(tag).count()
            self.of_source[model, rule.system] = got["n"]


def _conditions(model: str) -> set[str]:
    """What is counted of a model: its rows, those of each system with a rule, and what rules of later models ask for."""
    return (
        {"TRUE"} | {f"src_sys_key = '{r.system}'" for r in SOURCE_RULES if r.model == model}
        | {r.rows for r in MODEL_RULES if isinstance(r, ModelRule) and r.base == model})


RESULT = "rule string, kind string, n_model long, n_expected long, ok boolean"


def check(w) -> DataFrame:
    """(rule, kind, n_model, n_expected, ok) of every rule; models that are not built yet are built."""
    rows = []
    for rule in SOURCE_RULES:
        w.ref(rule.model)
        rows.append((rule.name, "source rows", w.counts.of_model[rule.model, f"src_sys_key = '{rule.system}'"], w.counts.of_source[rule.model, rule.system]))
    for rule in MODEL_RULES:
        model, base = w.ref(rule.model), w.ref(rule.base)
        have = w.counts.of_model[rule.model, "TRUE"]
        if isinstance(rule, ModelRule):
            want = w.counts.of_model[rule.base, rule.rows]
            if have != want:
                have, want = model.count(), base.filter(rule.rows).count()
            rows.append((rule.name, "model rows", have, want))
        else:
            partners = [(w.ref(t).filter(c), k) for t, c, k in rule.partners]
            want = fanout_count(base.filter(rule.rows), rule.key, partners, rule.required)
            rows.append((rule.name, "fan-out", have if have == want else model.count(), want))
    return w.spark.createDataFrame([(*r, r[2] == r[3]) for r in rows], RESULT)
