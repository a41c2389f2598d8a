"""Warehouse: named sources, named models, and the rules every model shares."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverloom.functions.keys import hash_key, marked_hash, marked_key, with_envelope
from silverloom.models.contracts import enforce, nulls
from silverloom.models.rules import Counts
from silverloom.operators.filters import drop_deleted, keep_matching, slice_system
from silverloom.operators.fx import RateBook, lookup_cube
from silverloom.operators.joins import enrich
from silverloom.operators.stack import marked
from silverloom.sources.tables import publish_view, setting, write_table

# The flags of rows that the loader or the CRM has deleted, and the raw tables of which a model reads other
# flags than the loader's.
SYNC, CRM = "_fivetran_deleted", "is_deleted"
DELETION_RULES: dict[tuple[str, str], tuple[str, ...]] = {
    ("apbillitem", "sage_intacct.ap_bill_item"): (),
    ("invoice_item", "sage_intacct.ar_invoice_item"): (),
    ("expenseitem", "sage_intacct.eexpenses_item"): (),
    ("estimates_vs_actuals", "salesforce.pse_est_vs_actuals_c"): (SYNC, CRM),
    ("estimates_vs_actuals", "salesforce.pse_resource_request_c"): (SYNC, CRM),
    ("estimates_vs_actuals", "salesforce.pse_assignment_c"): (SYNC, CRM),
    ("project_phase_code", "salesforce.pse_milestone_c"): (SYNC, CRM),
    ("project_phase_code", "salesforce.pse_project_task_c"): (SYNC, CRM),
    ("timesheet_entry", "salesforce.pse_task_time_c"): (CRM,),
    ("timesheet_entry", "salesforce.pse_timecard_header_c"): (CRM,),
    ("timesheet_entry", "salesforce.pse_proj_c"): (CRM,),
    ("timesheet_entry", "salesforce.contact"): (CRM,),
    ("timesheet_entry", "salesforce.pse_project_task_c"): (CRM,),
}


def deletion_flags(model_name: str | None, table: str) -> tuple[str, ...]:
    """Flags whose true or null value drops a row of the raw table from the model."""
    return DELETION_RULES.get((model_name or "", table), (SYNC,))


# Audit columns of the source systems and their names in the common layout.
AUDIT_NAMES = {
    "created_by_id": "src_created_by_id", "last_modified_by_id": "src_modified_by_id", "created_date": "dts_src_created",
    "last_modified_date": "dts_src_modified", "system_modstamp": "dts_system_modstamp", "whencreated": "dts_src_created",
    "whenmodified": "dts_src_modified", "date_time_created": "dts_src_created", "date_time_changed": "dts_src_modified",
}


#: What Spark takes a byte of a table's files for in memory, when it judges by the files whether a side is broadcast.
GROWTH = 1


@dataclass(frozen=True)
class Model:
    name: str
    layer: str
    sink: str
    build: Callable[["Warehouse"], DataFrame]
    growth: int = GROWTH


MODELS: dict[str, Model] = {}


def model(name: str, layer: str, sink: str = "table", growth: int = GROWTH):
    """Register a model. Silver belongs to layer consolidation, gold to dataconsumption; the sink is table or view.

    Stored rows are many times as large in memory as in their files, and the driver builds what is broadcast. A larger
    ``growth`` suits a model that looks up millions of rows of which few columns are read: its rows are moved instead.
    """

    def add(fn: Callable[["Warehouse"], DataFrame]):
        MODELS[name] = Model(name, layer, sink, fn, growth)
        return fn

    return add


class Warehouse:
    """Resolves sources and models. With ``root``, table models are written once and later models read the files."""

    def __init__(self, spark: SparkSession, source: Callable[[str, str], DataFrame], as_of: str, root: str | None = None,
                 first_week: str = "1970-01-05"):
        self.spark = spark
        self.first_week = first_week  # Monday of the first week for which sheets are expected
        self.as_of = as_of
        self.root = root
        self._source = source
        self._built: dict[str, DataFrame | RateBook] = {}
        self._building: list[str] = []
        self.counts = Counts()

    def source(self, system: str, table: str) -> DataFrame:
        """Raw table without the rows that are deleted for the model that is being built."""
        name, builds = f"{system}.{table}", self._building[-1] if self._building else None
        df = self._source(system, table)
        if self.root and builds:
            df = self.counts.watch_source(df, builds, name)
        flags = [c for c in deletion_flags(builds, name) if c in df.columns]
        return drop_deleted(df, *flags).drop(SYNC, CRM)

    def ref(self, name: str) -> DataFrame:
        if name not in self._built:
            m = MODELS[name]
            self._building.append(name)
            try:
                df = m.build(self)
            finally:
                self._building.pop()
            enforce(name, m.layer, m.sink, df)
            if self.root and m.sink == "table":
                parts = ["src_sys_key"] if m.layer == "consolidation" else None
                # a hash of a key beside it is no shorter than the key and cannot be compressed: it is made when it is read
                made = {h: hash_key(c) for h, c in marked(df).items()}
                with setting(self.spark, "spark.sql.sources.fileCompressionFactor", str(m.growth)):
                    df = write_table(self.counts.watch_model(df, name, nulls(m.layer, df.columns)), self.root, m.layer, name, parts, made=made)
                self.counts.settle(name, df, self._source)
            elif self.root:
                df = publish_view(df, name)
            self._built[name] = df
        return self._built[name]

    def system(self, name: str, tag: str) -> DataFrame:
        return slice_system(self.ref(name), tag)

    def rates(self) -> RateBook:
        """The rate cube of the active currencies, ready for many lookups."""
        if "__rates" not in self._built:
            active = self.source("seed", "currencies_active")
            cube = self.ref("ref_fx_rates_timeseries")
            for side in ("frm_curr", "to_curr"):
                cube = keep_matching(cube, active.select(F.col("currency").alias(side)), [side])
            self._built["__rates"] = lookup_cube(cube)
        return self._built["__rates"]


def rule_name(column: str, kind: str) -> str:
    """Name in the common layout: system affixes go, booleans, dates and timestamps get their prefix."""
    if column in AUDIT_NAMES:
        return AUDIT_NAMES[column]
    if column.startswith(("bln_", "dte_", "dts_")):
        return column
    base = column.removeprefix("pse_").removesuffix("_c")
    if kind == "boolean":
        return f"bln_{base}"
    if kind == "date":
        return "dte_" + base.removeprefix("date_").removesuffix("_date")
    if kind.startswith("timestamp"):
        return "dts_" + base.removeprefix("date_time_").removesuffix("_date")
    return base


def conform_by_rule(df: DataFrame, system: str, name: str, as_of: str, key: str = "id", link: str | None = None,
                    foreign: dict[str, str] | None = None, names: dict[str, str] | None = None,
                    columns: dict[str, str] | None = None) -> DataFrame:
    """Source rows in the common layout: envelope, key and link with hashes, foreign keys with hashes, then the rest.

    ``key``, ``link`` and ``columns`` are SQL expressions over the source; ``foreign`` maps source columns to entity
    names, ``names`` overrides the naming rule.
    """
    foreign, names, columns = foreign or {}, names or {}, columns or {}
    kinds = dict(df.dtypes)
    out = [marked_key(F.expr(key), "key"), marked_hash(F.expr(key), "key"),
           marked_key(F.expr(link or key), "link"), marked_hash(F.expr(link or key), "link")]
    for c, entity in foreign.items():
        out += [marked_key(c, f"key_{entity}"), marked_hash(c, f"key_{entity}")]
    done = {"key", "hash_key", "link", "hash_link", *(f"key_{e}" for e in foreign.values()), *(f"hash_key_{e}" for e in foreign.values())}
    for target, expr in columns.items():
        out.append(F.expr(expr).alias(target))
        done.add(target)
    for c in df.columns:
        target = names.get(c) or rule_name(c, kinds[c])
        if c in foreign or target in done or c == key:
            continue
        out.append(F.col(c).alias(target))
        done.add(target)
    return with_envelope(df.select(*out), system, name, as_of)


def silver(w: Warehouse, name: str, system: str, table: str, **spec) -> DataFrame:
    """One system's branch of a silver model straight from its raw table."""
    return conform_by_rule(w.source(*table.split(".")), system, name, w.as_of, **spec)


def lean(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """Rows of one system without their hashes, and the key column that each hash is made of.

    A hash is no shorter than its key and cannot be compressed: rows that go through several joins meet by their keys, and
    ``hashed`` makes the hashes anew in their old places afterwards.
    """
    of = {h: h.removeprefix("hash_") for h in df.columns if h.startswith("hash_") and h.removeprefix("hash_") in df.columns}
    return df.withColumns({h: F.lit(None).cast("string") for h in of}), of


def hashed(df: DataFrame, of: dict[str, str], **renamed: str) -> DataFrame:
    """Rows with the hashes that ``lean`` took off; ``renamed`` names the key column of a hash that has another name by now."""
    own = [c for h, c in of.items() if h not in renamed and c in df.columns and h == f"hash_{c}"]
    out = df.withColumns({h: hash_key(renamed.get(h, c)) for h, c in of.items()})
    return out.select(*[marked_key(c, c) if c in own else marked_hash(of[c], of[c]) if of.get(c) in own else c for c in out.columns])


def look(df: DataFrame, dim: DataFrame, fact_key: str | Sequence[str], dim_key: str | Sequence[str], take: str) -> DataFrame:
    """Left lookup; ``take`` lists dimension columns as "column:new name" separated by blanks.

    A new name replaces a fact column of the same name, the looked-up key included. Several keys must all be equal, as texts;
    rows that both sides have dealt by them are not moved again.
    """
    cols = dict(t.split(":") for t in take.split())
    new = set(cols.values())
    if not isinstance(fact_key, str):
        keys = {f"__k{i}": F.col(c).cast("string") for i, c in enumerate(dim_key)}
        right = dim.select(*[c.alias(n) for n, c in keys.items()], *[F.col(c).alias(f"__new_{n}") for c, n in cols.items()])
        same = reduce(and_, [F.col(c).cast("string") == F.col(n) for c, n in zip(fact_key, keys, strict=True)])
        out = df.join(right, same, "left").drop(*keys, *[c for c in df.columns if c in new])
        return out.withColumnsRenamed({f"__new_{n}": n for n in cols.values()})
    if fact_key in new:
        df, fact_key = df.withColumnRenamed(fact_key, "__fact_key"), "__fact_key"
    df = df.drop(*[c for c in df.columns if c in new])
    return enrich(df, [(dim, fact_key, dim_key, cols)]).drop("__fact_key")


def audited(df: DataFrame, name: str, as_of: str) -> DataFrame:
    """Gold rows: the silver envelope is replaced by the gold model's own audit columns."""
    head = with_envelope(df.drop("src_sys_key", "dts_eff_start", "dts_eff_end", "bln_current"), "gold", name, as_of)
    return head.drop("src_sys_key", "dts_eff_start", "dts_eff_end", "bln_current")


def pick(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*[c for c in names if c in df.columns])
