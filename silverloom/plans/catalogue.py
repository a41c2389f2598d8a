"""Every warehouse model as a query: the raw tables of the source systems are derived from the test tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from silverloom.models import gold, silver, views  # noqa: F401  (register the models)
from silverloom.models.core import MODELS, Warehouse
from silverloom.plans.model_sql import MODEL_SQL
from silverloom.registry import ORACLES, QUERIES, Tables, plain
from silverloom.sources.derived import ORDERS_AS_OF, inputs_of, spark_sql_text, with_inputs
from silverloom.sources.raw import RAW_TABLES, spark_form
from silverloom.sources.tables import fingerprint, shared_root


def warehouse(spark, folder: str, root: str | None = None) -> Warehouse:
    tables = Tables(spark, folder)
    made = {}

    def source(system: str, table: str):
        name = f"{system}.{table}"
        if name not in made:
            text = spark_form(RAW_TABLES[name])
            made[name] = tables.sql(spark_sql_text(text), {n: tables(n) for n in inputs_of(text)})
        return made[name]

    return Warehouse(spark, source, ORDERS_AS_OF, root, first_week="2001-01-01")


_STORES: dict[tuple[str, str], tuple[str, Warehouse]] = {}


def stored(spark, folder: str) -> Warehouse:
    """Warehouse of a session and folder whose table models are written once, to the cluster's shared folder. Where the
    files of the folder have changed since, everything is built anew."""
    at, now = (spark.sparkContext.applicationId, folder), fingerprint(spark, folder)
    if at not in _STORES or _STORES[at][0] != now:
        _STORES[at] = now, warehouse(spark, folder, f"{shared_root(spark)}/silverloom-{uuid.uuid4().hex}")
    return _STORES[at][1]


def _query(name: str):
    return lambda spark, folder: plain(stored(spark, folder).ref(name))


for _name in MODELS:
    QUERIES[f"model_{_name}"] = _query(_name)
    if _name in MODEL_SQL:
        ORACLES[f"model_{_name}"] = with_inputs(MODEL_SQL[_name])
