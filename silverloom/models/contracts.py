"""What a model's columns must be, checked on its plan before a job starts, and nulls on its way to the files.

Columns are declared by their layer and by their name: a prefix says what a column holds, so a new column is bound without
being listed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from silverloom.operators.quality import ContractError

TEXT, DAY, MOMENT, FLAG, NUMBER = "text", "day", "moment", "flag", "number"
# Columns that every model of a layer has, with what they hold.
AUDIT = {"dts_created_at": MOMENT, "created_by": TEXT, "dts_updated_at": MOMENT, "updated_by": TEXT}
ENVELOPE = {"src_sys_key": TEXT, **AUDIT, "dts_eff_start": MOMENT, "dts_eff_end": MOMENT, "bln_current": FLAG,
            "key": TEXT, "hash_key": TEXT, "link": TEXT, "hash_link": TEXT}
REQUIRED = {("consolidation", "table"): ENVELOPE, ("dataconsumption", "table"): AUDIT, ("dataconsumption", "view"): {}}
#: Columns that hold a value in every row.
FILLED = {"consolidation": ("src_sys_key", "key", "hash_key", "dts_created_at", "dts_eff_start", "dts_eff_end", "bln_current"),
          "dataconsumption": ("dts_created_at", "created_by")}
# What a column holds by the beginning of its name, the longer one first.
PREFIXES = (("hash_key", TEXT), ("hash_link", TEXT), ("bln_", FLAG), ("dte_", DAY), ("dts_", MOMENT), ("amt_", NUMBER), ("fx_rate_", NUMBER))
KINDS = {"string": TEXT, "date": DAY, "timestamp": MOMENT, "timestamp_ntz": MOMENT, "boolean": FLAG, "tinyint": NUMBER, "smallint": NUMBER,
         "int": NUMBER, "bigint": NUMBER, "float": NUMBER, "double": NUMBER}


def holds(data_type: str) -> str:
    """What a column of a type holds; the type itself for what no model should have."""
    return NUMBER if data_type.startswith("decimal") else KINDS.get(data_type, data_type)


def declared(layer: str, sink: str, column: str) -> str | None:
    """What the contract says of a column; null where it says nothing but that it is a plain value."""
    known = REQUIRED[layer, sink].get(column)
    return known or next((kind for prefix, kind in PREFIXES if column.startswith(prefix)), None)


def rows_of(name: str, layer: str, sink: str, schema: StructType) -> list[tuple]:
    """(model, column_name, declared, actual, required, filled, ok) of each column that is there or must be."""
    have = {f.name: holds(f.dataType.simpleString()) for f in schema}
    required = REQUIRED[layer, sink]
    out = []
    for column in [*have, *[c for c in required if c not in have]]:
        want, is_ = declared(layer, sink, column), have.get(column)
        plain = is_ in (TEXT, DAY, MOMENT, FLAG, NUMBER)
        filled = sink == "table" and column in FILLED[layer]
        out.append((name, column, want, is_, column in required, filled, plain and want in (None, is_)))
    return out


def enforce(name: str, layer: str, sink: str, df: DataFrame) -> None:
    """Raises where the plan's columns break the contract; reads no data."""
    names = [f.name for f in df.schema]
    bad = [f"{c} holds {is_ or 'nothing'}, declared {want or 'a plain value'}" for _, c, want, is_, _, _, ok in rows_of(name, layer, sink, df.schema) if not ok]
    bad += [f"{c} is there {names.count(c)} times" for c in sorted(set(names)) if names.count(c) > 1]
    if bad:
        raise ContractError(f"{name}: " + "; ".join(bad))


def nulls(layer: str, columns: list[str]) -> dict[str, Column]:
    """Counts of nulls in columns that must be filled, for the observation of the write."""
    return {f"null_{c}": F.count_if(F.col(c).isNull()) for c in FILLED[layer] if c in columns}


RESULT = "model string, column_name string, declared string, actual string, required boolean, filled boolean, ok boolean"


def all_rows(spark: SparkSession, models, ref) -> DataFrame:
    """The contract rows of all models."""
    rows = [r for m in models.values() for r in rows_of(m.name, m.layer, m.sink, ref(m.name).schema)]
    return spark.createDataFrame(rows, RESULT)
