"""Conforming source tables to one layout and stacking them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverloom.functions.keys import HASH_OF, HASHED_AS, col, hash_key, with_envelope
from silverloom.functions.text import blank_to_null

Mapping = Sequence[tuple[str, "str | Column | None", str]]


def conform(df: DataFrame, spec: Mapping) -> DataFrame:
    """Rename, cast and null-pad to a target layout. ``spec`` rows are (target, source or expression or None, type)."""
    out = []
    for target, source, kind in spec:
        value = F.lit(None) if source is None else col(source)
        out.append(value.cast(kind).alias(target))
    return df.select(*out)


def with_hashes(df: DataFrame, *keys: str) -> DataFrame:
    """A ``hash_<key>`` column right behind each named key."""
    cols = []
    for c in df.columns:
        cols.append(F.col(c))
        if c in keys:
            cols.append(hash_key(c).alias(f"hash_{c}"))
    return df.select(*cols)


def blanks_to_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Blank text becomes null, in the named or in all text columns."""
    names = cols or [n for n, t in df.dtypes if t == "string"]
    return df.withColumns({n: blank_to_null(n) for n in names})


def fill_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    return df.withColumns({n: F.coalesce(F.col(n), F.lit(v)) for n, v in defaults.items()})


def marked(df: DataFrame) -> dict[str, str]:
    """Hash columns and the key columns that they can be made of, where the metadata of both says so."""
    notes = {f.name: f.metadata for f in df.schema}
    return {h: k for h, k in ((h, m.get(HASH_OF)) for h, m in notes.items()) if k and notes.get(k, {}).get(HASHED_AS) == h}


def stack(*frames: DataFrame) -> DataFrame:
    """UNION ALL by column name; columns a source lacks become null. A hash stays marked as that of its key where it is so
    in every source that has either of them."""
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    marks = [(marked(f), set(f.columns)) for f in frames]
    wrong = [h for h, k in marked(out).items() if any(m.get(h) != k and {h, k} & have for m, have in marks)]
    for h in wrong:
        out = out.withMetadata(h, {})
    return out


def stack_distinct(*frames: DataFrame, dealt_by: Sequence[str] = ()) -> DataFrame:
    """UNION without equal rows. Rows dealt by some of the columns are not moved again for those, nor for what is grouped by
    them later."""
    out = stack(*frames)
    return (out.repartition(*dealt_by) if dealt_by else out).distinct()


def consolidate(sources: Sequence[tuple[str, DataFrame, Mapping]], model: str, as_of: str,
                hashes: Sequence[str] = ("key", "link")) -> DataFrame:
    """Conform every system's table, add envelope and hash keys, and stack the systems."""
    parts = []
    for system, frame, spec in sources:
        parts.append(with_envelope(with_hashes(conform(frame, spec), *hashes), system, model, as_of))
    return stack(*parts)


def unpivot_week(df: DataFrame, week_start: str, day_cols: Sequence[str], qty: str = "qty",
                 date: str = "dte_entry") -> DataFrame:
    """A row per day out of a week-wide sheet, in one scan. ``day_cols`` follow the week from its first day.

    Days with no or zero quantity give no row.
    """
    rest = [c for c in df.columns if c not in day_cols and c != week_start]
    days = F.array(*[
        F.struct(F.date_add(F.col(week_start), i).alias(date), F.col(c).alias(qty)) for i, c in enumerate(day_cols)
    ])
    out = df.select(*rest, F.explode(days).alias("__d")).select(*rest, "__d.*")
    return out.filter(F.col(qty) != 0)
