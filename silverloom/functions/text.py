"""Text, label and flag columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from silverloom.functions.keys import col

# How many leading characters of a cleaned postal code identify the area, by country code.
POSTAL_PREFIX = {"US": 5, "CA": 3, "IE": 3, "NL": 4, "KR": 5}
# Countries whose last characters are dropped instead.
POSTAL_DROP_TAIL = {"GB": 3}


def blank_to_null(c: str | Column) -> Column:
    return F.nullif(col(c), F.lit(""))


def proper_case(c: str | Column) -> Column:
    """First letter of each word upper, the rest lower; words start after any character that is no letter or digit.

    Spark's initcap starts words at blanks only, so hyphens and apostrophes are set off with a marker first.
    """
    mark = "\u0001"
    apart = F.regexp_replace(F.lower(col(c)), r"([^\p{L}\p{N} ])", f"$1{mark} ")
    return F.regexp_replace(F.initcap(apart), f"{mark} ", "")


def display_name(first: str | Column, last: str | Column, preferred: str | Column | None = None,
                 last_first: bool = False) -> Column:
    """"First Last" or "Last, First"; a non-blank preferred name replaces the first name."""
    given = col(first)
    if preferred is not None:
        given = F.coalesce(F.nullif(F.trim(col(preferred)), F.lit("")), given)
    if last_first:
        return proper_case(F.concat(F.trim(col(last)), F.lit(", "), F.trim(given)))
    return proper_case(F.concat(F.trim(given), F.lit(" "), F.trim(col(last))))


def norm_currency(c: str | Column, default: str = "USD") -> Column:
    return F.upper(F.coalesce(blank_to_null(c), F.lit(default)))


def clean_postal(c: str | Column) -> Column:
    """Postal code without blanks and hyphens; blank becomes null."""
    return F.trim(F.regexp_replace(blank_to_null(c), "[ -]", ""))


def norm_postal(c: str | Column, country: str | Column) -> Column:
    """Area part of a postal code: by country the first n characters, all but the last n, or the whole code."""
    clean = clean_postal(c)
    code = F.upper(col(country))
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, n in POSTAL_PREFIX.items():
        out = out.when(code == name, F.trim(F.substring(clean, 1, n)))
    for name, n in POSTAL_DROP_TAIL.items():
        kept = F.greatest(F.length(clean) - n, F.lit(0))
        out = out.when(code == name, F.trim(clean.substr(F.lit(1), kept)))
    return out.otherwise(clean)


def label(c: str | Column, mapping: dict, default: str | None = None) -> Column:
    """Code to label by a small fixed mapping."""
    pairs = list(mapping.items())
    out = F.when(col(c) == pairs[0][0], F.lit(pairs[0][1]))
    for code, text in pairs[1:]:
        out = out.when(col(c) == code, F.lit(text))
    return out.otherwise(F.lit(default))


def flag(c: str | Column, true_value) -> Column:
    """Boolean from a coded flag; null counts as false."""
    return F.coalesce(col(c) == true_value, F.lit(False))


def record_label(name: str | Column, record: str | Column) -> Column:
    """"name - id", or the id alone for a blank name."""
    text = blank_to_null(name)
    return F.coalesce(F.concat(text, F.lit(" - "), col(record).cast("string")), col(record).cast("string"))


def in_delimited(c: str | Column, value, sep: str = "|") -> Column:
    """True if a delimited list in a text column holds the value as a whole entry."""
    return F.array_contains(F.split(col(c), "\\Q" + sep + "\\E"), F.lit(value).cast("string"))


def in_list(c: str | Column, values, negate: bool = False) -> Column:
    """IN / NOT IN a literal list; a null value passes neither."""
    test = col(c).isin(list(values))
    return ~test if negate else test
