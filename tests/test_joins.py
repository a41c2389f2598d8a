"""Joins, identities, hierarchies and stacking."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from silverloom.functions.keys import hash_key
from silverloom.operators import filters, hierarchy, identity, joins, stack
from tests.conftest import SF, rows

D = dt.date.fromisoformat


def test_interval_join_includes_both_ends_and_keeps_unmatched(frame):
    facts = frame("k int, d date", (1, D("2024-01-10")), (1, D("2024-02-20")), (1, D("2024-02-21")), (1, D("2024-01-09")), (2, D("2024-01-10")), (1, None))
    ranges = frame("k int, date_from date, date_to date, v string", (1, D("2024-01-10"), D("2024-02-20"), "a"), (1, D("2024-03-01"), D("9999-12-31"), "b"))
    got = joins.interval_join(facts, ranges, ["k"], "d")
    assert rows(got.select("k", "d", "v")) == [
        (1, D("2024-01-09"), None), (1, D("2024-01-10"), "a"), (1, D("2024-02-20"), "a"), (1, D("2024-02-21"), None), (1, None, None), (2, D("2024-01-10"), None)]


def test_interval_join_with_a_hot_key_equals_the_plain_join(spark):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").select(
        F.when(F.col("l_linenumber") <= 3, 1).otherwise(F.col("l_partkey")).alias("k"), F.to_date("l_shipdate").alias("d"), "l_extendedprice")
    ranges = lines.filter("l_extendedprice > 60000").groupBy("k", F.col("d").alias("date_from")).agg(F.max("l_extendedprice").alias("p"))
    ranges = ranges.withColumn("date_to", F.date_add("date_from", 45))
    got = joins.interval_join(lines, ranges, ["k"], "d").groupBy("k").agg(F.count("p").alias("n"), F.sum(F.col("p").cast("decimal(18,2)")).alias("s"))
    r = ranges.withColumnRenamed("k", "rk")
    want = lines.join(r, (F.col("k") == F.col("rk")) & F.col("d").between(F.col("date_from"), F.col("date_to")), "left").groupBy("k").agg(
        F.count("p").alias("n"), F.sum(F.col("p").cast("decimal(18,2)")).alias("s"))
    assert rows(got) == rows(want)


def test_anti_join_with_null_on_the_right(frame):
    left, right = frame("k int", (1,), (2,), (None,)), frame("k int", (1,), (None,))
    assert rows(filters.drop_matching(left, right, ["k"])) == [(2,), (None,)]


def test_semi_join_does_not_multiply(frame):
    assert rows(filters.keep_matching(frame("k int", (1,), (2,)), frame("k int", (1,), (1,)), ["k"])) == [(1,)]


def test_soft_delete_drops_null_flags(frame):
    df = frame("id int, deleted boolean", (1, False), (2, True), (3, None))
    assert rows(filters.drop_deleted(df, "deleted").select("id")) == [(1,)]


def test_classify_keeps_rows_of_unknown_codes(frame):
    links = frame("code string, std string", ("A", "x"), ("A", "y"), ("B", "y"))
    flags = filters.class_flags(links, "code", {"is_x": F.col("std") == "x", "is_y": F.col("std") == "y"})
    got = filters.classify(frame("code string", ("A",), ("B",), ("C",), (None,)), "code", flags)
    assert rows(got) == [("A", True, True), ("B", False, True), ("C", False, False), (None, False, False)]


def test_change_filter_three_valued(frame):
    df = frame("p int, d date, id int, code string, pct int, rate boolean, reason string",
               (1, D("2024-01-01"), 1, "a", 0, False, "9"), (1, D("2024-01-02"), 2, "b", 0, False, "9"), (1, D("2024-01-03"), 3, None, None, None, None),
               (1, D("2024-01-04"), 4, "b", 5, False, "9"), (1, D("2024-01-05"), 5, "b", 0, False, "100"))
    got = filters.changed(df, "p", "d", "code", "pct", ["100"], "reason", "rate", ties=["id"])
    assert [r[0] for r in rows(got.select("id"))] == [2, 4, 5]


def test_specific_rate_wins_generic_only_without_it(frame):
    facts = frame("id int, s int, z int", (1, 1, 1), (2, 1, 2), (3, 9, 9))
    specific = frame("s int, z int, rate int", (1, 1, None))
    generic = frame("s int, rate int", (1, 7),)
    got = joins.match_else_generic(facts, specific, ["s", "z"], generic, ["s"], ["rate"])
    assert rows(got.select("id", "rate", "match_type")) == [(1, None, "specific"), (2, 7, "generic"), (3, None, "none")]


def test_expected_weeks_against_a_count_by_hand(frame):
    people = frame("p int, s date, e date", (1, D("2024-01-07"), None), (2, D("2024-01-06"), D("2024-01-14")), (3, D("2023-01-01"), D("2024-01-21")), (4, D("2024-03-01"), None))
    got = joins.expected_periods(people, "s", "e", "2024-01-01", "2024-01-17")
    weeks = [(D("2024-01-01"), D("2024-01-07")), (D("2024-01-08"), D("2024-01-14")), (D("2024-01-15"), D("2024-01-21"))]
    want = [(p, a, b) for p, s, e in [(1, "2024-01-07", None), (2, "2024-01-06", "2024-01-14"), (3, "2023-01-01", "2024-01-21"), (4, "2024-03-01", None)]
            for a, b in weeks if b > D(s) and (e is None or b < D(e))]
    assert rows(got.select("p", "week_start", "week_end")) == sorted(want)


def test_identity_ignores_null_links_and_shows_fan_out(frame):
    df = frame("src_sys_key string, key string, link string", ("u", "1", "x"), ("u", "2", None), ("s", "10", "x"), ("s", "11", "x"), ("s", "12", None))
    got = identity.resolve_identity(df.withColumn("hash_link", hash_key("link")), "u", ["s"], ["key"])
    assert rows(got) == [("1", "10"), ("1", "11"), ("2", None)]


def test_golden_takes_first_non_blank_in_order(frame):
    df = frame("src_sys_key string, key string, hash_link string, name string", ("u", "1", "h", ""), ("s", "2", "h", "Sam"))
    assert rows(identity.golden(df, "u", ["s"], ["key", "name"], {"name": ["u", "s"]})) == [("1", "2", "Sam")]


def test_master_plus_unmatched(frame):
    a, b = frame("k int, n string", (1, "a"), (None, "n")), frame("k int, n string", (1, "b"), (2, "c"), (None, "m"))
    assert rows(identity.master_plus_unmatched(a, b, ["k"])) == [(1, "a"), (2, "c"), (None, "m"), (None, "n")]


def _chain(parents, node):
    """Ancestors, and whether they run into a cycle."""
    out, at = [], parents.get(node)
    while at in parents:
        if at == node or at in out:
            return out, True
        out.append(at)
        at = parents[at]
    return out, False


def test_hierarchy_deep_chains_orphans_and_cycles(frame):
    parents = {1: None, **{i: i - 1 for i in range(2, 42)}, 50: 99, 60: 61, 61: 60, 70: 70, 80: 60, 81: 80}
    grade = {1: "root", 4: "four", 60: "c"}
    df = frame("id int, parent int, name string, grade string", *[(i, p, f"n{i}", grade.get(i)) for i, p in parents.items()])
    got = {r["id"]: r for r in hierarchy.hierarchy(df, "id", "parent", "name", ["grade"]).collect()}
    for i in parents:
        chain, cycle = _chain(parents, i)
        r = got[i]
        top = chain[-1] if chain and not cycle else None
        assert r["hierarchy_cycle"] == cycle
        assert r["top_key"] == top
        assert r["top_name"] == (f"n{top}" if top else None)
        assert r["hierarchy_path"] == ("|".join(str(c) for c in reversed(chain)) or None)
        assert r["grade_inherited"] == next((grade[c] for c in [i, *chain] if c in grade), None)
    assert len(got) == len(parents)
    assert got[41]["hierarchy_depth"] == 40


def test_unpivot_week_drops_zero_and_null_keeps_negative_over_year_end(frame):
    df = frame("p int, w date, a decimal(9,2), b decimal(9,2), c decimal(9,2), d decimal(9,2)", (1, D("2023-12-30"), Decimal(0), None, Decimal("-2"), Decimal("3")))
    assert rows(stack.unpivot_week(df, "w", ["a", "b", "c", "d"])) == [(1, D("2024-01-01"), Decimal("-2.00")), (1, D("2024-01-02"), Decimal("3.00"))]


def test_stack_pads_missing_columns(frame):
    assert rows(stack.stack(frame("a int, b int", (1, 2)), frame("b int", (3,)))) == [(1, 2), (None, 3)]


def test_fanout_matches_whole_entries_once(frame):
    df = frame("loc int, l string", (1, "|3|13|3|"), (2, "|30|"), (3, None))
    assert rows(joins.fanout(df, "l", {"3": "Three"}).select("loc", "group_name")) == [(1, "Three")]


def test_role_join_and_fallback_key(frame):
    dim = frame("id int, n string", (1, "one"), (2, "two"))
    facts = frame("a int, b int", (1, 2), (None, 1), (5, None))
    got = joins.role_join(facts, dim, "id", {"n": "name"}, {"x": "a", "y": "b"})
    assert rows(got) == [(1, 2, "one", "two"), (5, None, None, None), (None, 1, None, "one")]
    got = joins.fallback_key_join(facts, dim, ["a", "b"], "id", {"n": "name"})
    assert rows(got) == [(1, 2, "one"), (5, None, None), (None, 1, "one")]
