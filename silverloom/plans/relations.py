"""Queries over several relations: joins, windows, set operations, hierarchies and currency rates."""

from __future__ import annotations

from pyspark.sql import functions as F

from silverloom.functions import keys, text
from silverloom.operators import filters, fx, hierarchy, identity, joins, stack, timeline, windows
from silverloom.plans.rows import CUSTOMER_SPEC, SUPPLIER_SPEC
from silverloom.registry import Tables, query
from silverloom.sources.derived import EVENTS_AS_OF, ORDERS_AS_OF
from silverloom.sources.tables import cut_lineage

# ---------------------------------------------------------------- joins


@query("star_enrich", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, o_orderstatus AS order_status, c_name AS customer_name,
           n_name AS nation_name, r_name AS region_name
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
         LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def star_enrich(t: Tables):
    lines = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    out = joins.enrich(lines, [
        (t("orders"), "l_orderkey", "o_orderkey", {"o_orderstatus": "order_status", "o_custkey": "cust_id"}),
        (t("customer"), "cust_id", "c_custkey", {"c_name": "customer_name", "c_nationkey": "nation_id"}),
        (t("nation"), "nation_id", "n_nationkey", {"n_name": "nation_name", "n_regionkey": "region_id"}),
        (t("region"), "region_id", "r_regionkey", {"r_name": "region_name"}),
    ])
    return out.drop("cust_id", "nation_id", "region_id")


@query("inner_header_lines", """
    SELECT o_orderkey, o_orderstatus, l_linenumber, l_partkey, l_quantity FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")
def inner_header_lines(t: Tables):
    out = joins.join_on(t("orders"), t("lineitem"), [("o_orderkey", "l_orderkey")], "inner")
    return out.select("o_orderkey", "o_orderstatus", "l_linenumber", "l_partkey", "l_quantity")


@query("composite_key_join", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, rate FROM lineitem JOIN part ON l_partkey = p_partkey
    LEFT JOIN specific_rate ON l_suppkey = supp_id AND p_size = size_id""")
def composite_key_join(t: Tables):
    lines = joins.join_on(t("lineitem"), t("part"), [("l_partkey", "p_partkey")], "inner")
    out = joins.join_on(lines, t("specific_rate"), [("l_suppkey", "supp_id"), ("p_size", "size_id")])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "rate")


@query("normalised_key_join", """
    WITH s AS (SELECT upper(name) AS up_name, key AS supp_key FROM party_stack WHERE src_sys_key = 'int' AND name <> ''),
         c AS (SELECT replace(name, 'Customer', 'SUPPLIER') AS n, key FROM party_stack WHERE src_sys_key = 'sfc')
    SELECT key, n AS name, supp_key FROM c LEFT JOIN s ON lower(n) = lower(up_name)""")
def normalised_key_join(t: Tables):
    party = t("party_stack")
    s = party.filter("src_sys_key = 'int' AND name <> ''").select(F.upper("name").alias("up_name"), F.col("key").alias("supp_key"))
    c = party.filter("src_sys_key = 'sfc'").select("key", F.replace("name", F.lit("Customer"), F.lit("SUPPLIER")).alias("name"))
    return joins.join_on(c, s, [("name", "up_name")], "left", F.lower).select("key", "name", "supp_key")


@query("identity_resolve", """
    SELECT a.key AS int_key, a.name AS int_name, b.key AS sfc_key, b.name AS sfc_name
    FROM (SELECT * FROM party_stack WHERE src_sys_key = 'int') a
    LEFT JOIN (SELECT * FROM party_stack WHERE src_sys_key = 'sfc') b ON md5(a.link) = md5(b.link)""")
def identity_resolve(t: Tables):
    rows = t("party_stack").withColumn("hash_link", keys.hash_key("link"))
    return identity.resolve_identity(rows, "int", ["sfc"], ["key", "name"])


@query("interval_rate_join", """
    WITH r AS (SELECT part_id, unit_price,
                      CASE WHEN lag(dte) OVER w IS NULL THEN DATE '1900-01-01' ELSE dte END AS date_from,
                      coalesce(CAST(lead(dte) OVER w - 1 AS DATE), DATE '9999-12-31') AS date_to
               FROM price_change WINDOW w AS (PARTITION BY part_id ORDER BY dte))
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(o_orderdate AS DATE) AS dte, CAST(unit_price AS DOUBLE) AS unit_price,
           date_from, date_to
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    LEFT JOIN r ON part_id = l_partkey AND CAST(o_orderdate AS DATE) BETWEEN date_from AND date_to""")
def interval_rate_join(t: Tables):
    facts = joins.join_on(t("lineitem"), t("orders"), [("l_orderkey", "o_orderkey")], "inner").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("part_id"), F.to_date("o_orderdate").alias("dte"))
    out = timeline.as_of_join(facts, t("price_change"), ["part_id"], "dte", "dte", {"unit_price": F.max("unit_price")}, bounds=True)
    return out.withColumnRenamed("part_id", "l_partkey")


@query("expected_vs_missing", """
    WITH weeks AS (SELECT CAST(d AS DATE) AS week_start, CAST(d + INTERVAL 6 DAY AS DATE) AS week_end
                   FROM generate_series(TIMESTAMP '2023-12-25', TIMESTAMP '2024-01-31', INTERVAL 7 DAY) g(d))
    SELECT p.user_id, w.week_start, w.week_end FROM person_dates p
    JOIN weeks w ON w.week_end > p.dte_hired AND (p.dte_left IS NULL OR w.week_end < p.dte_left)
    LEFT JOIN sheets_seen s ON s.user_id = p.user_id AND s.week_start = w.week_start
    WHERE s.status IS NULL""")
def expected_vs_missing(t: Tables):
    due = joins.expected_periods(t("person_dates"), "dte_hired", "dte_left", "2023-12-25", EVENTS_AS_OF)
    seen = t("sheets_seen").select("user_id", "week_start")
    return filters.drop_matching(due, seen, ["user_id", "week_start"]).select("user_id", "week_start", "week_end")


@query("eav_pivot", """
    SELECT user_id, max(CASE WHEN field = 'view' THEN value END) AS max_view,
           max(CASE WHEN field = 'click' THEN value END) AS max_click,
           max(CASE WHEN field = 'purchase' THEN value END) AS max_purchase
    FROM attr_rows WHERE field IN ('view', 'click', 'purchase') GROUP BY user_id""")
def eav_pivot(t: Tables):
    return joins.eav_pivot(t("attr_rows"), "user_id", "field", "value", ["view", "click", "purchase"], prefix="max_")


@query("rate_fallback", """
    WITH f AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey AS supp_id, p_size AS size_id FROM lineitem JOIN part ON l_partkey = p_partkey),
         m AS (SELECT f.*, s.rate FROM f JOIN specific_rate s ON s.supp_id = f.supp_id AND s.size_id = f.size_id),
         u AS (SELECT f.*, g.rate FROM f LEFT JOIN generic_rate g ON g.supp_id = f.supp_id
               WHERE NOT EXISTS (SELECT 1 FROM specific_rate s WHERE s.supp_id = f.supp_id AND s.size_id = f.size_id))
    SELECT l_orderkey, l_linenumber, l_partkey, rate, 'specific' AS match_type FROM m UNION ALL
    SELECT l_orderkey, l_linenumber, l_partkey, rate, CASE WHEN rate IS NULL THEN 'none' ELSE 'generic' END FROM u""")
def rate_fallback(t: Tables):
    facts = joins.join_on(t("lineitem"), t("part"), [("l_partkey", "p_partkey")], "inner").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_suppkey").alias("supp_id"), F.col("p_size").alias("size_id"))
    out = joins.match_else_generic(facts, t("specific_rate"), ["supp_id", "size_id"], t("generic_rate"), ["supp_id"], ["rate"])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "rate", "match_type")


@query("role_playing_dim", """
    SELECT l_orderkey, l_linenumber, l_partkey, a.n_name AS buyer_nation, b.n_name AS seller_nation
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation a ON c_nationkey = a.n_nationkey
    LEFT JOIN nation b ON s_nationkey = b.n_nationkey""")
def role_playing_dim(t: Tables):
    out = joins.enrich(t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), [
        (t("orders"), "l_orderkey", "o_orderkey", {"o_custkey": "o_custkey"}),
        (t("customer"), "o_custkey", "c_custkey", {"c_nationkey": "buyer_id"}),
        (t("supplier"), "l_suppkey", "s_suppkey", {"s_nationkey": "seller_id"})])
    out = joins.role_join(out, t("nation"), "n_nationkey", {"n_name": "nation"}, {"buyer": "buyer_id", "seller": "seller_id"})
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "buyer_nation", "seller_nation")


@query("fallback_key_join", """
    SELECT user_id, c_name AS customer_name FROM (SELECT user_id, coalesce(dte_left - DATE '2024-01-01', user_id) AS k FROM person_dates)
    LEFT JOIN customer ON c_custkey = k""")
def fallback_key_join(t: Tables):
    left_on = F.datediff("dte_left", F.lit("2024-01-01").cast("date")).cast("long")
    out = joins.fallback_key_join(t("person_dates"), t("customer"), [left_on, "user_id"], "c_custkey", {"c_name": "customer_name"})
    return out.select("user_id", "customer_name")


@query("group_fanout", """
    SELECT p_partkey, g.id AS group_id, g.name AS group_name,
           (p_size < 40) AS bln_active
    FROM part JOIN (VALUES ('bolt', 'Fasteners'), ('ring', 'Rings'), ('red', 'Red line')) g(id, name)
         ON list_contains(string_split(p_name, ' '), g.id)""")
def group_fanout(t: Tables):
    out = joins.fanout(t("part"), "p_name", {"bolt": "Fasteners", "ring": "Rings", "red": "Red line"}, sep=" ")
    return out.select("p_partkey", "group_id", "group_name", (F.col("p_size") < 40).alias("bln_active"))


@query("dedup_then_join", """
    WITH d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1)
    SELECT c_custkey, c_name, o_orderkey AS last_order, o_orderstatus AS last_status FROM customer LEFT JOIN d ON o_custkey = c_custkey""")
def dedup_then_join(t: Tables):
    out = joins.dedup_join(t("customer"), t("orders"), "o_custkey", [F.desc("o_orderdate"), F.desc("o_orderkey")], "c_custkey",
                           {"o_orderkey": "last_order", "o_orderstatus": "last_status"})
    return out.select("c_custkey", "c_name", "last_order", "last_status")


@query("master_plus_unmatched", """
    SELECT 'int' AS src, key, name FROM party_stack WHERE src_sys_key = 'int' UNION ALL
    SELECT 'sfc', key, name FROM party_stack c WHERE src_sys_key = 'sfc'
      AND NOT EXISTS (SELECT 1 FROM party_stack i WHERE i.src_sys_key = 'int' AND i.key = c.key)""")
def master_plus_unmatched(t: Tables):
    rows = t("party_stack").select(F.col("src_sys_key").alias("src"), "key", "name")
    return identity.master_plus_unmatched(rows.filter("src = 'int'"), rows.filter("src = 'sfc'"), ["key"])


# ---------------------------------------------------------------- hierarchy

_TREE = """
    WITH a AS (SELECT * FROM account_tree),
    j AS (SELECT a0.account_id, a0.name, a0.grade, a1.account_id AS k1, a2.account_id AS k2, a3.account_id AS k3, a4.account_id AS k4,
                 a5.account_id AS k5, a6.account_id AS k6, a7.account_id AS k7, a8.account_id AS k8,
                 coalesce(a8.name, a7.name, a6.name, a5.name, a4.name, a3.name, a2.name, a1.name) AS top_name,
                 coalesce(a0.grade, a1.grade, a2.grade, a3.grade, a4.grade, a5.grade, a6.grade, a7.grade, a8.grade) AS grade_inherited
          FROM a a0 LEFT JOIN a a1 ON a0.parent_id = a1.account_id LEFT JOIN a a2 ON a1.parent_id = a2.account_id
          LEFT JOIN a a3 ON a2.parent_id = a3.account_id LEFT JOIN a a4 ON a3.parent_id = a4.account_id
          LEFT JOIN a a5 ON a4.parent_id = a5.account_id LEFT JOIN a a6 ON a5.parent_id = a6.account_id
          LEFT JOIN a a7 ON a6.parent_id = a7.account_id LEFT JOIN a a8 ON a7.parent_id = a8.account_id)"""


@query("hierarchy_top", _TREE + "SELECT account_id, coalesce(k8, k7, k6, k5, k4, k3, k2, k1) AS top_key, top_name FROM j")
def hierarchy_top(t: Tables):
    out = hierarchy.hierarchy(t("account_tree"), "account_id", "parent_id", name="name")
    return out.select("account_id", "top_key", "top_name")


@query("hierarchy_path", _TREE + """SELECT account_id, NULLIF(concat_ws('|', k8, k7, k6, k5, k4, k3, k2, k1), '') AS hierarchy_path FROM j""")
def hierarchy_path(t: Tables):
    return hierarchy.hierarchy(t("account_tree"), "account_id", "parent_id").select("account_id", "hierarchy_path")


@query("hierarchy_inherit", _TREE + "SELECT account_id, grade, grade_inherited FROM j")
def hierarchy_inherit(t: Tables):
    out = hierarchy.hierarchy(t("account_tree"), "account_id", "parent_id", inherit=["grade"])
    return out.select("account_id", "grade", "grade_inherited")


# ---------------------------------------------------------------- windows

@query("latest_per_key", """
    SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM
      (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""")
def latest_per_key(t: Tables):
    out = windows.latest_per_key(t("orders"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")])
    return out.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")


@query("change_date_ranges", """
    SELECT part_id, CASE WHEN lag(dte) OVER w IS NULL THEN DATE '1900-01-01' ELSE dte END AS date_from,
           coalesce(CAST(lead(dte) OVER w - 1 AS DATE), DATE '9999-12-31') AS date_to, CAST(unit_price AS DOUBLE) AS unit_price
    FROM price_change WINDOW w AS (PARTITION BY part_id ORDER BY dte)""")
def change_date_ranges(t: Tables):
    return windows.change_ranges(t("price_change"), ["part_id"], "dte", values=[F.max("unit_price").alias("unit_price")])


@query("fx_forward_fill", """
    WITH d AS (SELECT CAST(d AS DATE) AS date FROM generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 1 DAY) g(d)),
         c AS (SELECT DISTINCT frm_curr FROM fx_series)
    SELECT c.frm_curr, d.date, last_value(value IGNORE NULLS) OVER (PARTITION BY c.frm_curr ORDER BY d.date
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value
    FROM c CROSS JOIN d LEFT JOIN fx_series s ON s.frm_curr = c.frm_curr AND s.date = d.date""")
def fx_forward_fill(t: Tables):
    series = t("fx_series")
    days = F.sequence(F.lit("2024-01-01").cast("date"), F.lit(EVENTS_AS_OF).cast("date"))
    grid = series.select("frm_curr").distinct().withColumn("date", F.explode(days))
    rows = grid.join(series.select("frm_curr", "date", "value"), ["frm_curr", "date"], "left")
    return windows.forward_fill(rows, ["frm_curr"], "date", ["value"])


@query("scd2_history", """
    SELECT event_id, user_id, ts, coalesce(lead(ts) OVER w - INTERVAL 1 SECOND, TIMESTAMP '9999-12-31 00:00:00') AS dts_eff_end,
           (lead(ts) OVER w IS NULL) AS bln_current
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def scd2_history(t: Tables):
    return windows.scd2(t("events").select("event_id", "user_id", "ts"), "user_id", "ts", ["event_id"])


@query("priority_dedup", """
    WITH a AS (SELECT 'Job History' AS src, person_id, dte_effective, salary, change_id FROM job_change UNION ALL
               SELECT 'Compensation', person_id, dte_effective, salary, 0 FROM pay_snapshot)
    SELECT src, person_id, dte_effective, CAST(salary AS DOUBLE) AS salary FROM
      (SELECT *, row_number() OVER (PARTITION BY person_id, dte_effective
              ORDER BY CASE src WHEN 'Job History' THEN 0 ELSE 1 END, change_id DESC) AS rn FROM a) WHERE rn = 1""")
def priority_dedup(t: Tables):
    a = t("job_change").select(F.lit("Job History").alias("src"), "person_id", "dte_effective", "salary", "change_id")
    b = t("pay_snapshot").select(F.lit("Compensation").alias("src"), "person_id", "dte_effective", "salary")
    out = windows.prefer_source(stack.stack(a, b), ["person_id", "dte_effective"], "src", ["Job History", "Compensation"],
                                [F.desc("change_id")])
    return out.select("src", "person_id", "dte_effective", "salary")


@query("dedup_business_key", """
    SELECT l_suppkey, l_partkey, l_linenumber, l_returnflag, l_orderkey, l_shipdate, l_quantity FROM
      (SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_partkey, l_linenumber, l_returnflag
          ORDER BY l_shipdate DESC, l_orderkey DESC, l_quantity DESC, l_extendedprice DESC) AS rn FROM lineitem) WHERE rn = 1""")
def dedup_business_key(t: Tables):
    key = ["l_suppkey", "l_partkey", "l_linenumber", "l_returnflag"]
    out = windows.latest_per_key(t("lineitem"), key, [F.desc(c) for c in ("l_shipdate", "l_orderkey", "l_quantity", "l_extendedprice")])
    return out.select(*key, "l_orderkey", "l_shipdate", "l_quantity")


# ---------------------------------------------------------------- set operations and order

@query("sorted_output", "SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey")
def sorted_output(t: Tables):
    return t("customer").select("c_custkey", "c_name", "c_acctbal").orderBy(F.desc("c_acctbal"), "c_custkey")


@query("consolidate_union", """
    SELECT 'sfc' AS src, c_custkey AS key, c_name AS name, c_mktsegment AS segment FROM customer UNION ALL
    SELECT 'int', s_suppkey, s_name, NULL FROM supplier""")
def consolidate_union(t: Tables):
    a = t("customer").select(F.lit("sfc").alias("src"), F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
                             F.col("c_mktsegment").alias("segment"))
    b = t("supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("key"), F.lit("int").alias("src"))
    return stack.stack(a, b)


@query("union_distinct", """
    SELECT l_suppkey AS party, l_returnflag AS flag FROM lineitem UNION
    SELECT o_custkey, o_orderstatus FROM orders""")
def union_distinct(t: Tables):
    return stack.stack_distinct(
        t("lineitem").select(F.col("l_suppkey").alias("party"), F.col("l_returnflag").alias("flag")),
        t("orders").select(F.col("o_custkey").alias("party"), F.col("o_orderstatus").alias("flag")))


@query("distinct_pairs", "SELECT DISTINCT l_suppkey, l_partkey FROM lineitem")
def distinct_pairs(t: Tables):
    return t("lineitem").select("l_suppkey", "l_partkey").distinct()


WEEK = ["h_sun", "h_mon", "h_tue", "h_wed", "h_thu", "h_fri", "h_sat"]


@query("weekly_unpivot", "\nUNION ALL\n".join(
    f"SELECT user_id, CAST(week_start + {i} AS DATE) AS dte_entry, CAST({c} AS DOUBLE) AS qty FROM week_sheet WHERE NULLIF({c}, 0) <> 0"
    for i, c in enumerate(WEEK)))
def weekly_unpivot(t: Tables):
    return stack.unpivot_week(t("week_sheet"), "week_start", WEEK)


@query("activity_union", """
    SELECT 'order' AS fact, o_orderkey AS record_id, o_custkey AS party, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS amt,
           CAST(o_orderdate AS DATE) AS dte FROM orders UNION ALL
    SELECT 'line', l_orderkey, l_suppkey, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE), CAST(l_shipdate AS DATE) FROM lineitem UNION ALL
    SELECT 'event', event_id, user_id, CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE), CAST(ts AS DATE) FROM events""")
def activity_union(t: Tables):
    def spec(fact, record, party, amt, dte):
        return [("fact", F.lit(fact), "string"), ("record_id", record, "bigint"), ("party", party, "bigint"),
                ("amt", amt, "decimal(18,2)"), ("dte", dte, "date")]

    return stack.stack(
        stack.conform(t("orders"), spec("order", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")),
        stack.conform(t("lineitem"), spec("line", "l_orderkey", "l_suppkey", "l_extendedprice", "l_shipdate")),
        stack.conform(t("events"), spec("event", "event_id", "user_id", "value", "ts")))


# ---------------------------------------------------------------- identity and consolidation composites

@query("consolidate_party", """
    SELECT src AS src_sys_key, TIMESTAMP '2001-08-01 00:00:00' AS dts_created_at, 'party' AS created_by,
           TIMESTAMP '2001-08-01 00:00:00' AS dts_updated_at, 'party' AS updated_by, TIMESTAMP '2001-08-01 00:00:00' AS dts_eff_start,
           TIMESTAMP '9999-12-31 00:00:00' AS dts_eff_end, TRUE AS bln_current, key, md5(key) AS hash_key, key AS link,
           md5(key) AS hash_link, name, key_nation, amt_balance, segment FROM
      (SELECT 'sfc' AS src, CAST(c_custkey AS STRING) AS key, c_name AS name, CAST(c_nationkey AS STRING) AS key_nation,
              CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS amt_balance, c_mktsegment AS segment FROM customer UNION ALL
       SELECT 'int', CAST(s_suppkey AS STRING), s_name, CAST(s_nationkey AS STRING),
              CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS DOUBLE), NULL FROM supplier)""")
def consolidate_party(t: Tables):
    return stack.consolidate([("sfc", t("customer"), CUSTOMER_SPEC), ("int", t("supplier"), SUPPLIER_SPEC)], "party", ORDERS_AS_OF)


@query("golden_party", """
    WITH s AS (SELECT * FROM party_stack WHERE src_sys_key = 'sfc'), i AS (SELECT * FROM party_stack WHERE src_sys_key = 'int'),
         o AS (SELECT CAST(o_custkey AS STRING) AS k, count(*) AS n_orders, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS amt_orders FROM orders GROUP BY 1)
    SELECT s.key AS key, i.key AS key_int, coalesce(NULLIF(s.name, ''), NULLIF(i.name, '')) AS name,
           coalesce(i.nation_id, s.nation_id) AS nation_id, coalesce(NULLIF(s.segment, ''), NULLIF(i.segment, '')) AS segment,
           CAST(coalesce(s.amt_balance, i.amt_balance) AS DOUBLE) AS amt_balance, coalesce(n_orders, 0) AS n_orders,
           CAST(coalesce(amt_orders, 0) AS DOUBLE) AS amt_orders
    FROM s LEFT JOIN i ON s.link = i.link LEFT JOIN o ON o.k = s.key""")
def golden_party(t: Tables):
    rows = t("party_stack").withColumn("hash_link", keys.hash_key("link"))
    person = identity.golden(rows, "sfc", ["int"], ["key", "name", "nation_id", "segment", "amt_balance"], {
        "name": ["sfc", "int"], "nation_id": ["int", "sfc"], "segment": ["sfc", "int"], "amt_balance": ["sfc", "int"]})
    orders = t("orders").groupBy(F.col("o_custkey").cast("string").alias("__k")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("amt_orders"))
    out = joins.enrich(person, [(orders, "key", "__k", {"n_orders": "n_orders", "amt_orders": "amt_orders"})])
    return stack.fill_defaults(out, {"n_orders": 0, "amt_orders": 0})


# ---------------------------------------------------------------- currency rates

_CUBE = """
    WITH x AS (SELECT a.frm_curr, b.frm_curr AS to_curr, a.date, 1.0::DOUBLE / ((1.0::DOUBLE / a.value) * b.value) AS fx_rate_div,
                      (1.0::DOUBLE / a.value) * b.value AS fx_rate_mul
               FROM fx_series a JOIN fx_series b ON a.date = b.date AND a.frm_curr <> b.frm_curr
               UNION ALL SELECT frm_curr, to_curr, date, value, 1.0::DOUBLE / value FROM fx_series
               UNION ALL SELECT to_curr, frm_curr, date, 1.0::DOUBLE / value, value FROM fx_series),
         days AS (SELECT CAST(d AS DATE) AS date FROM generate_series(TIMESTAMP '2023-12-01', TIMESTAMP '2024-01-31', INTERVAL 1 DAY) g(d)
                  WHERE CAST(d AS DATE) <= (SELECT max(date) FROM fx_series)),
         pairs AS (SELECT DISTINCT frm_curr, to_curr FROM x),
         cube AS (SELECT * FROM (SELECT p.frm_curr, p.to_curr, d.date,
             last_value(fx_rate_div IGNORE NULLS) OVER (PARTITION BY p.frm_curr, p.to_curr ORDER BY d.date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fx_rate_div,
             last_value(fx_rate_mul IGNORE NULLS) OVER (PARTITION BY p.frm_curr, p.to_curr ORDER BY d.date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fx_rate_mul
             FROM pairs p CROSS JOIN days d LEFT JOIN x ON x.frm_curr = p.frm_curr AND x.to_curr = p.to_curr AND x.date = d.date)
             WHERE fx_rate_div IS NOT NULL),
         lim AS (SELECT min(date) AS lo, max(date) AS hi FROM cube)"""


def rate_cube(t: Tables):
    """Cube over the rate series of the events. Series and cube are small whatever the events hold; both are stored once."""
    return fx.lookup_cube(fx.fx_cube(cut_lineage(t("fx_series")), EVENTS_AS_OF))


@query("fx_cross_rates", """
    SELECT a.frm_curr, b.frm_curr AS to_curr, a.date, 1.0::DOUBLE / ((1.0::DOUBLE / a.value) * b.value) AS fx_rate_div,
           (1.0::DOUBLE / a.value) * b.value AS fx_rate_mul
    FROM fx_series a JOIN fx_series b ON a.date = b.date AND a.frm_curr <> b.frm_curr""")
def fx_cross_rates(t: Tables):
    return fx.cross_rates(cut_lineage(t("fx_series")))


@query("fx_cube", _CUBE + " SELECT * FROM cube")
def fx_cube(t: Tables):
    return fx.fx_cube(cut_lineage(t("fx_series")), EVENTS_AS_OF)


@query("fx_point_lookup", _CUBE + """
    SELECT o_orderkey, dte, upper(coalesce(NULLIF(currency, ''), 'USD')) AS currency_code, coalesce(fx_rate_mul, 1.0) AS fx_rate
    FROM order_currency CROSS JOIN lim
    LEFT JOIN cube ON frm_curr = upper(coalesce(NULLIF(currency, ''), 'USD')) AND to_curr = 'USD' AND date = greatest(least(dte, hi), lo)""")
def fx_point_lookup(t: Tables):
    rows = t("order_currency").withColumn("currency_code", text.norm_currency("currency"))
    out = fx.with_rate(rows, rate_cube(t), "currency_code", F.lit("USD"), "dte", "fx_rate")
    return out.select("o_orderkey", "dte", "currency_code", "fx_rate")


@query("fx_convert_multi", _CUBE + """,
    f AS (SELECT o_orderkey, amt, upper(coalesce(NULLIF(currency, ''), 'USD')) AS c, entity_currency AS e, greatest(least(dte, hi), lo) AS d
          FROM order_currency CROSS JOIN lim),
    g AS (SELECT f.*, CASE WHEN c = 'USD' THEN 1.0 ELSE coalesce(u.fx_rate_mul, 1.0) END AS ru,
                 CASE WHEN c = e THEN 1.0 ELSE coalesce(v.fx_rate_mul, 1.0) END AS re
          FROM f LEFT JOIN cube u ON u.frm_curr = c AND u.to_curr = 'USD' AND u.date = d
                 LEFT JOIN cube v ON v.frm_curr = c AND v.to_curr = e AND v.date = d)
    SELECT o_orderkey, CAST(amt AS DOUBLE) AS amt, ru AS fx_rate_usd, re AS fx_rate_entity,
           CAST(CAST(amt * CAST(ru AS DECIMAL(20,14)) AS DECIMAL(18,2)) AS DOUBLE) AS amt_usd,
           CAST(CAST(amt * CAST(re AS DECIMAL(20,14)) AS DECIMAL(18,2)) AS DOUBLE) AS amt_entity FROM g""")
def fx_convert_multi(t: Tables):
    rows = t("order_currency").withColumn("currency_code", text.norm_currency("currency"))
    out = fx.fx_convert(rows, rate_cube(t), ["amt"], "currency_code", {"usd": F.lit("USD"), "entity": "entity_currency"}, "dte")
    return out.select("o_orderkey", "amt", "fx_rate_usd", "fx_rate_entity", "amt_usd", "amt_entity")
