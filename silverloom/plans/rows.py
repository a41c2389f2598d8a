"""Queries over single rows: sources, sinks, filters and column operators."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, LongType, StructField, StructType

from silverloom.functions import dates, keys, money, text
from silverloom.operators import filters, stack
from silverloom.registry import Tables, query
from silverloom.sources import tables
from silverloom.sources.derived import ORDERS_AS_OF

PRIORITY_SEED = "code STRING, label STRING"


def seed_path(name: str) -> str:
    from importlib.resources import files

    return str(files("silverloom") / "seeds" / f"{name}.csv")


# ---------------------------------------------------------------- sources and sinks

@query("seed_lookup", """
    SELECT s.label AS label, count(*) AS n, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amt
    FROM lineitem LEFT JOIN (VALUES ('A', 'Accepted'), ('N', 'New'), ('R', 'Returned')) s(code, label)
         ON l_returnflag = s.code GROUP BY 1""")
def seed_lookup(t: Tables):
    seed = tables.load_seed(t.spark, seed_path("return_flags"), PRIORITY_SEED)
    sums = t("lineitem").groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.sum(money.money("l_extendedprice")).alias("amt"))
    return sums.join(seed, F.col("l_returnflag") == F.col("code"), "left").select("label", "n", "amt")


@query("table_roundtrip", """
    SELECT src_sys_key, key, link, name, nation_id, CAST(amt_balance AS DOUBLE) AS amt_balance, segment
    FROM party_stack""")
def table_roundtrip(t: Tables):
    root = f"{tables.shared_root(t.spark)}/roundtrip-{uuid.uuid4().hex}"
    return tables.write_table(t("party_stack"), root, "consolidation", "party", ["src_sys_key"], ["key"])


@query("view_over_model", """
    SELECT nation_id, count(*) AS n FROM party_stack WHERE src_sys_key = 'sfc' GROUP BY nation_id""")
def view_over_model(t: Tables):
    view = tables.publish_view(t("party_stack"), "vw_party")
    return filters.slice_system(view, "sfc").groupBy("nation_id").agg(F.count(F.lit(1)).alias("n"))


@query("catalog_roundtrip", """
    SELECT nation_id, count(*) AS n, count(link) AS n_linked FROM party_stack GROUP BY nation_id""")
def catalog_roundtrip(t: Tables):
    """A table published under a schema of its own, a persistent view over it, read back by its three-part name."""
    schema = f"party_{uuid.uuid4().hex[:12]}"
    tables.publish_table(t("party_stack"), schema, "party")
    tables.point_view(t.spark, f"{schema}.vw_party_count", f"SELECT nation_id, count(*) AS n, count(link) AS n_linked FROM {schema}.party GROUP BY nation_id")
    return tables.load_catalog_table(t.spark, f"spark_catalog.{schema}.vw_party_count")


# ---------------------------------------------------------------- filters

@query("soft_delete_filter", """
    SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE NOT (o_orderstatus = 'F')""")
def soft_delete_filter(t: Tables):
    return filters.drop_deleted(t("orders"), F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey", "o_orderstatus")


@query("source_slice", "SELECT key, name FROM party_stack WHERE src_sys_key = 'int'")
def source_slice(t: Tables):
    return filters.slice_system(t("party_stack"), "int").select("key", "name")


@query("sanity_range_filter", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
    WHERE l_extendedprice BETWEEN 2100 AND 50000""")
def sanity_range_filter(t: Tables):
    rows = filters.keep_between(t("lineitem"), "l_extendedprice", 2100, 50000)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


@query("outlier_neutralise", """
    SELECT o_orderkey, CASE WHEN o_totalprice < 1000 THEN 0 ELSE o_totalprice END AS amt,
           CASE WHEN o_totalprice / 100000 >= 1 THEN 0 ELSE o_totalprice / 100000 END AS share FROM orders""")
def outlier_neutralise(t: Tables):
    share = F.col("o_totalprice") / 100000
    return t("orders").select(
        "o_orderkey",
        money.neutralise("o_totalprice", F.col("o_totalprice") < 1000).alias("amt"),
        money.neutralise(share, share >= 1).alias("share"))


@query("delimited_membership", """
    SELECT p_partkey, p_name FROM part WHERE list_contains(string_split(p_name, ' '), 'bolt')""")
def delimited_membership(t: Tables):
    return t("part").filter(text.in_delimited("p_name", "bolt", " ")).select("p_partkey", "p_name")


@query("in_list_filter", """
    SELECT o_orderkey, o_orderpriority FROM orders
    WHERE o_orderpriority IN ('1-URGENT', '5-LOW') AND o_orderstatus NOT IN ('P')""")
def in_list_filter(t: Tables):
    cond = text.in_list("o_orderpriority", ["1-URGENT", "5-LOW"]) & text.in_list("o_orderstatus", ["P"], negate=True)
    return t("orders").filter(cond).select("o_orderkey", "o_orderpriority")


@query("semi_join_active", """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0 AND c_mktsegment = 'BUILDING')""")
def semi_join_active(t: Tables):
    active = t("customer").filter((F.col("c_acctbal") > 0) & (F.col("c_mktsegment") == "BUILDING"))
    rows = filters.keep_matching(t("orders"), active.select(F.col("c_custkey").alias("o_custkey")), ["o_custkey"])
    return rows.select("o_orderkey", "o_custkey")


@query("anti_join_unmatched", """
    SELECT c_custkey, c_name FROM customer c
    WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'P')""")
def anti_join_unmatched(t: Tables):
    late = t("orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return filters.drop_matching(t("customer"), late, ["c_custkey"]).select("c_custkey", "c_name")


@query("code_class_case", """
    SELECT e.task_name AS task_name,
           CASE WHEN task_name IN (SELECT phase_code FROM code_links WHERE standard_code = 'SICK') THEN '1'
                WHEN task_name IN (SELECT phase_code FROM code_links WHERE standard_code = 'PTO') THEN '2'
                WHEN task_name IN (SELECT phase_code FROM code_links WHERE standard_code = 'TVL') THEN '4'
                ELSE '0' END AS time_type, count(*) AS n
    FROM entry_fact e GROUP BY 1, 2""")
def code_class_case(t: Tables):
    std = F.col("standard_code")
    flags = filters.class_flags(t("code_links"), "phase_code", {"sick": std == "SICK", "pto": std == "PTO", "tvl": std == "TVL"})
    rows = filters.classify(t("entry_fact"), "task_name", flags, "phase_code")
    kind = F.when(F.col("sick"), "1").when(F.col("pto"), "2").when(F.col("tvl"), "4").otherwise("0")
    return rows.groupBy("task_name", kind.alias("time_type")).agg(F.count(F.lit(1)).alias("n"))


@query("header_required_join", """
    SELECT l_orderkey, l_linenumber, l_partkey, o_custkey FROM lineitem
    LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'O') ON l_orderkey = o_orderkey WHERE o_orderkey IS NOT NULL""")
def header_required_join(t: Tables):
    head = t("orders").filter("o_orderstatus = 'O'").select("o_orderkey", "o_custkey")
    rows = filters.require_header(t("lineitem"), head, F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "o_custkey")


@query("trailing_12m", f"""
    SELECT o_custkey, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amt
    FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '{ORDERS_AS_OF}' - INTERVAL 12 MONTH GROUP BY o_custkey""")
def trailing_12m(t: Tables):
    rows = t("orders").filter(dates.within_months("o_orderdate", 12, ORDERS_AS_OF))
    return rows.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.sum(money.money("o_totalprice")).alias("amt"))


@query("active_flag", """
    SELECT user_id, (dte_hired <= DATE '2024-01-15' AND (dte_left IS NULL OR DATE '2024-01-15' < dte_left)) AS bln_active
    FROM person_dates""")
def active_flag(t: Tables):
    return t("person_dates").select("user_id", dates.active_flag("dte_hired", "dte_left", "2024-01-15").alias("bln_active"))


@query("change_rows", """
    WITH j AS (SELECT *, lag(shift_code) OVER (PARTITION BY person_id ORDER BY dte_effective, change_id) AS prev FROM job_change)
    SELECT person_id, dte_effective, change_id, shift_code, prev AS previous_shift_code FROM j
    WHERE percent_change <> 0 OR bln_rate_change OR reason_code IN ('1', '5') OR prev <> shift_code""")
def change_rows(t: Tables):
    rows = filters.changed(t("job_change"), "person_id", "dte_effective", "shift_code", "percent_change", ["1", "5"],
                           "reason_code", "bln_rate_change", ties=["change_id"])
    return rows.select("person_id", "dte_effective", "change_id", "shift_code", "previous_shift_code")


# ---------------------------------------------------------------- projections

CUSTOMER_SPEC = [
    ("key", "c_custkey", "string"), ("link", "c_custkey", "string"), ("name", "c_name", "string"),
    ("key_nation", "c_nationkey", "string"), ("amt_balance", "c_acctbal", "decimal(18,2)"),
    ("segment", "c_mktsegment", "string"),
]
SUPPLIER_SPEC = [
    ("key", "s_suppkey", "string"), ("link", "s_suppkey", "string"), ("name", "s_name", "string"),
    ("key_nation", "s_nationkey", "string"), ("amt_balance", "s_acctbal", "decimal(18,2)"), ("segment", None, "string"),
]


@query("conform_party", """
    SELECT CAST(c_custkey AS STRING) AS key, CAST(c_custkey AS STRING) AS link, c_name AS name,
           CAST(c_nationkey AS STRING) AS key_nation, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS amt_balance,
           c_mktsegment AS segment FROM customer
    UNION ALL
    SELECT CAST(s_suppkey AS STRING), CAST(s_suppkey AS STRING), s_name, CAST(s_nationkey AS STRING),
           CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS DOUBLE), NULL FROM supplier""")
def conform_party(t: Tables):
    return stack.conform(t("customer"), CUSTOMER_SPEC).unionByName(stack.conform(t("supplier"), SUPPLIER_SPEC))


@query("audit_envelope", """
    SELECT 'int' AS src_sys_key, TIMESTAMP '2001-08-01 00:00:00' AS dts_created_at, 'party' AS created_by,
           TIMESTAMP '2001-08-01 00:00:00' AS dts_updated_at, 'party' AS updated_by,
           TIMESTAMP '2001-08-01 00:00:00' AS dts_eff_start, TIMESTAMP '9999-12-31 00:00:00' AS dts_eff_end,
           TRUE AS bln_current, s_suppkey, s_name FROM supplier""")
def audit_envelope(t: Tables):
    return keys.with_envelope(t("supplier").select("s_suppkey", "s_name"), "int", "party", ORDERS_AS_OF)


@query("hash_keys", """
    SELECT o_orderkey, md5(CAST(o_orderkey AS STRING)) AS hash_key,
           md5(CAST(o_custkey AS STRING) || ':' || CAST(o_orderkey AS STRING)) AS hash_link FROM orders""")
def hash_keys(t: Tables):
    return t("orders").select("o_orderkey", keys.hash_key("o_orderkey").alias("hash_key"),
                              keys.hash_key("o_custkey", "o_orderkey").alias("hash_link"))


@query("composite_key", """
    SELECT l_orderkey, l_linenumber, l_partkey,
           CAST(l_orderkey AS STRING) || ':' || CAST(NULLIF(l_linenumber, 7) AS STRING) AS key FROM lineitem""")
def composite_key(t: Tables):
    return t("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        keys.composite_key("l_orderkey", F.nullif(F.col("l_linenumber"), F.lit(7))).alias("key"))


@query("blank_to_null", "SELECT src_sys_key, key, NULLIF(name, '') AS name, NULLIF(segment, '') AS segment FROM party_stack")
def blank_to_null(t: Tables):
    return stack.blanks_to_null(t("party_stack"), ["name", "segment"]).select("src_sys_key", "key", "name", "segment")


@query("default_fill", """
    SELECT src_sys_key, key, coalesce(link, '0') AS link, coalesce(segment, '') AS segment FROM party_stack""")
def default_fill(t: Tables):
    return stack.fill_defaults(t("party_stack"), {"link": "0", "segment": ""}).select("src_sys_key", "key", "link", "segment")


@query("coalesce_chain", """
    SELECT src_sys_key, key, coalesce(segment, link, name) AS first_text FROM party_stack""")
def coalesce_chain(t: Tables):
    return t("party_stack").select("src_sys_key", "key", keys.first_non_null("segment", "link", "name").alias("first_text"))


@query("money_triplet", """
    WITH a AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS DECIMAL(18,2)) AS qty,
                      CAST(l_extendedprice AS DECIMAL(18,2)) AS rate FROM lineitem),
         b AS (SELECT *, CAST(rate * 1.37 AS DECIMAL(18,2)) AS rate_usd FROM a)
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(rate AS DOUBLE) AS rate, CAST(rate_usd AS DOUBLE) AS rate_usd,
           CAST(CAST(rate * qty AS DECIMAL(18,2)) AS DOUBLE) AS amt,
           CAST(CAST(rate_usd * qty AS DECIMAL(18,2)) AS DOUBLE) AS amt_usd FROM b""")
def money_triplet(t: Tables):
    rows = t("lineitem").withColumns({"qty": money.money("l_quantity"), "rate": F.col("l_extendedprice")})
    return money.money_steps(rows, [
        ("rate", F.col("rate")),
        ("rate_usd", money.convert("rate", F.lit(1.37))),
        ("amt", F.col("rate") * F.col("qty")),
        ("amt_usd", F.col("rate_usd") * F.col("qty")),
    ]).select("l_orderkey", "l_linenumber", "l_partkey", "rate", "rate_usd", "amt", "amt_usd")


@query("display_name", """
    SELECT p_partkey,
           upper(p_name[1]) || lower(substring(split_part(p_name, ' ', 1), 2)) || ' '
             || upper(p_type[1]) || lower(substring(p_type, 2)) AS name,
           upper(p_type[1]) || lower(substring(p_type, 2)) || ', '
             || upper(p_name[1]) || lower(substring(split_part(p_name, ' ', 1), 2)) AS name_lf FROM part""")
def display_name(t: Tables):
    first = F.split_part("p_name", F.lit(" "), F.lit(1))
    blank = F.lit("")
    return t("part").select(
        "p_partkey", text.display_name(first, "p_type", blank).alias("name"),
        text.display_name(first, "p_type", blank, last_first=True).alias("name_lf"))


@query("postal_normalise", """
    WITH a AS (SELECT c_custkey, c_nationkey % 7 AS c, substring(c_name, 10, 4) || '-' || substring(c_name, 14, 2) || ' '
                      || substring(c_name, 16) AS code FROM customer),
         b AS (SELECT c_custkey, CASE c WHEN 0 THEN 'us' WHEN 1 THEN 'CA' WHEN 2 THEN 'GB' WHEN 3 THEN 'IE' WHEN 4 THEN 'NL'
                                      WHEN 5 THEN 'KR' ELSE 'DE' END AS country, replace(replace(code, ' ', ''), '-', '') AS p FROM a)
    SELECT c_custkey, country, CASE upper(country) WHEN 'US' THEN left(p, 5) WHEN 'CA' THEN left(p, 3)
           WHEN 'GB' THEN left(p, length(p) - 3) WHEN 'IE' THEN left(p, 3) WHEN 'NL' THEN left(p, 4)
           WHEN 'KR' THEN left(p, 5) ELSE p END AS geo_postal_code FROM b""")
def postal_normalise(t: Tables):
    country = text.label(F.col("c_nationkey") % 7, {0: "us", 1: "CA", 2: "GB", 3: "IE", 4: "NL", 5: "KR"}, "DE")
    code = F.concat(F.substring("c_name", 10, 4), F.lit("-"), F.substring("c_name", 14, 2), F.lit(" "),
                    F.expr("substring(c_name, 16)"))
    rows = t("customer").select("c_custkey", country.alias("country"), code.alias("code"))
    return rows.select("c_custkey", "country", text.norm_postal("code", "country").alias("geo_postal_code"))


@query("code_label", """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open' ELSE 'Unknown' END AS status FROM orders""")
def code_label(t: Tables):
    return t("orders").select("o_orderkey", text.label("o_orderstatus", {"F": "Finished", "O": "Open"}, "Unknown").alias("status"))


@query("flag_to_bool", """
    SELECT src_sys_key, key, coalesce(segment = 'BUILDING', FALSE) AS bln_building FROM party_stack""")
def flag_to_bool(t: Tables):
    return t("party_stack").select("src_sys_key", "key", text.flag("segment", "BUILDING").alias("bln_building"))


@query("record_label", """
    SELECT src_sys_key, key, CASE WHEN name IS NULL OR name = '' THEN key ELSE name || ' - ' || key END AS label FROM party_stack""")
def record_label(t: Tables):
    return t("party_stack").select("src_sys_key", "key", text.record_label("name", "key").alias("label"))


@query("safe_ratio", """
    SELECT l_orderkey, l_linenumber, l_partkey,
           CASE WHEN l_discount = 0 OR l_discount IS NULL THEN 0.0 ELSE l_tax / l_discount END AS ratio FROM lineitem""")
def safe_ratio(t: Tables):
    return t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", money.safe_ratio("l_tax", "l_discount").alias("ratio"))


@query("derived_rate_fallback", """
    WITH a AS (SELECT c_custkey, CAST(c_acctbal AS DECIMAL(18,2)) AS annual,
                      CASE WHEN c_mktsegment = 'BUILDING' THEN NULL WHEN c_mktsegment = 'FURNITURE' THEN CAST(0 AS DECIMAL(18,2))
                           ELSE CAST(c_nationkey AS DECIMAL(18,2)) END AS weekly FROM customer)
    SELECT c_custkey, CAST(CASE WHEN weekly IS NULL OR weekly = 0 THEN CAST(CAST(annual AS DOUBLE) / 52 AS DECIMAL(18,4))
                           ELSE weekly END AS DOUBLE) AS weekly_pay FROM a""")
def derived_rate_fallback(t: Tables):
    weekly = (F.when(F.col("c_mktsegment") == "BUILDING", F.lit(None)).when(F.col("c_mktsegment") == "FURNITURE", F.lit(0))
              .otherwise(F.col("c_nationkey")).cast("decimal(18,2)"))
    annual = money.money("c_acctbal").cast("double")
    return t("customer").select(
        "c_custkey", money.rate_or_derived(weekly, (annual / 52).cast("decimal(18,4)")).cast("double").alias("weekly_pay"))


@query("fx_threshold_convert", """
    WITH a AS (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS amt,
                      CASE o_orderstatus WHEN 'F' THEN 0.09 WHEN 'O' THEN 1.25 ELSE 0.0078 END::DOUBLE AS div FROM orders)
    SELECT o_orderkey, CAST(CAST(amt * CAST(1.0::DOUBLE / div AS DECIMAL(20,14)) AS DECIMAL(18,2)) AS DOUBLE) AS amt_usd FROM a""")
def fx_threshold_convert(t: Tables):
    div = text.label("o_orderstatus", {"F": 0.09, "O": 1.25}, 0.0078)
    rows = t("orders").withColumns({"amt": money.money("o_totalprice"), "div": div})
    out = money.threshold_convert("amt", "div", F.lit(1.0) / F.col("div"))
    return rows.select("o_orderkey", out.alias("amt_usd"))


@query("amount_ladder", """
    SELECT o_orderkey, CAST(CASE WHEN upper(coalesce(NULLIF(currency, ''), 'USD')) = entity_currency THEN amt
                        WHEN entity_currency = 'USD' THEN CAST(amt * 0.9 AS DECIMAL(18,2))
                        ELSE CAST(amt * 1.37 AS DECIMAL(18,2)) END AS DOUBLE) AS amt_project FROM order_currency""")
def amount_ladder(t: Tables):
    trx = text.norm_currency("currency")
    picked = money.pick_amount(
        [(trx == F.col("entity_currency"), F.col("amt")),
         (F.col("entity_currency") == "USD", money.convert("amt", F.lit(0.9)))],
        money.convert("amt", F.lit(1.37)))
    return t("order_currency").select("o_orderkey", picked.alias("amt_project"))


@query("comp_totals", """
    WITH a AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_extendedprice AS DECIMAL(18,2)) AS base, CAST(l_tax AS DECIMAL(9,4)) AS cola,
                      CAST(l_quantity AS DECIMAL(18,2)) AS bonus FROM lineitem),
         b AS (SELECT *, base AS base_original,
                      CAST(base * (1 + cola) AS DECIMAL(18,2)) AS base_uplift_original,
                      bonus AS bonus_original,
                      CAST(base * 1.37 AS DECIMAL(18,2)) AS base_usd,
                      CAST(base * (1 + cola) * 1.37 AS DECIMAL(18,2)) AS base_uplift_usd,
                      CAST(bonus * 1.37 AS DECIMAL(18,2)) AS bonus_usd FROM a)
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(base_original AS DOUBLE) AS base_original,
           CAST(base_uplift_original AS DOUBLE) AS base_uplift_original, CAST(bonus_original AS DOUBLE) AS bonus_original,
           CAST(base_uplift_original + bonus_original AS DOUBLE) AS total_original, CAST(base_usd AS DOUBLE) AS base_usd,
           CAST(base_uplift_usd AS DOUBLE) AS base_uplift_usd, CAST(bonus_usd AS DOUBLE) AS bonus_usd,
           CAST(base_uplift_usd + bonus_usd AS DOUBLE) AS total_usd FROM b""")
def comp_totals(t: Tables):
    rows = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", money.money("l_extendedprice").alias("base"),
                                F.col("l_tax").alias("cola"), money.money("l_quantity").alias("bonus"))
    out = money.totals(rows, "base", F.col("cola"), "bonus", {"original": F.lit(1.0), "usd": F.lit(1.37)})
    return out.drop("base", "cola", "bonus")


# ---------------------------------------------------------------- scalar functions

@query("string_functions", """
    SELECT c_custkey, upper(c_name) AS up, lower(c_mktsegment) AS low, trim('  ' || c_name || ' ') AS trimmed,
           ltrim('||' || c_name, '|') AS no_bars, replace(c_name, '#', '-') AS replaced, left(c_name, 8) AS head,
           length(c_name) AS len, c_name LIKE '%7%' AS has_seven, md5(c_name) AS digest FROM customer""")
def string_functions(t: Tables):
    n = F.col("c_name")
    return t("customer").select(
        "c_custkey", F.upper(n).alias("up"), F.lower("c_mktsegment").alias("low"),
        F.trim(F.concat(F.lit("  "), n, F.lit(" "))).alias("trimmed"),
        F.ltrim(F.concat(F.lit("||"), n), F.lit("|")).alias("no_bars"), F.replace(n, F.lit("#"), F.lit("-")).alias("replaced"),
        F.left(n, F.lit(8)).alias("head"), F.length(n).cast("long").alias("len"), n.like("%7%").alias("has_seven"),
        keys.hash_key("c_name").alias("digest"))


@query("date_functions", """
    WITH a AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)
    SELECT o_orderkey, CAST(year(d) AS BIGINT) AS y, CAST(weekofyear(d) AS BIGINT) AS w, CAST(d + 10 AS DATE) AS plus_days,
           CAST(d - INTERVAL 12 MONTH AS DATE) AS year_ago, date_diff('day', d, DATE '2001-08-01') AS days_to,
           date_diff('day', date_trunc('week', d), date_trunc('week', DATE '2001-08-01')) // 7 AS weeks_to, CAST(date_trunc('month', d) AS DATE) AS month_start,
           strftime(d, '%Y-%m') AS month_text, make_date(year(d), 12, 31) AS year_end,
           CAST(dayofweek(d) + 1 AS BIGINT) AS weekday_no, CAST(last_day(d) AS DATE) AS month_end FROM a""")
def date_functions(t: Tables):
    d = dates.day("o_orderdate")
    today = F.lit(ORDERS_AS_OF).cast("date")
    return t("orders").select(
        "o_orderkey", F.year(d).cast("long").alias("y"), F.weekofyear(d).cast("long").alias("w"),
        F.date_add(d, 10).alias("plus_days"), F.add_months(d, -12).alias("year_ago"),
        F.datediff(today, d).cast("long").alias("days_to"), dates.monday_boundaries(d, today).cast("long").alias("weeks_to"),
        F.trunc(d, "month").alias("month_start"), F.date_format(d, "yyyy-MM").alias("month_text"),
        F.make_date(F.year(d), F.lit(12), F.lit(31)).alias("year_end"), F.dayofweek(d).cast("long").alias("weekday_no"),
        F.last_day(d).alias("month_end"))


@query("null_functions", """
    SELECT src_sys_key, key, coalesce(segment, 'none') AS seg, NULLIF(name, '') AS name_or_null,
           CASE WHEN link IS NULL THEN 0 ELSE 1 END AS has_link,
           CASE nation_id WHEN 0 THEN 1 ELSE nation_id END AS decoded,
           CASE WHEN amt_balance > 0 THEN 'credit' ELSE 'debt' END AS side FROM party_stack""")
def null_functions(t: Tables):
    return t("party_stack").select(
        "src_sys_key", "key", F.ifnull("segment", F.lit("none")).alias("seg"), text.blank_to_null("name").alias("name_or_null"),
        F.when(F.col("link").isNull(), 0).otherwise(1).alias("has_link"),
        text.label("nation_id", {0: 1}).alias("__z"), "nation_id",
        F.when(F.col("amt_balance") > 0, "credit").otherwise("debt").alias("side"),
    ).select("src_sys_key", "key", "seg", "name_or_null", "has_link", F.coalesce("__z", "nation_id").alias("decoded"), "side")


@query("math_functions", """
    SELECT l_orderkey, l_linenumber, l_partkey,
           CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)), 1) AS DOUBLE) AS rounded,
           least(l_quantity, 25.0) AS capped, greatest(l_discount, l_tax) AS larger,
           CAST(CAST(l_extendedprice AS DECIMAL(18,2)) - CAST(l_quantity AS DECIMAL(18,2)) AS DOUBLE) AS diff,
           coalesce(l_extendedprice / NULLIF(l_tax, 0), 0) AS per_tax FROM lineitem""")
def math_functions(t: Tables):
    return t("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.round(money.money("l_extendedprice"), 1).alias("rounded"),
        F.least("l_quantity", F.lit(25.0)).alias("capped"), F.greatest("l_discount", "l_tax").alias("larger"),
        (money.money("l_extendedprice") - money.money("l_quantity")).alias("diff"),
        money.safe_ratio("l_extendedprice", "l_tax").alias("per_tax"))


ORDER_CONTRACT = StructType([
    StructField("key", LongType()), StructField("key_customer", LongType()), StructField("amt", DecimalType(18, 2)),
    StructField("dte", DateType()),
])


@query("dq_schema_contract", """
    SELECT o_orderkey AS key, o_custkey AS key_customer, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS amt,
           CAST(o_orderdate AS DATE) AS dte FROM orders""")
def dq_schema_contract(t: Tables):
    from silverloom.operators.quality import check_schema

    rows = stack.conform(t("orders"), [
        ("key", "o_orderkey", "bigint"), ("key_customer", "o_custkey", "bigint"),
        ("amt", "o_totalprice", "decimal(18,2)"), ("dte", "o_orderdate", "date")])
    return check_schema(rows, ORDER_CONTRACT)
