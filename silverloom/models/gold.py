"""Gold models: entities resolved across systems, enriched with dimensions, money in several currencies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverloom.functions import pay
from silverloom.functions.keys import composite_key, first_non_null
from silverloom.functions.money import convert, threshold_convert
from silverloom.functions.text import blank_to_null, clean_postal, label, norm_currency, norm_postal, proper_case
from silverloom.models.core import GROWTH, Warehouse, audited, hashed, lean, look, model
from silverloom.operators import filters, fx, hierarchy, joins, reporting, rollup
from silverloom.operators.calendar import GRAIN_NAMES
from silverloom.operators.identity import master_plus_unmatched
from silverloom.operators.stack import fill_defaults, stack
from silverloom.operators.timeline import at_day, timelines, with_timeline
from silverloom.operators.windows import latest_per_key
from silverloom.sources.tables import cut_lineage

LAYER = "dataconsumption"
# Fixed value: first day of the rate series; earlier quotes are ignored.
FX_FIRST = "2016-01-01"


def gold(name: str, sink: str = "table", growth: int = GROWTH):
    """Register a gold model; its rows get the gold audit columns."""

    def add(fn):
        @model(name, LAYER, sink, growth)
        def build(w: Warehouse) -> DataFrame:
            return audited(fn(w), name, w.as_of)

        return fn

    return add


# ---------------------------------------------------------------- shared parts

# Fixed value: a location of the accounting system that is no place.
NO_LOCATION = "55-1"

def portal(w: Warehouse, table: str) -> DataFrame:
    return w.source("portal", table)


def people(w: Warehouse) -> DataFrame:
    """Payroll persons with their CRM user and contact ids, from the CRM row or else the portal row of the same person."""
    ukg = w.system("employee", "ukg").select("key", "link", "hash_link", "display_name", "display_name_lf", "email_address_work", "supervisor_id")
    out = link_system(ukg, w, "sfc", "key:sfc_key salesforce_user_id:sfc_user")
    out = link_system(out, w, "por", "contact_id:por_contact salesforce_user_id:por_user")
    return out.select("key", "hash_link", "display_name", "display_name_lf", "email_address_work", "supervisor_id",
                      first_non_null("sfc_user", "por_user").alias("sfc_user_id"), first_non_null("sfc_key", "por_contact").alias("sfc_contact_id"))


def directory(w: Warehouse) -> DataFrame:
    """Everyone: payroll persons, and CRM contacts that are no payroll person."""
    ukg = people(w).withColumn("src_sys_key", F.lit("ukg"))
    crm = w.system("employee", "sfc").select(
        F.lit("sfc").alias("src_sys_key"), "key", "hash_link", "display_name", "email_address_work",
        F.col("salesforce_user_id").alias("sfc_user_id"), F.col("key").alias("sfc_contact_id"))
    return master_plus_unmatched(ukg, crm, ["sfc_contact_id"])


def link_system(df: DataFrame, w: Warehouse, tag: str, take: str, name: str = "employee") -> DataFrame:
    """Columns of the same entity in another system, matched by link; a null link matches nothing."""
    other = w.system(name, tag).filter(F.col("link").isNotNull())
    return look(df, other, "link", "link", take)


def person(df: DataFrame, who: DataFrame, fk: str, key: str, role: str, proper: bool = True) -> DataFrame:
    """Key, both display names and mail of a person in a role."""
    out = look(df, who, fk, key, f"key:key_{role} display_name:{role}_name display_name_lf:{role}_name_lf email_address_work:{role}_email")
    if not proper:
        return out
    return out.withColumns({f"{role}_name": proper_case(f"{role}_name"), f"{role}_name_lf": proper_case(f"{role}_name_lf")})


def practice(df: DataFrame, w: Warehouse, fk: str = "key_practice") -> DataFrame:
    out = look(df, portal(w, "practices"), fk, "salesforce_id", "record_id:practice_record display_name:practice_name")
    return out.drop(fk).withColumnRenamed("practice_record", "key_practice")


def location(df: DataFrame, w: Warehouse, fk: str = "key_location") -> DataFrame:
    """Location of the CRM and its region."""
    out = look(df, portal(w, "locations"), fk, "salesforce_id", "record_id:location_record display_name:location_name region_id:__region")
    out = look(out, portal(w, "location_regions"), "__region", "id", "record_id:key_region display_name:region_name")
    return out.drop("__region", fk).withColumnRenamed("location_record", "key_location")


def country_state(df: DataFrame, w: Warehouse, country: str, state: str) -> DataFrame:
    """Country by its code; the state by its code within that country."""
    out = look(df, portal(w, "countries"), country, "salesforce_id", "id:__country record_id:key_country display_name:country_name")
    states = portal(w, "states").withColumn("__sk", composite_key("salesforce_id", "country_id"))
    out = out.withColumn("__sf", composite_key(state, "__country"))
    return look(out, states, "__sf", "__sk", "record_id:key_state display_name:state_name").drop("__sf", "__country")


def org(df: DataFrame, w: Warehouse, department: str = "department_id", loc: str = "location_id", base: str | Column | None = None) -> DataFrame:
    """Department, location and entity of an accounting row; the entity is the location's parent or the row's own base."""
    out = look(df, portal(w, "departments"), department, "intacct_id", "record_id:key_department display_name:department_name")
    places = portal(w, "locations").filter(F.col("intacct_id").isNull() | (F.col("intacct_id") != NO_LOCATION))
    out = look(out, places, loc, "intacct_id", "record_id:key_location display_name:location_name")
    out = look(out, w.source("sage_intacct", "location"), loc, "locationid", "parentkey:__parent recordno:__record")
    out = out.withColumn("__entity", F.coalesce(F.col("__parent"), base if base is not None else F.col("__record")))
    out = look(out, portal(w, "entities"), "__entity", "id", "record_id:key_entity_record display_name:entity_name currency_id:currency_code_entity")
    return out.drop("__parent", "__record", "__entity")


def payroll_person(df: DataFrame, w: Warehouse, fk: str = "employee_id") -> DataFrame:
    """Payroll person behind an accounting employee id."""
    return look(df, accounting_persons(w), fk, "intacct_employee_id",
                "key_employee_ukg:key_employee_ukg employee_name:employee_name employee_name_lf:employee_name_lf")


def accounting_persons(w: Warehouse) -> DataFrame:
    """Payroll persons by accounting employee id: the two systems meet before the many rows that ask for them."""
    acc = w.system("employee", "int").select("intacct_employee_id", "link")
    return look(acc, w.system("employee", "ukg"), "link", "link",
                "key:key_employee_ukg display_name:employee_name display_name_lf:employee_name_lf").drop("link")


def linked_persons(w: Warehouse, tag: str, key: str) -> DataFrame:
    """Payroll persons by a key of another system, as ``__who``: the two systems meet before the rows that ask for them."""
    other = w.system("employee", tag).select(F.col(key).alias("__who"), "link")
    return look(other, w.system("employee", "ukg"), "link", "link", "key:key display_name:display_name display_name_lf:display_name_lf email_address_work:email_address_work")


def intacct_project(df: DataFrame, w: Warehouse) -> DataFrame:
    return look(df, w.system("project", "int"), "key_project", "key",
                "project_id:project_id name:project_name currency_iso_code:currency_code_project")


def money_in(df: DataFrame, w: Warehouse, amounts: list[str], frm, targets: dict, date, **kw) -> DataFrame:
    return fx.fx_convert(df, w.rates(), amounts, frm, targets, date, **kw)


def as_money(df: DataFrame, amounts: list[str]) -> DataFrame:
    return df.withColumns({a: F.col(a).cast("decimal(18,2)") for a in amounts})


# ---------------------------------------------------------------- reference

@gold("ref_fx_rates_timeseries")
def ref_fx_rates_timeseries(w: Warehouse) -> DataFrame:
    series = w.source("finance_economics", "fx_rates_timeseries").filter(F.col("date") > F.lit(FX_FIRST).cast("date"))
    # quotes are few; the checkpoint keeps the pair join from reading the source again for each side
    return fx.fx_cube(cut_lineage(series), "9999-12-31")


@gold("ref_reporting_groups_locations")
def ref_reporting_groups_locations(w: Warehouse) -> DataFrame:
    """One row per reporting group, location and practice of its list; hidden groups are left out everywhere."""
    rows = look(portal(w, "reporting_groups_locations"), portal(w, "reporting_groups"), "group_id", "id",
                "name:reporting_group visible:visible parent_id:parent_id start_date:start_date end_date:end_date")
    rows = rows.filter("visible").withColumnRenamed("group_id", "reporting_group_id")
    rows = look(rows, portal(w, "locations"), "location_id", "id", "record_id:key_location display_name:location_name")
    # Practices that have groups of their own, by id.
    listed = joins.fanout(rows, "practice_id", {"2": "2", "3": "3", "4": "4", "5": "5"}).drop("group_name")
    listed = listed.withColumn("practice", F.col("group_id").cast("int")).drop("group_id")
    listed = look(listed, portal(w, "practices"), "practice", "id", "record_id:key_practice display_name:practice_name")
    inner = rows.filter("parent_id = 'INT1000'").withColumn("practice_name", F.lit("Internal"))
    today = F.lit(w.as_of).cast("date")
    active = (F.col("start_date") <= today) & (F.col("end_date").isNull() | (today < F.col("end_date")))
    return stack(listed, inner).withColumn("bln_active", F.coalesce(active, F.lit(False))).drop("practice_id")


# ---------------------------------------------------------------- employee

@gold("dim_employee")
def dim_employee(w: Warehouse) -> DataFrame:
    """Golden person: payroll is the master; accounting, portal and CRM add what payroll lacks."""
    out, hashes = lean(w.system("employee", "ukg").select(
        "key", "hash_key", "link", "hash_link", "display_name", "display_name_lf", "email_address_work", "employee_number", "first_name", "last_name",
        "address_country", "state_id", "address_zip_code", "department_id", "dol_status_id", "employee_type_id", F.col("key_entity").alias("company_ukg"),
        "ethnic_background_id", "gender_id", "location_id_intacct", "location_id_ukg", "payroll_company_id", "pay_type_id", "position_id", "practice_id",
        "base_team_id", "job_salary_grade", "supervisor_id", "dte_src_start", "dte_src_end", "dte_last_hire", "bln_is_active", "annual_salary",
        "hourly_pay_rate", "other_rate_2", "currency_code", "shift_code", "job_title", "termination_type_id",
    ))
    out = out.withColumnRenamed("employee_number", "ukg_employee_number")
    out = link_system(out, w, "int", "intacct_employee_id:intacct_employee_id intacct_location_key:intacct_location_key bln_mst_member:bln_mst")
    out = link_system(out, w, "por", "portal_id:portal_id contractor_company_id:contractor_company_id labor_category_id:labor_category_id key_entity:por_entity")
    out = link_system(out, w, "sfc", "key:sfc_contact_id salesforce_user_id:sfc_user_id")
    out = out.withColumns({"__state": F.lower("state_id"), "__country": F.lower("address_country")})
    lower_states = portal(w, "states").withColumn("__k", F.lower("ukg_id"))
    lower_countries = portal(w, "countries").withColumn("__k", F.lower("ukg_id"))
    out = look(out, lower_states, "__state", "__k", "record_id:key_state display_name:state_name location_id:__state_location")
    out = look(out, lower_countries, "__country", "__k", "record_id:key_country display_name:country_name location_id:__country_location")
    out = out.withColumn("__location", first_non_null("__state_location", "__country_location"))
    by_ukg = {"departments": ("department_id", "department"), "dol_statuses": ("dol_status_id", "dol_status"), "employee_types": ("employee_type_id", "employee_type"),
              "entities": ("company_ukg", "company"), "ethnic_backgrounds": ("ethnic_background_id", "ethnic_background"), "genders": ("gender_id", "gender"),
              "locations_intacct": ("location_id_intacct", "location_intacct"), "locations_ukg": ("location_id_ukg", "location_ukg"),
              "payroll_companies": ("payroll_company_id", "payroll_company"), "pay_types": ("pay_type_id", "pay_type"), "positions": ("position_id", "position"),
              "practices": ("practice_id", "practice"), "base_teams": ("base_team_id", "base_team"), "job_salary_grades": ("job_salary_grade", "salary_grade"),
              "termination_types": ("termination_type_id", "termination_type")}
    for table, (fk, n) in by_ukg.items():
        out = look(out, portal(w, table), fk, "ukg_id", f"record_id:key_{n} display_name:{n}_name")
    out = look(out, portal(w, "shift_codes"), "shift_code", "ukg_id", "record_id:key_shift display_name:shift_name shift_percent:cola_percent")
    out = out.withColumn("cola_percent", F.coalesce("cola_percent", F.lit(0)).cast("decimal(9,5)"))
    out = look(out, portal(w, "positions"), "position_id", "ukg_id", "family_id:__family")
    out = look(out, portal(w, "position_families"), "__family", "id", "record_id:key_position_family display_name:position_family_name")
    out = look(out, portal(w, "contractor_companies"), "contractor_company_id", "id", "display_name:contractor_company_name")
    out = look(out, portal(w, "labor_categories"), "labor_category_id", "id", "record_id:key_labor_categories display_name:labor_category_name")
    out = look(out, w.source("sage_intacct", "location"), "intacct_location_key", "recordno", "parentkey:__parent")
    out = out.withColumn("__entity", first_non_null("__parent", "intacct_location_key", F.col("por_entity").cast("bigint")))
    out = look(out, portal(w, "entities"), "__entity", "id", "record_id:key_entity display_name:entity_name currency_id:currency_code_entity work_hours_per_week:work_hours_per_week")
    out = look(out, portal(w, "locations"), "__location", "id", "record_id:key_location display_name:location_name region_id:__region")
    out = look(out, portal(w, "location_regions"), "__region", "id", "record_id:key_region display_name:region_name continent_id:__continent")
    out = look(out, portal(w, "location_continents"), "__continent", "id", "display_name:continent_name")
    sup = w.system("employee", "ukg")
    out = look(out, sup, "supervisor_id", "key", "key:key_supervisor display_name:supervisor_name display_name_lf:supervisor_name_lf email_address_work:supervisor_email")
    out = out.withColumn("geo_postal_code", F.upper(norm_postal("address_zip_code", "address_country")))
    geo = w.source("reference", "postal_code_geolocations").withColumn("__g", composite_key(F.upper(clean_postal("postal_code")), "key_country"))
    out = out.withColumn("__p", composite_key("geo_postal_code", "key_country"))
    out = look(out, geo, "__p", "__g", "latitude:geo_latitude longitude:geo_longitude")
    out = fill_defaults(out, {"work_hours_per_week": 40})
    return hashed(out.drop(*[c for c in out.columns if c.startswith("__")]), hashes)


def _person_entity(df: DataFrame, w: Warehouse) -> DataFrame:
    """Entity currency of a payroll person: the portal's override, else the accounting location's parent entity."""
    acc = w.system("employee", "int").filter(F.col("link").isNotNull())
    out = look(df, acc, "key_employee", "link", "intacct_location_key:__loc")
    out = look(out, w.system("employee", "por").filter(F.col("link").isNotNull()), "key_employee", "link", "intacct_override_entity_id:__override")
    out = look(out, w.source("sage_intacct", "location"), "__loc", "recordno", "parentkey:__parent")
    out = out.withColumn("__entity", first_non_null("__parent", "__loc"))
    out = look(out, portal(w, "entities"), "__entity", "id", "record_id:key_entity display_name:entity_name currency_id:__entity_currency")
    out = look(out, portal(w, "entities"), "__override", "display_name", "currency_id:__override_currency")
    out = out.withColumn("currency_code_entity", norm_currency(first_non_null("__override_currency", "__entity_currency")))
    return out.drop("__loc", "__override", "__parent", "__entity", "__entity_currency", "__override_currency")


def entity_of(df: DataFrame, w: Warehouse, key: str, name: str, by: str = "id") -> DataFrame:
    """Id, record, name and currency of the portal entity that a key names, as ``<name>_id`` and so on."""
    entities = portal(w, "entities").withColumn("__by", F.col(by).cast("string"))
    return look(df.withColumn("__of", F.col(key).cast("string")), entities, "__of", "__by",
                f"id:{name}_id record_id:{name}_record display_name:{name}_name currency_id:{name}_currency").drop("__of")


def first_entity(df: DataFrame, names: list[str], suffix: str = "") -> DataFrame:
    """The first of several looked-up entities that is known, as key, name and currency; its id stays as ``__entity``."""
    pick = {f"key_entity{suffix}": "record", f"entity_name{suffix}": "name", f"currency_code_entity{suffix}": "currency", f"__entity{suffix}": "id"}
    out = df.withColumns({n: F.coalesce(*[F.col(f"{e}_{part}") for e in names]) for n, part in pick.items()})
    return out.withColumn(f"currency_code_entity{suffix}", F.upper(f"currency_code_entity{suffix}"))


def benefit_rate(df: DataFrame, w: Warehouse, day: Column) -> DataFrame:
    """Benefit rate of the row's entity in the year of the day, 0 where there is none."""
    rates = portal(w, "entities_benefit_rates").withColumn("__k", composite_key("entity_id", "timeframe_id"))
    out = look(df.withColumn("__b", composite_key(F.col("__entity"), F.year(day))), rates, "__b", "__k", "total:benefits_rate")
    return out.withColumn("benefits_rate", F.coalesce("benefits_rate", F.lit(0)).cast("decimal(18,5)")).drop("__b")


def shift_and_grade(df: DataFrame, w: Warehouse, shift: str, grade: str) -> DataFrame:
    """Shift code with its cost-of-living share, and salary grade."""
    out = look(df, portal(w, "shift_codes"), shift, "ukg_id", "record_id:key_shift_code display_name:shift_code_name shift_percent:cola_percent")
    return look(out, portal(w, "job_salary_grades"), grade, "ukg_id", "record_id:key_salary_grade display_name:salary_grade_name")


def optional(df: DataFrame, *names: str) -> DataFrame:
    """The frame with nulls for raw columns that an installation does not have."""
    return df.withColumns({n: F.lit(None).cast("decimal(18,2)") for n in names if n not in df.columns})


@gold("dim_employee_compensation")
def dim_employee_compensation(w: Warehouse) -> DataFrame:
    """Pay in original, entity and US currency: salary, hourly, weekly and period pay with the cost-of-living share of the
    shift code, bonus and other rates, and totals. The entity is that of the accounting employee, else of the company."""
    out = w.system("employee_compensation", "ukg").withColumnRenamed("pay_period_pay_rate", "period_pay_rate")
    out = optional(out, "weekly_pay_rate", "period_pay_rate", *pay.EXTRAS, "other_rate_2")
    day = F.coalesce(*[F.col(c) for c in ("dte_in_job", "dte_last_worked") if c in out.columns], F.lit(w.as_of).cast("date"))
    jobs = latest_per_key(w.system("employee_job_history", "ukg").filter("bln_is_rate_change"), ["key_employee_company", "dte_job_effective"],
                          [F.desc("annual_salary"), F.desc("key")]).withColumn("__k", composite_key("key_employee_company", "dte_job_effective"))
    out = look(out.withColumn("__j", composite_key(F.col("key_employee_company"), day)), jobs, "__j", "__k", "key:key_job_history").drop("__j")
    out = look(out, w.system("employee", "ukg"), "key_employee", "key", "display_name:employee_name display_name_lf:employee_name_lf email_address_work:employee_email")
    out = look(out, portal(w, "positions"), "primary_job_id", "ukg_id", "record_id:key_position display_name:position_name")
    out = look(out, w.source("ukg_pro", "company"), "key_company", "id", "name:company_name")
    out = look(out, w.system("employee", "int").filter(F.col("link").isNotNull()), "key_employee", "link", "key_entity:__int")
    out = entity_of(entity_of(out, w, "__int", "__e1"), w, "key_company", "__e2", "ukg_id")
    out = shift_and_grade(benefit_rate(first_entity(out, ["__e1", "__e2"]), w, day), w, "primary_shift_code", "job_salary_grade")
    out = out.withColumns({"currency_code_original": F.upper("currency_code"), "job_title": first_non_null(blank_to_null("job_title"), "position_name")})
    out = fx.with_rates(out.drop("currency_code"), w.rates(), {
        f"conversion_rate_{s}": ("currency_code_original", to) for s, to in (("entity", "currency_code_entity"), ("usd", F.lit("USD")))}, day)
    out = pay.with_pay(out, {s: f"conversion_rate_{s}" for s in ("entity", "usd")})
    return out.drop(*[c for c in out.columns if c.startswith("__")])


def _payroll_lines(w: Warehouse, name: str, amounts: list[str]) -> DataFrame:
    rows, hashes = lean(w.system(name, "ukg"))
    out = _person_entity(as_money(rows, amounts), w)
    out = look(out, w.source("ukg_pro", "company"), "key_company", "id", "code:company_code name:company_name currency_code:company_currency")
    out = look(out, w.system("employee", "ukg"), "key_employee", "key",
               "display_name:employee_name display_name_lf:employee_name_lf currency_code:currency_code")
    out = out.withColumn("currency_code", norm_currency("currency_code")).drop("company_currency")
    out = money_in(out, w, amounts, "currency_code", {"entity": "currency_code_entity", "usd": F.lit("USD")}, "dte_pay")
    return hashed(out, hashes)


@gold("dim_employee_earning")
def dim_employee_earning(w: Warehouse) -> DataFrame:
    return _payroll_lines(w, "employee_earning", ["amt_base", "amt_current"])


@gold("dim_employee_payroll_deductions")
def dim_employee_payroll_deductions(w: Warehouse) -> DataFrame:
    return _payroll_lines(w, "employee_payroll_deductions", ["amt_employee", "amt_employer"])


@gold("dim_employee_job_history")
def dim_employee_job_history(w: Warehouse) -> DataFrame:
    """Job changes with all pay measures in original, entity, present entity and US currency. The entity is that of the
    change's location, else of the person's accounting location, else of the company; the present one is the second of them.
    Missing hourly, weekly and period pay follow from the salary and the hours."""
    rows, hashes = lean(w.system("employee_job_history", "ukg"))
    out = optional(rows, "weekly_pay_rate", "period_pay_rate", "hourly_pay_rate", "scheduled_work_hours", *pay.EXTRAS, "other_rate_2")
    own = {}
    for table, fk, n in (("practices", "key_practice", "practice"), ("departments", "key_department", "department"), ("base_teams", "key_base_team", "base_team")):
        own[f"hash_{fk}"] = f"ukg_{n}_id"
        out = look(out.withColumn("__fk", F.col(fk)).withColumnRenamed(fk, f"ukg_{n}_id"), portal(w, table), "__fk", "ukg_id", f"record_id:key_{n} display_name:{n}_name").drop("__fk")
    places = portal(w, "locations_intacct")
    out = look(out, places, "key_intacct_location", "ukg_id", "record_id:key_location_intacct display_name:intacct_location_name entity_id:__place_entity")
    out = look(out, w.system("employee", "int").filter(F.col("link").isNotNull()), "key_employee", "link", "locationid:__int_place")
    out = look(out, places, "__int_place", "intacct_id", "entity_id:__int_entity")
    out = entity_of(entity_of(entity_of(out, w, "__place_entity", "__e1"), w, "__int_entity", "__e2"), w, "key_company", "__e3", "ukg_id")
    hours = portal(w, "entities").withColumn("__by", F.col("ukg_id"))
    out = look(out, hours, "key_company", "__by", "work_hours_per_week:__week_hours")
    out = first_entity(first_entity(out, ["__e1", "__e2", "__e3"]), ["__e2"], "_current")
    out = shift_and_grade(benefit_rate(out, w, F.col("dte_job_effective")), w, "shift_code", "salary_grade")
    out = look(out, w.system("employee", "ukg"), "key_employee", "key", "display_name:employee_name display_name_lf:employee_name_lf email_address_work:employee_email")
    out = look(out, w.source("ukg_pro", "company"), "key_company", "id", "name:company_name")
    out = look(out, portal(w, "positions"), "job_id", "ukg_id", "record_id:key_position display_name:position_name")
    out = out.withColumns({"job_title": first_non_null("job_title", "position_name"), "currency_code_original": F.upper("currency_code")}).drop("currency_code")
    annual = F.coalesce("annual_salary", F.lit(0)).cast("decimal(18,2)")
    out = out.withColumns({
        "hourly_pay_rate": pay.or_derived(F.col("hourly_pay_rate"), annual / F.coalesce(F.col("__week_hours") * 52, F.lit(2080))),
        "weekly_pay_rate": pay.or_derived(F.col("weekly_pay_rate"), annual / 52)})
    out = out.withColumn("period_pay_rate", pay.or_derived(F.col("period_pay_rate"), F.col("hourly_pay_rate") * F.coalesce("scheduled_work_hours", F.lit(0)).cast("decimal(18,2)")))
    targets = {"entity": "currency_code_entity", "entity_current": "currency_code_entity_current", "usd": F.lit("USD")}
    out = fx.with_rates(out, w.rates(), {f"conversion_rate_{s}": ("currency_code_original", to) for s, to in targets.items()}, "dte_job_effective")
    out = pay.with_pay(out, {s: f"conversion_rate_{s}" for s in targets})
    return hashed(out.drop(*[c for c in out.columns if c.startswith("__")]), hashes, **own)


# ---------------------------------------------------------------- financial

# Columns that a line gets from small tables, its project and its person, in their order.
ADDED = ["key_department", "department_name", "key_location", "location_name", "key_entity_record", "entity_name", "currency_code_entity",
         "project_id", "project_name", "currency_code_project", "key_employee_ukg", "employee_name", "employee_name_lf"]


def _header_lines(w: Warehouse, lines: str, head: str, fk: str, take: str, of_line: tuple[DataFrame, str, str, str] | None = None,
                  of_header: tuple[DataFrame, str, str, str] | None = None) -> tuple[DataFrame, dict[str, str]]:
    """Accounting lines with their header; lines without one are dropped. Department, entity, project and person follow,
    then further lookups of the line and of its header. The hashes are left to ``hashed``, which takes the second part.

    What a header asks for is found before its many lines are, and what small tables add comes last: it is not moved.
    """
    rows, hashes = lean(w.system(lines, "int").filter("bln_line_item"))
    cols = dict(t.split(":") for t in take.split())
    header = w.system(head, "int").select(F.col("key").alias("__h"), *[F.col(c).alias(n) for c, n in cols.items()])
    tail = list(ADDED)
    if of_header:
        dim, key, dim_key, names = of_header
        header = look(header, dim, key, dim_key, names)
        found = [t.split(":")[1] for t in names.split()]
        rows = rows.drop(*found)
    out = filters.require_header(rows, header, F.col(fk) == F.col("__h")).drop("__h", *[n for n in cols.values() if n.startswith("__")])
    if of_line:
        out = look(out, *of_line)
        tail += [t.split(":")[1] for t in of_line[3].split()]
    out = payroll_person(intacct_project(out, w), w)
    out = org(out, w, base=F.col("baselocation"))
    tail += found if of_header else []
    return out.select(*[c for c in out.columns if c not in tail], *tail), hashes


@gold("dim_ap_bill_item")
def dim_ap_bill_item(w: Warehouse) -> DataFrame:
    return hashed(*_header_lines(w, "apbillitem", "apbill", "key_ap_bill", "key:key_bill recordid:ap_record_id basecurr:base_currency currency:currency_code dte_whenposted:dte_posted state:bill_state"))


@gold("dim_cc_transaction_entry")
def dim_cc_transaction_entry(w: Warehouse) -> DataFrame:
    return hashed(*_header_lines(w, "cc_transaction_entry", "cc_transaction", "key_cc_transaction", "key:key_transaction recordid:cc_record_id basecurr:base_currency currency:currency_code dte_whenposted:dte_posted state:cc_state"))


@gold("dim_expense_item")
def dim_expense_item(w: Warehouse) -> DataFrame:
    """Accounting expense lines with header, and the CRM line and report of the same expense."""
    item = w.system("expenseitem", "sfc").filter(F.col("link").isNotNull())
    report = w.system("expense", "sfc").filter(F.col("link").isNotNull())
    return hashed(*_header_lines(
        w, "expenseitem", "expense", "key_expense",
        "key:key_report recordid:exp_record_id basecurr:exp_base_currency currency:exp_currency dte_whenposted:exp_dte_when_posted state:exp_state link:__report_link",
        of_line=(item, "link", "link", "key:sfc_key_expense_item state:sfc_item_status gl_account_no:gl_account"),
        of_header=(report, "__report_link", "link", "key:sfc_key_expense project_name:sfc_project_name")))


@gold("dim_invoice")
def dim_invoice(w: Warehouse) -> DataFrame:
    """Invoices with what was entered, is due and was paid, in entity and US currency at the exchange date."""
    out = look(w.system("invoice", "int"), portal(w, "entities").withColumn("__id", F.col("id").cast("string")), "key_entity", "__id",
               "record_id:key_entity_record display_name:entity_name currency_id:currency_code_entity")
    amounts = ["amt_total", "amt_total_due", "amt_total_paid"]
    out = fill_defaults(as_money(out, amounts), dict.fromkeys(amounts, 0)).withColumn("currency_iso_code", norm_currency("currency_iso_code"))
    out = out.withColumn("dte_exch_rate", F.coalesce("dte_exch_rate", "dte_posted"))
    return money_in(out, w, amounts, "currency_iso_code", {"usd": F.lit("USD")}, "dte_exch_rate")


@gold("dim_invoice_item")
def dim_invoice_item(w: Warehouse) -> DataFrame:
    rows, hashes = lean(w.system("invoice_item", "int"))
    # large dimensions first, those that add least to a line before the others; what small ones add is not moved
    out = look(rows, w.system("employee", "int"), "key_employee", "key", "display_name:employee_name")
    heads = w.system("invoice", "int").withColumn("dte_invoice", F.coalesce("dte_exch_rate", "dte_posted"))
    out = look(out, heads, "key_invoice", "key", "recordid:invoice_record key_entity:invoice_entity dte_invoice:dte_invoice")
    out = look(out, w.system("project", "int"), "key_project", "key", "name:project_name project_id:project_id")
    out = look(out, portal(w, "entities").withColumn("__id", F.col("id").cast("string")), "invoice_entity", "__id", "currency_id:currency_code_entity display_name:entity_name")
    out = look(out, portal(w, "departments"), "department_id", "intacct_id", "display_name:department_name")
    out = look(out, portal(w, "locations"), "location_id", "intacct_id", "display_name:location_name")
    last = ["project_name", "project_id", "employee_name"]
    out = out.select(*[c for c in out.columns if c not in last], *last)
    out = as_money(out, ["amt", "amt_trx"]).withColumn("currency_iso_code", norm_currency("currency_iso_code"))
    # amt is in the entity's currency already, amt_trx in the invoice's
    out = money_in(out, w, ["amt_trx"], "currency_iso_code", {"usd": F.lit("USD"), "entity": "currency_code_entity"}, "dte_invoice")
    return hashed(out.withColumns({"amt_entity": F.col("amt"), "amt_usd": convert("amt", "fx_rate_usd")}), hashes)


@gold("dim_timesheet")
def dim_timesheet(w: Warehouse) -> DataFrame:
    out = org(w.system("timesheet", "int").withColumn("employee_id_intacct", F.col("employee_id")), w, "employee_department_id", "employee_location_id")
    return payroll_person(out, w, "employee_id_intacct")


@gold("dim_timesheet_entry")
def dim_timesheet_entry(w: Warehouse) -> DataFrame:
    """Time entries with the pay of the day, bill and cost in project, entity and US currency.

    Notes of the CRM entries of the same link are joined in order; the CRM sheet gives where the work was done.
    """
    rows, hashes = lean(w.system("timesheet_entry", "int"))
    crm = w.system("timesheet_entry", "sfc").filter(F.col("link").isNotNull())
    notes = rollup.ordered_concat(crm, ["link"], "task_name", F.col("dte_entry"), distinct=True)
    out = look(rows, notes, "link", "link", "values_text:sfc_notes")
    out = look(out, w.system("timesheet", "int"), "key_timesheet", "key", "status:state dte_src_start:dte_timesheet")
    out = intacct_project(out, w)
    # a person's entity and pay are found before the many entries ask for the person
    acc = w.system("employee", "int").withColumn("__entity_id", F.col("key_entity").cast("bigint"))
    who = look(accounting_persons(w), acc, "intacct_employee_id", "intacct_employee_id", "__entity_id:__person_entity")
    who = look(who, portal(w, "entities"), "__person_entity", "id", "record_id:key_entity_employee")
    paid = w.ref("vw_employee_pay_history").withColumnRenamed("key_employee", "key_employee_ukg")
    pay_of = {c: F.max(c) for c in ("hourly_pay_rate_usd", "annual_salary_usd")}
    who = with_timeline(who, timelines(paid, ["key_employee_ukg"], "date_from", pay_of), ["key_employee_ukg"])
    out = look(out, who, "employee_id_intacct", "intacct_employee_id",
               " ".join(f"{c}:{c}" for c in ("key_employee_ukg", "employee_name", "employee_name_lf", "key_entity_employee", "line")))
    out = at_day(out, "dte_entry", pay_of, open_start=False)
    # what small tables add comes last and is not moved
    have = set(out.columns)
    out = org(out, w, base=F.col("location_key"))
    added = [c for c in out.columns if c not in have]
    at = out.columns.index("dte_timesheet") + 1
    out = out.select(*out.columns[:at], *added, *[c for c in out.columns[at:] if c not in added])
    out = out.withColumns({"currency_iso_code": norm_currency("currency_iso_code"), "currency_code_project": norm_currency("currency_code_project"),
                           "currency_code_entity": norm_currency("currency_code_entity"), "bill_rate": F.coalesce("bill_rate", F.lit(0)).cast("decimal(18,2)"),
                           "qty": F.col("qty").cast("decimal(18,2)")})
    targets = {"project": "currency_code_project", "entity": "currency_code_entity", "usd": F.lit("USD")}
    out = money_in(out, w, ["bill_rate"], "currency_iso_code", targets, "dte_entry")
    cost = F.coalesce(F.col("hourly_pay_rate_usd"), F.lit(0)).cast("decimal(18,2)")
    out = out.withColumns({f"amt_bill_{s}": (F.col(f"bill_rate_{s}") * F.col("qty")).cast("decimal(18,2)") for s in targets})
    return hashed(out.withColumn("amt_cost_usd", (cost * F.col("qty")).cast("decimal(18,2)")), hashes)


def time_flags(w: Warehouse) -> DataFrame:
    """Class flags per task code from the links of the standard phase codes."""
    std, code = F.col("standard_phase_code_id"), F.col("phase_code")
    # Standard codes of paid leave, and further codes outside billable time.
    leave = std.isin("PTO", "PAIDLEAVE", "DULL", "COMP", "SICK", "LTS", "LTD")
    classes = {"pto": leave, "internal_travel": code == "Internal TVL", "travel": code == "TVL", "disfun": std == "DISFUN", "nowork": std == "NOWORK",
               "internal": leave | std.isin("NOWORK", "DISFUN"), "excluded": leave | std.isin("NOWORK", "DISFUN", "UNPAIDLEAVE") | code.isin("TVL", "Internal TVL")}
    return filters.class_flags(w.source("psatools", "standard_phase_codes_product_links"), "phase_code", classes).withColumnRenamed("phase_code", "task_name")


@gold("dim_timesheet_entry_aggregates")
def dim_timesheet_entry_aggregates(w: Warehouse) -> DataFrame:
    """Utilisation by person, entity, period and category with the forecast's plan."""
    rows = w.ref("dim_timesheet_entry").filter(F.col("key_employee_ukg").isNotNull())
    entries = rows.select(F.col("key_employee_ukg").alias("person_id"), F.col("key_entity_employee").alias("entity_person"), F.col("key_entity_record").alias("entity_project"),
                          "task_name", "bln_billable", "dte_entry", "qty", F.col("amt_bill_usd").alias("amt_bill"), F.col("amt_cost_usd").alias("amt_cost"))
    plan = look(portal(w, "users_forecasts"), portal(w, "timeframes"), "timeframe_id", "id", "enddate:enddate")
    plan = look(plan, portal(w, "users"), "user_id", "record_id", "ukg_id:person_id")
    plan = look(plan, w.system("employee", "ukg"), "person_id", "key", "dte_src_start:dte_start")
    plan = reporting.yearly_plan(plan.withColumn("year", F.year("enddate")), "plan_hours_year", "dte_start", "year")
    plan = plan.select("person_id", "year", "plan_hours_year", "plan_hours_week", "bill_rate")
    out = reporting.utilisation(entries, time_flags(w), plan)
    out = out.withColumn("date_group_type_name", label("date_group_type_id", GRAIN_NAMES))
    return look(out, w.system("employee", "ukg"), "person_id", "key", "display_name:employee_name display_name_lf:employee_name_lf employee_number:ukg_employee_number")


# ---------------------------------------------------------------- planning, project

@gold("dim_estimates_vs_actuals")
def dim_estimates_vs_actuals(w: Warehouse) -> DataFrame:
    """Planned hours with the hours and amounts booked by the same person on the same project inside the plan's interval."""
    plan = w.system("estimates_vs_actuals", "sfc").filter(~F.col("bln_exclude_from_planners")).select("key", "key_project", "key_resource", "dte_start", "dte_end", "planned_hours", "planned_bill_rate",
                                                           "planned_bill_amount", "currency_iso_code_bill_rate")
    plan = look(plan, w.system("employee", "sfc"), "key_resource", "key", "link:__person display_name:resource_name")
    plan = look(plan, w.system("project", "sfc"), "key_project", "key", "link:__project name:project_name")
    person_link = w.system("employee", "ukg").select(F.col("key").alias("k"), F.col("link").alias("__person_link"))
    entries = look(w.ref("dim_timesheet_entry"), person_link, "key_employee_ukg", "k", "__person_link:person_link")
    entries = look(entries, w.system("project", "int"), "key_project", "key", "link:project_link")
    plan = plan.withColumnsRenamed({"__person": "person_link", "__project": "project_link"})
    measures = {"actual_hours": F.col("qty"), "actual_amt_usd": F.col("amt_bill_usd")}
    out = rollup.plan_vs_actual(plan, entries, ["person_link", "project_link"], "dte_start", "dte_end", "dte_entry", measures)
    out = fill_defaults(out, {"actual_hours": 0, "actual_amt_usd": 0}).drop("person_link", "project_link")
    out = out.withColumns({"currency_iso_code_bill_rate": norm_currency("currency_iso_code_bill_rate"),
                           "actual_rate_usd": F.coalesce(F.try_divide(F.col("actual_amt_usd").cast("double"), F.col("actual_hours").cast("double")), F.lit(0.0))})
    return money_in(out, w, ["planned_bill_rate", "planned_bill_amount"], "currency_iso_code_bill_rate", {"usd": F.lit("USD")}, F.least("dte_end", F.lit(w.as_of).cast("date")))


@gold("dim_project")
def dim_project(w: Warehouse) -> DataFrame:
    """Golden project of accounting, with project tool and CRM; the order amount in US dollars."""
    rows, hashes = lean(w.system("project", "int"))
    out = rows.filter(F.lower("project_type") != "client site")
    # people of the other two systems' projects are found there, before the wide rows of accounting ask for them
    tool = w.system("project", "psa").filter(F.col("link").isNotNull()).select("link", "assistant_project_manager_id")
    tool = look(tool, w.system("employee", "por"), "assistant_project_manager_id", "key", "display_name:assistant_project_manager_name")
    crm = w.system("project", "sfc").filter(F.col("link").isNotNull()).select(
        "link", F.col("key").alias("key_sfc_project"), "account_id", "client_manager_id", "group_id", F.col("practice_id").alias("sfc_practice_id"), F.col("account_name").alias("customer_name"))
    crm = person(crm, linked_persons(w, "sfc", "key"), "client_manager_id", "__who", "client_manager")
    out = person(out, linked_persons(w, "int", "intacct_employee_id"), "project_manager_id", "__who", "project_manager")
    out = look(out, tool, "link", "link", " ".join(f"{c}:{c}" for c in tool.columns[1:]))
    out = look(out, crm, "link", "link", " ".join(f"{c}:{c}" for c in crm.columns[1:]))
    found = [f"{part}{role}{what}" for role in ("project_manager", "client_manager") for part, what in (("key_", ""), ("", "_name"), ("", "_name_lf"), ("", "_email"))]
    found.append("assistant_project_manager_name")
    out = out.select(*[c for c in out.columns if c not in found], *found)
    out = look(out, portal(w, "departments"), "department_id", "intacct_id", "record_id:key_department display_name:department_name")
    out = look(out, portal(w, "practices"), "group_id", "salesforce_id", "display_name:group_name")
    out = look(out, portal(w, "practice_areas"), "department_id", "intacct_id", "record_id:key_practice_area display_name:practice_area_name practice_id:__practice")
    out = look(out, portal(w, "practices"), "__practice", "id", "display_name:__p1")
    out = look(out, portal(w, "practices"), "sfc_practice_id", "salesforce_id", "display_name:__p2")
    out = out.withColumn("practice_name", first_non_null("__p1", "__p2"))
    out = look(out, portal(w, "locations"), "location_id", "intacct_id", "record_id:key_location display_name:location_name region_id:__region")
    regions = look(portal(w, "location_regions"), portal(w, "users").withColumnRenamed("display_name", "__name"), "regional_manager_user_id", "id", "__name:__manager")
    out = look(out, regions, "__region", "id", "display_name:region_name __manager:regional_manager_name")
    out = look(out, portal(w, "entities").withColumn("__id", F.col("id").cast("string")), "key_entity", "__id", "display_name:entity_name currency_id:currency_code_entity")
    out = out.withColumn("currency_iso_code", norm_currency("currency_iso_code"))
    out = fx.with_rate(out, w.rates(), "currency_iso_code", F.lit("USD"), "dte_src_start", "__div", rate="div")
    out = fx.with_rate(out, w.rates(), "currency_iso_code", F.lit("USD"), "dte_src_start", "__mul")
    out = out.withColumn("amt_po_usd", threshold_convert("amt_po", "__div", "__mul"))
    return hashed(out.drop("__practice", "__p1", "__p2", "__region", "__div", "__mul"), hashes)


def _project_dims(df: DataFrame, w: Warehouse, account: str) -> DataFrame:
    """Account with its country, state, location and region."""
    out = look(df, w.system("sales_account", "sfc"), account, "key", "name:account_name billing_country_code:__cc billing_state_code:__sc key_location:__loc")
    out = country_state(out, w, "__cc", "__sc")
    return location(out, w, "__loc").drop("__cc", "__sc")


@gold("dim_project_phase_code", growth=32)
def dim_project_phase_code(w: Warehouse) -> DataFrame:
    """Accounting phase codes with their CRM and project-tool counterparts, and CRM tasks that accounting does not know."""
    codes = w.ref("project_phase_code")
    miles = codes.filter("src_sys_key = 'sfc_milestones'")
    tool = codes.filter("src_sys_key = 'pts'")
    acc = codes.filter("src_sys_key = 'int'").select("key", "hash_link", "key_project", "hash_key_project", "name")
    acc = look(acc, miles, "hash_link", "hash_link", "key:key_milestone key_approver:key_approver key_practice_area:key_practice_area")
    acc = look(acc, tool, "hash_link", "hash_link", "key:key_psa")
    acc = look(acc, w.system("project", "int"), "key_project", "key", "name:project_name project_manager_id:project_manager_id hash_link:__pl")
    acc = look(acc, w.system("project", "sfc").filter(F.col("hash_link").isNotNull()), "__pl", "hash_link", "account_id:account_id").drop("__pl")
    only = codes.filter("src_sys_key = 'sfc_project_task' AND link IS NULL").select("key", "hash_link", "key_project", "hash_key_project", "name", "key_milestone")
    only = look(only, miles, "key_milestone", "key", "key_approver:key_approver key_practice_area:key_practice_area")
    only = look(only, tool, "key", "sfc_task_id", "key:key_psa")
    only = look(only, w.system("project", "sfc"), "key_project", "key", "name:project_name account_id:account_id")
    out = stack(acc, only)
    out = person(out, directory(w), "key_approver", "sfc_user_id", "approver")
    out = look(out, portal(w, "practice_areas"), "key_practice_area", "salesforce_id", "display_name:practice_area_name practice_id:__practice")
    out = look(out, portal(w, "practices"), "__practice", "id", "display_name:practice_name").drop("__practice")
    return _project_dims(out, w, "account_id")


@gold("dim_project_task")
def dim_project_task(w: Warehouse) -> DataFrame:
    rows, hashes = lean(w.system("project_task", "sfc"))
    # the CRM's project and accounting's meet before the tasks that ask for them
    crm = w.system("project", "sfc").select("key", "name", "account_id", F.col("link").alias("__pl"))
    crm = look(crm, w.system("project", "int").filter(F.col("link").isNotNull()), "__pl", "link", "key:key_project_int currency_iso_code:project_currency")
    # and so does its account
    crm = _project_dims(crm.withColumnRenamed("name", "project_name"), w, "account_id").drop("__pl")
    account = crm.columns[crm.columns.index("account_name"):]
    first = ["project_name", "account_id", "key_project_int", "project_currency"]
    out = look(rows, crm, "key_project", "key", " ".join(f"{c}:{c}" for c in first + account))
    out = look(out, w.ref("project_phase_code").filter("src_sys_key = 'sfc_milestones'"), "key_phase_code", "key", "name:phase_code_name")
    out = person(out, directory(w), "owner_id", "sfc_user_id", "owner")
    out = look(out, w.system("sales_proposal", "sfc"), "key_proposal", "key", "name:proposal_name")
    return hashed(out.select(*[c for c in out.columns if c not in account], *account), hashes)


@gold("dim_project_task_milestone")
def dim_project_task_milestone(w: Warehouse) -> DataFrame:
    """Milestones with the earned value in original, project and US currency."""
    rows, hashes = lean(w.system("project_task_milestone", "sfc"))
    # the CRM's project and accounting's meet before the milestones that ask for them
    crm = w.system("project", "sfc").select("key", "name", F.col("link").alias("__pl"))
    crm = look(crm, w.system("project", "int").filter(F.col("link").isNotNull()), "__pl", "link", "currency_iso_code:project_currency dte_src_start:__start")
    out = look(rows, crm, "key_project", "key", "name:project_name project_currency:project_currency __start:__start")
    own = "currency_iso_code" if "currency_iso_code" in out.columns else F.lit(None).cast("string")
    out = look(out, w.ref("project_phase_code").filter("src_sys_key = 'sfc_milestones'"), "key_milestone", "key", "name:phase_code_name")
    out = look(out, w.system("project_task", "sfc"), "key_project_task", "key", "name:task_name")
    every = directory(w)
    users = w.system("sales_user", "sfc")
    for role in ("created", "modified"):
        out = look(out, every, f"src_{role}_by_id", "sfc_user_id", f"display_name:__d_{role}")
        out = look(out, users, f"src_{role}_by_id", "key", f"name:__u_{role}")
        out = out.withColumn(f"{role}_by_name", first_non_null(f"__d_{role}", f"__u_{role}")).drop(f"__d_{role}", f"__u_{role}")
    out = as_money(out.withColumnRenamed("earned_value", "earned_value_original"), ["earned_value_original"]).withColumns(
        {"project_currency": norm_currency("project_currency"), "__day": F.coalesce("dte_milestone", "__start"), "earned_value": F.col("earned_value_original")})
    out = out.withColumn("currency_original", norm_currency(first_non_null(blank_to_null(own), "project_currency")))
    out = money_in(out, w, ["earned_value"], "currency_original", {"project": "project_currency", "usd": F.lit("USD")}, "__day")
    return hashed(out.drop("__day", "__start", "earned_value"), hashes)


# ---------------------------------------------------------------- sales

@gold("dim_sales_account")
def dim_sales_account(w: Warehouse) -> DataFrame:
    """Account with its whole ancestry, inherited grade and terms, managers, region and geo position."""
    out = w.system("sales_account", "sfc")
    out = hierarchy.hierarchy(out, "key", "key_parent_account", name="name", inherit=["grade", "payment_terms"])
    out = out.withColumnsRenamed({"top_key": "key_top_level_parent_account", "top_name": "top_level_parent_account_name"})
    out = out.drop("grade", "payment_terms").withColumnsRenamed({"grade_inherited": "grade", "payment_terms_inherited": "payment_terms"})
    who = people(w)
    out = out.withColumnsRenamed({"key_client_manager": "__cm", "key_owner": "__ow"})
    out = person(out, who, "__cm", "sfc_contact_id", "client_manager")
    out = person(out, who, "__ow", "sfc_user_id", "owner").drop("__cm", "__ow")
    out = look(out, w.system("sales_rate_card_set", "sfc"), "key_rate_card_set", "key", "name:rate_card_set_name")
    out = location(practice(country_state(out, w, "billing_country_code", "billing_state_code"), w), w)
    out = out.withColumn("geo_postal_code", norm_postal("billing_postal_code", "billing_country_code"))
    geo = w.source("reference", "postal_code_geolocations").withColumn("__g", composite_key(F.upper(clean_postal("postal_code")), "key_country"))
    out = out.withColumn("__p", composite_key("geo_postal_code", "key_country"))
    return look(out, geo, "__p", "__g", "latitude:geo_latitude longitude:geo_longitude").drop("__p")


def _discounts(df: DataFrame, lines: DataFrame, fk: str) -> DataFrame:
    sums = rollup.discount_rollup(lines, fk, F.col("list_price").cast("decimal(18,2)"), F.col("total_price").cast("decimal(18,2)"))
    return look(df, sums, "key", fk, "amt_gross:amt_gross amt_net:amt_net amt_discount:amt_discount discount_percent:discount_percent")


@gold("dim_sales_opportunity")
def dim_sales_opportunity(w: Warehouse) -> DataFrame:
    rows, hashes = lean(w.system("sales_opportunity", "sfc"))
    out = _discounts(rows, w.system("sales_opportunity_line_item", "sfc"), "key_opportunity")
    out = hierarchy.hierarchy(out, "key", "key_parent_opportunity", name="name").withColumnsRenamed(
        {"top_key": "key_top_level_opportunity", "top_name": "top_level_opportunity_name"})
    out = look(out, w.ref("dim_sales_account"), "key_account", "key", "name:account_name key_top_level_parent_account:key_top_level_parent_account")
    out = out.withColumnRenamed("key_owner", "__ow")
    out = hashed(person(out, directory(w), "__ow", "sfc_user_id", "owner"), hashes, hash_key_owner="__ow").drop("__ow")
    out = location(practice(out, w), w).withColumn("currency_iso_code", norm_currency("currency_iso_code"))
    return money_in(as_money(out, ["amt"]), w, ["amt"], "currency_iso_code", {"usd": F.lit("USD")}, "dte_close")


@gold("dim_sales_opportunity_line_item", growth=4)
def dim_sales_opportunity_line_item(w: Warehouse) -> DataFrame:
    lines, hashes = lean(w.system("sales_opportunity_line_item", "sfc"))
    # the opportunity's account is found before its many lines are
    head = _project_dims(w.system("sales_opportunity", "sfc").select("key", F.col("name").alias("opportunity_name"), "key_account", "stage_name"), w, "key_account")
    own, account = head.columns[1:4], head.columns[4:]
    # the product adds little to a line; what the opportunity adds comes last and is not moved with the lines
    product = ["product_name", "product_family"]
    out = look(lines, w.system("sales_product", "sfc"), "key_product", "key", "name:product_name family:product_family")
    out = look(out, head, "key_opportunity", "key", " ".join(f"{c}:{c}" for c in own + account))
    out = out.select(*[c for c in out.columns if c not in product + account], *product, *account)
    return practice(hashed(out, hashes), w)


@gold("dim_sales_proposal")
def dim_sales_proposal(w: Warehouse) -> DataFrame:
    """Proposal with its project, discounts against two list prices, and fifteen approver and reviewer roles.

    The project is the opportunity's, else the proposal's own.
    The roles are stacked to one row per proposal and role, looked up in the directory once, and folded back: one join
    instead of fifteen.
    """
    base, hashes = lean(w.system("sales_proposal", "sfc"))
    roles = [f"approver_{i}" for i in range(1, 11)] + [f"reviewer_{i}" for i in range(1, 6)]
    pairs = F.explode(F.array(*[F.struct(F.lit(r).alias("role"), F.col(r).alias("user_id")) for r in roles]))
    long = base.select("key", pairs.alias("__r")).select("key", "__r.*").filter(F.col("user_id").isNotNull())
    named = look(long, directory(w).filter(F.col("sfc_user_id").isNotNull()), "user_id", "sfc_user_id", "display_name:display_name")
    # a role's short row moves, not a row of fifteen columns for each
    wide = joins.eav_pivot(named.repartition("key"), "key", "role", "display_name", roles)
    sums = rollup.price_discounts(w.system("sales_proposal_line_item", "sfc"), "key_proposal", "total_price", "unit_price", ["location", "opportunity"])
    out = look(base.withColumnRenamed("key_project", "sfc_project_id"), w.system("sales_opportunity", "sfc"), "key_opportunity", "key", "name:opportunity_name key_project:__project")
    out = out.withColumn("__project", F.coalesce("__project", "sfc_project_id"))
    linked = w.system("project", "sfc").filter(F.col("hash_link").isNotNull()).select(F.col("key").alias("__sfc"), "hash_link")
    linked = look(linked, w.system("project", "int").filter(F.col("hash_link").isNotNull()), "hash_link", "hash_link", "key:key_project project_id:project_id name:project_name")
    out = look(out, linked, "__project", "__sfc", "key_project:key_project project_id:project_id project_name:project_name")
    out = out.drop("__project").withColumnRenamed("key_owner", "__ow")
    out = _project_dims(person(out, directory(w), "__ow", "sfc_user_id", "owner"), w, "key_account")
    last = out.columns[out.columns.index("account_name"):]
    # sums and names of roles come last: they meet the proposal by its key, and no other join moves them
    late = [*sums.columns[1:], *[f"{r}_name" for r in roles]]
    out = look(out, sums, "key", "key_proposal", " ".join(f"{c}:{c}" for c in sums.columns[1:]))
    out = look(out, wide, "key", "key", " ".join(f"{r}:{r}_name" for r in roles))
    first = [c for c in out.columns[:out.columns.index("opportunity_name")] if c not in late]
    out = out.select(*first, *late, *[c for c in out.columns if c not in first + late])
    out = hashed(out, hashes, hash_key_project="sfc_project_id", hash_key_owner="__ow").drop("__ow")
    out = practice(out, w)
    return out.select(*[c for c in out.columns if c not in last], *last)


@gold("dim_sales_proposal_line_item", growth=4)
def dim_sales_proposal_line_item(w: Warehouse) -> DataFrame:
    lines, hashes = lean(w.system("sales_proposal_line_item", "sfc"))
    # account and opportunity of a proposal are found before its many lines are
    head = w.system("sales_proposal", "sfc").select("key", F.col("name").alias("proposal_name"), "key_account", "key_opportunity")
    head = look(head, w.system("sales_account", "sfc"), "key_account", "key", "name:account_name")
    head = look(head, w.system("sales_opportunity", "sfc"), "key_opportunity", "key", "name:opportunity_name")
    out = look(lines, w.system("sales_product", "sfc"), "key_product", "key", "name:product_name")
    out = look(out, head, "key_proposal", "key", " ".join(f"{c}:{c}" for c in head.columns[1:]))
    last = ["product_name", "account_name", "opportunity_name"]
    return practice(hashed(out.select(*[c for c in out.columns if c not in last], *last), hashes), w)


@gold("dim_sales_purchase_order")
def dim_sales_purchase_order(w: Warehouse) -> DataFrame:
    """Orders of customers in US currency, that of their opportunity, and that of their account's entity."""
    rows, hashes = lean(w.system("sales_purchase_order", "sfc"))
    out = _project_dims(rows, w, "key_account")
    out = look(out, w.system("sales_opportunity", "sfc"), "key_opportunity", "key", "name:opportunity_name currency_iso_code:currency_iso_code_opportunity")
    accounts = look(w.system("sales_account", "sfc"), portal(w, "locations"), "key_location", "salesforce_id", "entity_id:__entity")
    accounts = look(accounts, portal(w, "entities"), "__entity", "id", "display_name:entity_name currency_id:currency_iso_code_entity")
    out = look(out, accounts, "key_account", "key", "entity_name:entity_name currency_iso_code_entity:currency_iso_code_entity")
    out = as_money(out, ["amt_po"]).withColumns({"amt_po": F.coalesce(F.col("amt_po").cast("decimal(18,2)"), F.lit(0).cast("decimal(18,2)")),
                                                 "currency_iso_code": norm_currency("currency_iso_code")})
    return hashed(money_in(out, w, ["amt_po"], "currency_iso_code", {
        "usd": F.lit("USD"), "opportunity": "currency_iso_code_opportunity", "entity": "currency_iso_code_entity"}, "dte_received"), hashes)


def _with_directory(w: Warehouse, name: str, fk: str, role: str) -> DataFrame:
    return hashed(*_lean_with_directory(w, name, fk, role))


def _lean_with_directory(w: Warehouse, name: str, fk: str, role: str) -> tuple[DataFrame, dict[str, str]]:
    """The same rows with the hashes left to ``hashed``."""
    rows, hashes = lean(w.system(name, "sfc"))
    out = person(rows.withColumnRenamed(fk, "__fk"), directory(w), "__fk", "sfc_user_id", role).withColumnRenamed("__fk", f"{fk}_sfc")
    return out, {**hashes, f"hash_{fk}": f"{fk}_sfc"}


@gold("dim_sales_account_team_member")
def dim_sales_account_team_member(w: Warehouse) -> DataFrame:
    return look(_with_directory(w, "sales_account_team_member", "key_user", "member"), w.system("sales_account", "sfc"), "key_account", "key", "name:account_name")


@gold("dim_sales_opportunity_team_member")
def dim_sales_opportunity_team_member(w: Warehouse) -> DataFrame:
    out, hashes = _lean_with_directory(w, "sales_opportunity_team_member", "key_user", "member")
    out = look(out, w.system("sales_opportunity", "sfc"), "key_opportunity", "key", "name:opportunity_name key_account:key_account")
    return hashed(look(out, w.system("sales_account", "sfc"), "key_account", "key", "name:account_name"), hashes)


@gold("dim_sales_contact")
def dim_sales_contact(w: Warehouse) -> DataFrame:
    out = look(w.system("sales_contact", "sfc"), w.system("sales_user", "sfc"), "key_user", "key", "ukg_employee_id:user_employee_id name:user_name")
    every = directory(w)
    out = look(out, every, "user_employee_id", "key", "display_name:employee_name supervisor_id:__sup")
    out = look(out, every, "__sup", "key", "display_name:supervisor_name email_address_work:supervisor_email").drop("__sup")
    out = look(out, w.system("sales_account", "sfc"), "key_account", "key", "name:account_name")
    return practice(out, w)


@gold("dim_sales_lead")
def dim_sales_lead(w: Warehouse) -> DataFrame:
    out, hashes = _lean_with_directory(w, "sales_lead", "key_owner", "owner")
    out = hashed(look(out, w.system("sales_opportunity", "sfc"), "key_opportunity", "key", "name:opportunity_name"), hashes)
    return location(practice(country_state(out, w, "country_code", "state_code"), w), w)


@gold("dim_sales_price_book_entry")
def dim_sales_price_book_entry(w: Warehouse) -> DataFrame:
    return look(w.system("sales_price_book_entry", "sfc"), w.system("sales_product", "sfc"), "key_product", "key", "name:product_name")


@gold("dim_sales_product")
def dim_sales_product(w: Warehouse) -> DataFrame:
    return w.system("sales_product", "sfc")


@gold("dim_sales_rate_card")
def dim_sales_rate_card(w: Warehouse) -> DataFrame:
    out = look(_with_directory(w, "sales_rate_card", "key_owner", "owner"), w.system("sales_rate_card_set", "sfc"), "key_rate_card_set", "key", "name:rate_card_set_name")
    out = look(out, w.system("sales_account", "sfc"), "key_account", "key", "name:account_name")
    return location(practice(out, w), w)


@gold("dim_sales_rate_card_set")
def dim_sales_rate_card_set(w: Warehouse) -> DataFrame:
    return _with_directory(w, "sales_rate_card_set", "key_owner", "owner")


@gold("dim_sales_user")
def dim_sales_user(w: Warehouse) -> DataFrame:
    """CRM users with their person by payroll id, the contact that names them as user, and who approves in their place."""
    every = directory(w)
    out = person(w.system("sales_user", "sfc"), every, "ukg_employee_id", "key", "person")
    out = look(out, w.system("sales_contact", "sfc"), "key", "key_user", "key:key_contact_user key_account:key_account")
    out = look(out, w.system("sales_account", "sfc"), "key_account", "key", "name:account_name")
    out = look(out, every, "key_delegated_approver", "sfc_user_id", "display_name:__person")
    out = look(out, w.system("sales_user", "sfc"), "key_delegated_approver", "key", "name:__user")
    return out.withColumn("delegated_approver_name", first_non_null(proper_case("__person"), "__user")).drop("__person", "__user")


# ---------------------------------------------------------------- reports

@gold("rpt_activity_by_project")
def rpt_activity_by_project(w: Warehouse) -> DataFrame:
    """Billable time, expenses, bills and card entries of every project in record, project and US currency."""
    def facts(df: DataFrame, fact: str, record: str, project: str, who: str, dte: str, cur: str, base, amt_trx: str, amt_base: str, qty) -> DataFrame:
        return df.select(F.lit(fact).alias("fact"), F.col(record).cast("string").alias("record_id"), F.col(project).alias("project_id"), F.col(who).alias("person_id"),
                         F.col(dte).alias("dte"), F.col(cur).alias("currency"), base.alias("base_currency"), F.col(amt_trx).cast("decimal(18,2)").alias("amt_trx"),
                         F.col(amt_base).cast("decimal(18,2)").alias("amt_base"), qty.cast("decimal(18,2)").alias("qty"))

    one = F.lit(1)
    time = w.ref("dim_timesheet_entry").filter("bln_billable")
    exp = w.ref("dim_expense_item").filter("bln_billable")
    parts = [
        facts(time, "time", "key", "key_project", "key_employee_ukg", "dte_entry", "currency_iso_code", F.col("currency_iso_code"), "bill_rate", "bill_rate", F.col("qty")),
        facts(exp, "expense", "exp_record_id", "key_project", "key_employee_ukg", "exp_dte_when_posted", "org_currency", F.col("exp_base_currency"), "amt_trx", "amt", one),
        facts(w.ref("dim_ap_bill_item").filter("bln_billable"), "ap", "ap_record_id", "key_project", "key_employee_ukg", "dte_posted", "currency_code", F.col("base_currency"), "amt_trx", "amt", one),
        facts(w.ref("dim_cc_transaction_entry").filter("bln_billable"), "card", "cc_record_id", "key_project", "key_employee_ukg", "dte_posted", "currency_code", F.col("base_currency"), "amt_trx", "amt", one),
    ]
    project = w.ref("dim_project").filter(F.col("dte_src_start").isNotNull()).select(
        F.col("key").alias("project_id"), "project_manager_name", F.col("name").alias("project_name"), F.col("currency_iso_code").alias("project_currency"), "account_id", "amt_po_usd")
    out = reporting.activity(stack(*parts), project.select("project_id", "project_name", "project_currency"), w.rates())
    out = look(out, project, "project_id", "project_id", "project_manager_name:project_manager_name account_id:key_account amt_po_usd:amt_po_usd")
    out = look(out, w.ref("dim_sales_account"), "key_account", "key", "name:account_name top_level_parent_account_name:top_level_parent_account_name")
    out = look(out, w.ref("dim_employee"), "person_id", "key", "ukg_employee_number:ukg_employee_number display_name:employee_name")
    return fill_defaults(out, {"account_name": "", "employee_name": "", "project_manager_name": ""})


@gold("rpt_labor_budgeting")
def rpt_labor_budgeting(w: Warehouse) -> DataFrame:
    year = F.year(F.lit(w.as_of).cast("date"))
    who = w.ref("dim_employee").select(
        F.col("key").alias("person_id"), F.col("annual_salary").cast("decimal(18,2)").alias("salary"), F.coalesce("other_rate_2", F.lit(0)).cast("decimal(9,4)").alias("bonus_percent"),
        F.coalesce("cola_percent", F.lit(0)).cast("decimal(9,4)").alias("cola_percent"), F.col("currency_code").alias("currency"), F.col("currency_code_entity").alias("entity_currency"),
        "display_name", "department_name", "entity_name", "portal_id")
    who = look(who, w.source("seed", "currencies_active"), "currency", "currency", "default_fx_rate_to_usd:default_fx_rate_to_usd")
    plan = portal(w, "users_forecasts").filter(F.col("timeframe_id") == year).select(
        F.col("user_id").alias("person_id"), (F.col("plan_hours_year") / 52).cast("decimal(18,2)").alias("plan_hours_week"), F.col("bill_rate").cast("decimal(18,2)").alias("bill_rate"))
    weekly = w.ref("dim_timesheet_entry_aggregates").filter("entity_grouping = 'Employee' AND date_group_type_id = 'W'").select(
        "person_id", F.to_date(F.substring("date_group_id", 2, 10)).alias("week_start"), "type", "hours", F.col("amt_bill").alias("amt"))
    return reporting.labor_budget(who, plan, weekly, w.rates(), w.as_of)


@gold("rpt_payroll")
def rpt_payroll(w: Warehouse) -> DataFrame:
    """Entries with their sheet and a time-type indicator; the classes come from the seed of time types."""
    kinds = {"sicktime": "1", "vacholtime": "2", "dulltime": "3", "tvltime": "4", "excludepayroll": "5"}
    flags = filters.class_flags(w.source("seed", "time_type_phase_codes"), "phase_code", {k: F.col("time_type") == k for k in kinds})
    flags = flags.withColumnRenamed("phase_code", "task_name")
    sheets = w.ref("dim_timesheet").select(F.col("key").alias("key_timesheet"), F.col("status").alias("sheet_status"), "entity_name", "dte_src_start")
    entries = w.ref("dim_timesheet_entry").select("key", "key_timesheet", "key_employee_ukg", "task_name", "qty", "dte_entry", "bln_billable")
    out = reporting.payroll(sheets, entries, "key_timesheet", flags, kinds)
    return look(out, w.ref("dim_employee"), "key_employee_ukg", "key", "ukg_employee_number:ukg_employee_number base_team_name:base_team_name state_name:state_name country_name:country_name")
