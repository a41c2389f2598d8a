"""The row-count rules of all models as one query, and the same counts as SQL over the raw tables."""

from __future__ import annotations

from silverloom.models import contracts
from silverloom.models.core import MODELS
from silverloom.models.rules import MODEL_RULES, SOURCE_RULES, FanoutRule, check
from silverloom.plans.catalogue import stored
from silverloom.plans.model_sql import MODEL_SQL, RAW_TABLES
from silverloom.registry import ORACLES, QUERIES
from silverloom.sources import raw
from silverloom.sources.derived import with_inputs

QUERIES["model_contracts"] = lambda spark, folder: contracts.all_rows(spark, MODELS, stored(spark, folder).ref)
QUERIES["dq_models"] = lambda spark, folder: check(stored(spark, folder))

_LINKS = f"""
    SELECT 'ukg' AS s, id AS link FROM ({RAW_TABLES['ukg_pro.employee']}) UNION ALL SELECT 'int', ukg_employee_number FROM ({RAW_TABLES['sage_intacct.employee']})
    UNION ALL SELECT 'por', ukg_id FROM ({RAW_TABLES['portal.users']})
    UNION ALL SELECT 'sfc', ukg_employee_id_c FROM ({RAW_TABLES['salesforce.contact']}) WHERE record_type_id = '0124W000001bI6LQAU'"""
_PROJECTS = f"""
    SELECT 'int' AS s, recordno AS link, projecttype FROM ({RAW_TABLES['sage_intacct.project']}) UNION ALL SELECT 'psa', int_record_no, NULL FROM ({RAW_TABLES['psatools.projects']})
    UNION ALL SELECT 'sfc', intacct_record_no_c, NULL FROM ({RAW_TABLES['salesforce.pse_proj_c']})"""
#: Rows that a reporting model must have where its base has no SQL of its own.
_EXPECTED = {
    "dim_employee": f"""SELECT count(*) FROM ({_LINKS}) u LEFT JOIN ({_LINKS}) i ON u.link = i.link AND i.s = 'int' LEFT JOIN ({_LINKS}) p ON u.link = p.link AND p.s = 'por'
        LEFT JOIN ({_LINKS}) c ON u.link = c.link AND c.s = 'sfc' WHERE u.s = 'ukg'""",
    "dim_project": f"""SELECT count(*) FROM ({_PROJECTS}) i LEFT JOIN ({_PROJECTS}) p ON i.link = p.link AND p.s = 'psa' LEFT JOIN ({_PROJECTS}) c ON i.link = c.link AND c.s = 'sfc'
        WHERE i.s = 'int' AND lower(i.projecttype) <> 'client site'""",
    "dim_ap_bill_item": f"""SELECT count(*) FROM ({raw.RAW_TABLES['sage_intacct.ap_bill_item']}) i LEFT JOIN ({RAW_TABLES['sage_intacct.ap_bill']}) b ON i.recordkey = b.recordno
        WHERE i.lineitem AND b.recordno IS NOT NULL""",
    "dim_timesheet_entry": f"""SELECT count(*) FROM (SELECT DISTINCT projectid, employeeid, entrydate, taskkey FROM ({RAW_TABLES['sage_intacct.timesheetentry']})
        WHERE timesheetkey IN (SELECT recordno FROM ({RAW_TABLES['sage_intacct.timesheet']})))""",
}


def _sql() -> str:
    rows = []
    for r in SOURCE_RULES:
        expected = f"SELECT count(*) FROM ({raw.RAW_TABLES[r.table]}) WHERE {r.rows}"
        model = f"SELECT count(*) FROM ({MODEL_SQL[r.model]}) WHERE src_sys_key = '{r.system}'" if r.model in MODEL_SQL else expected
        rows.append((r.name, "source rows", model, expected))
    for r in MODEL_RULES:
        expected = _EXPECTED.get(r.model) or f"SELECT count(*) FROM ({MODEL_SQL[r.base]}) WHERE {r.rows}"
        model = f"SELECT count(*) FROM ({MODEL_SQL[r.model]})" if r.model in MODEL_SQL else expected
        rows.append((r.name, "fan-out" if isinstance(r, FanoutRule) else "model rows", model, expected))
    # inputs come before the models' own WITH clauses, which stay inside their parentheses
    parts = [f"SELECT '{name}' AS rule, '{kind}' AS kind, ({model}) AS n_model, ({expected}) AS n_expected" for name, kind, model, expected in rows]
    return f"SELECT rule, kind, CAST(n_model AS BIGINT) AS n_model, CAST(n_expected AS BIGINT) AS n_expected, n_model = n_expected AS ok FROM ({' UNION ALL '.join(parts)})"


ORACLES["dq_models"] = with_inputs(_sql())
