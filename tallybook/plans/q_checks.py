"""Registered integrity checks (section 2.8) with their oracle SQL."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ..operators import checks as C
from ..operators.check_state import CheckState
from ..sources import complete
from ..sources.complete import CompleteLedger
from ..sources.fixtures import FIXTURE_COLUMNS
from ..sources.io import staging_dir
from . import catalog as K
from . import integrity as I
from . import oracle_checks as O
from .oracle_fixtures import FULL
from .registry import PARAMS as P
from .registry import register

AS_OF_DATE = P["as_of"]


def _columns(table):
    return complete.columns(table) if table in complete.COLUMNS else FIXTURE_COLUMNS[table]


def _violation_sql(r, as_of):
    return O.violation_sql(r, _columns(r.table), _key_cols(r.table), as_of, FULL)


def _count_sql(r, as_of):
    return O.count_sql(r, as_of, FULL)


def _key_cols(table):
    return K.KEY_COLUMNS.get(table, K.KEY_COLUMNS.get(table.replace("_billing", ""), ()))


def register_violations(name: str, rules, as_of: str | None = None):
    rules = list(rules)
    sql = "\nunion all\n".join(_violation_sql(r, as_of) for r in rules)
    keys = {r.table: _key_cols(r.table) for r in rules}
    register(name, sql)(lambda lg: C.violations(CompleteLedger.of(lg), rules, keys, as_of=as_of))
    return rules


def register_summary(name: str, rules, as_of: str | None = None):
    rules = list(rules)
    sql = "\nunion all\n".join(_count_sql(r, as_of) for r in rules)
    register(name, sql)(lambda lg: C.summary(CompleteLedger.once(lg), rules, as_of=as_of))
    return rules, sql


_billing = [replace(r, table="t_account_billing") for r in K.BILLING_RULES
            if r.kind in ("range", "exclusive")]
_shift = [replace(r, table="t_account_billing") for r in K.DOMAIN_RULES
          if r.name == "ck_billing_cycle_weekend_shift"]

register_violations("check_not_null", K.NOT_NULL_RULES)
register_violations("check_domain", K.DOMAIN_RULES + _shift)
register_violations("check_lowercase", K.LOWERCASE_RULES)
register_violations("check_not_empty", K.rules_of_kind("not_empty"))
register_violations("check_regex", K.rules_of_kind("regex"))
register_violations("check_length", [r for r in K.FORMAT_RULES
                                     if r.kind in ("min_length", "max_length", "max_bytes")])
register_violations("check_range", [r for r in _billing if r.kind == "range"])
register_violations("check_exclusive", [r for r in _billing if r.kind == "exclusive"])
register_violations("check_non_negative", K.rules_of_kind("non_negative"))
register_violations("check_sum_consistency", K.rules_of_kind("sum_consistency"))
register_violations("check_not_future_date", K.rules_of_kind("not_future"), as_of=AS_OF_DATE)
register_violations("check_numeric_fits", K.NUMERIC_RULES)
register_violations("check_unique", K.PK_RULES + K.UNIQUE_RULES)
register_violations("check_unique_legacy", K.rules_of_kind("unique", K.LEGACY_RULES))
register_violations("check_foreign_key", K.FK_RULES)
register_violations("check_foreign_key_legacy", K.rules_of_kind("foreign_key", K.LEGACY_RULES))

_ALL_FOR_SUMMARY = (K.ROW_RULES + K.PK_RULES + K.UNIQUE_RULES + K.FK_RULES + K.LEGACY_RULES
                    + K.ORPHAN_RULES + _billing + _shift)
_summary_rules, SUMMARY_SQL = register_summary("check_summary", _ALL_FOR_SUMMARY,
                                               as_of=AS_OF_DATE)

register("validation_verdict", f"""
select errors, warnings, passed,
 case when errors > 0 then 'FAILED' when warnings > 0 then 'PASSED WITH WARNINGS' else 'PASSED' end as verdict
from (select count(*) filter (where coalesce(violations, 1) > 0 and severity = 'error') as errors,
             count(*) filter (where coalesce(violations, 1) > 0 and severity = 'warning') as warnings,
             count(*) filter (where violations = 0) as passed
      from ({SUMMARY_SQL}) s) v
""")(lambda lg: C.verdict(C.summary(CompleteLedger.once(lg), _summary_rules, as_of=AS_OF_DATE)))

# -- the summary kept up to date --------------------------------------------------------
# A state made without some rows of three tables and with some of a fourth twice; the changes give
# it the rows it lacks and take the doubled ones away, which leaves the summary of the whole tables.
_STATE_TABLES = ("t_account", "t_transaction", "t_payment", "t_category", "t_description")
_state_rules = [r for r in K.ALL_RULES if r.table in _STATE_TABLES and r.ref_table in (None, *_STATE_TABLES)]
_LATE = {"t_account": "account_id % 100 = 3", "t_transaction": "transaction_id % 100 = 1", "t_payment": "payment_id % 100 = 2"}
_DOUBLED = "category_id % 3 = 0"


def _incremental(lg):
    full = CompleteLedger.of(lg)
    tables = {t: getattr(full, t) for t in _STATE_TABLES}
    early = {t: df.where(f"not coalesce({_LATE[t]}, false)") if t in _LATE else df for t, df in tables.items()}
    doubled = tables["t_category"].where(_DOUBLED)
    early["t_category"] = tables["t_category"].union(doubled)
    state = CheckState.create(lg.spark, staging_dir(lg.spark, "check-state"), early, _state_rules, as_of=AS_OF_DATE)
    state.update({t: tables[t].where(c) for t, c in _LATE.items() if t != "t_account"})
    state.update({"t_account": tables["t_account"].where(_LATE["t_account"])}, {"t_category": doubled})
    return state.summary()


register("check_summary_incremental", "\nunion all\n".join(_count_sql(r, AS_OF_DATE) for r in _state_rules))(_incremental)

# -- backup-validation checks -----------------------------------------------------
register("orphan_transaction_categories", """
select count(*) as orphaned_count from t_transaction_categories tc
left join t_transaction t on tc.transaction_id = t.transaction_id where t.transaction_id is null
""")(lambda lg: I.orphan_count(lg, "t_transaction_categories"))
register("orphan_receipt_images", """
select count(*) as orphaned_count from t_receipt_image r
left join t_transaction t on r.transaction_id = t.transaction_id where t.transaction_id is null
""")(lambda lg: I.orphan_count(lg, "t_receipt_image"))

_LOOSE = """
with loose as (
 select 1 as pos, 't_transaction_categories' as child, count(*) as n from t_transaction_categories c
 where not exists (select 1 from t_transaction t where t.transaction_id = c.transaction_id)
 union all
 select 2, 't_receipt_image', count(*) from t_receipt_image c
 where not exists (select 1 from t_transaction t where t.transaction_id = c.transaction_id))"""
# The descriptions of the integrity function's issues.
_IR = f"""{_LOOSE}
select child as table_name, 'orphaned_records' as issue_type, n as issue_count,
 case pos when 1 then 'Transaction categories without corresponding transactions'
          when 2 then 'Receipt images without corresponding transactions' end as description from loose where n > 0
"""
register("integrity_report", _IR)(lambda lg: I.integrity_report(lg))

_IV = f"""{_LOOSE}
select case pos when 1 then 'Orphaned Transaction Categories' else 'Orphaned Receipt Images' end as issue_type,
 n as issue_count, cast('{P["as_of"]}' as timestamp) as last_checked from loose
"""
register("integrity_view", _IV)(lambda lg: I.integrity_view(lg, as_of=P["as_of"]))
register("integrity_view_issues", _IV + " where n > 0")(
    lambda lg: I.integrity_view(lg, as_of=P["as_of"]).where(F.col("issue_count") > 0))

_RC = "\nunion all\n".join(
    f"select '{label}' as table_name, count(*) as row_count from {t}"
    for label, t in I.ROW_COUNT_TABLES) + "\norder by table_name"
register("row_count_summary", _RC)(lambda lg: I.row_count_summary(lg))
register("transaction_date_range", """
select min(transaction_date) as earliest_date, max(transaction_date) as latest_date, count(*) as total_transactions
from t_transaction
""")(lambda lg: I.transaction_date_range(lg))
register("validation_record_count", """
select count(*) as validation_count, count(*) > 0 as has_validation_data from t_validation_amount
""")(lambda lg: I.validation_record_count(lg))

_VB_ROWS = "\nunion all\n".join(
    # a table that can be read succeeds, an empty one too
    f"select 'row_counts' as step, '{t}' as check_name, 'success' as severity, cast(count(*) as varchar) as detail from {t}"
    for _, t in I.ROW_COUNT_TABLES)
_VB_SQL = _VB_ROWS + """
union all
select 'orphans', 'Orphaned Transaction Categories', case when count(*) = 0 then 'success' else 'warning' end,
 cast(count(*) as varchar)
from t_transaction_categories tc left join t_transaction t on tc.transaction_id = t.transaction_id
where t.transaction_id is null
union all
select 'orphans', 'Orphaned Receipt Images', case when count(*) = 0 then 'success' else 'warning' end,
 cast(count(*) as varchar)
from t_receipt_image ri left join t_transaction t on ri.transaction_id = t.transaction_id
where t.transaction_id is null
union all
select 'date_range', 'transaction_date', case when count(*) > 0 then 'success' else 'error' end,
 concat_ws(' ', cast(min(transaction_date) as varchar), cast(max(transaction_date) as varchar),
 cast(count(*) as varchar)) from t_transaction
union all
select 'validation_data', 't_validation_amount', case when count(*) > 0 then 'success' else 'info' end,
 cast(count(*) as varchar) from t_validation_amount
"""
register("validate_backup", _VB_SQL)(lambda lg: I.validate_backup(lg.once()))
register("validate_backup_verdict", f"""
select count(*) filter (where severity = 'success') as successes,
 count(*) filter (where severity = 'warning') as warnings,
 count(*) filter (where severity = 'error') as errors,
 case when count(*) filter (where severity = 'error') > 0 then 'FAILED'
      when count(*) filter (where severity = 'warning') > 0 then 'PASSED WITH WARNINGS' else 'PASSED' end as verdict
from ({_VB_SQL}) r""")(lambda lg: I.backup_verdict(I.validate_backup(lg.once())))
