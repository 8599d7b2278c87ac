"""Registered mutations (section 2.9) and schema evolution (2.10).

Each query returns the new version of the changed table (whole table) so the
oracle compares every row, not only the touched ones.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evolution as V
from ..operators import mutations as M
from ..sources import schemas as S
from ..sources.change_set import ChangedTable
from ..sources.fixtures import FIXTURE_COLUMNS
from ..sources.io import staging_dir
from . import reports as R
from .registry import PARAMS as P
from .registry import register

ACC = P["account"]
NEW = "renamed_account_owner"
AS_OF = "2024-01-15 00:00:00"

register("rename_account", f"""
select * replace (case when account_name_owner = '{ACC}' then '{NEW}' else account_name_owner end as account_name_owner)
from t_transaction""")(
    lambda lg: M.rename_account(lg.t_transaction, lg.t_account, ACC, NEW)["t_transaction"])
register("rename_account_owner_scoped", f"""
select * replace (case when account_name_owner = '{ACC}' and owner = 'owner_1' then '{NEW}'
 else account_name_owner end as account_name_owner) from t_account""")(
    lambda lg: M.rename_account(lg.t_transaction, lg.t_account, ACC, NEW,
                                owner="owner_1")["t_account"])
register("disable_account", f"""
select * replace (case when account_name_owner = '{ACC}' then false else active_status end as active_status)
from t_account""")(lambda lg: M.disable_account(lg.t_transaction, lg.t_account, ACC)["t_account"])
register("deactivate_orphaned_active", """
select * replace (case when active_status = true and account_name_owner in
 (select account_name_owner from t_account where active_status = false) then false else active_status end as active_status)
from t_transaction""")(lambda lg: M.deactivate_orphaned_active(lg.t_transaction, lg.t_account))
register("fix_account_type", f"""
select * replace (case when account_name_owner = '{ACC}' and account_type = 'debit' then 'credit'
 else account_type end as account_type) from t_transaction""")(
    lambda lg: M.fix_account_type(lg.t_transaction, lg.t_account, ACC)["t_transaction"])

# the other table of each of these
register("rename_account_accounts", f"""
select * replace (case when account_name_owner = '{ACC}' then '{NEW}' else account_name_owner end as account_name_owner)
from t_account""")(lambda lg: M.rename_account(lg.t_transaction, lg.t_account, ACC, NEW)["t_account"])
register("disable_account_transactions", f"""
select * replace (case when account_name_owner = '{ACC}' then false else active_status end as active_status)
from t_transaction""")(lambda lg: M.disable_account(lg.t_transaction, lg.t_account, ACC)["t_transaction"])
register("fix_account_type_accounts", f"""
select * replace (case when account_name_owner = '{ACC}' and account_type = 'debit' then 'credit'
 else account_type end as account_type) from t_account""")(
    lambda lg: M.fix_account_type(lg.t_transaction, lg.t_account, ACC)["t_account"])

register("refresh_account_fields", """
select t.* replace (coalesce(x.account_id, t.account_id) as account_id,
 case when x.account_name_owner is not null then x.account_type else t.account_type end as account_type)
from t_transaction t left join (select account_id, account_name_owner, account_type from t_account) x
 on t.account_name_owner = x.account_name_owner""")(
    lambda lg: M.refresh_account_fields(lg.t_transaction, lg.t_account))

register("store_grand_total", f"""
select a.*, cast(case when a.account_name_owner = '{ACC}' then g.totals end as decimal(38,2)) as totals
from t_account a, (select cast(d.debits - c.credits as decimal(38,2)) as totals from
 (select sum(amount) as debits from t_transaction where account_type = 'debit' and active_status = true) d,
 (select sum(amount) as credits from t_transaction where account_type = 'credit' and active_status = true) c) g
""")(lambda lg: M.store_grand_total(lg.t_account, R.grand_total(lg), ACC))

register("flip_credit_sign", """
select * replace (case when account_type = 'credit' then cast(amount * -1.0 as decimal(12,2)) else amount end as amount)
from t_transaction""")(lambda lg: M.flip_credit_sign(lg.t_transaction))

register("collapse_double_spaces", """
select * replace (case when description like '%  %' then replace(description, '  ', ' ') else description end as description,
 case when notes like '%  %' then replace(notes, '  ', ' ') else notes end as notes) from t_transaction
""")(lambda lg: M.collapse_double_spaces(lg.t_transaction, "description", "notes"))

register("strip_text_marker", """
select * replace (case when description like ' - *reoccur*' then replace(description, ' - *reoccur*', '')
 else description end as description) from t_transaction""")(
    lambda lg: M.strip_text_marker(lg.t_transaction, "description", " - *reoccur*",
                                   " - *reoccur*"))

register("normalize_lowercase", """
select * replace (case when description != lower(description) then lower(description) else description end as description)
from t_pending_transaction""")(
    lambda lg: M.normalize_lowercase(lg.t_pending_transaction, "description"))


def _padded_docs(lg):
    d = lg.source("documents").select("doc_id", "text")
    pad = F.when(F.col("doc_id") % 3 == 0, F.lit(" \t")).otherwise(F.lit(""))
    return d.select("doc_id", F.concat(F.replace(F.col("text"), F.lit("\n"),
                                                 F.concat(pad, F.lit("\n"))), pad)
                    .alias("text"))


_PADDED_SQL = """(select doc_id, replace(text, chr(10), case when doc_id % 3 = 0 then ' ' || chr(9) else '' end || chr(10))
 || case when doc_id % 3 = 0 then ' ' || chr(9) else '' end as text from documents)"""
_TRIM_SQL = "regexp_replace(text, '(?m)[ \\t\\x0B\\f\\r]+$', '', 'g')"
register("trim_trailing_whitespace", f"""
select doc_id, {_TRIM_SQL} as text from {_PADDED_SQL} d""")(
    lambda lg: M.trim_trailing_whitespace(_padded_docs(lg), "text"))
register("trim_trailing_whitespace_dry_run", f"""
select doc_id, text from {_PADDED_SQL} d where {_TRIM_SQL} != text""")(
    lambda lg: M.trim_trailing_whitespace(_padded_docs(lg), "text", dry_run=True))

register("delete_void_records", """
select * from t_transaction where not coalesce(amount = 0.00 and transaction_state = 'cleared'
 and description in ('void', 'none') and notes = '', false)""")(
    lambda lg: M.delete_void_records(lg.t_transaction))
register("delete_orphans", """
select * from t_transaction_categories where transaction_id in (select transaction_id from t_transaction)
""")(lambda lg: M.delete_orphans(lg.t_transaction_categories, lg.t_transaction))

_IMG_LEN = 1000
register("delete_images_and_unlink", f"""
select * replace (case when receipt_image_id in (select receipt_image_id from t_receipt_image
 where octet_length(image) = {_IMG_LEN}) then null else receipt_image_id end as receipt_image_id) from t_transaction""")(
    lambda lg: M.delete_images_and_unlink(lg.t_transaction, lg.t_receipt_image,
                                          _IMG_LEN)["t_transaction"])
register("delete_images_and_unlink_receipts", f"""
select receipt_image_id, transaction_id, image_format_type from t_receipt_image
where receipt_image_id not in (select receipt_image_id from t_receipt_image where octet_length(image) = {_IMG_LEN})
""")(lambda lg: M.delete_images_and_unlink(lg.t_transaction, lg.t_receipt_image, _IMG_LEN)[
    "t_receipt_image"].drop("image"))

_CLONE_GUID = P["receipt_guid"]


def _guid_sql(src: str, key: str) -> str:
    h = f"sha256(concat_ws('|', 'clone', {src}, cast({key} as varchar)))"
    return (f"concat_ws('-', substr({h},1,8), substr({h},9,4), substr({h},13,4), "
            f"substr({h},17,4), substr({h},21,12))")


def _clone_sql(date_expr: str, amount_expr: str, reocc: str) -> str:
    return f"""
select * from t_transaction union all
select t.* replace (k.new_id as transaction_id, {_guid_sql('t.guid', 'k.new_id')} as guid,
 {date_expr} as transaction_date, {amount_expr} as amount, {reocc} as reoccurring_type)
from t_transaction t, (select max(transaction_id) + 1 as new_id from t_transaction) k
where t.guid = '{_CLONE_GUID}'"""


register("clone_for_next_year", _clone_sql("cast(t.transaction_date + interval '365' day as date)",
                                           "t.amount", "'monthly'"))(
    lambda lg: M.clone_for_next_year(lg.t_transaction, _CLONE_GUID, AS_OF))
register("clone_zeroed", _clone_sql("date '1996-08-31'", "cast(0 as decimal(12,2))",
                                    "t.reoccurring_type"))(
    lambda lg: M.clone_zeroed(lg.t_transaction, _CLONE_GUID, "1996-08-31", AS_OF))

register("deactivate_rare_descriptions", f"""
select * replace (case when description_name in (select description from t_transaction
 where description in (select description_name from t_description where active_status = true)
 group by description having count(description) < {P["threshold"]}) then false else active_status end as active_status)
from t_description""")(
    lambda lg: M.deactivate_rare_descriptions(lg.t_description, lg.t_transaction, P["threshold"]))

register("backfill_destination", """
select * replace (case when (destination_account is null or trim(destination_account, ' ') = '')
 and account_name_owner is not null then account_name_owner else destination_account end as destination_account)
from t_payment""")(lambda lg: M.backfill_destination(lg.t_payment))
register("remap_name_if_match", """
select * replace (case when destination_account not in (select account_name_owner from t_account)
 and replace(destination_account, '-', '_') in (select account_name_owner from t_account)
 then replace(destination_account, '-', '_') else destination_account end as destination_account)
from t_payment""")(lambda lg: M.remap_name_if_match(lg.t_payment, lg.t_account,
                                                    "destination_account"))
register("migrate_payment_accounts", """
with b as (select * replace (case when (destination_account is null or trim(destination_account, ' ') = '')
   and account_name_owner is not null then account_name_owner else destination_account end as destination_account)
  from t_payment),
 l as (select * replace (lower(destination_account) as destination_account, lower(source_account) as source_account) from b),
 d as (select * replace (case when destination_account not in (select account_name_owner from t_account)
   and replace(destination_account, '-', '_') in (select account_name_owner from t_account)
   then replace(destination_account, '-', '_') else destination_account end as destination_account) from l),
 s as (select * replace (case when source_account not in (select account_name_owner from t_account)
   and replace(source_account, '-', '_') in (select account_name_owner from t_account)
   then replace(source_account, '-', '_') else source_account end as source_account) from d)
select * exclude (account_name_owner) from s""")(
    lambda lg: M.migrate_payment_accounts(lg.t_payment, lg.t_account))

register("backfill_owner", """
select *, 'owner_default' as owner from t_transfer""")(
    lambda lg: M.backfill_owner(lg.t_transfer, "owner_default"))
register("remap_owner", """
select * replace (case when owner = 'owner_0' then 'tenant_zero' else owner end as owner) from t_account""")(
    lambda lg: M.remap_owner(lg.t_account, "owner_0", "tenant_zero"))
register("force_owner", """
select * replace ('owner_0' as owner), coalesce(owner is null or owner = '' or owner != 'owner_0', false) as owner_changed
from t_family_member""")(lambda lg: M.force_owner(lg.t_family_member, "owner_0"))
register("sync_paid_amount", """
select *, case when transaction_id is not null then patient_responsibility else cast(0 as decimal(12,2)) end as paid_amount
from t_medical_expense""")(lambda lg: M.sync_paid_amount(lg.t_medical_expense))
register("seed_self_members", """
select m.top + row_number() over (order by account_name_owner) as family_member_id,
 account_name_owner as owner, account_name_owner as member_name, 'self' as relationship
from (select distinct account_name_owner from t_account where active_status = true
 and account_name_owner not in (select owner from t_family_member where relationship = 'self')) a,
 (select coalesce(max(family_member_id), 0) as top from t_family_member) m""")(
    lambda lg: M.seed_self_members(lg.t_family_member, lg.t_account))
register("stamp_update", f"""
select *, timestamp '{AS_OF}' as date_updated from t_category""")(
    lambda lg: M.stamp_update(lg.t_category, AS_OF))
register("stamp_insert", f"""
select *, timestamp '{AS_OF}' as date_added, timestamp '{AS_OF}' as date_updated from t_role""")(
    lambda lg: M.stamp_insert(lg.t_role, AS_OF))
register("inherit_owner", f"""
select l.category_id, l.transaction_id, (select t.owner from t_transaction t where t.transaction_id = l.transaction_id) as owner,
 timestamp '{AS_OF}' as date_updated, timestamp '{AS_OF}' as date_added from t_transaction_categories l""")(
    lambda lg: M.inherit_owner(lg.t_transaction_categories, lg.t_transaction, AS_OF))


def _defaults_sql(table: str, fixture: str) -> str:
    cols = []
    have = FIXTURE_COLUMNS[fixture]
    defaults = S.DEFAULTS.get(table, {})
    for f in S.SCHEMAS[table].fields:
        t = f.dataType.simpleString().replace("string", "varchar").replace(
            "timestamp_ntz", "timestamp")
        if f.name in have:
            cols.append(f"cast({f.name} as {t}) as {f.name}")
        elif f.name in defaults:
            v = defaults[f.name]
            lit = ("true" if v is True else "false" if v is False else f"'{v}'")
            cols.append(f"cast({lit} as {t}) as {f.name}")
        elif f.dataType in (S.TS, S.TSZ):
            cols.append(f"timestamp '1970-01-01 00:00:00' as {f.name}")
        else:
            cols.append(f"cast(null as {t}) as {f.name}")
    return f"select {', '.join(cols)} from {fixture}"


register("apply_defaults", _defaults_sql("t_transaction", "t_transaction"))(
    lambda lg: M.apply_defaults(lg.t_transaction, "t_transaction"))
register("apply_defaults_account", _defaults_sql("t_account", "t_account"))(
    lambda lg: M.apply_defaults(lg.t_account, "t_account"))

register("next_ids", """
select pending_transaction_id, m.top + row_number() over (order by pending_transaction_id) as new_id
from t_pending_transaction, (select coalesce(max(transaction_id), 0) as top from t_transaction) m""")(
    lambda lg: M.allocate_keys(lg.t_pending_transaction.select("pending_transaction_id"),
                               lg.t_transaction, "transaction_id", ["pending_transaction_id"]))

register("cascade_update", """
select t.* replace (coalesce(m.new_name, t.account_name_owner) as account_name_owner) from t_transaction t
left join (select account_name_owner as old_name, account_name_owner || '_moved' as new_name from t_account
 where owner = 'owner_0') m on t.account_name_owner = m.old_name""")(
    lambda lg: M.cascade_update(
        lg.t_transaction, ["account_name_owner"],
        lg.t_account.where(F.col("owner") == "owner_0").select(
            F.col("account_name_owner").alias("old_name"),
            F.concat("account_name_owner", F.lit("_moved")).alias("new_name")),
        ["old_name"], ["new_name"]))
register("cascade_delete", """
select * from t_medical_expense where transaction_id not in
 (select transaction_id from t_transaction where description = 'void')""")(
    lambda lg: M.cascade_delete(lg.t_medical_expense, "transaction_id",
                                lg.t_transaction.where(F.col("description") == "void"),
                                "transaction_id"))
register("restrict_delete", """
select category, count(*) as blocking_rows from t_transaction
where category in (select category_name from t_category where category_name in ('urgent', 'low'))
group by category""")(
    lambda lg: M.restrict_delete(lg.t_transaction, "category",
                                 lg.t_category.where(F.col("category_name").isin("urgent", "low")),
                                 "category_name"))
register("prune_expired_tokens", f"""
select * from t_token_blacklist where expires_at >= timestamp '{P["token_as_of"]}'""")(
    lambda lg: M.prune_expired_tokens(lg.t_token_blacklist, P["token_as_of"]))

# -- inserts with uniqueness ------------------------------------------------------------
_NEW_PARAMS_SQL = """(select owner, parameter_name, parameter_value from
 (select distinct owner from t_parameter) o, (values ('payment_account', 'bank_account'), ('timezone', 'America/Chicago'),
 ('param_algeria', '9')) v(parameter_name, parameter_value))"""


def _new_params(lg):
    owners = lg.t_parameter.select("owner").distinct()
    vals = lg.spark.createDataFrame(
        [("payment_account", "bank_account"), ("timezone", "America/Chicago"),
         ("param_algeria", "9")], "parameter_name string, parameter_value string")
    return owners.crossJoin(F.broadcast(vals))


register("insert_parameter", f"""
select * from t_parameter union all
select m.top + row_number() over (order by n.owner, n.parameter_name) as parameter_id, n.parameter_name,
 n.parameter_value, n.owner
from {_NEW_PARAMS_SQL} n, (select coalesce(max(parameter_id), 0) as top from t_parameter) m
where not exists (select 1 from t_parameter p where p.owner = n.owner and p.parameter_name = n.parameter_name)""")(
    lambda lg: M.insert_rows_unique(lg.t_parameter, _new_params(lg),
                                    ["owner", "parameter_name"], "parameter_id"))

# -- schema evolution ------------------------------------------------------------------------
register("add_column_default", """
select *, cast(0.00 as decimal(12,2)) as paid_amount from t_medical_expense""")(
    lambda lg: V.add_column_default(lg.t_medical_expense, "paid_amount", "0.00", S.MONEY))
register("add_billing_columns", """
select *, cast(null as smallint) as billing_statement_close_day, cast(null as smallint) as billing_grace_period_days,
 cast(null as smallint) as billing_due_day_same_month, cast(null as smallint) as billing_due_day_next_month,
 cast(null as varchar) as billing_cycle_weekend_shift from t_account""")(
    lambda lg: V.add_billing_columns(lg.t_account))
register("drop_column", "select * exclude (account_name_owner) from t_payment")(
    lambda lg: V.drop_column(lg.t_payment, "account_name_owner"))
register("rename_column", "select category_id as id, category_name, active_status from t_category")(
    lambda lg: V.rename_column(lg.t_category, "category_id", "id"))
register("set_not_null", "select * from t_transaction")(
    lambda lg: V.set_not_null(lg.t_transaction, "amount"))
register("drop_not_null", "select * from t_medical_expense")(
    lambda lg: V.drop_not_null(lg.t_medical_expense, "transaction_id"))
register("widen_decimal", """
select transaction_id, cast(try_cast(amount as decimal(8,2)) as decimal(12,2)) as amount from t_transaction""")(
    lambda lg: V.widen_decimal(
        lg.t_transaction.select("transaction_id",
                                F.col("amount").try_cast(S.MONEY_NARROW).alias("amount")),
        "amount", S.MONEY))
register("extend_domain", """
select 'ck_account_type' as rule, 't_account' as "table", cast(account_id as varchar) as key,
 'account_type=' || account_type as detail
from (select account_id, case when account_id % 10 = 0 then 'crypto_wallet' when account_id % 10 = 1 then 'hsa'
 else account_type end as account_type from t_account) a
where account_type not in ('credit', 'debit', 'undefined', 'hsa')""")(
    lambda lg: V.extend_domain_check(
        lg.t_account.withColumn("account_type", F.when(F.col("account_id") % 10 == 0, "crypto_wallet")
                                .when(F.col("account_id") % 10 == 1, "hsa")
                                .otherwise(F.col("account_type"))),
        "t_account", "ck_account_type", "account_type", S.ACCOUNT_TYPES_LEGACY, ("hsa",),
        ("account_id",)))
register("conform_variant", """
select transaction_id, account_type, case reoccurring_type when 'bi-annually' then 'biannually'
 when 'every_two_weeks' then 'fortnightly' else reoccurring_type end as reoccurring_type,
 active_status = '1' as active_status
from (select transaction_id, account_type,
 case transaction_id % 5 when 0 then 'bi-annually' when 1 then 'every_two_weeks' else reoccurring_type end as reoccurring_type,
 case when active_status then '1' else '0' end as active_status, '1' as reoccurring from t_transaction) v""")(
    lambda lg: V.conform_variant(
        lg.t_transaction.select(
            "transaction_id", "account_type",
            F.when(F.col("transaction_id") % 5 == 0, "bi-annually")
            .when(F.col("transaction_id") % 5 == 1, "every_two_weeks")
            .otherwise(F.col("reoccurring_type")).alias("reoccurring_type"),
            F.when(F.col("active_status"), "1").otherwise("0").alias("active_status"),
            F.lit("1").alias("reoccurring")),
        "oracle", "t_transaction"))



def _narrow(c):
    return F.col(c).cast(S.MONEY_NARROW).alias(c)


register("conform_variant_test_provider", """
select provider_id, provider_name, concat(cast(provider_id as varchar), ' main street') as address_line1, phone,
 concat(provider_name, '@example.org') as email from t_medical_provider""")(
    lambda lg: V.conform_variant(lg.t_medical_provider.select(
        F.concat("provider_name", F.lit("@example.org")).alias("provider_email"),
        F.col("phone").alias("provider_phone_number"),
        F.concat(F.col("provider_id").cast("string"), F.lit(" main street")).alias("provider_address"),
        "provider_name", F.col("provider_id").alias("medical_provider_id")), "test", "t_medical_provider"))

register("conform_variant_test_family", """
select family_member_id, concat(member_name, ' ', relationship) as member_name from t_family_member""")(
    lambda lg: V.conform_variant(lg.t_family_member.select(
        "family_member_id", F.col("member_name").alias("first_name"), F.col("relationship").alias("last_name")),
        "test", "t_family_member"))

register("conform_variant_test_expense", """
select provider_id, service_date, concat('visit ', cast(provider_id as varchar)) as service_description, billed_amount,
 patient_responsibility, concat('c', cast(transaction_id as varchar)) as claim_number from t_medical_expense""")(
    lambda lg: V.conform_variant(lg.t_medical_expense.select(
        F.col("provider_id").alias("medical_provider_id"), F.col("service_date").alias("expense_date"),
        _narrow("billed_amount").alias("amount"),
        F.concat(F.lit("visit "), F.col("provider_id").cast("string")).alias("description"),
        F.concat(F.lit("c"), F.col("transaction_id").cast("string")).alias("insurance_claim_id"),
        _narrow("patient_responsibility").alias("out_of_pocket_amount")), "test", "t_medical_expense"))

register("conform_variant_oracle_category", """
select category_id, category_name, active_status from t_category""")(
    lambda lg: V.conform_variant(lg.t_category.select(
        "category_id", F.col("category_name").alias("category"),
        F.when(F.col("active_status"), "1").otherwise("0").alias("active_status")), "oracle", "t_category"))

register("conform_variant_oracle_parameter", """
select parameter_id, parameter_name, parameter_value from t_parameter""")(
    lambda lg: V.conform_variant(lg.t_parameter.select(
        F.col("parameter_value").alias("parm_value"), F.col("parameter_name").alias("parm_name"),
        F.col("parameter_id").cast("decimal(38,0)").alias("parm_id")), "oracle", "t_parm"))

register("conform_variant_oracle_receipt", """
select receipt_image_id, transaction_id, image from t_receipt_image""")(
    lambda lg: V.conform_variant(lg.t_receipt_image.select(
        F.col("image").alias("jpg_image"), F.col("transaction_id").cast("decimal(38,0)").alias("transaction_id"),
        "receipt_image_id"), "oracle", "t_receipt_image"))


# -- the same by change sets ---------------------------------------------------------------
def _changed(lg, step):
    held = lg.__dict__.setdefault("_changed", {})
    if step not in held:
        new = lg.t_account.where("account_id % 3 = 0").select(
            "account_name_owner", (F.col("account_id") + 1000000).alias("new_id"), F.lit("cash").alias("new_type"))
        table = ChangedTable.create(lg.t_transaction, staging_dir(lg.spark, f"changes-{step}"), ["transaction_id"])
        table.update_from(new, ["account_name_owner"], {"account_id": "new_id", "account_type": "new_type"})
        table.delete("description = 'void'")
        if step == "compacted":
            table.compact()
        held[step] = table
    return held[step]


_CHANGED = """(select t.* replace (case when x.name is null then t.account_id else x.account_id end as account_id,
 case when x.name is null then t.account_type else 'cash' end as account_type) from t_transaction t
 left join (select account_name_owner as name, account_id + 1000000 as account_id from t_account where account_id % 3 = 0) x
 on t.account_name_owner = x.name)"""
for _step in ("merged", "compacted"):
    register(f"change_set_{_step}", f"select * from {_CHANGED} c where description is distinct from 'void'")(
        lambda lg, s=_step: _changed(lg, s).read().select(*lg.t_transaction.columns))
register("change_set_log", f"""
select c.transaction_id, 'update' as kind, 0 as change, 'account_id' as "column", cast(t.account_id as varchar) as old,
 cast(c.account_id as varchar) as new from {_CHANGED} c join t_transaction t using (transaction_id)
 where c.account_id is distinct from t.account_id
union all select c.transaction_id, 'update', 0, 'account_type', t.account_type, c.account_type
 from {_CHANGED} c join t_transaction t using (transaction_id) where c.account_type is distinct from t.account_type
union all select transaction_id, 'delete', 1, null, null, null from t_transaction where description = 'void'""")(
    lambda lg: _changed(lg, "merged").changes())
