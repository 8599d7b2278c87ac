"""Registered ledger reports (section 2.7) with their oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import reports as R
from .registry import PARAMS as P
from .registry import register

Y, S, E, AS_OF = P["year"], P["start"], P["end"], P["as_of"]


register("credits_by_account", """
select account_name_owner, cast(sum(amount) as decimal(38,2)) as credits from t_transaction
where account_type = 'credit' and active_status = true group by account_name_owner order by account_name_owner
""")(lambda lg: R.credits_by_account(lg))

register("debits_by_account", """
select account_name_owner, cast(sum(amount) as decimal(38,2)) as credits from t_transaction
where account_type = 'debit' and active_status = true group by account_name_owner order by account_name_owner
""")(lambda lg: R.debits_by_account(lg))

register("totals_by_account", """
select account_name_owner, cast(sum(amount) as decimal(38,2)) as totals from t_transaction
where active_status = true group by account_name_owner order by account_name_owner
""")(lambda lg: R.totals_by_account(lg))

_SIDES = """
(select cast(sum(amount) as decimal(38,2)) as debits from t_transaction where account_type = 'debit' and active_status = true) a,
(select cast(sum(amount) as decimal(38,2)) as credits from t_transaction where account_type = 'credit' and active_status = true) b"""

register("debits_and_credits", f"select a.debits, b.credits from {_SIDES}")(
    lambda lg: R.debits_and_credits(lg))
register("grand_total", f"select cast(a.debits - b.credits as decimal(38,2)) as totals from {_SIDES}")(
    lambda lg: R.grand_total(lg))

register("count_account_type", f"""
select count(*) as cnt from t_transaction where account_name_owner = '{P["account"]}' and account_type = 'debit'
""")(lambda lg: R.count_account_type(lg, P["account"], "debit"))

register("count_void", """
select count(*) as void_record_count from t_transaction
where amount = 0.00 and transaction_state = 'cleared' and description = 'void' and notes = ''
""")(lambda lg: R.count_void(lg))
register("count_none", """
select count(*) as none_record_count from t_transaction
where amount = 0.00 and transaction_state = 'cleared' and description = 'none' and notes = ''
""")(lambda lg: R.count_none(lg))

register("double_space_descriptions",
         "select description from t_transaction where description like '%  %'")(
    lambda lg: R.double_space_descriptions(lg))
register("double_space_notes", "select notes from t_transaction where notes like '%  %'")(
    lambda lg: R.double_space_notes(lg))

register("cleared_count_by_week", """
select cast(date_trunc('week', transaction_date) as date) as weekly, count(*) as cnt from t_transaction
where transaction_state = 'cleared' group by 1 order by 1 desc
""")(lambda lg: R.cleared_count_by_week(lg))

_SPEND_WHERE = """transaction_state = 'cleared' and account_type = 'credit' and description != 'payment'
 and account_name_owner != 'medical'"""
register("spend_by_week", f"""
select cast(date_trunc('week', transaction_date) as date) as weekly, cast(sum(amount) as decimal(38,2)) as total
from t_transaction where {_SPEND_WHERE} group by 1 order by 1 desc
""")(lambda lg: R.spend_by_week(lg))
register("spend_by_month", f"""
select cast(date_trunc('month', transaction_date) as date) as monthly, cast(sum(amount) as decimal(38,2)) as total
from t_transaction where {_SPEND_WHERE} group by 1 order by 1 desc
""")(lambda lg: R.spend_by_month(lg))

register("credits_by_month", """
select cast(date_trunc('month', transaction_date) as date) as dt, cast(sum(amount) as decimal(38,2)) as total
from t_transaction where account_type = 'credit' group by 1 order by 1
""")(lambda lg: R.credits_by_month(lg))

FLAGSHIP_SQL = f"""
with monthly as (
 select cast(date_trunc('month', transaction_date) as date) as month,
  cast(sum(abs(amount)) filter (where transaction_type = 'income') as decimal(38,2)) as income,
  cast(sum(abs(amount)) filter (where transaction_type = 'expense') as decimal(38,2)) as expense
 from t_transaction where transaction_date > date '{P["since"]}' group by all
 having count(*) filter (where transaction_type = 'income') > 0
    and count(*) filter (where transaction_type = 'expense') > 0)
select month, income, expense, cast(income - expense as decimal(38,2)) as net from monthly order by month
"""
register("income_expense_net_by_month", FLAGSHIP_SQL)(
    lambda lg: R.income_expense_net_by_month(lg, since=P["since"]))

_SYM = (f"transaction_date between least(date '{P['range_a']}', date '{P['range_b']}') "
        f"and greatest(date '{P['range_a']}', date '{P['range_b']}')")
register("count_in_range", f"select count(*) as cnt from t_transaction where {_SYM}")(
    lambda lg: R.count_in_range(lg, P["range_a"], P["range_b"]))
register("expense_in_range", f"""
select cast(sum(amount) as decimal(38,2)) as total from t_transaction where {_SYM} and transaction_type = 'expense'
""")(lambda lg: R.expense_in_range(lg, P["range_a"], P["range_b"]))

register("stale_future_credits", f"""
select * from t_transaction where transaction_state = 'future' and transaction_date < timestamp '{AS_OF}'
 and account_type = 'credit'""")(lambda lg: R.stale_future_credits(lg, as_of=AS_OF))
register("stale_outstanding_credits", f"""
select * from t_transaction where transaction_state = 'outstanding' and transaction_date < timestamp '{AS_OF}'
 and account_type = 'credit'""")(lambda lg: R.stale_outstanding_credits(lg, as_of=AS_OF))
register("cleared_in_future", f"""
select * from t_transaction where transaction_state = 'cleared' and transaction_date > timestamp '{AS_OF}'
""")(lambda lg: R.cleared_in_future(lg, as_of=AS_OF))
register("uncleared_in_past", f"""
select * from t_transaction where transaction_state in ('future', 'outstanding') and transaction_date < timestamp '{AS_OF}'
""")(lambda lg: R.uncleared_in_past(lg, as_of=AS_OF))

_CREDIT_ACTIVE = ("account_name_owner in (select account_name_owner from t_account "
                  "where account_type = 'credit' and active_status = true)")
register("accounts_needing_payment", f"""
select account_name_owner, cast(sum(amount) as decimal(38,2)) as totals from t_transaction
where transaction_state = 'cleared' and {_CREDIT_ACTIVE} group by account_name_owner having sum(amount) > 0
""")(lambda lg: R.accounts_needing_payment(lg))
register("accounts_needing_payment_names", f"""
select account_name_owner from t_transaction
where transaction_state = 'cleared' and {_CREDIT_ACTIVE} group by account_name_owner having sum(amount) > 0
""")(lambda lg: R.accounts_needing_payment_names(lg))
_OR_BRANCH = ("(transaction_state = 'outstanding' and account_type = 'credit' "
              "and description = 'payment')")
register("accounts_needing_payment_detail", f"""
select account_name_owner, cast(sum(amount) as decimal(38,2)) as totals from t_transaction
where transaction_state = 'cleared' and {_CREDIT_ACTIVE} or {_OR_BRANCH}
group by account_name_owner having sum(amount) > 0 order by account_name_owner
""")(lambda lg: R.accounts_needing_payment_detail(lg))
register("accounts_needing_payment_detail_names", f"""
select account_name_owner from t_transaction
where transaction_state = 'cleared' and {_CREDIT_ACTIVE} or {_OR_BRANCH}
group by account_name_owner having sum(amount) > 0 order by account_name_owner
""")(lambda lg: R.accounts_needing_payment_detail_names(lg))
register("outstanding_payments", """
select account_name_owner, amount as totals from t_transaction
where transaction_state = 'outstanding' and account_type = 'credit' and description = 'payment'
""")(lambda lg: R.outstanding_payments(lg))

_PROJ = ("cast(transaction_date + interval '1 year' as date) as next_date, description, "
         "abs(amount) as amount")
register("project_next_year_like", f"""
select '{P["projected_account"]}' as account, {_PROJ} from t_transaction
where description like '%centerpoint%' and extract(year from transaction_date) = {Y}
""")(lambda lg: R.project_next_year_like(lg, "%centerpoint%", Y, P["projected_account"]))
register("project_next_year_exact", f"""
select '{P["projected_account"]}' as account, {_PROJ} from t_transaction
where description like 't-mobile.com' and extract(year from transaction_date) = {Y}
""")(lambda lg: R.project_next_year_exact(lg, "t-mobile.com", Y, P["projected_account"]))
register("project_next_year_recurring", f"""
select description as account, {_PROJ} from t_transaction
where reoccurring_type != 'undefined' and extract(year from transaction_date) = {Y}
""")(lambda lg: R.project_next_year_recurring(lg, Y))
register("recurring_count_by_description", f"""
select description, count(description) as cnt from t_transaction
where reoccurring_type != 'undefined' and extract(year from transaction_date) = {Y} group by description
""")(lambda lg: R.recurring_count_by_description(lg, Y))
register("recurring_by_account_desc_category", f"""
select account_name_owner, description, category, count(description) as cnt from t_transaction
where transaction_date > date '{S}' and transaction_date < date '{E}' and reoccurring_type != 'undefined'
group by account_name_owner, description, category order by description
""")(lambda lg: R.recurring_by_account_desc_category(lg, S, E))
register("bill_pay_for_month", f"""
select * from t_transaction where category = 'bill_pay' and transaction_date > date '{S}'
 and transaction_date < date '{E}' and account_name_owner = '{P["bill_account"]}'
""")(lambda lg: R.bill_pay_for_month(lg, P["bill_account"], S, E))
register("rare_descriptions", f"""
select description, count(description) as cnt from t_transaction
where description in (select description_name from t_description where active_status = true)
group by description having count(description) < {P["threshold"]} order by cnt desc
""")(lambda lg: R.rare_descriptions(lg, P["threshold"]))
register("account_ledger", f"""
select * from t_transaction where account_name_owner = '{P["bill_account"]}' and active_status = true
order by transaction_date desc
""")(lambda lg: R.account_ledger(lg, P["bill_account"]))
register("active_flag_mismatch", """
select * from t_transaction where t_transaction.active_status = true and t_transaction.account_name_owner in
 (select account_name_owner from t_account where active_status = false)
""")(lambda lg: R.active_flag_mismatch(lg))
register("dangling_payments_source", """
select * from t_payment where guid_source not in (select guid from t_transaction)
""")(lambda lg: R.dangling_payments_source(lg))
register("dangling_payments_destination", """
select * from t_payment where guid_destination not in (select guid from t_transaction)
""")(lambda lg: R.dangling_payments_destination(lg))
register("unreferenced_receipts_not_in", """
select receipt_image_id from t_receipt_image where receipt_image_id not in (select receipt_image_id from t_transaction)
""")(lambda lg: R.unreferenced_receipts_not_in(lg))
register("unreferenced_receipts", """
select r.receipt_image_id from t_receipt_image r
where not exists (select 1 from t_transaction t where t.receipt_image_id = r.receipt_image_id)
""")(lambda lg: R.unreferenced_receipts(lg))

_SNIFF = """case when lower(hex(image)) like lower(hex(encode('data:image/jpeg;base64,'))) || '%' then 'jpeg'
 when lower(hex(image)) like lower(hex(encode('data:image/png;base64,'))) || '%' then 'png' else 'undefined' end"""
register("receipt_prefix_sniff", f"""
select receipt_image_id, left(lower(hex(image)), 44) as hex_prefix, {_SNIFF} as sniffed_format from t_receipt_image
""")(lambda lg: R.receipt_prefix_sniff(lg))
register("receipt_size_mb", """
select receipt_image_id, octet_length(image) / 1048576.0 as size_mb, left(lower(hex(image)), 100) as hex_preview
from t_receipt_image
""")(lambda lg: R.receipt_size_mb(lg))
register("receipt_by_guid", f"""
select t.guid, t.receipt_image_id, octet_length(r.image) as image_bytes, lower(hex(r.image)) as image_hex
from t_transaction t join t_receipt_image r on t.receipt_image_id = r.receipt_image_id
where t.guid = '{P["receipt_guid"]}'
""")(lambda lg: R.receipt_by_guid(lg, P["receipt_guid"]))
register("receipts_of_length", """
select receipt_image_id, transaction_id, octet_length(image) as image_bytes from t_receipt_image
where octet_length(image) = 1000
""")(lambda lg: R.receipts_of_length(lg, 1000))
register("accounts_without_self_member", """
select distinct account_name_owner from t_account where active_status = true
and account_name_owner not in (select owner from t_family_member where relationship = 'self')
""")(lambda lg: R.accounts_without_self_member(lg))


def _double_space_rows(lg):
    d = R.double_space_descriptions(lg).select(F.lit("description").alias("column_name"),
                                               F.col("description").alias("value"))
    n = R.double_space_notes(lg).select(F.lit("notes").alias("column_name"),
                                        F.col("notes").alias("value"))
    return d.unionByName(n)


register("double_space_rows", """
select 'description' as column_name, description as value from t_transaction where description like '%  %'
union all
select 'notes', notes from t_transaction where notes like '%  %'""")(_double_space_rows)
