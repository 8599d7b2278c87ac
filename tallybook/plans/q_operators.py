"""Registered generic operators (sections 2.2-2.6) with their oracle SQL.

Each query applies one operator to the derived ledger tables with the
predicate / expression shape of the statement it comes from.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import expr as X
from ..operators import joins as J
from ..operators import relational as O
from .registry import PARAMS as P
from .registry import register

S_, E_ = P["start"], P["end"]

# -- 2.2 filters / projections ----------------------------------------------------------
register("filter_eq_and", """
select * from t_transaction where amount = 0.00 and transaction_state = 'cleared' and active_status = true""")(
    lambda lg: O.filter_eq_and(lg.t_transaction.where(F.col("amount") == F.lit(0).cast("decimal(12,2)")),
                               transaction_state="cleared", active_status=True))
register("filter_ne", "select * from t_transaction where reoccurring_type != 'undefined'")(
    lambda lg: O.filter_ne(lg.t_transaction, "reoccurring_type", "undefined"))
register("filter_or_precedence", """
select * from t_transaction where transaction_state = 'cleared' and account_type = 'credit'
 or transaction_state = 'outstanding' and description = 'payment'""")(
    lambda lg: O.filter_or(
        lg.t_transaction,
        (F.col("transaction_state") == "cleared") & (F.col("account_type") == "credit"),
        (F.col("transaction_state") == "outstanding") & (F.col("description") == "payment")))
register("filter_in_list", """
select * from t_validation_amount where transaction_state in ('outstanding', 'future', 'cleared', 'undefined')""")(
    lambda lg: O.filter_in_list(lg.t_validation_amount, "transaction_state",
                                ("outstanding", "future", "cleared", "undefined")))
register("filter_like", "select * from t_transaction where description like '%centerpoint%'")(
    lambda lg: O.filter_like(lg.t_transaction, "description", "%centerpoint%"))
register("filter_like_exact", "select * from t_transaction where description like 't-mobile.com'")(
    lambda lg: O.filter_like(lg.t_transaction, "description", "t-mobile.com"))
register("filter_regex", r"""
select * from t_medical_provider where regexp_matches(npi, '\A[0-9]{10}\z')""")(
    lambda lg: O.filter_regex(lg.t_medical_provider, "npi", r"\A[0-9]{10}\z"))
register("filter_date_range", f"""
select * from t_transaction where transaction_date > date '{S_}' and transaction_date < date '{E_}'""")(
    lambda lg: O.filter_date_range(lg.t_transaction, "transaction_date", S_, E_))
register("filter_between", """
select * from t_account_billing where billing_statement_close_day between 1 and 31""")(
    lambda lg: O.filter_between(lg.t_account_billing, "billing_statement_close_day", 1, 31))
register("filter_between_symmetric", """
select * from t_transaction where transaction_date between least(date '1996-08-31', date '1996-08-01')
 and greatest(date '1996-08-31', date '1996-08-01')""")(
    lambda lg: O.filter_between_symmetric(lg.t_transaction, "transaction_date", "1996-08-31",
                                          "1996-08-01"))
register("filter_null_or_blank", """
select * from t_payment where destination_account is null or trim(destination_account, ' ') = ''""")(
    lambda lg: O.filter_null_or_blank(lg.t_payment, "destination_account"))
register("filter_null_blank_or_other", """
select * from t_family_member where owner is null or owner = '' or owner != 'owner_0'""")(
    lambda lg: lg.t_family_member.where(
        F.col("owner").isNull() | (F.col("owner") == "") | (F.col("owner") != "owner_0")))
register("project_const", f"""
select 'centerpoint_owner' as account, cast(transaction_date + interval '1 year' as date) as next_date,
 description, abs(amount) as amount from t_transaction where description like '%centerpoint%'""")(
    lambda lg: O.project_const(
        lg.t_transaction.where(F.col("description").like("%centerpoint%")), "centerpoint_owner",
        "account", X.plus_years("transaction_date").alias("next_date"), "description",
        F.abs("amount").alias("amount")))
register("select_all_where", f"""
select * from t_transaction where transaction_state = 'future' and transaction_date < timestamp '{P["as_of"]}'""")(
    lambda lg: lg.t_transaction.where((F.col("transaction_state") == "future")
                                      & (F.col("transaction_date") < X.lit_ts(P["as_of"]))))
register("distinct_rows", "select distinct owner from t_account")(
    lambda lg: O.distinct_rows(lg.t_account, "owner"))
register("exists_probe", "select 1 as probe from t_transaction limit 1")(
    lambda lg: O.exists_probe(lg.t_transaction))

# -- 2.3 joins ------------------------------------------------------------------------------
register("inner_equi_join", """
select a.account_name_owner, a.cleared, t.totals from t_account a
join (select account_name_owner, cast(sum(amount) as decimal(38,2)) as totals from t_transaction
      group by account_name_owner) t on a.account_name_owner = t.account_name_owner""")(
    lambda lg: lg.t_account.select("account_name_owner", "cleared").join(
        lg.t_transaction.groupBy("account_name_owner").agg(X.money_sum("amount").alias("totals")),
        "account_name_owner"))
register("cross_join_scalars", """
select a.n_accounts, b.n_transactions from (select count(*) as n_accounts from t_account) a,
 (select count(*) as n_transactions from t_transaction) b""")(
    lambda lg: J.cross_join_scalars(lg.t_account.agg(F.count(F.lit(1)).alias("n_accounts")),
                                    lg.t_transaction.agg(F.count(F.lit(1)).alias("n_transactions"))))
register("left_join_orphans", """
select tc.* from t_transaction_categories tc left join t_transaction t on tc.transaction_id = t.transaction_id
where t.transaction_id is null""")(
    lambda lg: J.left_join_orphans(lg.t_transaction_categories, lg.t_transaction,
                                   "transaction_id", "transaction_id"))
register("semi_join_in", """
select * from t_transaction where account_name_owner in (select account_name_owner from t_account where active_status = false)""")(
    lambda lg: J.semi_join(lg.t_transaction, lg.t_account.where(~F.col("active_status"))
                           .select("account_name_owner"), "account_name_owner"))
register("semi_join_exists", """
select * from t_payment p where exists (select 1 from t_account a where a.account_name_owner = replace(p.destination_account, '-', '_'))""")(
    lambda lg: lg.t_payment.join(lg.t_account.select(F.col("account_name_owner").alias("_an")),
                                 F.replace(F.col("destination_account"), F.lit("-"), F.lit("_"))
                                 == F.col("_an"), "left_semi"))
register("anti_join_not_exists", """
select * from t_payment p where not exists (select 1 from t_account a where a.account_name_owner = p.destination_account)""")(
    lambda lg: J.anti_join(lg.t_payment, lg.t_account.select(
        F.col("account_name_owner").alias("destination_account")), "destination_account"))
register("anti_join_not_in", """
select * from t_transfer where guid_destination not in (select guid from t_transaction)""")(
    lambda lg: J.not_in(lg.t_transfer, "guid_destination", lg.t_transaction, "guid"))
register("anti_join_not_in_nullable", """
select * exclude (image) from t_receipt_image where receipt_image_id not in (select receipt_image_id from t_transaction)""")(
    lambda lg: J.not_in(lg.t_receipt_image, "receipt_image_id", lg.t_transaction,
                        "receipt_image_id").drop("image"))
register("update_from_join", """
select t.* replace (coalesce(x.account_id, t.account_id) as account_id,
 case when x.account_name_owner is not null then x.account_type else t.account_type end as account_type)
from t_transaction t left join t_account x on t.account_name_owner = x.account_name_owner""")(
    lambda lg: J.update_from_join(lg.t_transaction, lg.t_account, ["account_name_owner"],
                                  {"account_id": "account_id", "account_type": "account_type"}))
register("scalar_subquery_lookup", """
select l.*, (select t.owner from t_transaction t where t.transaction_id = l.transaction_id) as owner
from t_transaction_categories l""")(
    lambda lg: J.scalar_lookup(lg.t_transaction_categories, "transaction_id", lg.t_transaction,
                               "transaction_id", "owner", "owner"))

# -- 2.4 aggregation ----------------------------------------------------------------------
register("agg_sum_group", """
select account_name_owner, cast(sum(amount) as decimal(38,2)) as totals from t_transaction group by account_name_owner""")(
    lambda lg: O.agg_group(lg.t_transaction, ["account_name_owner"],
                           [X.money_sum("amount").alias("totals")]))
register("agg_sum_global", "select cast(sum(amount) as decimal(38,2)) as total from t_transaction")(
    lambda lg: O.agg_global(lg.t_transaction, [X.money_sum("amount").alias("total")]))
register("agg_count_star", "select count(*) as cnt from t_transaction")(
    lambda lg: O.agg_global(lg.t_transaction, [F.count(F.lit(1)).alias("cnt")]))
register("agg_count_col", """
select count(reoccurring_type) as n_typed, count(receipt_image_id) as n_with_receipt from t_transaction""")(
    lambda lg: O.agg_global(lg.t_transaction, [F.count("reoccurring_type").alias("n_typed"),
                                               F.count("receipt_image_id").alias("n_with_receipt")]))
register("agg_min_max_count", """
select min(transaction_date) as earliest_date, max(transaction_date) as latest_date, count(*) as total_transactions
from t_transaction""")(
    lambda lg: O.agg_global(lg.t_transaction, [F.min("transaction_date").alias("earliest_date"),
                                               F.max("transaction_date").alias("latest_date"),
                                               F.count(F.lit(1)).alias("total_transactions")]))
register("agg_max_plus_one", """
select coalesce(max(transaction_id), 0) + 1 as next_id from t_transaction""")(
    lambda lg: O.max_plus_one(lg.t_transaction, "transaction_id"))

_SEQ_TABLES = (("t_receipt_image", "receipt_image_id"), ("t_transaction", "transaction_id"),
               ("t_payment", "payment_id"), ("t_account", "account_id"),
               ("t_category", "category_id"), ("t_description", "description_id"),
               ("t_parameter", "parameter_id"), ("t_validation_amount", "validation_id"),
               ("t_transfer", "transfer_id"), ("t_pending_transaction", "pending_transaction_id"),
               ("t_medical_provider", "provider_id"), ("t_family_member", "family_member_id"),
               ("t_token_blacklist", "token_blacklist_id"))


def _seq_reset(lg):
    parts = [O.max_or_one(lg.table(t), c).select(F.lit(t).alias("table_name"), "seq_value")
             for t, c in _SEQ_TABLES]
    return O.union_all(parts)


register("agg_max_coalesce", "\nunion all\n".join(
    f"select '{t}' as table_name, coalesce(max({c}), 1) as seq_value from {t}"
    for t, c in _SEQ_TABLES))(_seq_reset)
register("agg_sum_abs", """
select cast(sum(abs(amount)) as decimal(38,2)) as total from t_transaction where transaction_type = 'income'""")(
    lambda lg: O.agg_global(lg.t_transaction.where(F.col("transaction_type") == "income"),
                            [F.sum(F.abs("amount")).cast("decimal(38,2)").alias("total")]))
register("group_by_expr", """
select cast(date_trunc('month', transaction_date) as date) as dt, count(*) as cnt from t_transaction group by 1""")(
    lambda lg: O.agg_group(lg.t_transaction, [X.month_start("transaction_date").alias("dt")],
                           [F.count(F.lit(1)).alias("cnt")]))
register("group_by_multi", """
select account_name_owner, description, category, count(description) as cnt from t_transaction
group by account_name_owner, description, category""")(
    lambda lg: O.agg_group(lg.t_transaction, ["account_name_owner", "description", "category"],
                           [F.count("description").alias("cnt")]))
register("having_filter", """
select account_name_owner, cast(sum(amount) as decimal(38,2)) as totals from t_transaction
group by account_name_owner having sum(amount) > 0""")(
    lambda lg: O.agg_group(lg.t_transaction, ["account_name_owner"],
                           [X.money_sum("amount").alias("totals")], having=F.col("totals") > 0))
register("having_global", """
select count(*) as orphaned from t_transaction_categories tc left join t_transaction t
 on tc.transaction_id = t.transaction_id where t.transaction_id is null having count(*) > 0""")(
    lambda lg: O.agg_global(J.left_join_orphans(lg.t_transaction_categories, lg.t_transaction,
                                                "transaction_id", "transaction_id"),
                            [F.count(F.lit(1)).alias("orphaned")], having=F.col("orphaned") > 0))
register("having_global_empty", """
select count(*) as void_clones from t_transaction where description = 'no such description' having count(*) > 0""")(
    lambda lg: O.agg_global(lg.t_transaction.where(F.col("description") == "no such description"),
                            [F.count(F.lit(1)).alias("void_clones")],
                            having=F.col("void_clones") > 0))

# -- 2.5 sort / union -------------------------------------------------------------------------
register("sort_desc", """
select account_name_owner, transaction_date, amount from t_transaction order by transaction_date desc""")(
    lambda lg: O.sort_by(lg.t_transaction.select("account_name_owner", "transaction_date",
                                                 "amount"), ["transaction_date"], False))
register("union_all", """
select 'payment' as label, transaction_date, amount from t_payment
union all select 'transfer', transaction_date, amount from t_transfer""")(
    lambda lg: O.union_all([lg.t_payment.select("transaction_date", "amount"),
                            lg.t_transfer.select("transaction_date", "amount")],
                           ["payment", "transfer"]))

# -- 2.6 scalar functions -----------------------------------------------------------------------
register("scalar_text_functions", """
select transaction_id, lower(description) as lowered, replace(notes, '  ', ' ') as collapsed,
 trim(notes, ' ') as trimmed, length(description) as desc_len, left(guid, 6) as guid_prefix,
 description || '/' || category as joined
from t_transaction""")(
    lambda lg: lg.t_transaction.select(
        "transaction_id", F.lower("description").alias("lowered"),
        X.replace_once("notes", "  ", " ").alias("collapsed"),
        F.btrim(F.col("notes"), F.lit(" ")).alias("trimmed"),
        F.length("description").cast("long").alias("desc_len"),
        F.left(F.col("guid"), F.lit(6)).alias("guid_prefix"),
        F.concat(F.col("description"), F.lit("/"), F.col("category")).alias("joined")))
register("scalar_binary_functions", """
select receipt_image_id, octet_length(image) as n_bytes, left(lower(hex(image)), 44) as hex44
from t_receipt_image""")(
    lambda lg: lg.t_receipt_image.select(
        "receipt_image_id", X.byte_length("image").alias("n_bytes"),
        F.left(X.hex_lower("image"), F.lit(44)).alias("hex44")))
register("scalar_arithmetic", """
select transaction_id, abs(amount) as magnitude, cast(amount * -1.0 as decimal(12,2)) as flipped,
 amount + amount as doubled from t_transaction""")(
    lambda lg: lg.t_transaction.select(
        "transaction_id", F.abs("amount").alias("magnitude"),
        (F.col("amount") * F.lit(-1.0).cast("decimal(2,1)")).cast("decimal(12,2)").alias("flipped"),
        (F.col("amount") + F.col("amount")).alias("doubled")))
register("scalar_date_functions", """
select transaction_id, cast(date_trunc('week', transaction_date) as date) as week_start,
 cast(date_trunc('month', transaction_date) as date) as month_start,
 extract(year from transaction_date) as yr,
 cast(transaction_date + interval '1 year' as date) as plus_year,
 cast(transaction_date + interval '365' day as date) as plus_365
from t_transaction""")(
    lambda lg: lg.t_transaction.select(
        "transaction_id", X.week_start("transaction_date").alias("week_start"),
        X.month_start("transaction_date").alias("month_start"),
        X.year_of("transaction_date").alias("yr"),
        X.plus_years("transaction_date").alias("plus_year"),
        X.plus_days("transaction_date", 365).alias("plus_365")))
register("scalar_epoch_functions", """
select validation_id, epoch(validation_date) as epoch_s,
 epoch(date_trunc('month', validation_date)) as month_epoch_s,
 make_timestamp(cast(floor(epoch(validation_date)) as bigint) * 1000000) as from_epoch
from t_validation_amount""")(
    lambda lg: lg.t_validation_amount.select(
        "validation_id", X.epoch_seconds("validation_date").alias("epoch_s"),
        X.month_epoch("validation_date").cast("double").alias("month_epoch_s"),
        X.from_epoch(F.floor(X.epoch_seconds("validation_date"))).alias("from_epoch")))
register("scalar_conditional", """
select account_id, coalesce(billing_grace_period_days, billing_due_day_same_month, billing_due_day_next_month) as due_rule,
 case when billing_grace_period_days is not null then 1 else 0 end + case when billing_due_day_same_month is not null then 1 else 0 end
 + case when billing_due_day_next_month is not null then 1 else 0 end as n_methods
from t_account_billing""")(
    lambda lg: lg.t_account_billing.select(
        "account_id", F.coalesce("billing_grace_period_days", "billing_due_day_same_month",
                                 "billing_due_day_next_month").alias("due_rule"),
        X.flag_count(F.col("billing_grace_period_days").isNotNull(),
                     F.col("billing_due_day_same_month").isNotNull(),
                     F.col("billing_due_day_next_month").isNotNull()).alias("n_methods")))
register("scalar_casts", """
select transaction_id, cast(transaction_id as varchar) as id_text, cast(transaction_date as timestamp) as ts,
 cast(cast(transaction_id as varchar) as bigint) as id_back, encode(guid) as guid_bytes from t_transaction""")(
    lambda lg: lg.t_transaction.select(
        "transaction_id", F.col("transaction_id").cast("string").alias("id_text"),
        F.col("transaction_date").cast("timestamp_ntz").alias("ts"),
        F.col("transaction_id").cast("string").cast("long").alias("id_back"),
        F.col("guid").cast("binary").alias("guid_bytes")))
register("scalar_hash_and_guid", """
select token_blacklist_id, sha256(cast(token_blacklist_id as varchar)) as digest,
 length(token_hash) as hash_len from t_token_blacklist""")(
    lambda lg: lg.t_token_blacklist.select(
        "token_blacklist_id", X.sha256_hex("token_blacklist_id").alias("digest"),
        F.length("token_hash").cast("long").alias("hash_len")))
register("scalar_time_zone", """
select validation_id, cast(timezone('America/Chicago', cast(validation_date as timestamptz)) as timestamp) as local_time
from t_validation_amount""")(
    lambda lg: lg.t_validation_amount.select(
        "validation_id", X.to_local_time("validation_date", "America/Chicago")
        .alias("local_time")))

register("group_by_alias", """
select cast(date_trunc('week', transaction_date) as date) as weekly, count(*) as cnt from t_transaction
where transaction_state = 'cleared' group by weekly""")(
    lambda lg: O.agg_group(lg.t_transaction.where(F.col("transaction_state") == "cleared"),
                           [X.week_start("transaction_date").alias("weekly")],
                           [F.count(F.lit(1)).alias("cnt")]))
register("sort_asc", """
select account_name_owner, cast(sum(amount) as decimal(38,2)) as totals from t_transaction
group by account_name_owner order by account_name_owner""")(
    lambda lg: O.sort_by(O.agg_group(lg.t_transaction, ["account_name_owner"],
                                     [X.money_sum("amount").alias("totals")]),
                         ["account_name_owner"]))


def _uuid_sql(col: str) -> str:
    h = f"sha256(concat_ws('|', 'txn', cast({col} as varchar)))"
    return (f"concat_ws('-', substr({h},1,8), substr({h},9,4), substr({h},13,4), "
            f"substr({h},17,4), substr({h},21,12))")


register("scalar_uuid", f"""
select transaction_id, {_uuid_sql('transaction_id')} as new_guid from t_transaction""")(
    lambda lg: lg.t_transaction.select(
        "transaction_id", X.guid_from(F.lit("txn"), F.col("transaction_id")).alias("new_guid")))
register("scalar_parse_datetime", """
select transaction_id, strptime(cast(transaction_date as varchar) || ' 12:30:00', '%Y-%m-%d %H:%M:%S') as parsed
from t_transaction""")(
    lambda lg: lg.t_transaction.select(
        "transaction_id",
        X.parse_datetime(F.concat(F.col("transaction_date").cast("string"), F.lit(" 12:30:00")),
                         "yyyy-MM-dd HH:mm:ss").alias("parsed")))
