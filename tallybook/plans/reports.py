"""Ledger reports: one function per query of the reference's query book.

Signature: ``report(tables, as_of=None, owner=None, **params) -> DataFrame``.
``tables`` is anything with the ledger tables as attributes or keys (a
``sources.fixtures.Ledger`` or a dict of DataFrames).  Parameters replace the
literals of the original statements (account, year, date bounds, threshold).
``owner`` restricts every input table to one tenant.

Plans are declarative: filters and projections reach the parquet scan,
aggregates run partial (map-side) then final, and the only joins are
fact-to-dimension semi/anti joins whose strategy (broadcast under the size
threshold, else sort-merge with AQE skew splitting) Catalyst picks from sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expr as X
from ..operators import joins as J


def table(tables, name: str, owner: str | None = None) -> DataFrame:
    df = tables[name] if isinstance(tables, dict) else getattr(tables, name)
    if owner is not None and "owner" in df.columns:
        df = df.where(F.col("owner") == owner)
    return df


def _active(c: str = "active_status") -> Column:
    return F.col(c) == F.lit(True)


# -- sums by account ------------------------------------------------------
def _sum_by_account(tables, owner, type_filter: Column | None, alias: str) -> DataFrame:
    t = table(tables, "t_transaction", owner).where(_active())
    if type_filter is not None:
        t = t.where(type_filter)
    return (t.groupBy("account_name_owner").agg(X.money_sum("amount").alias(alias))
            .orderBy("account_name_owner"))


def credits_by_account(tables, owner=None, account_type: str = "credit") -> DataFrame:
    return _sum_by_account(tables, owner, F.col("account_type") == account_type, "credits")


def debits_by_account(tables, owner=None, account_type: str = "debit") -> DataFrame:
    # the original query labels the debit totals ``credits``; kept
    return _sum_by_account(tables, owner, F.col("account_type") == account_type, "credits")


def totals_by_account(tables, owner=None) -> DataFrame:
    return _sum_by_account(tables, owner, None, "totals")


def _side_total(tables, owner, account_type: str, alias: str) -> DataFrame:
    t = table(tables, "t_transaction", owner)
    return (t.where((F.col("account_type") == account_type) & _active())
            .agg(X.money_sum("amount").alias(alias)))


def debits_and_credits(tables, owner=None) -> DataFrame:
    """One row: total debits and total credits, from one scan (a side is NULL
    when it has no rows)."""
    t = table(tables, "t_transaction", owner)
    side = lambda kind: F.when(F.col("account_type") == kind, F.col("amount"))
    return (t.where(F.col("account_type").isin("debit", "credit") & _active())
            .agg(X.money_sum(side("debit")).alias("debits"), X.money_sum(side("credit")).alias("credits")))


def grand_total(tables, owner=None) -> DataFrame:
    """debits - credits; NULL when either side is empty."""
    both = debits_and_credits(tables, owner)
    return both.select((F.col("debits") - F.col("credits")).cast("decimal(38,2)").alias("totals"))


# -- counts -------------------------------------------------------------------
def count_account_type(tables, account: str, account_type: str = "debit", owner=None) -> DataFrame:
    t = table(tables, "t_transaction", owner)
    return (t.where((F.col("account_name_owner") == account)
                    & (F.col("account_type") == account_type))
            .agg(F.count(F.lit(1)).alias("cnt")))


def _zero_cleared(description: str) -> Column:
    return ((F.col("amount") == F.lit(0).cast("decimal(12,2)"))
            & (F.col("transaction_state") == "cleared")
            & (F.col("description") == description) & (F.col("notes") == ""))


def count_void(tables, owner=None) -> DataFrame:
    t = table(tables, "t_transaction", owner)
    return t.where(_zero_cleared("void")).agg(F.count(F.lit(1)).alias("void_record_count"))


def count_none(tables, owner=None) -> DataFrame:
    t = table(tables, "t_transaction", owner)
    return t.where(_zero_cleared("none")).agg(F.count(F.lit(1)).alias("none_record_count"))


def double_space_descriptions(tables, owner=None) -> DataFrame:
    t = table(tables, "t_transaction", owner)
    return t.where(F.col("description").like("%  %")).select("description")


def double_space_notes(tables, owner=None) -> DataFrame:
    t = table(tables, "t_transaction", owner)
    return t.where(F.col("notes").like("%  %")).select("notes")


# -- time buckets -------------------------------------------------------------
def cleared_count_by_week(tables, owner=None) -> DataFrame:
    t = table(tables, "t_transaction", owner).where(F.col("transaction_state") == "cleared")
    return (t.groupBy(X.week_start("transaction_date").alias("weekly"))
            .agg(F.count(F.lit(1)).alias("cnt")).orderBy(F.col("weekly").desc()))


def _spend(tables, owner, excluded_description: str, excluded_account: str) -> DataFrame:
    t = table(tables, "t_transaction", owner)
    return t.where((F.col("transaction_state") == "cleared") & (F.col("account_type") == "credit")
                   & (F.col("description") != excluded_description)
                   & (F.col("account_name_owner") != excluded_account))


def spend_by_week(tables, owner=None, excluded_description: str = "payment",
                  excluded_account: str = "medical") -> DataFrame:
    t = _spend(tables, owner, excluded_description, excluded_account)
    return (t.groupBy(X.week_start("transaction_date").alias("weekly"))
            .agg(X.money_sum("amount").alias("total")).orderBy(F.col("weekly").desc()))


def spend_by_month(tables, owner=None, excluded_description: str = "payment",
                   excluded_account: str = "medical") -> DataFrame:
    t = _spend(tables, owner, excluded_description, excluded_account)
    return (t.groupBy(X.month_start("transaction_date").alias("monthly"))
            .agg(X.money_sum("amount").alias("total")).orderBy(F.col("monthly").desc()))


def credits_by_month(tables, owner=None, account_type: str = "credit") -> DataFrame:
    t = table(tables, "t_transaction", owner).where(F.col("account_type") == account_type)
    return (t.groupBy(X.month_start("transaction_date").alias("dt"))
            .agg(X.money_sum("amount").alias("total")).orderBy("dt"))


def income_expense_net_by_month(tables, since: str = "2022-01-01", owner=None) -> DataFrame:
    """month, income, expense, net for months that have both income and
    expense rows after ``since`` (strict).

    The original joins two monthly aggregates; here one scan computes both
    sides with conditional sums plus per-side row counts, and a month is kept
    only when both counts are positive -- the same rows as the inner join, one
    shuffle instead of three.
    """
    t = table(tables, "t_transaction", owner).where(
        (F.col("transaction_date") > X.lit_date(since))
        & F.col("transaction_type").isin("income", "expense"))
    is_inc = F.col("transaction_type") == "income"
    is_exp = F.col("transaction_type") == "expense"
    mag = F.abs(F.col("amount"))
    g = t.groupBy(X.month_start("transaction_date").alias("month")).agg(
        F.sum(F.when(is_inc, mag)).cast("decimal(38,2)").alias("income"),
        F.sum(F.when(is_exp, mag)).cast("decimal(38,2)").alias("expense"),
        F.count(F.when(is_inc, 1)).alias("_n_inc"), F.count(F.when(is_exp, 1)).alias("_n_exp"))
    return (g.where((F.col("_n_inc") > 0) & (F.col("_n_exp") > 0))
            .select("month", "income", "expense",
                    (F.col("income") - F.col("expense")).cast("decimal(38,2)").alias("net"))
            .orderBy("month"))


def count_in_range(tables, a: str, b: str, owner=None) -> DataFrame:
    t = table(tables, "t_transaction", owner)
    return (t.where(X.between_symmetric("transaction_date", a, b))
            .agg(F.count(F.lit(1)).alias("cnt")))


def expense_in_range(tables, a: str, b: str, transaction_type: str = "expense",
                     owner=None) -> DataFrame:
    t = table(tables, "t_transaction", owner)
    return (t.where(X.between_symmetric("transaction_date", a, b)
                    & (F.col("transaction_type") == transaction_type))
            .agg(X.money_sum("amount").alias("total")))


# -- state / date contradictions ---------------------------------------------
def _before(as_of) -> Column:
    return F.col("transaction_date") < X.as_of_or_now(as_of)


def stale_future_credits(tables, as_of=None, owner=None) -> DataFrame:
    t = table(tables, "t_transaction", owner)
    return t.where((F.col("transaction_state") == "future") & _before(as_of)
                   & (F.col("account_type") == "credit"))


def stale_outstanding_credits(tables, as_of=None, owner=None) -> DataFrame:
    t = table(tables, "t_transaction", owner)
    return t.where((F.col("transaction_state") == "outstanding") & _before(as_of)
                   & (F.col("account_type") == "credit"))


def cleared_in_future(tables, as_of=None, owner=None) -> DataFrame:
    t = table(tables, "t_transaction", owner)
    return t.where((F.col("transaction_state") == "cleared")
                   & (F.col("transaction_date") > X.as_of_or_now(as_of)))


def uncleared_in_past(tables, as_of=None, owner=None) -> DataFrame:
    t = table(tables, "t_transaction", owner)
    return t.where(F.col("transaction_state").isin("future", "outstanding") & _before(as_of))


# -- accounts that need a payment -------------------------------------------
def _credit_active_accounts(tables, owner) -> DataFrame:
    a = table(tables, "t_account", owner)
    return a.where((F.col("account_type") == "credit") & _active()).select("account_name_owner")


def _needing_payment(tables, owner, with_outstanding: bool) -> DataFrame:
    """Per account: SUM(amount) of cleared rows if the account is an active
    credit account, plus (detail form) outstanding credit 'payment' rows of
    any account -- ``A AND IN(..) OR B`` with AND binding tighter, as in the
    original.  Kept only when the sum is > 0.

    Transactions are pre-aggregated per account (two conditional sums,
    combined map-side) BEFORE the account membership test, so the join sees
    one row per account however skewed the accounts are.
    """
    t = table(tables, "t_transaction", owner)
    cleared = F.col("transaction_state") == "cleared"
    outstanding = ((F.col("transaction_state") == "outstanding")
                   & (F.col("account_type") == "credit") & (F.col("description") == "payment"))
    measures = [F.sum(F.when(cleared, F.col("amount"))).alias("_s_cleared")]
    if with_outstanding:
        measures.append(F.sum(F.when(outstanding, F.col("amount"))).alias("_s_out"))
        t = t.where(cleared | outstanding)
    else:
        t = t.where(cleared)
    per_acct = t.groupBy("account_name_owner").agg(*measures)
    flagged = J.in_subquery_flag(per_acct, "account_name_owner",
                                 _credit_active_accounts(tables, owner), "account_name_owner",
                                 "_in_credit")
    part1 = F.when(F.col("_in_credit"), F.col("_s_cleared"))
    if with_outstanding:
        part2 = F.col("_s_out")
        total = F.when(part1.isNull() & part2.isNull(), F.lit(None)).otherwise(
            F.coalesce(part1, F.lit(0)) + F.coalesce(part2, F.lit(0)))
    else:
        total = part1
    out = flagged.select("account_name_owner", total.cast("decimal(38,2)").alias("totals"))
    return out.where(F.col("totals") > 0)


def accounts_needing_payment(tables, owner=None) -> DataFrame:
    return _needing_payment(tables, owner, False)


def accounts_needing_payment_names(tables, owner=None) -> DataFrame:
    return _needing_payment(tables, owner, False).select("account_name_owner")


def accounts_needing_payment_detail(tables, owner=None) -> DataFrame:
    return _needing_payment(tables, owner, True).orderBy("account_name_owner")


def accounts_needing_payment_detail_names(tables, owner=None) -> DataFrame:
    return (_needing_payment(tables, owner, True).select("account_name_owner")
            .orderBy("account_name_owner"))


def outstanding_payments(tables, owner=None) -> DataFrame:
    t = table(tables, "t_transaction", owner)
    return t.where((F.col("transaction_state") == "outstanding")
                   & (F.col("account_type") == "credit") & (F.col("description") == "payment")
                   ).select("account_name_owner", F.col("amount").alias("totals"))


# -- projections to next year ------------------------------------------------
def _projection(t: DataFrame, first: Column) -> DataFrame:
    return t.select(first, X.plus_years("transaction_date").alias("next_date"), "description",
                    F.abs(F.col("amount")).alias("amount"))


def project_next_year_like(tables, pattern: str, year: int, account: str,
                           owner=None) -> DataFrame:
    t = table(tables, "t_transaction", owner)
    t = t.where(F.col("description").like(pattern) & X.in_year("transaction_date", year))
    return _projection(t, F.lit(account).alias("account"))


def project_next_year_exact(tables, description: str, year: int, account: str,
                            owner=None) -> DataFrame:
    # LIKE without a wildcard is an equality test
    return project_next_year_like(tables, description, year, account, owner)


def _recurring() -> Column:
    # the boolean ``reoccurring`` of the old schema is ``reoccurring_type``
    # other than 'undefined' today; NULL types drop out as with ``!=``
    return F.col("reoccurring_type") != "undefined"


def project_next_year_recurring(tables, year: int, owner=None) -> DataFrame:
    t = table(tables, "t_transaction", owner)
    t = t.where(_recurring() & X.in_year("transaction_date", year))
    return _projection(t, F.col("description").alias("account"))


def recurring_count_by_description(tables, year: int, owner=None) -> DataFrame:
    t = table(tables, "t_transaction", owner)
    return (t.where(_recurring() & X.in_year("transaction_date", year))
            .groupBy("description").agg(F.count("description").alias("cnt")))


def recurring_by_account_desc_category(tables, start: str, end: str, owner=None) -> DataFrame:
    t = table(tables, "t_transaction", owner)
    t = t.where((F.col("transaction_date") > X.lit_date(start))
                & (F.col("transaction_date") < X.lit_date(end)) & _recurring())
    return (t.groupBy("account_name_owner", "description", "category")
            .agg(F.count("description").alias("cnt")).orderBy("description"))


def bill_pay_for_month(tables, account: str, start: str, end: str,
                       category: str = "bill_pay", owner=None) -> DataFrame:
    t = table(tables, "t_transaction", owner)
    return t.where((F.col("category") == category)
                   & (F.col("transaction_date") > X.lit_date(start))
                   & (F.col("transaction_date") < X.lit_date(end))
                   & (F.col("account_name_owner") == account))


def rare_descriptions(tables, threshold: int = 11, owner=None) -> DataFrame:
    """Descriptions (active in t_description) used fewer than ``threshold``
    times.  The original comment says "more than 10"; the code says
    ``HAVING COUNT < 11`` and is followed."""
    t = table(tables, "t_transaction", owner)
    d = table(tables, "t_description", owner).where(_active()).select(
        F.col("description_name").alias("description"))
    # count per description first (map-side combined), then the semi join
    # sees one row per description
    counts = t.groupBy("description").agg(F.count("description").alias("cnt"))
    return (counts.join(d, "description", "left_semi").where(F.col("cnt") < threshold)
            .orderBy(F.col("cnt").desc(), "description"))


def account_ledger(tables, account: str, owner=None) -> DataFrame:
    """One account's active rows, newest first (the query the composite
    (account, active, date desc) index was built for; here the table layout
    written by ``sources.io.write_table`` gives the same pruning)."""
    t = table(tables, "t_transaction", owner)
    return (t.where((F.col("account_name_owner") == account) & _active())
            .orderBy(F.col("transaction_date").desc(), F.col("transaction_id").desc()))


def active_flag_mismatch(tables, owner=None) -> DataFrame:
    t = table(tables, "t_transaction", owner).where(_active())
    inactive = (table(tables, "t_account", owner).where(F.col("active_status") == F.lit(False))
                .select("account_name_owner"))
    return t.join(inactive, "account_name_owner", "left_semi")


def dangling_payments_source(tables, owner=None) -> DataFrame:
    p = table(tables, "t_payment", owner)
    g = table(tables, "t_transaction", owner).select("guid")
    return J.not_in(p, "guid_source", g, "guid")


def dangling_payments_destination(tables, owner=None) -> DataFrame:
    p = table(tables, "t_payment", owner)
    g = table(tables, "t_transaction", owner).select("guid")
    return J.not_in(p, "guid_destination", g, "guid")


def unreferenced_receipts_not_in(tables, owner=None) -> DataFrame:
    """Exact ``NOT IN`` semantics: once one transaction has a NULL
    receipt_image_id the answer is empty (kept on purpose)."""
    r = table(tables, "t_receipt_image", owner).select("receipt_image_id")
    t = table(tables, "t_transaction", owner).select("receipt_image_id")
    return J.not_in(r, "receipt_image_id", t, "receipt_image_id")


def unreferenced_receipts(tables, owner=None) -> DataFrame:
    """Null-safe form: receipts no transaction points to."""
    r = table(tables, "t_receipt_image", owner).select("receipt_image_id")
    t = table(tables, "t_transaction", owner).select("receipt_image_id")
    return r.join(t, "receipt_image_id", "left_anti")


def receipt_prefix_sniff(tables, owner=None, n_hex: int = 44) -> DataFrame:
    r = table(tables, "t_receipt_image", owner)
    return r.select("receipt_image_id",
                    F.left(X.hex_lower("image"), F.lit(n_hex)).alias("hex_prefix"),
                    X.image_format_from_prefix("image").alias("sniffed_format"))


def receipt_size_mb(tables, owner=None, preview: int = 100) -> DataFrame:
    r = table(tables, "t_receipt_image", owner)
    return r.select("receipt_image_id",
                    (X.byte_length("image") / F.lit(1048576.0)).alias("size_mb"),
                    F.left(X.hex_lower("image"), F.lit(preview)).alias("hex_preview"))


def receipt_by_guid(tables, guid: str, owner=None) -> DataFrame:
    t = table(tables, "t_transaction", owner).where(F.col("guid") == guid).select(
        "guid", "receipt_image_id")
    r = table(tables, "t_receipt_image", owner).select("receipt_image_id", "image")
    return t.join(r, "receipt_image_id").select(
        "guid", "receipt_image_id", X.byte_length("image").alias("image_bytes"),
        X.hex_lower("image").alias("image_hex"))


def receipts_of_length(tables, n_bytes: int, owner=None) -> DataFrame:
    r = table(tables, "t_receipt_image", owner)
    return r.where(X.byte_length("image") == n_bytes).select(
        "receipt_image_id", "transaction_id", X.byte_length("image").alias("image_bytes"))


def accounts_without_self_member(tables, owner=None) -> DataFrame:
    a = table(tables, "t_account", owner).where(_active()).select("account_name_owner")
    selves = (table(tables, "t_family_member", owner).where(F.col("relationship") == "self")
              .select(F.col("owner").alias("self_owner")))
    return J.not_in(a, "account_name_owner", selves, "self_owner").distinct()
