"""Hand-made edge frames for the SQL semantics the ledger depends on."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tallybook.functions import expr as X
from tallybook.operators import checks as C
from tallybook.operators import joins as J
from tallybook.operators import mutations as M
from tallybook.plans import catalog as K
from tallybook.plans import reports as R

TXN = ("transaction_id long, account_name_owner string, account_type string, "
       "transaction_type string, transaction_state string, description string, "
       "category string, amount decimal(12,2), transaction_date date, active_status boolean, "
       "notes string, reoccurring_type string, receipt_image_id long, owner string, guid string")


def txn(spark, rows):
    full = []
    for i, r in enumerate(rows):
        base = dict(transaction_id=i + 1, account_name_owner="a_x", account_type="credit",
                    transaction_type="expense", transaction_state="cleared",
                    description="d", category="c", amount=D("1.00"),
                    transaction_date=dt.date(2020, 1, 1), active_status=True, notes="",
                    reoccurring_type="monthly", receipt_image_id=None, owner="o",
                    guid=f"g{i + 1}")
        base.update(r)
        full.append(base)
    cols = [c.split()[0] for c in TXN.split(", ")]
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in full], TXN)


def test_check_passes_on_null(spark):
    df = txn(spark, [{"reoccurring_type": None}, {"reoccurring_type": "weekly"}])
    out = C.violations({"t_transaction": df}, K.rules("ck_reoccurring_type"),
                       {"t_transaction": ("transaction_id",)}).collect()
    assert [r.key for r in out] == ["2"]


def test_unique_treats_nulls_as_distinct(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, 7), (4, 7)],
                               "medical_expense_id long, transaction_id long")
    out = C.violations({"t_medical_expense": df}, K.rules("uk_medical_expense_transaction"),
                       {}).collect()
    assert [(r.key, r.detail) for r in out] == [("7", "count=2")]


def test_composite_reference_is_match_simple(spark):
    acct = spark.createDataFrame([("o", 1)], "owner string, account_id long")
    val = spark.createDataFrame([(1, None, 5), (2, "o", 9), (3, "o", 1)],
                                "validation_id long, owner string, account_id long")
    out = C.violations({"t_validation_amount": val, "t_account": acct},
                       K.rules("fk_validation_account_id"),
                       {"t_validation_amount": ("validation_id",)}).collect()
    assert [r.key for r in out] == ["2"]


def test_not_in_null_rules(spark):
    outer = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    with_null = spark.createDataFrame([(1,), (None,)], "k2 long")
    no_null = spark.createDataFrame([(1,)], "k2 long")
    empty = spark.createDataFrame([], "k2 long")
    assert J.not_in(outer, "k", with_null, "k2").count() == 0
    assert [r.k for r in J.not_in(outer, "k", no_null, "k2").collect()] == [2]
    assert J.not_in(outer, "k", empty, "k2").count() == 3
    # NOT EXISTS keeps the NULL key
    assert J.anti_join(outer, no_null.withColumnRenamed("k2", "k"), "k").count() == 2


def test_or_binds_looser_than_and(spark):
    acct = spark.createDataFrame([("inactive_acct", "credit", False)],
                                 "account_name_owner string, account_type string, active_status boolean")
    t = txn(spark, [{"account_name_owner": "inactive_acct", "transaction_state": "outstanding",
                     "description": "payment", "amount": D("5.00")}])
    tables = {"t_transaction": t, "t_account": acct}
    assert R.accounts_needing_payment(tables).count() == 0
    assert [r.account_name_owner for r in R.accounts_needing_payment_detail(tables).collect()] \
        == ["inactive_acct"]


def test_sum_over_no_rows_is_null(spark):
    t = txn(spark, [{"account_type": "credit"}])
    row = R.grand_total({"t_transaction": t}).first()
    assert row.totals is None


def test_ne_drops_nulls(spark):
    t = txn(spark, [{"reoccurring_type": None}, {"reoccurring_type": "undefined"},
                    {"reoccurring_type": "monthly"}])
    assert t.where(F.col("reoccurring_type") != "undefined").count() == 1


def test_replace_is_single_pass(spark):
    row = spark.createDataFrame([("a   b",)], "s string").select(
        X.replace_once("s", "  ", " ").alias("r")).first()
    assert row.r == "a  b"


def test_like_without_wildcard_is_equality(spark):
    t = txn(spark, [{"description": "t-mobile.com"}, {"description": "t-mobile.com x"}])
    assert t.where(F.col("description").like("t-mobile.com")).count() == 1


def test_year_interval_clamps_leap_day(spark):
    df = spark.createDataFrame([(dt.date(2020, 2, 29), dt.date(2020, 1, 1))], "a date, b date")
    r = df.select(X.plus_years("a").alias("y"), X.plus_days("b", 365).alias("d"),
                  X.plus_years("b").alias("yb")).first()
    assert r.y == dt.date(2021, 2, 28)
    assert r.d == dt.date(2020, 12, 31) and r.yb == dt.date(2021, 1, 1)


def test_week_starts_monday(spark):
    r = spark.createDataFrame([(dt.date(2024, 1, 7),)], "d date").select(
        X.week_start("d").alias("w")).first()
    assert r.w == dt.date(2024, 1, 1)


def test_between_symmetric_accepts_reversed_bounds(spark):
    t = txn(spark, [{"transaction_date": dt.date(2022, 8, 15)}])
    assert R.count_in_range({"t_transaction": t}, "2022-08-31", "2022-08-01").first().cnt == 1


def test_anchored_regex_rejects_trailing_newline(spark):
    df = spark.createDataFrame([(1, "1234567890\n"), (2, "1234567890")],
                               "provider_id long, npi string")
    out = C.violations({"t_medical_provider": df}, K.rules("ck_npi_format"),
                       {"t_medical_provider": ("provider_id",)}).collect()
    assert [r.key for r in out] == ["1"]


def test_trim_keeps_tabs(spark):
    df = spark.createDataFrame([(1, "\t"), (2, "   ")], "provider_id long, provider_name string")
    out = C.violations({"t_medical_provider": df}, K.rules("ck_provider_name_not_empty"),
                       {"t_medical_provider": ("provider_id",)}).collect()
    assert [r.key for r in out] == ["2"]


def test_image_size_limit_is_inclusive(spark):
    df = spark.createDataFrame([(1, b"x" * 1048576), (2, b"x" * 1048577)],
                               "receipt_image_id long, image binary")
    out = C.violations({"t_receipt_image": df}, K.rules("ck_image_size"),
                       {"t_receipt_image": ("receipt_image_id",)}).collect()
    assert [(r.key, r.detail) for r in out] == [("2", "bytes=1048577")]


def test_billing_due_methods_exclusive(spark):
    df = spark.createDataFrame([(1, 5, None, None), (2, 5, 10, None)],
                               "account_id long, billing_grace_period_days short, "
                               "billing_due_day_same_month short, billing_due_day_next_month short")
    out = C.violations({"t_account": df}, K.rules("ck_billing_due_method_exclusive"),
                       {"t_account": ("account_id",)}).collect()
    assert [r.key for r in out] == ["2"]


def test_expired_tokens_pruned(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 2, 1))],
                               "token_blacklist_id long, expires_at timestamp_ntz")
    out = M.prune_expired_tokens(df, "2024-01-15 00:00:00").collect()
    assert [r.token_blacklist_id for r in out] == [2]


def test_update_from_join_rejects_duplicate_lookup_keys(spark):
    t = spark.createDataFrame([(1, "a")], "id long, k string")
    lookup = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v long")
    with pytest.raises(Exception, match="not unique"):
        J.update_from_join(t.withColumn("v", F.lit(0).cast("long")), lookup, ["k"],
                           {"v": "v"}).collect()


def test_flagship_drops_months_missing_a_side(spark):
    t = txn(spark, [
        {"transaction_type": "income", "transaction_date": dt.date(2022, 3, 5), "amount": D("10.00")},
        {"transaction_type": "expense", "transaction_date": dt.date(2022, 3, 9), "amount": D("-4.00")},
        {"transaction_type": "income", "transaction_date": dt.date(2022, 4, 5), "amount": D("7.00")},
    ])
    out = R.income_expense_net_by_month({"t_transaction": t}, since="2022-01-01").collect()
    assert [(r.month, r.income, r.expense, r.net) for r in out] == [
        (dt.date(2022, 3, 1), D("10.00"), D("4.00"), D("6.00"))]


def test_check_summary_and_verdict(spark):
    df = txn(spark, [{"reoccurring_type": "weekly"}, {}])
    rules = K.rules("ck_reoccurring_type", "ck_transaction_state", "pk_t_transaction")
    summ = C.summary({"t_transaction": df}, rules)
    got = {r.rule: r.violations for r in summ.collect()}
    assert got == {"ck_reoccurring_type": 1, "ck_transaction_state": 0, "pk_t_transaction": 0}
    assert C.verdict(summ).first().verdict == "FAILED"


def test_schema_contradictions_are_reported(spark):
    found = {(f, t) for f, t, _ in K.schema_findings()}
    assert ("default_outside_domain", "t_account") in found          # 'unknown' account type
    assert ("reference_domain_mismatch", "t_transaction") in found   # 3 vs 30 account types
    assert K.schema_audit(spark).count() == len(K.schema_findings())
