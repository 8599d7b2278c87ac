"""Hot keys: one account holds a third of all rows; results must stay exact."""

from decimal import Decimal as D

import pandas as pd
from pyspark.sql import functions as F

from tallybook.operators import checks as C
from tallybook.plans import reports as R

N = 30000


def _frames(spark):
    rows = []
    for i in range(N):
        acct = "hot_account" if i % 3 == 0 else f"acct_{i % 500}"
        rows.append((i, acct, "credit" if i % 2 else "debit",
                     "cleared" if i % 5 else "outstanding",
                     "payment" if i % 7 == 0 else "shop", D(i % 100) - D(40), True, "o",
                     None if i % 11 == 0 else i % 600))
    txn = spark.createDataFrame(rows, "transaction_id long, account_name_owner string, "
                                "account_type string, transaction_state string, "
                                "description string, amount decimal(12,2), active_status boolean, "
                                "owner string, account_id long").repartition(8)
    accts = spark.createDataFrame(
        [("hot_account", "credit", True, "o", 0)]
        + [(f"acct_{k}", "credit" if k % 2 else "debit", k % 3 != 0, "o", k) for k in range(1, 450)],
        "account_name_owner string, account_type string, active_status boolean, owner string, "
        "account_id long")
    return txn, accts


def test_needing_payment_detail_with_hot_account(spark):
    txn, accts = _frames(spark)
    got = {r.account_name_owner: r.totals
           for r in R.accounts_needing_payment_detail({"t_transaction": txn,
                                                       "t_account": accts}).collect()}
    t, a = txn.toPandas(), accts.toPandas()
    credit = set(a[(a.account_type == "credit") & a.active_status].account_name_owner)
    sel = t[((t.transaction_state == "cleared") & t.account_name_owner.isin(credit))
            | ((t.transaction_state == "outstanding") & (t.account_type == "credit")
               & (t.description == "payment"))]
    exp = sel.groupby("account_name_owner").amount.sum()
    exp = {k: v for k, v in exp.items() if v > 0}
    assert got == exp


def test_reference_and_unique_checks_with_hot_key(spark):
    txn, accts = _frames(spark)
    rule = C.Rule("fk_acct", "t_transaction", "foreign_key", ("account_id",),
                  ref_table="t_account", ref_columns=("account_id",))
    uq = C.Rule("uq_acct_name", "t_transaction", "unique", ("account_name_owner",))
    tables = {"t_transaction": txn, "t_account": accts}
    summ = {r.rule: r.violations for r in C.summary(tables, [rule, uq]).collect()}
    t, a = txn.toPandas(), accts.toPandas()
    ids = set(a.account_id)
    orphans = t[t.account_id.notna() & ~t.account_id.isin(ids)]
    dup_keys = (t.groupby("account_name_owner").size() > 1).sum()
    assert summ == {"fk_acct": len(orphans), "uq_acct_name": dup_keys}
    rows = C.violations(tables, [rule], {"t_transaction": ("transaction_id",)})
    assert rows.count() == len(orphans)
    assert rows.where(F.col("rule") != "fk_acct").count() == 0


def test_rare_descriptions_with_hot_description(spark):
    txn, _ = _frames(spark)
    desc = spark.createDataFrame([("payment", True), ("shop", True)],
                                 "description_name string, active_status boolean")
    got = R.rare_descriptions({"t_transaction": txn, "t_description": desc},
                              threshold=5000).collect()
    cnt = pd.Series([r[4] for r in txn.collect()]).value_counts()
    assert [(r.description, r.cnt) for r in got] == [
        (k, v) for k, v in cnt.items() if v < 5000]
