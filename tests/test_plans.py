"""Plan shapes that matter at scale (read from ``explain``)."""

import io
import sys

from tallybook.plans import reports as R
from tallybook.sources import io as IO


def _plan(df) -> str:
    buf, old = io.StringIO(), sys.stdout
    sys.stdout = buf
    try:
        df.explain("formatted")
    finally:
        sys.stdout = old
    return buf.getvalue()


def test_flagship_pushes_date_filter_and_prunes_columns(ledger):
    plan = _plan(R.income_expense_net_by_month(ledger, since="1995-01-01"))
    scan = plan[plan.index("Scan parquet"):]
    assert "PushedFilters" in scan and "transaction_date" in scan.split("PushedFilters")[1][:300]
    schema = scan.split("ReadSchema:")[1].split("\n")[0]
    for unused in ("guid", "notes", "category", "receipt_image_id"):
        assert unused not in schema
    tree = plan.split("\n\n")[0]
    assert tree.count("Exchange") == 2      # one aggregation shuffle + the final sort


def test_not_in_has_no_null_aware_broadcast_of_the_inner_side(ledger):
    plan = _plan(R.dangling_payments_destination(ledger))
    assert "NullAware" not in plan and "null aware" not in plan.lower()


def test_account_ledger_reads_one_account(ledger):
    plan = _plan(R.account_ledger(ledger, "customer_000000001"))
    assert "EqualTo(account_name_owner,customer_000000001)" in plan


def test_csv_import_fails_on_malformed_rows(spark):
    import pytest
    path = IO.staging_dir(spark, "bad")
    spark.createDataFrame([("1", "x"), ("not-a-number", "y")], "a string, b string") \
        .write.option("header", "true").csv(path)
    with pytest.raises(Exception):
        IO.import_csv(spark, path, spark.createDataFrame([], "a long, b string").schema).collect()
    chk = IO.check_extract(spark, path, spark.createDataFrame([], "a long, b string").schema)
    assert chk["status"].startswith("unreadable")


def test_checks_copy_no_rows_per_key_set(ledger):
    from tallybook.operators import checks as C
    from tallybook.plans import catalog as K
    from tallybook.sources.complete import CompleteLedger

    plan = _plan(C.summary(CompleteLedger.of(ledger), K.rules(
        "pk_t_account", "unique_owner_account_name_owner", "unique_owner_account_name_owner_account_type",
        "fk_legacy_pending_account", "fk_pending_account")))
    assert "Expand" not in plan


def test_key_sets_with_nulls_roll_up_as_counted_alone(spark):
    from itertools import combinations

    from tallybook.operators import checks as C

    rows = [(1, "a", None), (1, "a", None), (1, None, 2), (1, None, 2), (None, "a", 2), (2, "b", 3), (2, "b", 4)]
    df = spark.createDataFrame(rows, "x long, y string, z long")
    sets = [s for n in (1, 2, 3) for s in combinations("xyz", n)]
    rules = [C.Rule("-".join(s), "t", "unique", s) for s in sets]
    expected = {}
    for s in sets:
        keys = [tuple(r["xyz".index(c)] for c in s) for r in rows]
        expected["-".join(s)] = len({k for k in keys if None not in k and keys.count(k) > 1})
    got = {r.rule: r.violations for r in C.summary({"t": df}, rules).collect()}
    assert got == expected
    assert {r.rule for r in C.violations({"t": df}, rules, {}).collect()} == {k for k, n in expected.items() if n}
