"""Id allocation, CSV round trips, migration, and mutation properties."""

from pyspark.sql import functions as F

from tallybook.operators import checks as C
from tallybook.operators import ids
from tallybook.operators import mutations as M
from tallybook.plans import integrity as I
from tallybook.sources import io as IO


def test_sequential_ids_dense_across_partitions(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k")).repartition(9)
    out = ids.sequential_ids(df, ["k"], "rid", start=5)
    rows = out.orderBy("k").collect()
    assert [r.rid for r in rows] == list(range(5, 1005))
    assert [r.k for r in rows] == list(range(1000))


def test_next_ids_after_max_and_empty(spark):
    existing = spark.createDataFrame([(3,), (10,)], "id long")
    new = spark.createDataFrame([("b",), ("a",)], "name string")
    got = {r.name: r.id for r in ids.next_ids(new, existing, "id", ["name"]).collect()}
    assert got == {"a": 11, "b": 12}
    empty = spark.createDataFrame([], "id long")
    got = sorted(r.id for r in ids.next_ids(new, empty, "id", ["name"]).collect())
    assert got == [1, 2]


def _same(a, b):
    return sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_csv_round_trip_keeps_nulls_empties_and_bytes(spark, ledger):
    for name in ("t_transaction", "t_receipt_image", "t_token_blacklist"):
        df = ledger.table(name)
        path = IO.staging_dir(spark, f"t-{name}")
        IO.export_csv(df, path, order_by=[df.columns[0]])
        assert _same(IO.import_csv(spark, path, df.schema), df), name


def test_migrate_reports_every_table(spark, ledger):
    names = ["t_account", "t_transaction", "t_role"]
    rep = IO.migrate_tables(spark, ledger, names, IO.staging_dir(spark, "target"))
    rows = rep.orderBy("step").collect()
    assert [r.table_name for r in rows] == names
    assert all(r.status == "ok" and r.source_rows == r.loaded_rows for r in rows)


def test_migrate_stops_at_first_failure(spark, ledger):
    rep = IO.migrate_tables(spark, {"t_role": ledger.t_role}, ["t_missing", "t_role"],
                            IO.staging_dir(spark, "target"))
    assert [r.status for r in rep.orderBy("step").collect()] == ["missing", "skipped"]


def test_cleanups_are_idempotent(ledger):
    t = ledger.t_transaction
    once = M.normalize_lowercase(ledger.t_pending_transaction, "description")
    assert _same(M.normalize_lowercase(once, "description"), once)
    once = M.delete_void_records(t)
    assert _same(M.delete_void_records(once), once)
    once = M.deactivate_orphaned_active(t, ledger.t_account)
    assert _same(M.deactivate_orphaned_active(once, ledger.t_account), once)


def test_check_is_clean_after_its_cleanup(ledger):
    fixed = M.normalize_lowercase(ledger.t_pending_transaction, "description")
    rules = [C.Rule("pending_lowercase", "t_pending_transaction", "lowercase", ("description",))]
    assert C.violations({"t_pending_transaction": fixed}, rules, {}).count() == 0
    kept = M.delete_orphans(ledger.t_transaction_categories, ledger.t_transaction)
    assert I.orphans({"t_transaction_categories": kept,
                      "t_transaction": ledger.t_transaction}, "t_transaction_categories").count() == 0
    migrated = M.migrate_payment_accounts(ledger.t_payment, ledger.t_account)
    assert migrated.where(F.col("destination_account") == " ").count() == 0


def test_mutations_share_one_snapshot(ledger):
    out = M.delete_images_and_unlink(ledger.t_transaction, ledger.t_receipt_image, 1000)
    gone = ledger.t_receipt_image.join(out["t_receipt_image"], "receipt_image_id", "left_anti")
    dangling = out["t_transaction"].join(gone, "receipt_image_id", "left_semi")
    assert dangling.count() == 0


def test_seeded_self_members_have_fresh_keys(ledger):
    new = M.seed_self_members(ledger.t_family_member, ledger.t_account)
    top = ledger.t_family_member.agg(F.max("family_member_id")).first()[0]
    keys = [r.family_member_id for r in new.collect()]
    assert keys and min(keys) == top + 1 and len(set(keys)) == len(keys)


def test_backup_verdict_levels(spark):
    from tallybook.plans import integrity as I

    def tables(links, txn_rows):
        t = spark.createDataFrame(txn_rows, "transaction_id long, transaction_date date")
        base = {name: spark.createDataFrame([(1,)], "x long") for _, name in I.ROW_COUNT_TABLES}
        base["t_transaction"] = t
        base["t_transaction_categories"] = spark.createDataFrame(links, "transaction_id long")
        base["t_receipt_image"] = spark.createDataFrame([(1,)], "transaction_id long")
        base["t_validation_amount"] = spark.createDataFrame([(1,)], "x long")
        return base

    import datetime as dt
    day = dt.date(2024, 1, 1)
    clean = I.backup_verdict(I.validate_backup(tables([(1,)], [(1, day)]))).first()
    assert clean.verdict == "PASSED"
    orphaned = I.backup_verdict(I.validate_backup(tables([(1,), (7,)], [(1, day)]))).first()
    assert (orphaned.verdict, orphaned.warnings) == ("PASSED WITH WARNINGS", 1)
    no_links = I.backup_verdict(I.validate_backup(tables([], [(1, day)]))).first()
    assert (no_links.verdict, no_links.errors) == ("PASSED WITH WARNINGS", 0) or no_links.verdict == "PASSED"
    absent = tables([(1,)], [(1, day)])
    del absent["t_payment"]
    gone = I.backup_verdict(I.validate_backup(absent)).first()
    assert (gone.verdict, gone.errors) == ("FAILED", 1)


def test_sequential_ids_with_a_hot_tie_group(spark):
    df = spark.range(0, 3000).select(F.when(F.col("id") % 3 == 0, F.lit(0))
                                     .otherwise(F.col("id")).alias("k")).repartition(6)
    out = ids.sequential_ids(df, ["k"], "rid", start=1)
    rows = out.collect()
    assert sorted(r.rid for r in rows) == list(range(1, 3001))
    hot = sorted(r.rid for r in rows if r.k == 0)
    assert hot == list(range(1, 1001))          # the tie group is numbered first, densely
