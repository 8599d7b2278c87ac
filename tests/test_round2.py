"""Nothing is dropped without a word; values of single statements; CSV line breaks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallybook.operators import checks as C
from tallybook.operators import evolution as E
from tallybook.operators import ids
from tallybook.operators import joins as J
from tallybook.operators import mutations as M
from tallybook.plans import reports as R
from tallybook.sources import io as IO


def test_sequential_ids_keep_every_row_with_payload(spark, tmp_path):
    path = str(tmp_path / "keys")
    (spark.range(0, 300_000, 1, 12).select((F.col("id") * 7919 % 300_000).alias("k"), F.sha2(F.col("id").cast("string"), 256)
                                           .alias("p"), F.lit("x").alias("q")).write.parquet(path))
    out = ids.sequential_ids(spark.read.parquet(path), ["k"], "rid")
    n, distinct, wrong = out.agg(F.count("rid"), F.countDistinct("rid"),
                                 F.count(F.when(F.col("rid") != F.col("k") + 1, 1))).first()
    assert (n, distinct, wrong) == (300_000, 300_000, 0)


def test_rules_that_cannot_run_are_errors(spark):
    t = {"t_account": spark.createDataFrame([("a",)], "account_name_owner string")}
    rules = [C.Rule("ok", "t_account", "lowercase", ("account_name_owner",)),
             C.Rule("no_column", "t_account", "not_null", ("owner",)),
             C.Rule("no_table", "t_payment", "not_null", ("amount",)),
             C.Rule("no_parent", "t_account", "foreign_key", ("account_name_owner",), ref_table="t_user",
                    ref_columns=("username",))]
    rows = {r.rule: (r.severity, r.violations) for r in C.summary(t, rules).collect()}
    assert rows == {"ok": ("error", 0), "no_column": ("error", None), "no_table": ("error", None),
                    "no_parent": ("error", None)}
    v = C.verdict(C.summary(t, rules)).first()
    assert (v.errors, v.passed, v.verdict) == (3, 1, "FAILED")
    details = {r.rule: r.detail for r in C.violations(t, rules, {}).collect()}
    assert details == {"no_column": "not evaluated: t_account.owner missing",
                       "no_table": "not evaluated: t_payment missing",
                       "no_parent": "not evaluated: t_user missing"}


def test_missing_core_table_is_reported(spark):
    t = {"t_account": spark.createDataFrame([(1,)], "x long")}
    rows = {r.table_name: (r.row_count, r.status) for r in IO.verify_core_nonempty(t, ["t_transaction", "t_account"]).collect()}
    assert rows == {"t_transaction": (None, "missing"), "t_account": (1, "ok")}


def test_grand_total_leaves_other_accounts_alone(spark):
    acct = spark.createDataFrame([("x", "5.00"), ("y", "7.00")], "account_name_owner string, totals string").withColumn(
        "totals", F.col("totals").cast("decimal(38,2)"))
    total = spark.createDataFrame([("9.00",)], "totals string").withColumn("totals", F.col("totals").cast("decimal(38,2)"))
    assert {r[0]: float(r[1]) for r in M.store_grand_total(acct, total, "x").collect()} == {"x": 9.0, "y": 7.0}


def test_defaults_are_the_declared_ones(spark):
    row = M.apply_defaults(spark.createDataFrame([("p", "o")], "provider_name string, owner string"),
                           "t_medical_provider", "2024-05-01 00:00:00").first()
    assert (row.network_status, row.provider_type, row.date_added) == ("unknown", "general", dt.datetime(2024, 5, 1))
    with pytest.raises(ValueError, match="expires_at"):
        M.apply_defaults(spark.createDataFrame([("h",)], "token_hash string"), "t_token_blacklist")


def test_lookup_and_insert_reject_repeated_keys(spark):
    left = spark.createDataFrame([(1,)], "k long")
    two = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "d")], "id long, v string")
    with pytest.raises(Exception, match="not unique"):
        J.scalar_lookup(left, "k", two, "id", "v", "v").collect()
    with pytest.raises(Exception, match="not unique"):
        M.insert_rows_unique(spark.createDataFrame([(1, "z")], "id long, n string"),
                             spark.createDataFrame([("a",), ("a",)], "n string"), ["n"], "id").collect()


def test_csv_keeps_line_breaks_and_reads_in_parts(spark, tmp_path):
    texts = ["a\nb", "c\r\nd", "back\\slash", "\\n kept", "\\\\n", "", None, "quote\" , comma", "end\\"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, t string")
    path = str(tmp_path / "csv")
    IO.export_csv(df, path, order_by=["id"])
    assert [r.t for r in IO.import_csv(spark, path, df.schema).orderBy("id").collect()] == texts
    assert "multiLine" not in IO.CSV_OPTIONS


def test_empty_extract_and_foreign_failures(spark, tmp_path):
    schema = spark.createDataFrame([], "id long").schema
    IO.export_csv(spark.createDataFrame([], schema), str(tmp_path / "none"))
    assert IO.check_extract(spark, str(tmp_path / "none"), schema)["status"] == "empty"
    assert IO.check_extract(spark, str(tmp_path / "absent"), schema)["status"].startswith("unreadable")


def test_set_not_null_changes_the_schema_and_fails_on_null(spark):
    df = spark.createDataFrame([(1,)], "a long")
    assert not E.set_not_null(df, "a").schema["a"].nullable
    with pytest.raises(Exception, match="contains NULL"):
        E.set_not_null(spark.createDataFrame([(1,), (None,)], "a long"), "a").collect()


def test_side_totals_are_null_without_rows_and_one_scan(spark):
    t = spark.createDataFrame([("debit", 2.0, True)], "account_type string, amount double, active_status boolean")
    t = t.withColumn("amount", F.col("amount").cast("decimal(12,2)"))
    row = R.debits_and_credits({"t_transaction": t}).first()
    assert (float(row.debits), row.credits) == (2.0, None)


def test_null_keys_are_spread_and_match_nothing(spark):
    left = spark.range(0, 4000).select("id", F.when(F.col("id") % 10 == 0, F.col("id")).alias("k"))
    keys = spark.createDataFrame([(0,), (20,), (20,), (None,)], "s long")
    out = J.in_subquery_flag(left, "k", keys, "s", "hit")
    assert out.columns == ["id", "k", "hit"]
    assert sorted(r.id for r in out.where("hit").collect()) == [0, 20]
    assert out.count() == 4000
    spread, _, _ = J.spread_nulls(left, ["k"], keys, ["s"])
    nulls = spread.where("k is null").groupBy(F.expr("pmod(_tb_at, 8)").alias("p")).count().collect()
    assert len(nulls) == 8 and max(r["count"] for r in nulls) < 2 * 3600 / 8
    narrow = spark.createDataFrame([(20,)], "s int")  # other key type: joined as it is
    assert [r.id for r in J.in_subquery_flag(left, "k", narrow, "s", "hit").where("hit").collect()] == [20]


def test_scalars_must_be_one_row(spark):
    one, two = spark.range(1), spark.range(2).withColumnRenamed("id", "n")
    assert J.cross_join_scalars(one, spark.createDataFrame([], "n long")).count() == 0
    with pytest.raises(Exception, match="more than one row"):
        J.cross_join_scalars(one, two).collect()


def test_migration_appends_reports_absent_tables_and_checks_the_reference(spark, tmp_path):
    parent = spark.createDataFrame([(1, "a"), (2, "b")], "receipt_image_id long, t string")
    child = spark.createDataFrame([(1, 1), (2, None), (3, 9)], "transaction_id long, receipt_image_id long")
    reference = [("fk", "t_transaction", "receipt_image_id", "t_receipt_image", "receipt_image_id")]

    def run(truncate):
        rep = IO.migrate_tables(spark, {"t_transaction": child, "t_receipt_image": parent},
                                ["t_transaction", "t_receipt_image"], str(tmp_path / "target"), truncate=truncate,
                                optional=["t_token_blacklist"], columns={"t_receipt_image": ["receipt_image_id"]},
                                references=reference)
        return [tuple(r)[1:] for r in rep.orderBy("step").collect()]

    expected = [("t_transaction", 3, 3, 3, "ok"), ("t_receipt_image", 2, 2, 2, "ok"),
                ("t_token_blacklist", None, 0, None, "absent"), ("fk", None, None, None, "1 rows without parent")]
    assert run(None) == expected
    again = run({"t_receipt_image": True})  # the first table is appended to, the second emptied first
    assert again[:3] == expected[:3] and again[3][4] == "2 rows without parent"
    assert spark.read.parquet(str(tmp_path / "target" / "t_transaction")).count() == 6
    images = spark.read.parquet(str(tmp_path / "target" / "t_receipt_image"))
    assert images.columns == ["receipt_image_id"] and images.count() == 2


def test_dialect_tables_get_declared_types_and_order(spark):
    old = spark.createDataFrame([("visit", 1, "5.25")], "description string, medical_provider_id int, amount string")
    out = E.conform_variant(old, "test", "t_medical_expense")
    assert [(f.name, f.dataType.simpleString()) for f in out.schema.fields] == [
        ("provider_id", "bigint"), ("service_description", "string"), ("billed_amount", "decimal(12,2)")]
