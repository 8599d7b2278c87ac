"""Sides of joins that look small by their files but not by their rows are not sent through the driver."""

import pytest
from pyspark.sql import functions as F

from tallybook.operators import checks as C
from tallybook.operators import joins as J
from tallybook.operators import mutations as M
from tallybook.plans import integrity as I
from tallybook.sources import io as IO

N = 300_000


@pytest.fixture(scope="module")
def packed(spark):
    """Parents of which the key is a small part of the files by the planner's estimate, and children of every 1000th."""
    path = IO.staging_dir(spark, "packed")
    spark.range(N).select(F.col("id").alias("transaction_id"), F.xxhash64("id").alias("noise"),
                          *[F.lit("x").alias(f"c{i}") for i in range(20)]).write.parquet(path)
    child = spark.range(0, 2 * N, 1000).select(F.when(F.col("id") != 5000, F.col("id")).alias("transaction_id"),
                                               (F.col("id") % 7).alias("category_id"))
    at = IO.staging_dir(spark, "children")
    child.write.parquet(at)
    return {"t_transaction": spark.read.parquet(path), "t_transaction_categories": spark.read.parquet(at),
            "t_receipt_image": spark.read.parquet(at)}


RULE = C.Rule("fk", "t_transaction_categories", "foreign_key", ("transaction_id",), ref_table="t_transaction",
              ref_columns=("transaction_id",))
KEYS = {"t_transaction_categories": ("category_id", "transaction_id")}

# query, rows it returns: 300 of the 600 children are orphans, and the one without a key
JOINS = {
    "left_join_orphans": (lambda t: J.left_join_orphans(t["t_transaction_categories"], t["t_transaction"],
                                                        "transaction_id", "transaction_id"), 301),
    "delete_orphans": (lambda t: M.delete_orphans(t["t_transaction_categories"], t["t_transaction"]), 299),
    "integrity_view": (lambda t: I.integrity_view(t, as_of="1998-06-01"), 2),
    "validate_backup": (lambda t: I.validate_backup({**t, "t_transaction": t["t_transaction"].withColumn(
        "transaction_date", F.lit("2020-01-01").cast("date")), "t_validation_amount": t["t_receipt_image"]}, ("t_transaction",)), 5),
    "check_foreign_key": (lambda t: C.violations(t, [RULE], KEYS), 300),
    "check_summary": (lambda t: C.summary(t, [RULE]), 1),
}


@pytest.mark.parametrize("name", JOINS)
def test_a_parent_is_not_broadcast_by_the_size_of_its_files(packed, name):
    build, rows = JOINS[name]
    df = build(packed)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
    assert "BroadcastHashJoin" not in plan
    assert df.count() == rows


def test_orphans_are_counted_as_they_are(packed):
    assert [r.issue_count for r in I.integrity_view(packed, as_of="1998-06-01").collect()] == [301, 301]
    assert [r.violations for r in C.summary(packed, [RULE]).collect()] == [300]
    assert {r.key for r in C.violations(packed, [RULE], KEYS).where("key like '0,%'").collect()} == {
        f"0,{k}" for k in range(N, 2 * N, 1000) if k % 7 == 0}


def test_a_small_parent_is_left_to_the_planner(spark, packed):
    few = spark.range(0, 2000, 1000).withColumnRenamed("id", "transaction_id")
    df = J.left_join_orphans(packed["t_transaction_categories"], few, "transaction_id", "transaction_id")
    assert "BroadcastHashJoin" in df._jdf.queryExecution().executedPlan().toString()
    assert df.count() == 598
