"""Backup-validation and integrity roll-ups over the ledger tables.

Each returns a small DataFrame (one row per table or per issue) computed by
distributed aggregates; nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expr as X
from ..operators.relational import union_tree
from ..operators import joins as J


def _t(tables, name):
    return tables[name] if isinstance(tables, dict) else getattr(tables, name)


def orphans(tables, child: str, parent: str = "t_transaction",
            key: str = "transaction_id") -> DataFrame:
    """Child rows whose ``key`` has no parent row (LEFT JOIN .. IS NULL)."""
    return J.left_join_orphans(_t(tables, child), _t(tables, parent), key, key)


def orphan_count(tables, child: str) -> DataFrame:
    return orphans(tables, child).agg(F.count(F.lit(1)).alias("orphaned_count"))


# The issues the integrity function reports.
ISSUES = (
    ("t_transaction_categories", "orphaned_records",
     "Transaction categories without corresponding transactions",
     "Orphaned Transaction Categories"),
    ("t_receipt_image", "orphaned_records",
     "Receipt images without corresponding transactions", "Orphaned Receipt Images"),
)


def integrity_report(tables) -> DataFrame:
    """(table_name, issue_type, issue_count, description), only issues with a
    positive count (``HAVING COUNT(*) > 0`` without GROUP BY)."""
    parts = [orphans(tables, child).agg(F.count(F.lit(1)).alias("issue_count"))
             .where(F.col("issue_count") > 0)
             .select(F.lit(child).alias("table_name"), F.lit(issue).alias("issue_type"),
                     "issue_count", F.lit(desc).alias("description"))
             for child, issue, desc, _ in ISSUES]
    return union_tree(parts)


def integrity_view(tables, as_of=None) -> DataFrame:
    """(issue_type, issue_count, last_checked): always one row per issue."""
    parts = [orphans(tables, child).agg(F.count(F.lit(1)).alias("issue_count"))
             .select(F.lit(label).alias("issue_type"), "issue_count",
                     X.as_of_or_now(as_of).alias("last_checked"))
             for child, _, _, label in ISSUES]
    return union_tree(parts)


# Labels of the row-count summary of a restored backup.
ROW_COUNT_TABLES = (
    ("Transactions", "t_transaction"), ("Accounts", "t_account"),
    ("Categories", "t_category"), ("Descriptions", "t_description"),
    ("Parameters", "t_parameter"), ("Validation_Amounts", "t_validation_amount"),
    ("Payments", "t_payment"), ("Transfers", "t_transfer"),
    ("Receipt_Images", "t_receipt_image"), ("Pending_Transactions", "t_pending_transaction"),
    ("Transaction_Categories", "t_transaction_categories"),
)


def row_count_summary(tables, labels=ROW_COUNT_TABLES) -> DataFrame:
    parts = [_t(tables, t).agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(label).alias("table_name"), "row_count") for label, t in labels]
    return union_tree(parts).orderBy("table_name")


def transaction_date_range(tables) -> DataFrame:
    t = _t(tables, "t_transaction")
    return t.agg(F.min("transaction_date").alias("earliest_date"),
                 F.max("transaction_date").alias("latest_date"),
                 F.count(F.lit(1)).alias("total_transactions"))


def validation_record_count(tables) -> DataFrame:
    v = _t(tables, "t_validation_amount")
    return v.agg(F.count(F.lit(1)).alias("validation_count")).withColumn(
        "has_validation_data", F.col("validation_count") > 0)


def _has(tables, name: str) -> bool:
    try:
        return _t(tables, name) is not None
    except (KeyError, AttributeError):
        return False


def validate_backup(tables, expected=tuple(t for _, t in ROW_COUNT_TABLES)) -> DataFrame:
    """The backup-validation job as one plan: ``[step, check_name, severity,
    detail]`` rows for table row counts (an empty table is accessible
    and succeeds, a missing one is an error), orphan checks (warnings when non-zero), the transaction date
    range and the presence of validation records (info when absent)."""
    parts = []
    missing = [name for name in expected if not _has(tables, name)]
    if missing:
        parts.append(_t(tables, "t_transaction").sparkSession.createDataFrame(
            [("row_counts", name, "error", "missing") for name in missing],
            "step string, check_name string, severity string, detail string"))
    for name in expected:
        if name in missing:
            continue
        n = _t(tables, name).agg(F.count(F.lit(1)).alias("n"))
        parts.append(n.select(
            F.lit("row_counts").alias("step"), F.lit(name).alias("check_name"),
            F.lit("success").alias("severity"), F.col("n").cast("string").alias("detail")))
    for child, _, _, label in ISSUES:
        n = orphans(tables, child).agg(F.count(F.lit(1)).alias("n"))
        parts.append(n.select(
            F.lit("orphans").alias("step"), F.lit(label).alias("check_name"),
            F.when(F.col("n") == 0, "success").otherwise("warning").alias("severity"),
            F.col("n").cast("string").alias("detail")))
    rng = transaction_date_range(tables)
    parts.append(rng.select(
        F.lit("date_range").alias("step"), F.lit("transaction_date").alias("check_name"),
        F.when(F.col("total_transactions") > 0, "success").otherwise("error").alias("severity"),
        F.concat_ws(" ", F.col("earliest_date").cast("string"), F.col("latest_date").cast("string"),
                    F.col("total_transactions").cast("string")).alias("detail")))
    val = validation_record_count(tables)
    parts.append(val.select(
        F.lit("validation_data").alias("step"), F.lit("t_validation_amount").alias("check_name"),
        F.when(F.col("has_validation_data"), "success").otherwise("info").alias("severity"),
        F.col("validation_count").cast("string").alias("detail")))
    return union_tree(parts)


def backup_verdict(report: DataFrame) -> DataFrame:
    """Severity roll-up of a validation report -> counts and the verdict."""
    sev = F.col("severity")
    agg = report.agg(F.count(F.when(sev == "success", 1)).alias("successes"),
                     F.count(F.when(sev == "warning", 1)).alias("warnings"),
                     F.count(F.when(sev == "error", 1)).alias("errors"))
    return agg.withColumn("verdict", F.when(F.col("errors") > 0, "FAILED")
                          .when(F.col("warnings") > 0, "PASSED WITH WARNINGS")
                          .otherwise("PASSED"))
