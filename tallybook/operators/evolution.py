"""Schema evolution on tables: the migrations' DDL as DataFrame transforms."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import schemas as S
from . import checks as C


def add_column_default(df: DataFrame, name: str, default, dtype: T.DataType) -> DataFrame:
    """``ADD COLUMN IF NOT EXISTS name type DEFAULT v``: existing rows get v."""
    if name in df.columns:
        return df
    return df.withColumn(name, F.lit(default).cast(dtype))


# Columns the backup job adds to accounts, all nullable without default.
BILLING_COLUMNS = (("billing_statement_close_day", S.SHORT),
                   ("billing_grace_period_days", S.SHORT),
                   ("billing_due_day_same_month", S.SHORT),
                   ("billing_due_day_next_month", S.SHORT),
                   ("billing_cycle_weekend_shift", S.STR))


def add_billing_columns(acct: DataFrame) -> DataFrame:
    out = acct
    for name, dtype in BILLING_COLUMNS:
        out = add_column_default(out, name, None, dtype)
    return out


def drop_column(df: DataFrame, name: str) -> DataFrame:
    """``DROP COLUMN IF EXISTS``."""
    return df.drop(name)


def rename_column(df: DataFrame, old: str, new: str) -> DataFrame:
    return df.withColumnRenamed(old, new)


def set_not_null(df: DataFrame, column: str) -> DataFrame:
    """``ALTER COLUMN c SET NOT NULL``: the job fails (lazily, when the data
    is read) if a NULL is present; the column becomes non-nullable in the schema."""
    kind = df.schema[column].dataType
    fail = F.raise_error(F.lit(f"column {column} contains NULL")).cast(kind)
    # never reached: a last literal is what makes the expression non-nullable
    last = {"string": "", "boolean": False, "binary": b"", "date": dt.date(1970, 1, 1),
            "timestamp": dt.datetime(1970, 1, 1), "timestamp_ntz": dt.datetime(1970, 1, 1)}.get(kind.typeName(), 0)
    return df.withColumn(column, F.coalesce(F.col(column), fail, F.lit(last).cast(kind)))


def drop_not_null(df: DataFrame, column: str) -> DataFrame:
    """``ALTER COLUMN c DROP NOT NULL``: the declared schema becomes nullable."""
    fields = [T.StructField(f.name, f.dataType, True if f.name == column else f.nullable)
              for f in df.schema.fields]
    return df.to(T.StructType(fields))


def widen_decimal(df: DataFrame, column: str, dtype: T.DecimalType = S.MONEY) -> DataFrame:
    """NUMERIC(8,2) -> NUMERIC(12,2) (widening never fails)."""
    return df.withColumn(column, F.col(column).cast(dtype))


def extend_domain_check(df: DataFrame, table: str, rule_name: str, column: str,
                        domain, added, key_cols) -> DataFrame:
    """Violations of a domain CHECK after extending it with ``added`` values."""
    rule = C.Rule(rule_name, table, "domain", (column,), values=tuple(domain) + tuple(added))
    return C.violations({table: df}, [rule], {table: tuple(key_cols)})


# Renames between the Oracle / test dialects and the final schema.
VARIANT_TABLE_RENAMES = {"t_parm": "t_parameter"}
VARIANT_COLUMN_RENAMES = {
    "oracle": {"t_receipt_image": {"jpg_image": "image"},
               "t_category": {"category": "category_name"},
               "t_description": {"description": "description_name"},
               "t_parm": {"parm_id": "parameter_id", "parm_name": "parameter_name",
                          "parm_value": "parameter_value"}},
    "test": {"t_medical_provider": {"medical_provider_id": "provider_id",
                                    "provider_address": "address_line1",
                                    "provider_phone_number": "phone", "provider_email": "email"},
             "t_medical_expense": {"medical_provider_id": "provider_id",
                                   "expense_date": "service_date", "amount": "billed_amount",
                                   "description": "service_description",
                                   "insurance_claim_id": "claim_number",
                                   "out_of_pocket_amount": "patient_responsibility"}},
}
# columns of a dialect that are joined by a space into one
VARIANT_JOINED = {"test": {"t_family_member": {"member_name": ("first_name", "last_name")}}}
VARIANT_DROPPED = {"oracle": {"t_account": ("totals", "totals_balanced"),
                              "t_transaction": ("reoccurring",)}}
REOCCURRING_RENAMES = {"bi-annually": "biannually", "every_two_weeks": "fortnightly"}
FLAG_COLUMNS = ("active_status", "reoccurring")


def conform_variant(df: DataFrame, dialect: str, table: str) -> DataFrame:
    """Map a table of an older dialect to the final shape: CHAR(1) '1'/'0'
    flags become BOOLEAN, renamed recurrence types and columns are mapped,
    retired columns are dropped, and what is left has the declared types
    (``NUMERIC(8,2)`` becomes ``NUMERIC(12,2)``) in the declared order, with
    columns unknown to the schema last."""
    out = df
    for c in FLAG_COLUMNS:
        if c in out.columns and out.schema[c].dataType == T.StringType():
            out = out.withColumn(c, F.col(c) == "1")
    if "reoccurring_type" in out.columns:
        m = F.col("reoccurring_type")
        for old, new in REOCCURRING_RENAMES.items():
            m = F.when(F.col("reoccurring_type") == old, F.lit(new)).otherwise(m)
        out = out.withColumn("reoccurring_type", m)
    for old, new in VARIANT_COLUMN_RENAMES.get(dialect, {}).get(table, {}).items():
        if old in out.columns:
            out = out.withColumnRenamed(old, new)
    for new, parts in VARIANT_JOINED.get(dialect, {}).get(table, {}).items():
        if all(c in out.columns for c in parts):
            out = out.withColumn(new, F.concat_ws(" ", *parts)).drop(*parts)
    out = out.drop(*VARIANT_DROPPED.get(dialect, {}).get(table, ()))
    schema = S.SCHEMAS[VARIANT_TABLE_RENAMES.get(table, table)]
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields if f.name in out.columns],
                      *[c for c in out.columns if c not in schema.names])
