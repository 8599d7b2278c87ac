"""Set-based clean-ups: old tables in, new tables out.

Spark tables are immutable, so every UPDATE / DELETE / INSERT of the
reference becomes a transformation producing the next version of the table
(write it with ``sources.io.write_table``).  Multi-table operations compute
all outputs from the same input snapshot, as the single-statement CTE
updates of PostgreSQL do.  No operation collects rows to the driver; lookups
are joins, and keys come from ``operators.ids``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expr as X
from ..sources import schemas as S
from . import joins as J
from .ids import next_ids, sequential_ids


def _set(df: DataFrame, cond: Column, **values) -> DataFrame:
    """``UPDATE df SET k = v WHERE cond`` (rows where cond is NULL unchanged)."""
    hit = F.coalesce(cond, F.lit(False))
    out = df
    for k, v in values.items():
        v = v if isinstance(v, Column) else F.lit(v)
        out = out.withColumn(k, F.when(hit, v.cast(df.schema[k].dataType)).otherwise(F.col(k)))
    return out.select(*df.columns)


def _delete(df: DataFrame, cond: Column) -> DataFrame:
    """``DELETE FROM df WHERE cond``: rows where cond is NULL stay."""
    return df.where(~F.coalesce(cond, F.lit(False)))


def _scope(cond: Column, owner: str | None) -> Column:
    return cond if owner is None else cond & (F.col("owner") == owner)


# -- account maintenance ----------------------------------------------------------
def rename_account(txn: DataFrame, acct: DataFrame, old: str, new: str,
                   owner: str | None = None) -> dict[str, DataFrame]:
    """Same rename in transactions and accounts, optionally for one tenant."""
    cond = _scope(F.col("account_name_owner") == old, owner)
    return {"t_transaction": _set(txn, cond, account_name_owner=new),
            "t_account": _set(acct, cond, account_name_owner=new)}


def disable_account(txn: DataFrame, acct: DataFrame, name: str,
                    owner: str | None = None) -> dict[str, DataFrame]:
    cond = _scope(F.col("account_name_owner") == name, owner)
    return {"t_transaction": _set(txn, cond, active_status=False),
            "t_account": _set(acct, cond, active_status=False)}


def deactivate_orphaned_active(txn: DataFrame, acct: DataFrame) -> DataFrame:
    """Active transactions of inactive accounts become inactive."""
    inactive = acct.where(F.col("active_status") == F.lit(False)).select("account_name_owner")
    flagged = J.in_subquery_flag(txn, "account_name_owner", inactive, "account_name_owner",
                                 "_tb_inactive")
    return _set(flagged, F.col("_tb_inactive") & (F.col("active_status") == F.lit(True)),
                active_status=False).select(*txn.columns)


def fix_account_type(txn: DataFrame, acct: DataFrame, name: str, new_type: str = "credit",
                     old_type: str = "debit") -> dict[str, DataFrame]:
    cond = (F.col("account_name_owner") == name) & (F.col("account_type") == old_type)
    return {"t_transaction": _set(txn, cond, account_type=new_type),
            "t_account": _set(acct, cond, account_type=new_type)}


def refresh_account_fields(txn: DataFrame, acct: DataFrame) -> DataFrame:
    """Copy account_id / account_type onto transactions by account name."""
    return J.update_from_join(txn, acct, ["account_name_owner"],
                              {"account_id": "account_id", "account_type": "account_type"})


def store_grand_total(acct: DataFrame, grand_total: DataFrame, target: str,
                      column: str = "totals") -> DataFrame:
    """Write the (1-row) grand total onto one account row; other rows keep
    their value (NULL where the column is new)."""
    if column not in acct.columns:
        acct = acct.withColumn(column, F.lit(None).cast(S.MONEY_SUM))
    with_total = acct.crossJoin(F.broadcast(J.one_row(grand_total.select(F.col("totals").alias("_tb_gt")))))
    return with_total.withColumn(
        column, F.when(F.col("account_name_owner") == target, F.col("_tb_gt"))
        .otherwise(F.col(column)).cast(S.MONEY_SUM)).drop("_tb_gt")


def flip_credit_sign(txn: DataFrame, account_type: str = "credit") -> DataFrame:
    return _set(txn, F.col("account_type") == account_type,
                amount=(F.col("amount") * F.lit(-1.0).cast("decimal(2,1)")))


# -- text clean-ups -----------------------------------------------------------------
def collapse_double_spaces(df: DataFrame, *columns: str) -> DataFrame:
    """One single-pass replace of two spaces by one where LIKE '%  %'."""
    out = df
    for c in columns:
        out = _set(out, F.col(c).like("%  %"), **{c: X.replace_once(c, "  ", " ")})
    return out


def strip_text_marker(df: DataFrame, column: str, marker: str, pattern: str) -> DataFrame:
    """``SET c = replace(c, marker, '') WHERE c LIKE pattern``."""
    return _set(df, F.col(column).like(pattern), **{column: X.replace_once(column, marker, "")})


def normalize_lowercase(df: DataFrame, *columns: str) -> DataFrame:
    out = df
    for c in columns:
        out = _set(out, F.col(c) != F.lower(F.col(c)), **{c: F.lower(F.col(c))})
    return out


# Trailing blanks per line, as ``sed 's/[[:space:]]*$//'`` sees them: only
# '\n' ends a line (UNIX_LINES), and [[:space:]] short of the newline itself.
TRAILING_WS = r"(?md)[ \t\x0B\f\r]+$"


def trim_trailing_whitespace(df: DataFrame, column: str, dry_run: bool = False) -> DataFrame:
    """Remove trailing whitespace on every line of a text column.  With
    ``dry_run`` only the rows that would change are returned, unchanged."""
    trimmed = F.regexp_replace(F.col(column), TRAILING_WS, "")
    if dry_run:
        return df.where(trimmed != F.col(column))
    return df.withColumn(column, trimmed)


# -- deletes ---------------------------------------------------------------------------
def delete_void_records(txn: DataFrame, descriptions=("void", "none")) -> DataFrame:
    zero = ((F.col("amount") == F.lit(0).cast("decimal(12,2)"))
            & (F.col("transaction_state") == "cleared")
            & F.col("description").isin(*descriptions) & (F.col("notes") == ""))
    return _delete(txn, zero)


def delete_orphans(links: DataFrame, txn: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Keep link rows whose transaction exists (delete the orphans)."""
    return links.join(J.by_rows(txn.select(key)), key, "left_semi")


def delete_images_and_unlink(txn: DataFrame, receipts: DataFrame,
                             n_bytes: int) -> dict[str, DataFrame]:
    """Delete receipts of a given byte length and NULL the references to
    them, both from the same snapshot."""
    doomed = receipts.where(X.byte_length("image") == n_bytes).select("receipt_image_id")
    flagged = J.in_subquery_flag(txn, "receipt_image_id", doomed, "receipt_image_id", "_tb_gone")
    new_txn = _set(flagged, F.col("_tb_gone"), receipt_image_id=None).select(*txn.columns)
    return {"t_transaction": new_txn,
            "t_receipt_image": receipts.join(doomed, "receipt_image_id", "left_anti")}


# -- inserts ---------------------------------------------------------------------------
def clone_for_next_year(txn: DataFrame, guid: str, as_of: str, days: int = 365,
                        reoccurring_type: str = "monthly") -> DataFrame:
    """Copy one transaction a year on: new key, new (deterministic) guid,
    date + ``days``, recurring type set, stamps ``as_of``.  Returns the new
    table (old rows plus the clone)."""
    src = txn.where(F.col("guid") == guid)
    clone = src.withColumn("transaction_date", X.plus_days("transaction_date", days))
    if "reoccurring_type" in txn.columns:
        clone = clone.withColumn("reoccurring_type", F.lit(reoccurring_type))
    return _append_clone(txn, clone, as_of)


def clone_zeroed(txn: DataFrame, guid: str, new_date: str, as_of: str) -> DataFrame:
    """Copy one transaction to ``new_date`` with amount 0.00."""
    clone = (txn.where(F.col("guid") == guid)
             .withColumn("transaction_date", X.lit_date(new_date))
             .withColumn("amount", F.lit(0).cast(S.MONEY)))
    return _append_clone(txn, clone, as_of)


def _append_clone(txn: DataFrame, clone: DataFrame, as_of: str) -> DataFrame:
    keyed = next_ids(clone.drop("transaction_id"), txn, "transaction_id", order_by=["guid"])
    keyed = keyed.withColumn("guid", X.guid_from(F.lit("clone"), F.col("guid"),
                                                 F.col("transaction_id")))
    for c in ("date_updated", "date_added"):
        if c in txn.columns:
            keyed = keyed.withColumn(c, X.lit_ts(as_of))
    return txn.unionByName(keyed.select(*txn.columns))


def deactivate_rare_descriptions(desc: DataFrame, txn: DataFrame, threshold: int) -> DataFrame:
    """Active descriptions used fewer than ``threshold`` times become inactive."""
    active = desc.where(F.col("active_status") == F.lit(True)).select(
        F.col("description_name").alias("description"))
    rare = (txn.groupBy("description").agg(F.count("description").alias("_tb_n"))
            .join(active, "description", "left_semi").where(F.col("_tb_n") < threshold)
            .select(F.col("description").alias("_tb_rare")))
    flagged = J.in_subquery_flag(desc, "description_name", rare, "_tb_rare", "_tb_hit")
    return _set(flagged, F.col("_tb_hit"), active_status=False).select(*desc.columns)


# -- payment account migration ----------------------------------------------------------
def backfill_destination(pay: DataFrame) -> DataFrame:
    cond = X.is_null_or_blank("destination_account") & F.col("account_name_owner").isNotNull()
    return _set(pay, cond, destination_account=F.col("account_name_owner"))


def remap_name_if_match(pay: DataFrame, acct: DataFrame, column: str) -> DataFrame:
    """Hyphen -> underscore in ``column`` only when the current name matches
    no account and the remapped one does (two existence tests)."""
    names = acct.select("account_name_owner")
    swapped = F.replace(F.col(column), F.lit("-"), F.lit("_"))
    flagged = J.in_subquery_flag(pay.withColumn("_tb_swapped", swapped), column, names,
                                 "account_name_owner", "_tb_now")
    flagged = J.in_subquery_flag(flagged, "_tb_swapped", names, "account_name_owner",
                                 "_tb_then")
    return _set(flagged, ~F.col("_tb_now") & F.col("_tb_then"),
                **{column: F.col("_tb_swapped")}).select(*pay.columns)


def migrate_payment_accounts(pay: DataFrame, acct: DataFrame) -> DataFrame:
    """Back-fill, lower-case, remap, then drop ``account_name_owner``."""
    out = backfill_destination(pay)
    out = _set(out, F.col("destination_account").isNotNull(),
               destination_account=F.lower("destination_account"))
    out = _set(out, F.col("source_account").isNotNull(), source_account=F.lower("source_account"))
    out = remap_name_if_match(out, acct, "destination_account")
    out = remap_name_if_match(out, acct, "source_account")
    return out.drop("account_name_owner")


# -- tenants -------------------------------------------------------------------------------
def backfill_owner(df: DataFrame, owner: str) -> DataFrame:
    """``SET owner = v WHERE owner IS NULL``; adds the column when absent."""
    if "owner" not in df.columns:
        df = df.withColumn("owner", F.lit(None).cast("string"))
    return _set(df, F.col("owner").isNull(), owner=owner)


def remap_owner(df: DataFrame, old: str, new: str) -> DataFrame:
    return _set(df, F.col("owner") == old, owner=new)


def force_owner(df: DataFrame, owner: str) -> DataFrame:
    """``SET owner = v WHERE owner IS NULL OR owner = '' OR owner != v``, with
    an ``owner_changed`` flag."""
    cond = F.col("owner").isNull() | (F.col("owner") == "") | (F.col("owner") != owner)
    return df.withColumn("owner_changed", F.coalesce(cond, F.lit(False))).withColumn(
        "owner", F.lit(owner))


def inherit_owner(links: DataFrame, txn: DataFrame, as_of: str) -> DataFrame:
    """Link rows take the owner of their transaction (NULL if none) and the
    insert stamps."""
    base = links.drop("owner") if "owner" in links.columns else links
    out = J.scalar_lookup(base, "transaction_id", txn, "transaction_id", "owner", "owner")
    return (out.withColumn("date_updated", X.lit_ts(as_of))
            .withColumn("date_added", X.lit_ts(as_of)))


# -- medical ----------------------------------------------------------------------------------
def sync_paid_amount(expense: DataFrame) -> DataFrame:
    if "paid_amount" not in expense.columns:
        expense = expense.withColumn("paid_amount", F.lit(0).cast(S.MONEY))
    return _set(expense, F.col("transaction_id").isNotNull(),
                paid_amount=F.col("patient_responsibility"))


def seed_self_members(family: DataFrame, acct: DataFrame) -> DataFrame:
    """New 'self' members for active accounts that are not yet the owner of
    a 'self' member (exact NOT IN semantics).  Returns the inserted rows with
    keys after the current maximum."""
    selves = family.where(F.col("relationship") == "self").select(
        F.col("owner").alias("_tb_self_owner"))
    names = J.not_in(acct.where(F.col("active_status") == F.lit(True))
                     .select("account_name_owner"), "account_name_owner", selves,
                     "_tb_self_owner").distinct()
    new = names.select(F.col("account_name_owner").alias("owner"),
                       F.col("account_name_owner").alias("member_name"),
                       F.lit("self").alias("relationship"))
    return next_ids(new, family, "family_member_id", order_by=["owner"])


def insert_rows_unique(df: DataFrame, new_rows: DataFrame, key: list[str],
                       id_col: str) -> DataFrame:
    """INSERT that skips rows whose unique key already exists.  New keys follow
    the current max.  A key repeated within the batch breaks the unique rule,
    so the job fails, as the insert would."""
    fresh = J.assert_unique(new_rows.join(df.select(*key), key, "left_anti"), key)
    keyed = next_ids(fresh, df, id_col, order_by=key)
    return df.unionByName(keyed, allowMissingColumns=True)


def stamp(df: DataFrame, as_of: str, *columns: str) -> DataFrame:
    """Trigger bodies: set the given timestamp columns to ``as_of``."""
    out = df
    for c in columns:
        out = out.withColumn(c, X.lit_ts(as_of))
    return out


def stamp_insert(df: DataFrame, as_of: str) -> DataFrame:
    return stamp(df, as_of, "date_added", "date_updated")


def stamp_update(df: DataFrame, as_of: str) -> DataFrame:
    return stamp(df, as_of, "date_updated")


def apply_defaults(df: DataFrame, table: str, as_of: str | None = None) -> DataFrame:
    """Conform rows to the table schema: absent columns take the declared
    default (epoch or, where the schema says now(), ``as_of``), present columns
    are cast to the declared type, schema order.  An absent NOT NULL column
    without default raises, unless it is a generated key."""
    schema = S.SCHEMAS[table]
    defaults = S.DEFAULTS.get(table, {})
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif f.name in defaults:
            cols.append(F.lit(defaults[f.name]).cast(f.dataType).alias(f.name))
        elif f.name in S.NOW_DEFAULT_COLUMNS.get(table, ()):
            cols.append(X.lit_ts(as_of or "1970-01-01 00:00:00").cast(f.dataType).alias(f.name))
        elif f.name in S.EPOCH_DEFAULT_COLUMNS:
            cols.append(X.lit_ts("1970-01-01 00:00:00").cast(f.dataType).alias(f.name))
        elif not f.nullable and f.name not in S.PRIMARY_KEY.get(table, ()):
            raise ValueError(f"{table}.{f.name} is NOT NULL and has no default")
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


# -- references -------------------------------------------------------------------------------
def cascade_update(child: DataFrame, child_cols: list[str], mapping: DataFrame,
                   old_cols: list[str], new_cols: list[str]) -> DataFrame:
    """ON UPDATE CASCADE: child references follow a parent key change given as
    a mapping (old key -> new key, unique on old)."""
    m = J.assert_unique(mapping, old_cols).select(
        *[F.col(o).alias(f"_tb_o{i}") for i, o in enumerate(old_cols)],
        *[F.col(n).alias(f"_tb_n{i}") for i, n in enumerate(new_cols)],
        F.lit(True).alias("_tb_hit"))
    left, m, cond = J.spread_nulls(child, child_cols, m, [f"_tb_o{i}" for i in range(len(child_cols))])
    out = left.join(m, cond, "left")
    for i, c in enumerate(child_cols):
        out = out.withColumn(c, F.when(F.col("_tb_hit"), F.col(f"_tb_n{i}")).otherwise(F.col(c)))
    return out.select(*child.columns)


def cascade_delete(child: DataFrame, child_key: str, deleted_parents: DataFrame,
                   parent_key: str) -> DataFrame:
    """ON DELETE CASCADE: child rows of deleted parents go too."""
    gone = deleted_parents.select(F.col(parent_key).alias("_tb_gone"))
    return child.join(gone, F.col(child_key) == F.col("_tb_gone"), "left_anti")


def restrict_delete(child: DataFrame, child_key: str, doomed_parents: DataFrame,
                    parent_key: str) -> DataFrame:
    """ON DELETE RESTRICT: per parent key about to be deleted, the number of
    child rows that block it (only blocked keys are listed)."""
    doomed = doomed_parents.select(F.col(parent_key).alias(child_key))
    return (child.join(doomed, child_key, "left_semi").groupBy(child_key)
            .agg(F.count(F.lit(1)).alias("blocking_rows")))


def prune_expired_tokens(tokens: DataFrame, as_of: str) -> DataFrame:
    """Drop tokens whose expiry is before ``as_of``."""
    return tokens.where(F.col("expires_at") >= X.lit_ts(as_of))


def allocate_keys(rows: DataFrame, existing: DataFrame, id_col: str, order_by: list[str],
                  new_col: str = "new_id") -> DataFrame:
    """Keys for ``rows`` after ``max(existing.id_col)`` in ``order_by`` order."""
    top = existing.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("long").alias("_tb_top"))
    base = rows.crossJoin(F.broadcast(top))
    out = sequential_ids(base, order_by, new_col, start=F.col("_tb_top") + F.lit(1))
    return out.drop("_tb_top")
