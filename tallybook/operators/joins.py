"""Join operators: semi / anti / NOT IN / update-from / scalar lookups.

Strategy is left to Catalyst and AQE: a side is broadcast only when its
estimated size is under ``spark.sql.autoBroadcastJoinThreshold``; otherwise
both sides shuffle on the key and AQE splits skewed partitions.  The estimate
is one of file sizes, which a column that compresses well keeps small however
many rows it has, so the keys of a data-sized table are joined ``by_rows``.
The only explicit broadcasts here are of 1-row aggregates.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def semi_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """``WHERE key IN (SELECT ..)`` / ``EXISTS (correlated)``."""
    return left.join(right, on, "left_semi")


def anti_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """``NOT EXISTS (correlated)``: NULL keys never match, so they are kept."""
    return left.join(right, on, "left_anti")


#: a side may be broadcast by its estimate if the files behind it are within this part of the threshold
_PACKED = 8


def by_rows(df: DataFrame) -> DataFrame:
    """``df`` as the side of a join that is broadcast only if it is small however its files are packed.

    The planner estimates a side as the share its columns have in the size of the files, which for keys
    that compress well is a small part of their rows, and a broadcast passes whole through the driver.
    So a side read from more than a small part of the threshold, all columns counted, is merged."""
    most = int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return df if size * _PACKED <= most else df.hint("merge")


def left_join_orphans(child: DataFrame, parent: DataFrame, child_key: str,
                      parent_key: str) -> DataFrame:
    """``LEFT JOIN parent ON .. WHERE parent.key IS NULL`` -- an anti join."""
    p = parent.select(F.col(parent_key).alias("_tb_pk")).where(F.col("_tb_pk").isNotNull())
    return child.join(by_rows(p), F.col(child_key) == F.col("_tb_pk"), "left_anti")


def spread_nulls(left: DataFrame, left_keys: list[str], right: DataFrame,
                 right_keys: list[str]) -> tuple[DataFrame, DataFrame, Column]:
    """Both sides with a join column that spreads left rows with a NULL key over
    all partitions (they match nothing, but would all hash to one partition),
    and the join condition.  Equal keys have equal join columns; where the key
    types differ the sides are left as they are."""
    on = reduce(lambda a, b: a & b, [F.col(a) == F.col(b)
                                     for a, b in zip(left_keys, right_keys, strict=True)])
    if any(left.schema[a].dataType != right.schema[b].dataType
           for a, b in zip(left_keys, right_keys)):
        return left, right, on
    null = reduce(lambda a, b: a | b, [F.col(a).isNull() for a in left_keys])
    left = left.withColumn("_tb_at", F.when(null, F.xxhash64(*left.columns))
                           .otherwise(F.xxhash64(*left_keys)))
    right = right.withColumn("_tb_to", F.xxhash64(*right_keys))
    return left, right, on & (F.col("_tb_at") == F.col("_tb_to"))


def in_subquery_flag(df: DataFrame, key: str, sub: DataFrame, sub_key: str,
                     flag: str) -> DataFrame:
    """Add ``flag`` = ``key IN (SELECT sub_key FROM sub)`` for positive use
    (inside an OR, or as an UPDATE condition): TRUE on a match, else FALSE
    (where SQL would give NULL or FALSE, which a WHERE treats alike).

    A left join against the DISTINCT subquery keys (map-side de-duplicated),
    so every left row is kept exactly once; unlike an existence join it is
    eligible for AQE skew splitting when one key holds many left rows, and
    AQE still turns it into a broadcast join when the key side is small.
    """
    keys = (sub.select(F.col(sub_key).alias("_tb_sq_key")).where(F.col("_tb_sq_key").isNotNull())
            .distinct().withColumn("_tb_sq_hit", F.lit(True)))
    left, keys, on = spread_nulls(df, [key], keys, ["_tb_sq_key"])
    return (left.join(keys, on, "left")
            .withColumn(flag, F.coalesce(F.col("_tb_sq_hit"), F.lit(False)))
            .drop("_tb_sq_key", "_tb_sq_hit", "_tb_at", "_tb_to"))


def not_in(outer: DataFrame, key: str, inner: DataFrame, inner_key: str) -> DataFrame:
    """``WHERE key NOT IN (SELECT inner_key FROM inner)`` with SQL NULL rules,
    without a null-aware broadcast of the inner side.

    * inner empty -> every outer row (NULL keys included);
    * inner has a NULL -> no row;
    * else -> outer rows with a non-NULL key that matches no inner key.

    The inner side is reduced to a 1-row (count, has_null) aggregate, joined by
    broadcast (size bound: one row), plus a plain anti join on the key, which
    scales like any shuffle join.
    """
    ik = inner.select(F.col(inner_key).alias("_tb_ik"))
    stats = ik.agg(F.count(F.lit(1)).alias("_tb_n"),
                   F.max(F.col("_tb_ik").isNull().cast("int")).alias("_tb_nulls"))
    kept = outer.join(ik.where(F.col("_tb_ik").isNotNull()),
                      F.col(key) == F.col("_tb_ik"), "left_anti")
    return (kept.crossJoin(F.broadcast(stats))
            .where((F.col("_tb_n") == 0)
                   | ((F.col("_tb_nulls") == 0) & F.col(key).isNotNull()))
            .drop("_tb_n", "_tb_nulls"))


def one_row(df: DataFrame) -> DataFrame:
    """``df`` if it has at most one row; more rows fail the job.  An aggregate
    without keys, so what is broadcast is one row whatever the caller passes."""
    held = df.agg(F.count(F.lit(1)).alias("_tb_rows"), *[F.first(c).alias(c) for c in df.columns])
    return held.where(F.when(F.col("_tb_rows") > 1,
                             F.raise_error(F.lit("more than one row")).cast("boolean"))
                      .otherwise(F.col("_tb_rows") == 1)).drop("_tb_rows")


def cross_join_scalars(*scalars: DataFrame) -> DataFrame:
    """Cartesian product of 1-row aggregates (``FROM (..) A, (..) B``)."""
    out = one_row(scalars[0])
    for df in scalars[1:]:
        out = out.crossJoin(F.broadcast(one_row(df)))
    return out


def assert_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Return ``df`` with a guard that fails the job if ``keys`` repeat.

    The guard is lazy: a 1-row duplicate count joined in and raised on with
    ``raise_error`` when a lookup side would multiply rows.
    """
    dup = (df.groupBy(*keys).count().where(F.col("count") > 1)
           .agg(F.count(F.lit(1)).alias("_tb_dups")))
    guard = F.when(F.col("_tb_dups") > 0,
                   F.raise_error(F.lit(f"lookup key {keys} is not unique")))
    # a filter (not a projected column) so column pruning cannot drop it
    return df.crossJoin(F.broadcast(dup)).where(guard.isNull()).drop("_tb_dups")


def update_from_join(target: DataFrame, lookup: DataFrame, keys: list[str],
                     set_cols: dict[str, str]) -> DataFrame:
    """``UPDATE target SET c = x.c FROM lookup x WHERE target.k = x.k``.

    Unmatched rows keep their values.  ``lookup`` must be unique on ``keys``
    (PostgreSQL would pick an arbitrary match); duplicates raise.
    """
    renamed = assert_unique(lookup, keys).select(*keys, *[F.col(src).alias(f"_tb_new_{dst}")
                                     for dst, src in set_cols.items()])
    renamed = renamed.withColumn("_tb_hit", F.lit(True))
    joined = target.join(renamed, keys, "left")
    out = joined
    for dst in set_cols:
        out = out.withColumn(dst, F.when(F.col("_tb_hit"), F.col(f"_tb_new_{dst}"))
                             .otherwise(F.col(dst)))
    return out.select(*target.columns)


def scalar_lookup(df: DataFrame, key: str, lookup: DataFrame, lookup_key: str,
                  value: str, alias: str) -> DataFrame:
    """Correlated scalar subquery ``(SELECT value FROM lookup WHERE k = key)``
    as a left join; NULL when no row matches.  Two matches raise, as the
    subquery would."""
    sub = assert_unique(lookup.where(F.col(lookup_key).isNotNull()), [lookup_key]).select(
        F.col(lookup_key).alias("_tb_lk"), F.col(value).alias(alias))
    left, sub, on = spread_nulls(df, [key], sub, ["_tb_lk"])
    return left.join(sub, on, "left").drop("_tb_lk", "_tb_at", "_tb_to")
