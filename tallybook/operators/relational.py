"""Generic filter / projection / aggregate / sort / union operators.

Thin, typed spellings of the SQL shapes the ledger queries use, with the
PostgreSQL NULL rules spelled out.  All are lazy DataFrame transformations;
predicates are plain Catalyst expressions, so they push down into the
parquet scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expr as X


# -- 2.2 filters and projections -----------------------------------------------
def filter_eq_and(df: DataFrame, **equals) -> DataFrame:
    """``WHERE a = x AND b = y ...`` (NULL never equals)."""
    cond = reduce(lambda a, b: a & b, [F.col(k) == F.lit(v) for k, v in equals.items()])
    return df.where(cond)


def filter_ne(df: DataFrame, column: str, value) -> DataFrame:
    """``WHERE c != v``: rows where c is NULL drop out."""
    return df.where(F.col(column) != F.lit(value))


def filter_or(df: DataFrame, *conjunctions: Column) -> DataFrame:
    """``A AND B OR C AND D``: AND binds tighter; pass each conjunction."""
    return df.where(reduce(lambda a, b: a | b, conjunctions))


def filter_in_list(df: DataFrame, column: str, values) -> DataFrame:
    return df.where(F.col(column).isin(*values))


def filter_like(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """SQL LIKE; without ``%`` it is an equality test."""
    return df.where(F.col(column).like(pattern))


def filter_regex(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """POSIX ``~``; use ``\\A..\\z`` anchors (see ``functions.expr``)."""
    return df.where(X.anchored_match(column, pattern))


def filter_date_range(df: DataFrame, column: str, after: str, before: str) -> DataFrame:
    """Open range ``after < c < before``."""
    return df.where((F.col(column) > X.lit_date(after)) & (F.col(column) < X.lit_date(before)))


def filter_between(df: DataFrame, column: str, low, high) -> DataFrame:
    return df.where(F.col(column).between(low, high))


def filter_between_symmetric(df: DataFrame, column: str, a, b) -> DataFrame:
    return df.where(X.between_symmetric(column, a, b))


def filter_null_or_blank(df: DataFrame, column: str, other_value: str | None = None) -> DataFrame:
    """``c IS NULL OR btrim(c) = ''`` and optionally ``OR c != v``."""
    cond = X.is_null_or_blank(column)
    if other_value is not None:
        cond = cond | (F.col(column) != F.lit(other_value))
    return df.where(cond)


def project_const(df: DataFrame, const, name: str, *columns: Column | str) -> DataFrame:
    """A literal first column followed by computed columns."""
    return df.select(F.lit(const).alias(name), *columns)


def distinct_rows(df: DataFrame, *columns: str) -> DataFrame:
    return (df.select(*columns) if columns else df).distinct()


def exists_probe(df: DataFrame) -> DataFrame:
    """``SELECT 1 FROM t LIMIT 1``: one row if the table is readable and non-empty.
    The limit is the feature (an accessibility probe)."""
    return df.select(F.lit(1).alias("probe")).limit(1)


# -- 2.4 aggregation -------------------------------------------------------------
def agg_group(df: DataFrame, keys: list[str | Column], measures: list[Column],
              having: Column | None = None) -> DataFrame:
    out = df.groupBy(*keys).agg(*measures)
    return out.where(having) if having is not None else out


def agg_global(df: DataFrame, measures: list[Column], having: Column | None = None) -> DataFrame:
    """Aggregate with no GROUP BY: always one row, or none under HAVING."""
    out = df.agg(*measures)
    return out.where(having) if having is not None else out


def max_plus_one(df: DataFrame, column: str, alias: str = "next_id") -> DataFrame:
    """``COALESCE(MAX(id), 0) + 1``: the next key, 1 for an empty table."""
    return df.agg((F.coalesce(F.max(column), F.lit(0)) + 1).cast("long").alias(alias))


def max_or_one(df: DataFrame, column: str, alias: str = "seq_value") -> DataFrame:
    """``COALESCE(MAX(id), 1)``: the sequence value set after a restore."""
    return df.agg(F.coalesce(F.max(column), F.lit(1)).cast("long").alias(alias))


# -- 2.5 sort / union --------------------------------------------------------------
def sort_by(df: DataFrame, keys: list[str], ascending: bool | list[bool] = True) -> DataFrame:
    return df.orderBy(*keys, ascending=ascending)


def union_tree(dfs: list[DataFrame], by_name: bool = True) -> DataFrame:
    """UNION ALL of many frames as a balanced tree: each union re-analyses
    its inputs, so a left-deep fold costs O(n^2) analysis, a tree O(n log n)."""
    if not dfs:
        raise ValueError("nothing to union")
    level = list(dfs)
    while len(level) > 1:
        nxt = []
        for i in range(0, len(level) - 1, 2):
            a, b = level[i], level[i + 1]
            nxt.append(a.unionByName(b) if by_name else a.union(b))
        if len(level) % 2:
            nxt.append(level[-1])
        level = nxt
    return level[0]


def union_all(dfs: list[DataFrame], labels: list[str] | None = None,
              label_col: str = "label") -> DataFrame:
    """UNION ALL by column name (no dedup), optionally tagging each branch."""
    if labels is not None:
        dfs = [d.select(F.lit(lbl).alias(label_col), *d.columns) for d, lbl in zip(dfs, labels)]
    return union_tree(dfs)
