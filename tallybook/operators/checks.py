"""Integrity checks: declared rules turned into violation queries.

A ``Rule`` is data (kind, table, columns, parameters).  Row-level kinds
compile to one boolean Column that is TRUE, FALSE or NULL exactly like the
CHECK constraint, and a row violates the rule only when it is FALSE (CHECK
passes on NULL).  Set-level kinds (``unique``, ``foreign_key``) compile to an
aggregate or an anti join.

Two outputs:

* ``violations(df, rules)`` -> ``[rule, table, key, detail]``, one row per
  offending row (per duplicated key for ``unique``);
* ``summary(tables, rules)`` -> ``[rule, table, severity, violations]``.

Per table, all row-level rules run in ONE scan.  Each set of key columns is one
aggregate over those columns (map-side combined, so a hot key shrinks before
the shuffle), shared by every uniqueness rule and, in the summary, by every
reference on them, which anti-joins those keys with the parents' keys.  The
summary shuffles whole keys of uniqueness rules only where a hash of them repeats.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expr as X
from . import joins as J
from .cascade import _kept, _seen
from .relational import union_tree

ROW_KINDS = ("not_null", "domain", "lowercase", "not_empty", "regex", "min_length",
             "max_length", "max_bytes", "range", "exclusive", "non_negative",
             "sum_consistency", "not_future", "numeric_fits")
SET_KINDS = ("unique", "foreign_key")


@dataclass(frozen=True)
class Rule:
    name: str
    table: str
    kind: str
    columns: tuple[str, ...]
    values: tuple = ()                       # domain values / (low, high) / (precision, scale)
    pattern: str | None = None               # regex
    limit: int | None = None                 # length / bytes / exclusive max
    ref_table: str | None = None             # foreign key parent
    ref_columns: tuple[str, ...] = ()
    severity: str = "error"
    note: str = field(default="", compare=False)

    def applies_to(self, df: DataFrame) -> bool:
        return all(c in df.columns for c in self.columns)


# -- row-level rules ----------------------------------------------------------------
def ok_expr(rule: Rule, as_of=None) -> Column:
    """The CHECK expression: TRUE / NULL pass, FALSE fails."""
    cols = [F.col(c) for c in rule.columns]
    c0 = cols[0]
    k = rule.kind
    if k == "not_null":
        return reduce(lambda a, b: a & b, [c.isNotNull() for c in cols])
    if k == "domain":
        return c0.isin(*rule.values)
    if k == "lowercase":
        return c0 == F.lower(c0)
    if k == "not_empty":
        return X.trimmed_length(c0) > 0
    if k == "regex":
        return c0.rlike(rule.pattern)
    if k == "min_length":
        return F.length(c0) >= rule.limit
    if k == "max_length":
        return F.length(c0) <= rule.limit
    if k == "max_bytes":
        return X.byte_length(c0) <= rule.limit
    if k == "range":
        return c0.between(rule.values[0], rule.values[1])
    if k == "exclusive":
        return X.flag_count(*[c.isNotNull() for c in cols]) <= rule.limit
    if k == "non_negative":
        return reduce(lambda a, b: a & b, [c >= 0 for c in cols])
    if k == "sum_consistency":
        return c0 >= reduce(lambda a, b: a + b, cols[1:])
    if k == "not_future":
        bound = (X.lit_date(as_of) if isinstance(as_of, str) and len(as_of) == 10
                 else F.to_date(X.as_of_or_now(as_of)))
        return c0 <= bound
    if k == "numeric_fits":
        return X.fits_numeric(c0, *rule.values)
    raise ValueError(f"not a row-level rule kind: {k}")


@lru_cache(maxsize=4096)
def violated(rule: Rule, as_of=None) -> Column:
    """TRUE exactly when the rule fails (NULL in a CHECK passes).

    Memoised: a rule's expression is a pure function of the rule and is
    reused by every check query that evaluates it (a Column is an unresolved
    expression, not bound to any DataFrame)."""
    if rule.kind == "not_null":
        return ~ok_expr(rule)
    return F.coalesce(~ok_expr(rule, as_of), F.lit(False))


#: column of a judged table: one bit for each row rule that the row breaks
BROKEN = "_tb_broken"


def broken_bits(rules, as_of=None) -> Column:
    """The broken ones of ``rules`` (up to 63 (position, rule) pairs) as bits of a long."""
    return reduce(lambda a, b: a.bitwiseOR(b), [F.when(violated(r, as_of), F.lit(1 << i)).otherwise(F.lit(0)).cast("long")
                                                for i, r in rules], F.lit(0).cast("long"))


def has_bit(i: int) -> Column:
    return F.col(BROKEN).bitwiseAND(F.lit(1 << i).cast("long")) != 0


def _key(df: DataFrame, key_cols) -> Column:
    cols = [c for c in key_cols if c in df.columns] or list(df.columns[:1])
    return _key_cols(tuple(cols))


@lru_cache(maxsize=4096)
def _key_cols(cols: tuple) -> Column:
    return F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in cols])


@lru_cache(maxsize=4096)
def _detail_cols(columns: tuple) -> Column:
    return F.concat_ws(", ", *[F.concat(F.lit(f"{c}="),
                                        F.coalesce(F.col(c).cast("string"), F.lit("NULL")))
                               for c in columns])


def _detail(columns) -> Column:
    return _detail_cols(tuple(columns))


def _shape(df: DataFrame, rule: Rule, key: Column, detail: Column) -> DataFrame:
    return df.select(F.lit(rule.name).alias("rule"), F.lit(rule.table).alias("table"),
                     key.alias("key"), detail.alias("detail"))


# -- set-level rules ----------------------------------------------------------------
def _key_counts(df: DataFrame, key_sets) -> dict[tuple[str, ...], DataFrame]:
    """Rows per key (``_tb_n``) for several key column sets of ONE table.

    Each set is its own aggregate over its own columns (map-side combined), so
    no row is copied per set.  A set that lacks one column of another one is
    rolled up from that one's groups: both read the same shuffle, not the table.
    """
    out: dict[tuple[str, ...], DataFrame] = {}
    for ks in sorted({tuple(k) for k in key_sets}, key=lambda k: (-len(k), k)):
        finer = next((s for s in out if len(s) == len(ks) + 1 and set(ks) < set(s)), None)
        if finer:
            out[ks] = out[finer].groupBy(*ks).agg(F.sum("_tb_n").alias("_tb_n"))
        else:
            out[ks] = df.groupBy(*ks).agg(F.count(F.lit(1)).alias("_tb_n"))
    return out


def _may_repeat(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Rows without a NULL in ``columns`` whose values may come more than once: all that do, and few others.

    Only 40 bits of a hash of the key are shuffled to find them; those that repeat are written, and a bitmap
    of them keeps the other rows from any shuffle.  Where too many repeat for a bitmap, all rows stay.
    """
    hashed = df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])).withColumn(
        "_tb_hash", F.shiftrightunsigned(F.xxhash64(*columns), 24))
    twice, n = _kept(hashed.groupBy("_tb_hash").agg(F.count(F.lit(1)).alias("_tb_n")).where("_tb_n >= 2").select("_tb_hash"),
                     "repeated-" + "-".join(columns))
    seen = _seen(hashed, ["_tb_hash"], twice, n)
    return hashed if seen is None else seen.where("_tb_seen")


def _repeat_counts(df: DataFrame, key_sets) -> dict[tuple[str, ...], DataFrame]:
    """Rows per key (``_tb_n``) of at least the keys that repeat, for several sets of ONE table.  Rows that
    repeat in a set repeat in each part of it, so a set is counted on the rows its smallest part leaves.
    A single column of fixed width that is part of no other set is no wider than its hash: counted at once."""
    sets = sorted({tuple(k) for k in key_sets}, key=lambda k: (len(k), k))
    rows: dict[tuple[str, ...], DataFrame] = {}
    out: dict[tuple[str, ...], DataFrame] = {}
    for ks in sets:
        part = next((s for s in rows if set(s) <= set(ks)), None)
        if part is None:
            narrow = len(ks) == 1 and df.schema[ks[0]].dataType.typeName() not in ("string", "binary")
            alone = not any(set(ks) < set(s) for s in sets)
            rows[ks], part = df if narrow and alone else _may_repeat(df, ks), ks
        out[ks] = rows[part].groupBy(*ks).agg(F.count(F.lit(1)).alias("_tb_n"))
    return out


@lru_cache(maxsize=4096)
def _groups_with(cols: tuple, least: int) -> Column:
    """Groups of at least ``least`` rows without a NULL in the key.  One
    predicate on the count, which stays above the aggregate: a filter on the
    key alone would be pushed below it, and no two sets could share a shuffle."""
    nn = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    return F.when(nn, F.col("_tb_n") >= least).otherwise(False)


def unique_groups(df: DataFrame, rules) -> DataFrame:
    """Duplicated keys of several uniqueness rules of one table:
    ``[rule, key, _tb_n]`` with ``key`` the comma-joined key values."""
    counts = _key_counts(df, [r.columns for r in rules])
    return union_tree([
        counts[tuple(r.columns)].where(_groups_with(tuple(r.columns), 2))
        .select(F.lit(r.name).alias("rule"), _key_cols(tuple(r.columns)).alias("key"), "_tb_n")
        for r in rules])


def _loose_keys(child: DataFrame, rule: Rule, parent: DataFrame) -> DataFrame:
    """Rows or key groups of one reference, those with a NULL too, that have no parent row: the
    child's keys anti-joined, in their own types, with the parent's key columns."""
    p = parent.select(*[F.col(c).alias(f"_tb_p{i}") for i, c in enumerate(rule.ref_columns)])
    on = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_tb_p{i}")
                                     for i, c in enumerate(rule.columns)])
    return child.join(J.by_rows(p), on, "left_anti")


def orphan_keys(rules, parents, counts) -> dict[str, DataFrame]:
    """Rule name -> key groups (``_tb_n``) of its orphans, for the references of ONE table; ``counts`` has the
    groups of the key sets that no wider reference covers.  A row without a parent by some columns has none by
    more of them either, so a reference that another one extends is checked on that one's loose keys alone."""
    loose: dict[str, DataFrame] = {}
    for r in sorted(rules, key=lambda r: -len(r.columns)):
        wider = _wider(r, rules)
        groups = (loose[wider.name].groupBy(*r.columns).agg(F.sum("_tb_n").alias("_tb_n")) if wider
                  else counts[tuple(r.columns)])
        loose[r.name] = _loose_keys(groups, r, parents[r.ref_table])
    return {r.name: loose[r.name].where(_groups_with(tuple(r.columns), 1)) for r in rules}


def _wider(rule: Rule, rules) -> Rule | None:
    """The reference among ``rules`` to the same parent with least columns more than ``rule``."""
    pairs = lambda r: set(zip(r.columns, r.ref_columns, strict=True))
    found = [r for r in rules if r.ref_table == rule.ref_table and pairs(rule) < pairs(r)]
    return min(found, key=lambda r: len(r.columns), default=None)


def fk_violations(child: DataFrame, parent: DataFrame, rule: Rule, key_cols) -> DataFrame:
    """Offending child rows of one reference: those without a NULL in the key that have no parent row.

    One anti join of the child's rows, cut to the columns shown, with the parent's
    key columns.  Both sides are plain shuffles, so adaptive execution splits a hot
    key; no set of keys that grows with the data is broadcast.
    """
    nn = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in rule.columns])
    orphans = _loose_keys(child.where(nn), rule, parent)
    return _shape(orphans, rule, _key(orphans, key_cols), _detail(rule.columns))


# -- drivers --------------------------------------------------------------------------
def _table(tables, name):
    return tables[name] if isinstance(tables, dict) else getattr(tables, name)


def _missing(tables, rule: Rule) -> str | None:
    """Tables or columns that ``rule`` needs and that are absent; None if it can run."""
    gone = []
    for name, columns in ((rule.table, rule.columns), (rule.ref_table, rule.ref_columns)):
        if name is None:
            continue
        try:
            have = tables.columns_of(name) if hasattr(type(tables), "columns_of") else _table(tables, name).columns
        except (KeyError, AttributeError):
            gone.append(name)
            continue
        gone += [f"{name}.{c}" for c in columns if c not in have]
    return ", ".join(gone) or None


def _split(tables, rules) -> tuple[list[Rule], list[tuple[Rule, str]]]:
    """Rules that can run, and those that cannot with what they lack."""
    found = [(r, _missing(tables, r)) for r in rules]
    return [r for r, gone in found if not gone], [(r, gone) for r, gone in found if gone]


def _session(tables, rules) -> SparkSession:
    for r in rules:
        try:
            return _table(tables, r.table).sparkSession
        except (KeyError, AttributeError):
            continue
    return SparkSession.active()


def fused_row_violations(df: DataFrame, table: str, rules, key_cols, as_of=None) -> DataFrame:
    """All row-level rules of one table in ONE scan.

    Rows that break no rule are dropped by a single OR predicate; the rest
    carry an array of (rule, detail) structs for the rules they break, which
    is exploded into one output row per (row, rule).
    """
    def detail(r: Rule) -> Column:
        # bytes are shown by their length only; where the rule is NOT NULL there are none
        cols = [c for c in r.columns if r.kind == "not_null" or df.schema[c].dataType.typeName() != "binary"]
        return _detail(cols) if cols else F.concat(
            F.lit("bytes="), X.byte_length(r.columns[0]).cast("string"))

    flags = [violated(r, as_of) for r in rules]
    tagged = F.array(*[F.when(f, F.struct(F.lit(r.name).alias("rule"), detail(r).alias("detail")))
                       for f, r in zip(flags, rules)])
    hit = df.where(reduce(lambda a, b: a | b, flags)).select(
        _key(df, key_cols).alias("key"),
        F.explode(F.filter(tagged, lambda x: x.isNotNull())).alias("_tb_v"))
    return hit.select(F.col("_tb_v.rule").alias("rule"), F.lit(table).alias("table"), "key",
                      F.col("_tb_v.detail").alias("detail"))


def violations(tables, rules, key_cols: dict[str, tuple[str, ...]], as_of=None) -> DataFrame:
    """``[rule, table, key, detail]`` for every rule that applies.

    Row-level rules are fused per table (one scan each); every unique key and
    reference is one aggregate / anti join.  A rule whose table or columns are
    absent gives one row without key that says what it lacks.
    """
    parts = []
    row_rules: dict[str, list[Rule]] = {}
    uniq: dict[str, list[Rule]] = {}
    able, unable = _split(tables, rules)
    if unable:
        parts.append(_session(tables, rules).createDataFrame(
            [(r.name, r.table, None, f"not evaluated: {gone} missing") for r, gone in unable],
            "rule string, table string, key string, detail string"))
    for r in able:
        df = _table(tables, r.table)
        keys = key_cols.get(r.table, ())
        if r.kind == "unique":
            uniq.setdefault(r.table, []).append(r)
        elif r.kind == "foreign_key":
            parts.append(fk_violations(df, _table(tables, r.ref_table), r, keys))
        else:
            row_rules.setdefault(r.table, []).append(r)
    for tname, rs in row_rules.items():
        parts.append(fused_row_violations(_table(tables, tname), tname, rs,
                                          key_cols.get(tname, ()), as_of))
    for tname, rs in uniq.items():
        parts.append(unique_groups(_table(tables, tname), rs).select(
            "rule", F.lit(tname).alias("table"), "key",
            F.concat(F.lit("count="), F.col("_tb_n").cast("string")).alias("detail")))
    if not parts:
        raise ValueError("no rules are given")
    return union_tree(parts)


def summary(tables, rules, as_of=None) -> DataFrame:
    """``[rule, table, severity, violations]`` for every rule; ``violations`` is
    NULL and the severity ``error`` for a rule whose table or columns are absent.

    Per table: ONE scan evaluates every row-level rule (conditional counts,
    unpivoted); one aggregate per set of key columns serves every reference on
    it, and one over the keys that may repeat every uniqueness rule; each
    reference then anti-joins its pre-aggregated keys with the parent's key
    columns.  Tables that can judge their rows (``judged``) hand out key
    columns and the rules each row breaks, instead of whole rows.
    """
    row: dict[str, list[Rule]] = {}
    keyed: dict[str, list[Rule]] = {}
    able, unable = _split(tables, rules)
    needed: dict[str, dict[str, None]] = {}
    for r in able:
        (keyed if r.kind in SET_KINDS else row).setdefault(r.table, []).append(r)
        for name, columns in ((r.table, r.columns), (r.ref_table, r.ref_columns)):
            if name is not None:
                needed.setdefault(name, {}).update(dict.fromkeys(columns if r.kind in SET_KINDS else ()))
    judged = tables.judged if hasattr(type(tables), "judged") else lambda *_: None
    frames: dict[str, DataFrame] = {}
    for name, columns in needed.items():
        df = judged(name, tuple(columns), tuple(row.get(name, ())), as_of)
        frames[name] = _table(tables, name) if df is None else df

    def broken(tname: str, i: int, r: Rule) -> Column:
        return has_bit(i) if BROKEN in frames[tname].columns else violated(r, as_of)

    def shape(counts: DataFrame, tname: str, rs: list[Rule], prefix: str) -> DataFrame:
        # unpivot the per-rule counts: (rule, severity, violations) + table
        stacked = ", ".join(f"'{r.name}', '{r.severity}', {prefix}{i}" for i, r in enumerate(rs))
        return counts.selectExpr(f"stack({len(rs)}, {stacked}) as (rule, severity, violations)",
                                 f"'{tname}' as table")

    parts: list[DataFrame] = []
    if unable:
        parts.append(_session(tables, rules).createDataFrame(
            [(r.name, "error", None, r.table) for r, _ in unable],
            "rule string, severity string, violations long, table string"))
    for tname, rs in row.items():
        counts = frames[tname].agg(*[F.count(F.when(broken(tname, i, r), 1)).alias(f"c{i}")
                                     for i, r in enumerate(rs)])
        parts.append(shape(counts, tname, rs, "c"))
    for tname, rs in keyed.items():
        # duplicated keys (unique rules) and orphan keys (references), both
        # as [rule, _tb_n], counted in one aggregate per table
        refs, uniq = [r for r in rs if r.kind == "foreign_key"], [r for r in rs if r.kind == "unique"]
        groups = _key_counts(frames[tname], [r.columns for r in refs if not _wider(r, refs)])
        orphans = orphan_keys(refs, frames, groups)
        repeats = _repeat_counts(frames[tname], [r.columns for r in uniq if tuple(r.columns) not in groups])
        hit = union_tree([
            ((repeats | groups)[tuple(r.columns)].where(_groups_with(tuple(r.columns), 2))
             .select(F.lit(i).alias("rule"), F.lit(1).cast("long").alias("_tb_n"))
             if r.kind == "unique" else orphans[r.name].select(F.lit(i).alias("rule"), "_tb_n"))
            for i, r in enumerate(rs)])
        counts = hit.agg(*[F.coalesce(F.sum(F.when(F.col("rule") == i, F.col("_tb_n"))), F.lit(0))
                           .alias(f"k{i}") for i in range(len(rs))])
        parts.append(shape(counts, tname, rs, "k"))
    return union_tree(parts)


def verdict(summary_df: DataFrame) -> DataFrame:
    """Roll-up of a summary: one row with error / warning / passed counts and
    the verdict PASSED, PASSED WITH WARNINGS or FAILED.  A rule that could not
    be evaluated counts as an error."""
    failed = F.col("violations").isNull() | (F.col("violations") > 0)
    agg = summary_df.agg(
        F.count(F.when(failed & (F.col("severity") == "error"), 1)).alias("errors"),
        F.count(F.when(failed & (F.col("severity") == "warning"), 1)).alias("warnings"),
        F.count(F.when(~failed, 1)).alias("passed"))
    return agg.withColumn("verdict", F.when(F.col("errors") > 0, "FAILED")
                          .when(F.col("warnings") > 0, "PASSED WITH WARNINGS")
                          .otherwise("PASSED"))
