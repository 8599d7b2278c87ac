"""Key changes and deletes carried through the declared references.

A reference says what happens to child rows when a parent's key changes or the
parent goes: ``cascade`` (the child follows), ``no action`` (the statement is
refused if a child is left without a parent at its end) or ``restrict``
(refused if there is any child).  One call starts from changed rows of some
tables and works through the references table by table: each round joins the
children of the tables changed in the last one, until a round changes nothing.
Only keys and referenced columns travel, as frames of ``(key, old, new)`` rows
that are written to the shared folder once a round; the full tables are joined
with them once, at the end, and only where the caller reads them.  Rows that a
bitmap of the changed keys rules out are not shuffled; the joins behind it are
exact.  The bitmaps are plain filters, one on each column too, so where a table
is itself a join they are applied below it.  Tables that no round reaches are
not asked for.

What refuses the statement is returned as rows, not raised, so a caller can
report it; ``Outcome.accepted()`` raises.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, replace
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_path
from . import joins as J
from .mutations import cascade_update
from .relational import union_tree

CASCADE, NO_ACTION, RESTRICT = "cascade", "no action", "restrict"


@dataclass(frozen=True)
class Reference:
    name: str
    child: str
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]
    on_update: str = NO_ACTION
    on_delete: str = NO_ACTION


def with_actions(references: Iterable[Reference], **actions: str) -> list[Reference]:
    """The same references with other actions, for all of them."""
    return [replace(r, **actions) for r in references]


def dependents(references: Iterable[Reference], tables: Iterable[str]) -> list[str]:
    """``tables`` and every table that refers to one of them, directly or not
    (what TRUNCATE .. CASCADE empties), in the order they are reached."""
    references, out = list(references), list(dict.fromkeys(tables))
    for table in out:  # grows while it is read
        out += [c for c in dict.fromkeys(r.child for r in references if r.parent == table) if c not in out]
    return out


BLOCKED = "reference string, table string, event string, key string, blocking_rows long"


@dataclass
class Outcome:
    """``tables``: every changed table in full; ``changes``: the keys and old and
    new values of its changed rows (for deletes, the keys of the rows that go);
    ``blocked``: (reference, table, event, key, blocking_rows) of what refuses
    the statement, where event is ``update``, ``delete`` or ``no parent``; made
    by ``refusals`` when it is first read."""

    tables: dict[str, DataFrame]
    changes: dict[str, DataFrame]
    refusals: Callable[[], DataFrame]

    @cached_property
    def blocked(self) -> DataFrame:
        return self.refusals()

    def accepted(self) -> dict[str, DataFrame]:
        """The changed tables; a refused statement is an error."""
        first = self.blocked.orderBy("reference", "key").first()
        if first:
            raise ValueError(f"{first.reference}: {first.event} of {first.key} is refused by {first.blocking_rows} rows of {first.table}")
        return self.tables


def _kept(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """Written to the shared folder and read again, with the number of rows: the next round starts from
    files, not from all rounds before."""
    path, obs = shared_path(df.sparkSession, "tallybook-cascade", f"{label}-{uuid.uuid4().hex}"), Observation("kept")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), int(obs.get["rows"])


#: rows of which a join with a whole table is left to the planner, which broadcasts them
_FEW = 50_000
#: bits of the largest bitmap (16 MB, one row)
_MOST_BITS = 1 << 27
_HASHED = (T.StringType(), T.LongType(), T.IntegerType(), T.DateType())


def _seen(rows: DataFrame, columns: Iterable[str], keys: DataFrame, n: int) -> DataFrame | None:
    """``rows`` with a column _tb_seen that is true where ``columns`` may equal one of the ``n`` rows of
    ``keys`` (by position, NULL equal to NULL) and false where they do not; None where that is of no use.
    It is an expression of ``columns`` alone, so a filter on it moves below joins that do not make them."""
    columns = list(columns)
    types = [rows.schema[c].dataType for c in columns]
    bits = 1 << max(10, (16 * n - 1).bit_length())
    bits = min(bits, _MOST_BITS)
    if n > bits // 2 or types != [f.dataType for f in keys.schema.fields] or any(t not in _HASHED for t in types):
        return None
    place = lambda cs: F.pmod(F.xxhash64(*cs), F.lit(bits))
    one = F.lit(1).cast("long")
    found = keys.select(place(keys.columns).alias("at")).select(
        F.shiftright("at", 6).alias("word"), F.call_function("shiftleft", one, (F.col("at") % 64).cast("int")).alias("mask"))
    every = rows.sparkSession.range(bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("mask"))
    words = found.union(every).groupBy("word").agg(F.bit_or("mask").alias("mask"))
    bitmap = words.agg(F.transform(F.sort_array(F.collect_list(F.struct("word", "mask"))), lambda x: x["mask"]).alias("bits"))
    at = place(columns)
    word = F.get(bitmap.scalar(), F.shiftright(at, 6).cast("int"))
    hit = word.bitwiseAND(F.call_function("shiftleft", one, (at % 64).cast("int"))) != 0
    return rows.withColumn("_tb_seen", hit)


def _near(rows: DataFrame, columns: Iterable[str], keys: DataFrame, n: int) -> DataFrame:
    """Rows whose ``columns`` may be among ``keys`` (at most ``n`` rows): all that are, and perhaps others."""
    columns = list(columns)
    for at in _slices(len(columns)):
        seen = _seen(rows, columns[at], keys.select(*keys.columns[at]), n)
        rows = rows if seen is None else seen.where("_tb_seen").drop("_tb_seen")
    return rows


def _slices(n: int) -> list[slice]:
    """All of ``n`` columns, then each alone."""
    return [slice(None), *([slice(i, i + 1) for i in range(n)] if n > 1 else [])]


def rows_apart(rows: DataFrame, keys: Iterable[str], changed: DataFrame, n: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows whose ``keys`` may be among those of ``changed``, and the others (None: all may be)."""
    seen = None if n <= _FEW else _seen(rows, keys, changed.select(*keys), n)
    if seen is None:
        return rows, None
    return seen.where("_tb_seen").drop("_tb_seen"), seen.where(~F.col("_tb_seen")).drop("_tb_seen")


def _without(table: DataFrame, rows: DataFrame, keys: Iterable[str], columns: Mapping[str, str], n: int) -> DataFrame:
    """``table`` without the rows that equal one of ``rows`` in ``columns``."""
    near, far = rows_apart(table, keys, rows, n)
    left = _match(near, rows, columns, "left_anti")
    return left if far is None else left.unionByName(far)


def _match(rows: DataFrame, other: DataFrame, columns: Mapping[str, str], how: str) -> DataFrame:
    """Join on equal rows, NULL equal to NULL: ``columns`` names each of ``rows``' columns and its one in ``other``."""
    renamed = other.select(*[F.col(b).alias(f"_tb_m{i}") for i, b in enumerate(columns.values())],
                           *[c for c in other.columns if c not in columns.values()])
    out = rows.join(renamed, _all(F.col(a).eqNullSafe(F.col(f"_tb_m{i}")) for i, a in enumerate(columns)), how)
    return out.drop(*[f"_tb_m{i}" for i in range(len(columns))])


def _all(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def _any(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _tuples(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Distinct values of ``columns`` as _tb_p0, .. without a NULL among them."""
    out = df.select(*[F.col(c).alias(f"_tb_p{i}") for i, c in enumerate(columns)])
    return out.where(_all(F.col(c).isNotNull() for c in out.columns)).distinct()


def _on(columns: Iterable[str]) -> Column:
    return _all(F.col(c) == F.col(f"_tb_p{i}") for i, c in enumerate(columns))


def _blocking(rows: DataFrame, r: Reference, columns: Iterable[str], event: str, n: Column | None = None) -> DataFrame:
    """Rows of a child counted by the values that refer to a parent; ``n``: the rows that each stands for."""
    key = F.concat_ws("|", *[F.col(c).cast("string") for c in columns])
    count = F.count(F.lit(1)) if n is None else F.sum(n)
    return rows.groupBy(key.alias("key")).agg(count.alias("blocking_rows")).select(
        F.lit(r.name).alias("reference"), F.lit(r.child).alias("table"), F.lit(event).alias("event"), "key", "blocking_rows")


def _join_blocked(parts: list[DataFrame], spark) -> DataFrame:
    return union_tree(parts) if parts else spark.createDataFrame([], BLOCKED)


def _columns_of(references: Iterable[Reference], table: str) -> list[str]:
    """Columns of ``table`` that take part in any reference, as child or parent."""
    found = [c for r in references for t, cols in ((r.child, r.columns), (r.parent, r.parent_columns)) if t == table for c in cols]
    return list(dict.fromkeys(found))


def _travelling(references: list[Reference], touched: dict[str, set[str]]) -> dict[str, list[str]]:
    """By table, the columns of every reference that a change of the ``touched`` columns may reach, at most:
    what becomes of a row depends on no other values."""
    touched = {t: set(cs) for t, cs in touched.items()}
    grown = True
    while grown:
        grown = False
        for r in references:
            if r.on_update == CASCADE:
                new = {c for c, p in zip(r.columns, r.parent_columns, strict=True) if p in touched.get(r.parent, ())}
                if new - touched.get(r.child, set()):
                    touched[r.child] = touched.get(r.child, set()) | new
                    grown = True
    return {t: _columns_of([r for r in references if (r.child == t and cs & set(r.columns)) or (r.parent == t and cs & set(r.parent_columns))], t)
            for t, cs in touched.items()}


def delete_rows(tables: Mapping[str, DataFrame], references: Iterable[Reference], doomed: Mapping[str, DataFrame],
                keys: Mapping[str, tuple[str, ...]]) -> Outcome:
    """Delete the rows of ``doomed`` and what follows them by ON DELETE CASCADE.

    ``doomed`` holds rows (or only their keys) by table; ``keys`` names the key
    columns of every table.  A key without a row deletes nothing; rows that
    share a key and all values that refer or are referred to go together, others
    do not, so a key that is not unique is no harm below the first tables.  NULL
    references nothing (MATCH SIMPLE).  Cycles of references end when a round
    finds no new row.
    """
    references = list(references)

    def carried(t: str) -> dict[str, str]:
        return {c: c for c in [*keys[t], *_columns_of(references, t)]}

    def first(t: str, rows: DataFrame) -> tuple[DataFrame, int]:
        given, n = _kept(rows.select(*keys[t]).distinct(), f"{t}-keys")
        near = _near(tables[t].select(*carried(t)), keys[t], given, n)
        return _kept(J.semi_join(near, given, list(keys[t])).distinct(), t)

    frontier = {t: first(t, rows) for t, rows in doomed.items()}
    gone: dict[str, DataFrame] = {}
    size: dict[str, int] = {}
    while frontier:
        for t, (rows, n) in frontier.items():
            gone[t], size[t] = gone[t].union(rows) if t in gone else rows, size.get(t, 0) + n
        found: dict[str, tuple[DataFrame, int]] = {}
        for child in dict.fromkeys(r.child for r in references if r.parent in frontier and r.on_delete == CASCADE):
            hits = []
            for r in references:
                if r.child == child and r.parent in frontier and r.on_delete == CASCADE:
                    parents, n = frontier[r.parent]
                    rows = _near(tables[child].select(*carried(child)), r.columns, parents.select(*r.parent_columns), n)
                    hits.append(rows.join(_tuples(parents, r.parent_columns), _on(r.columns), "left_semi"))
            rows = union_tree(hits).distinct()
            if child in gone:
                rows = _match(rows, gone[child], carried(child), "left_anti")
            rows, n = _kept(rows, child)
            if n:
                found[child] = rows, n
        frontier = found
    left = {t: _without(tables[t], rows, keys[t], carried(t), size[t]) for t, rows in gone.items()}

    def refusals() -> DataFrame:
        blocked = []
        for r in references:
            if r.parent not in gone or r.on_delete == CASCADE:
                continue
            lost_keys = gone[r.parent].select(*r.parent_columns)
            tuples, rows = _tuples(lost_keys, r.parent_columns), tables[r.child]
            if r.on_delete == NO_ACTION:  # judged at the end: a row that goes too, or another parent of the same key, is no hindrance
                rows = left.get(r.child, rows)
                # of the parents that stay only those with a key that is lost matter
                again = _near(left[r.parent].select(*r.parent_columns), r.parent_columns, lost_keys, size[r.parent])
                again = again.join(tuples, _on(r.parent_columns), "left_semi").select(
                    *[F.col(c).alias(f"_tb_q{i}") for i, c in enumerate(r.parent_columns)])
                lost = tuples.join(again, _all(F.col(f"_tb_p{i}") == F.col(f"_tb_q{i}") for i in range(len(r.columns))), "left_anti")
            else:
                lost = tuples
            rows = _near(rows, r.columns, lost_keys, size[r.parent])
            blocked.append(_blocking(rows.join(lost, _on(r.columns), "left_semi"), r, r.columns, "delete"))
        return _join_blocked(blocked, next(iter(doomed.values())).sparkSession)

    return Outcome(left, gone, refusals)


def update_keys(tables: Mapping[str, DataFrame], references: Iterable[Reference], updates: Mapping[str, DataFrame],
                keys: Mapping[str, tuple[str, ...]]) -> Outcome:
    """Change rows and carry their keys' changes by ON UPDATE CASCADE.

    ``updates`` holds, by table, a frame of the key columns and of new values as
    ``new_<column>``, one row a key.  All rows of a round change at once, so
    values may be swapped; the references of one child are applied in the order
    given, each to what the ones before have made.  Two parents that give one
    old key two new ones are an error.  Children are told apart by their key and
    all values of references that the statement may touch, so their keys need not
    be unique.
    Whether new keys are unique is left to the uniqueness rules.
    """
    references = list(references)
    touched: dict[str, set[str]] = {}
    columns = _travelling(references, {t: {c[4:] for c in given.columns if c.startswith("new_")} for t, given in updates.items()})
    total: dict[str, DataFrame] = {}
    size: dict[str, int] = {}
    frontier: dict[str, tuple[DataFrame, set[str], int]] = {}
    for t, given in updates.items():
        fresh = [c[4:] for c in given.columns if c.startswith("new_")]
        columns[t] = list(dict.fromkeys([*columns.get(t, ()), *fresh]))
        given = J.assert_unique(given.select(*keys[t], *[f"new_{c}" for c in fresh]), list(keys[t]))
        rows = tables[t].join(given, list(keys[t])).select(
            *keys[t], *[F.col(c).alias(f"old_{c}") for c in columns[t]],
            *[(F.col(f"new_{c}").cast(tables[t].schema[c].dataType) if c in fresh else F.col(c)).alias(f"now_{c}") for c in columns[t]])
        total[t], size[t] = _kept(_counted(_renamed(rows.where(_differs(columns[t])), columns[t]).withColumn("_tb_n", F.lit(1).cast("long"))), t)
        touched[t], frontier[t] = set(fresh), (total[t], set(fresh), size[t])
    while frontier:
        found: dict[str, tuple[DataFrame, set[str], int]] = {}
        moved = [r for r in references if r.on_update == CASCADE and r.parent in frontier and frontier[r.parent][1] & set(r.parent_columns)]
        for child in dict.fromkeys(r.child for r in moved):
            own = [r for r in moved if r.child == child]
            maps = {r: _mapping(frontier[r.parent][0], r) for r in own}
            near = _referring(tables[child].select(*keys[child], *[c for c in columns[child] if c not in keys[child]]),
                              [(r, _moved(frontier[r.parent][0], r), frontier[r.parent][2]) for r in own])
            moving = [c for c in columns[child] if any(c in r.columns for r in own)]
            rows = _state(near, total.get(child), keys[child], columns[child], moving)
            for r in own:
                rows = cascade_update(rows, [f"now_{c}" for c in r.columns], maps[r],
                                      [f"_tb_old{i}" for i in range(len(r.columns))], [f"_tb_new{i}" for i in range(len(r.columns))])
            was = "was" if child in total else "old"
            rows, n = _kept(_counted(rows.where(_any(~F.col(f"{was}_{c}").eqNullSafe(F.col(f"now_{c}")) for c in moving))), child)
            if not n:
                continue
            if child not in total:
                rows = rows.select("*", *[F.col(f"old_{c}").alias(f"was_{c}") for c in columns[child]],
                                   *[F.col(f"old_{c}").alias(f"now_{c}") for c in columns[child] if c not in moving])
            set_now = {c for r in own for c, p in zip(r.columns, r.parent_columns, strict=True) if p in frontier[r.parent][1]}
            delta = rows.select(*keys[child], *[F.col(f"was_{c}").alias(f"old_{c}") for c in columns[child]],
                                *[F.col(f"now_{c}").alias(f"new_{c}") for c in columns[child]])
            every = _renamed(rows, columns[child])
            if child in total:
                same = {c: c for c in [*keys[child], *[f"old_{c}" for c in columns[child]]]}
                every = every.union(_match(total[child], rows.select(*same), same, "left_anti").select(*every.columns))
            total[child], size[child] = every, size.get(child, 0) + n
            touched[child] = touched.get(child, set()) | set_now
            found[child] = delta, set_now, n
        frontier = found
    made = {t: _replaced(tables[t], rows, keys[t], columns[t], touched[t], size[t]) for t, rows in total.items()}
    return Outcome(made, {t: rows.drop("_tb_n") for t, rows in total.items()}, lambda: _join_blocked(_refused(tables, references, total, touched, made, keys, columns, size),
                                                      next(iter(updates.values())).sparkSession))


def _referring(rows: DataFrame, sources: list[tuple[Reference, DataFrame, int]]) -> DataFrame:
    """Rows that any of the changed parents' old values may be referred to by: the first reference that changes
    a row does so by its values as they stand, so no other row is changed."""
    for at in _slices(max(len(r.columns) for r, _, _ in sources)):
        out = rows.withColumn("_tb_any", F.lit(False))
        for r, moved, n in sources:
            own = r.columns[at] or r.columns[-1:]
            old = [f"_tb_old{r.columns.index(c)}" for c in own]
            seen = _seen(out, own, moved.select(*old), n)
            if seen is None:  # one reference may change any row
                break
            out = seen.withColumn("_tb_any", F.col("_tb_any") | F.col("_tb_seen")).drop("_tb_seen")
        else:
            rows = out.where("_tb_any").drop("_tb_any")
    return rows


def _counted(rows: DataFrame) -> DataFrame:
    """Equal rows as one, _tb_n the rows of the table they are."""
    return rows.groupBy(*[c for c in rows.columns if c != "_tb_n"]).agg(F.sum("_tb_n").alias("_tb_n"))


def _differs(columns: list[str]) -> Column:
    return _any(~F.col(f"old_{c}").eqNullSafe(F.col(f"now_{c}")) for c in columns)


def _renamed(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Original values as old_, current ones as new_."""
    keys = [c for c in rows.columns if not c.startswith(("old_", "now_", "was_"))]
    return rows.select(*keys, *[f"old_{c}" for c in columns], *[F.col(f"now_{c}").alias(f"new_{c}") for c in columns])


def _state(table: DataFrame, total: DataFrame | None, keys: tuple[str, ...], columns: list[str], moving: list[str]) -> DataFrame:
    """Keys with the original values (old_), those before this round (was_), those to be changed (now_) and a
    number of rows (_tb_n); in the first round for a table only the values that may move are there twice."""
    rows = table.select(*keys, *[F.col(c).alias(f"old_{c}") for c in columns])
    one = F.lit(1).cast("long").alias("_tb_n")
    if total is None:
        return rows.select("*", *[F.col(f"old_{c}").alias(f"now_{c}") for c in moving], one)
    states = [(s, c) for s in ("was", "now") for c in columns]
    fresh = _match(rows, total, {c: c for c in rows.columns}, "left_anti")
    # equal rows have been one change, and are one here
    moved = total.select(*rows.columns, *[F.col(f"new_{c}").alias(f"{s}_{c}") for s, c in states], "_tb_n")
    return fresh.select("*", *[F.col(f"old_{c}").alias(f"{s}_{c}") for s, c in states], one).union(moved)


def _mapping(changes: DataFrame, r: Reference) -> DataFrame:
    """Old and new values of a parent's referenced columns, where they differ and the old ones refer to something."""
    return _moved(changes, r).distinct()


def _moved(changes: DataFrame, r: Reference) -> DataFrame:
    """The rows of ``_mapping``, which may repeat."""
    old, new = ([F.col(f"{s}_{c}") for c in r.parent_columns] for s in ("old", "new"))
    rows = changes.where(_all(c.isNotNull() for c in old) & _any(~a.eqNullSafe(b) for a, b in zip(old, new, strict=True)))
    return rows.select(*[c.alias(f"_tb_old{i}") for i, c in enumerate(old)],
                       *[c.alias(f"_tb_new{i}") for i, c in enumerate(new)])


def _replaced(table: DataFrame, rows: DataFrame, keys: tuple[str, ...], columns: list[str], touched: set[str], n: int) -> DataFrame:
    """The table with the new values of its changed rows, which are told by their keys and old values."""
    changed = rows.select(*keys, *[f"old_{c}" for c in columns], F.lit(True).alias("_tb_seen"),
                          *[F.col(f"new_{c}").alias(f"_tb_{c}") for c in sorted(touched)])
    near, far = rows_apart(table, keys, rows, n)
    out = _match(near, changed, {c: c for c in keys} | {c: f"old_{c}" for c in columns if c not in keys}, "left")
    out = out.select(*[F.when(F.col("_tb_seen"), F.col(f"_tb_{c}")).otherwise(F.col(c)).alias(c) if c in touched else F.col(c)
                       for c in table.columns])
    return out if far is None else out.unionByName(far)


def _refused(tables, references, total, touched, made, keys, columns, size) -> list[DataFrame]:
    out = []
    for r in references:
        if r.parent not in total and r.child not in total:
            continue

        def have(wanted: DataFrame, n: int, r=r) -> DataFrame:
            """Those of the ``wanted`` values that the parent has after the change."""
            rows = tables[r.parent]
            if r.parent not in total or not touched[r.parent] & set(r.parent_columns):
                return _tuples(_near(rows.select(*r.parent_columns), r.parent_columns, wanted, n), r.parent_columns)
            same = {c: c for c in keys[r.parent]} | {c: f"old_{c}" for c in columns[r.parent] if c not in keys[r.parent]}
            stay = _near(rows.select(*same), r.parent_columns, wanted, n)
            stay = _match(stay, total[r.parent].select(*same.values()), same, "left_anti").select(*r.parent_columns)
            come = total[r.parent].select(*[F.col(f"new_{c}").alias(c) for c in r.parent_columns])
            return _tuples(stay.union(_near(come, r.parent_columns, wanted, n)), r.parent_columns)

        if r.parent in total and r.on_update != CASCADE and touched[r.parent] & set(r.parent_columns):
            moved = _moved(total[r.parent], r).select(*[F.col(f"_tb_old{i}").alias(f"_tb_p{i}") for i in range(len(r.columns))])
            lost = moved.distinct()
            if r.on_update == NO_ACTION:  # judged at the end, so another parent of the old key will do
                lost = lost.join(have(moved, size[r.parent]), lost.columns, "left_anti")
            rows = made[r.child] if r.on_update == NO_ACTION and r.child in made else tables[r.child]
            rows = _near(rows, r.columns, moved, size[r.parent]).join(lost, _on(r.columns), "left_semi")
            out.append(_blocking(rows, r, r.columns, "update"))
        if r.child in total and touched[r.child] & set(r.columns):
            new = [f"new_{c}" for c in r.columns]
            changes = total[r.child].where(_all(F.col(c).isNotNull() for c in new) & _any(
                ~F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}")) for c in r.columns))
            changes = changes.select(*new, "_tb_n")
            lone = changes.join(have(changes.select(*new), size[r.child]), _on(new), "left_anti")
            out.append(_blocking(lone, r, new, "no parent", F.col("_tb_n")))
    return out
