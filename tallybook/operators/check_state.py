"""Check summaries kept up to date from changes, without reading the tables again.

Stored for every key set of the rules, on either side of a reference: signed
row counts per key, one folder a version.  A change writes the counts of its own
keys as the next version and judges those keys again: how a rule's number of
violations moves follows from the counts of the touched keys before and after.
For a reference that includes keys whose parent has come or gone, which the
child's stored counts tell the rows of.  Row rules are counted on the changed
rows alone.  Tables are read once, when the state is made.

A version is a small summary table over the counts up to it; a change that fails
half-way leaves the last summary as it was, and the next one writes its folders
anew.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import checks as C
from .checks import Rule
from .relational import union_tree

SUMMARY = "rule string, severity string, violations long, table string"


def _solid(columns) -> F.Column:
    """No NULL among the columns: only such keys repeat or refer."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


class CheckState:
    """``create`` once, then ``update`` with inserted and deleted rows; ``summary`` is
    that of a full run on the tables as they are now."""

    def __init__(self, spark: SparkSession, path: str, rules, as_of: str | None = None):
        self.spark, self.path, self.as_of = spark, path.rstrip("/"), as_of
        self.rules: list[Rule] = list(rules)
        self.keyed = [r for r in self.rules if r.kind in C.SET_KINDS]
        self.sets: dict[str, set[tuple[str, ...]]] = {}
        for r in self.keyed:
            self.sets.setdefault(r.table, set()).add(tuple(r.columns))
            if r.kind == "foreign_key":
                self.sets.setdefault(r.ref_table, set()).add(tuple(r.ref_columns))
        self.version = -1

    @classmethod
    def create(cls, spark: SparkSession, path: str, tables, rules, as_of: str | None = None) -> "CheckState":
        """A new state under ``path`` from whole tables; rules that lack a table or column are left out."""
        able, _ = C._split(tables, rules)
        state = cls(spark, f"{path.rstrip('/')}/{uuid.uuid4().hex[:12]}", able, as_of)
        counts = {t: C._key_counts(C._table(tables, t), sets) for t, sets in state.sets.items()}
        for t, sets in counts.items():
            for ks, df in sets.items():
                state._write(df.where(_solid(ks)), t, ks, 0)
        state._write_summary(C.summary(tables, able, as_of), 0)
        state.version = 0
        return state

    # -- stored frames ------------------------------------------------------------
    def _folder(self, table: str, columns, version: int) -> str:
        return f"{self.path}/counts/{table}/{'-'.join(columns)}/v{version:06d}"

    def _write(self, df: DataFrame, table: str, columns, version: int) -> None:
        df.select(*columns, F.col("_tb_n").cast("long").alias("_tb_n")).write.mode("overwrite").parquet(
            self._folder(table, columns, version))

    def _write_summary(self, df: DataFrame, version: int) -> None:
        df.select("rule", "severity", F.col("violations").cast("long").alias("violations"), "table").coalesce(1).write.mode(
            "overwrite").parquet(f"{self.path}/summary/v{version:06d}")

    def summary(self) -> DataFrame:
        return self.spark.read.schema(SUMMARY).parquet(f"{self.path}/summary/v{self.version:06d}")

    def _versions(self, table: str, columns) -> list[str]:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/counts/{table}/{'-'.join(columns)}")
        fs = folder.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        found = sorted(str(f.getPath().getName()) for f in fs.listStatus(folder))
        return [f"{folder.toString()}/{v}" for v in found if int(v[1:]) <= self.version]

    def _counts(self, table: str, columns, touched: DataFrame) -> DataFrame:
        """Stored rows per key, of ``touched`` keys only."""
        held = self.spark.read.parquet(*self._versions(table, columns))
        return held.join(touched, list(columns), "left_semi").groupBy(*columns).agg(F.sum("_tb_n").alias("_tb_n"))

    # -- changes --------------------------------------------------------------------
    def update(self, inserted: Mapping[str, DataFrame] | None = None, deleted: Mapping[str, DataFrame] | None = None) -> DataFrame:
        """The summary after rows were inserted and deleted (an update of a row is both)."""
        signed: dict[str, DataFrame] = {}
        for frames, sign in ((inserted or {}, 1), (deleted or {}, -1)):
            for t, df in frames.items():
                part = df.withColumn("_tb_sign", F.lit(sign).cast("long"))
                signed[t] = signed[t].unionByName(part) if t in signed else part
        version = self.version + 1
        deltas: dict[tuple[str, tuple[str, ...]], DataFrame] = {}
        for t, df in signed.items():
            for ks in self.sets.get(t, ()):
                moved = df.where(_solid(ks)).groupBy(*ks).agg(F.sum("_tb_sign").alias("_tb_n")).where("_tb_n != 0")
                self._write(moved, t, ks, version)
                deltas[t, ks] = self.spark.read.schema(moved.schema).parquet(self._folder(t, ks, version))
        parts = [p for t, df in signed.items() if (p := self._row_rules(t, df)) is not None]
        parts += [self._unique(r, deltas[r.table, tuple(r.columns)]) for r in self.keyed
                  if r.kind == "unique" and (r.table, tuple(r.columns)) in deltas]
        parts += [p for r in self.keyed if r.kind == "foreign_key" and (p := self._reference(r, deltas)) is not None]
        if parts:
            change = union_tree(parts).groupBy("rule").agg(F.sum("change").cast("long").alias("change"))
            now = self.summary().join(change, "rule", "left").withColumn(
                "violations", F.col("violations") + F.coalesce("change", F.lit(0)))
        else:
            now = self.summary()
        self._write_summary(now, version)
        self.version = version
        return self.summary()

    def _row_rules(self, table: str, signed: DataFrame) -> DataFrame | None:
        rules = [r for r in self.rules if r.table == table and r.kind not in C.SET_KINDS]
        if not rules:
            return None
        sums = signed.agg(*[F.coalesce(F.sum(F.when(C.violated(r, self.as_of), F.col("_tb_sign"))), F.lit(0)).alias(f"c{i}")
                            for i, r in enumerate(rules)])
        stacked = ", ".join(f"'{r.name}', c{i}" for i, r in enumerate(rules))
        return sums.selectExpr(f"stack({len(rules)}, {stacked}) as (rule, change)")

    def _unique(self, r: Rule, delta: DataFrame) -> DataFrame:
        ks = tuple(r.columns)
        old = self._counts(r.table, ks, delta).withColumnRenamed("_tb_n", "_tb_old")
        both = delta.join(old, list(ks), "left").select(F.coalesce("_tb_old", F.lit(0)).alias("old"), F.col("_tb_n").alias("n"))
        repeated = lambda n: F.when(n >= 2, 1).otherwise(0)
        return both.agg(F.sum(repeated(F.col("old") + F.col("n")) - repeated(F.col("old"))).alias("change")).select(
            F.lit(r.name).alias("rule"), F.coalesce("change", F.lit(0)).cast("long").alias("change"))

    def _reference(self, r: Rule, deltas) -> DataFrame | None:
        child, parent = deltas.get((r.table, tuple(r.columns))), deltas.get((r.ref_table, tuple(r.ref_columns)))
        if child is None and parent is None:
            return None
        types = self.spark.read.parquet(*self._versions(r.table, r.columns)).schema
        names = [f"_tb_k{i}" for i in range(len(r.columns))]

        def named(df: DataFrame, columns, count: str) -> DataFrame:
            """Counts with the key columns as _tb_k0, .., in the child's types."""
            return df.select(*[F.col(c).cast(types[own].dataType).alias(n) for c, own, n in zip(columns, r.columns, names, strict=True)],
                             F.col("_tb_n").alias(count))

        moved_child = named(child, r.columns, "c_move") if child is not None else None
        moved_parent = named(parent, r.ref_columns, "p_move") if parent is not None else None
        touched = reduce(lambda a, b: a.union(b), [d.select(*names) for d in (moved_child, moved_parent) if d is not None]).distinct()

        def held(table: str, columns, count: str) -> DataFrame:
            return named(self.spark.read.parquet(*self._versions(table, columns)), columns, count).join(
                touched, names, "left_semi").groupBy(*names).agg(F.sum(count).alias(count))

        both = touched.join(held(r.table, r.columns, "c_old"), names, "left").join(held(r.ref_table, r.ref_columns, "p_old"), names, "left")
        for d, count in ((moved_child, "c_move"), (moved_parent, "p_move")):
            both = both.join(d.groupBy(*names).agg(F.sum(count).alias(count)), names, "left") if d is not None else both.withColumn(count, F.lit(0))
        n = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("c_old", "c_move", "p_old", "p_move")}
        after = F.when(n["p_old"] + n["p_move"] > 0, 0).otherwise(n["c_old"] + n["c_move"])
        before = F.when(n["p_old"] > 0, 0).otherwise(n["c_old"])
        return both.agg(F.sum(after - before).alias("change")).select(
            F.lit(r.name).alias("rule"), F.coalesce("change", F.lit(0)).cast("long").alias("change"))

    def compact(self) -> None:
        """Write the counts of all versions as one, in a new state folder; the old one can be deleted."""
        moved = CheckState(self.spark, f"{self.path.rsplit('/', 1)[0]}/{uuid.uuid4().hex[:12]}", self.rules, self.as_of)
        for t, sets in self.sets.items():
            for ks in sets:
                held = self.spark.read.parquet(*self._versions(t, ks))
                moved._write(held.groupBy(*ks).agg(F.sum("_tb_n").alias("_tb_n")).where("_tb_n != 0"), t, ks, 0)
        moved._write_summary(self.summary(), 0)
        self.path, self.version = moved.path, 0
