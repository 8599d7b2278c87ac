"""Tables changed by keyed change rows: merged when read, compacted by file.

A table is a manifest over parquet files and change sets.  An update writes one
row for each key whose values really change (its old and its new values), a
delete one row for each key that goes; the files stay as they are.  Readers join
the change sets in order.  ``compact`` rewrites only the files that hold a
changed key and publishes a manifest without change sets; files without one are
neither read whole nor written.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import joins as J
from ..operators.cascade import rows_apart
from .migration import _Notes

KIND, UPDATE, DELETE = "_tb_kind", "update", "delete"


class ChangedTable:
    """A table under ``path`` with unique ``keys`` that are not NULL."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.manifests = _Notes(spark, f"{self.path}/manifests")
        self.manifest = self.manifests.read(self.manifests.names()[-1])
        self.schema = T.StructType.fromJson(self.manifest["schema"])
        self.keys: list[str] = self.manifest["keys"]

    @classmethod
    def create(cls, df: DataFrame, path: str, keys: list[str], clustered: bool = True) -> "ChangedTable":
        """Write ``df`` as a new table; clustered by key, so that changes of near keys touch few files."""
        spark, folder = df.sparkSession, f"data-{uuid.uuid4().hex[:12]}"
        out = df.repartitionByRange(*keys).sortWithinPartitions(*keys) if clustered else df
        out.write.option("compression", "zstd").parquet(f"{path.rstrip('/')}/{folder}")
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])
        files = cls._files_in(spark, f"{path.rstrip('/')}/{folder}")
        _Notes(spark, f"{path.rstrip('/')}/manifests").write(
            f"{0:08d}", {"keys": list(keys), "schema": schema.jsonValue(), "files": files, "changes": []})
        return cls(spark, path)

    @staticmethod
    def _files_in(spark: SparkSession, folder: str) -> list[str]:
        """Parquet files of a folder, as folder/file."""
        where = spark._jvm.org.apache.hadoop.fs.Path(folder)
        fs = where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        names = sorted(f.getPath().getName() for f in fs.listStatus(where))
        return [f"{folder.rsplit('/', 1)[-1]}/{n}" for n in names if n.endswith(".parquet")]

    def _publish(self, **changed) -> None:
        version = int(self.manifests.names()[-1]) + 1
        manifest = {**self.manifest, **changed}
        self.manifests.write(f"{version:08d}", manifest)
        self.manifest = manifest

    def _data(self, files: list[str]) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{f}" for f in files])

    def _change(self, entry: dict) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{entry['folder']}")

    def _merged(self, rows: DataFrame, entries: list[dict]) -> DataFrame:
        if not entries:
            return rows
        # rows that a bitmap of all changed keys rules out stay where they are
        moved = reduce(lambda a, b: a.union(b), [self._change(e).select(*self.keys) for e in entries])
        rows, far = rows_apart(rows, self.keys, moved, sum(e.get("rows", 0) for e in entries))
        for entry in entries:
            change = self._change(entry)
            new = [F.col(f"new_{c}").alias(f"_tb_new_{c}") for c in entry["columns"]]
            out = rows.join(change.select(*self.keys, KIND, *new), self.keys, "left").where(
                F.col(KIND).isNull() | (F.col(KIND) != DELETE))
            rows = out.select(*[F.when(F.col(KIND) == UPDATE, F.col(f"_tb_new_{c}")).otherwise(F.col(c)).alias(c)
                                if c in entry["columns"] else F.col(c) for c in self.schema.names])
        return rows if far is None else rows.unionByName(far)

    def read(self) -> DataFrame:
        """The table as it is now."""
        return self._merged(self._data(self.manifest["files"]), self.manifest["changes"])

    def changes(self) -> DataFrame:
        """``keys, kind, change, column, old, new`` (as texts) of all change sets since the last compaction, one row a changed value."""
        parts = []
        for k, entry in enumerate(self.manifest["changes"]):
            change, head = self._change(entry), [*self.keys, F.col(KIND).alias("kind"), F.lit(k).alias("change")]
            values = [F.struct(F.lit(c).alias("column"), F.col(f"old_{c}").cast("string").alias("old"),
                               F.col(f"new_{c}").cast("string").alias("new")) for c in entry["columns"]]
            if values:
                moved = change.select(*head, F.explode(F.array(*values)).alias("v")).select(*self.keys, "kind", "change", "v.*")
                parts.append(moved.where(~F.col("old").eqNullSafe(F.col("new"))))
            else:
                nothing = F.lit(None).cast("string")
                parts.append(change.select(*head, nothing.alias("column"), nothing.alias("old"), nothing.alias("new")))
        if not parts:
            keys = [f for f in self.schema.fields if f.name in self.keys]
            return self.spark.createDataFrame([], T.StructType([*keys, T.StructField("kind", T.StringType()),
                                                                T.StructField("change", T.IntegerType()),
                                                                *[T.StructField(c, T.StringType()) for c in ("column", "old", "new")]]))
        return reduce(lambda a, b: a.unionByName(b), parts)

    def _add(self, rows: DataFrame, columns: list[str]) -> int:
        folder, obs = f"change-{uuid.uuid4().hex[:12]}", Observation("change")
        rows.observe(obs, F.count(F.lit(1)).alias("rows")).write.option("compression", "zstd").parquet(f"{self.path}/{folder}")
        n = int(obs.get["rows"])
        if n:
            self._publish(changes=[*self.manifest["changes"], {"folder": folder, "columns": columns, "rows": n}])
        return n

    def update_from(self, lookup: DataFrame, on: list[str], set_cols: dict[str, str], where=None) -> int:
        """UPDATE .. SET c = lookup.x FROM lookup WHERE on: writes the rows whose values change, returns their number.

        ``lookup`` must be unique on ``on``; rows of it that match nothing change nothing.
        """
        source = J.assert_unique(lookup, on).select(*on, *[F.col(x).alias(f"_tb_x_{c}") for c, x in set_cols.items()])
        now = self.read() if where is None else self.read().where(where)
        both = now.join(source, on)
        new = {c: F.col(f"_tb_x_{c}").cast(self.schema[c].dataType) for c in set_cols}
        moved = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(x) for c, x in new.items()])
        return self._add(both.where(moved).select(*self.keys, F.lit(UPDATE).alias(KIND), *[F.col(c).alias(f"old_{c}") for c in new],
                                                  *[x.alias(f"new_{c}") for c, x in new.items()]), list(set_cols))

    def delete(self, where) -> int:
        """DELETE .. WHERE: writes the keys that go, returns their number."""
        return self._add(self.read().where(where).select(*self.keys, F.lit(DELETE).alias(KIND)), [])

    def insert(self, rows: DataFrame) -> None:
        """New files; what was changed before does not touch them, so the changes are compacted first."""
        self.compact()
        folder = f"data-{uuid.uuid4().hex[:12]}"
        rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields]).write.option("compression", "zstd").parquet(f"{self.path}/{folder}")
        self._publish(files=[*self.manifest["files"], *self._files_in(self.spark, f"{self.path}/{folder}")])

    def compact(self) -> list[str]:
        """Rewrite the files that hold changed keys; returns them.  Only their names reach the driver."""
        entries = self.manifest["changes"]
        if not entries:
            return []
        touched = reduce(lambda a, b: a.union(b), [self._change(e).select(*self.keys) for e in entries]).distinct()
        files = self.manifest["files"]
        placed = self._data(files).select(*self.keys, F.col("_metadata.file_path").alias("_tb_file"))
        found = [r[0] for r in placed.join(touched, self.keys, "left_semi").select("_tb_file").distinct().collect()]
        names = {"/".join(f.rsplit("/", 2)[-2:]) for f in found}
        hit = [f for f in files if f in names]
        folder = f"data-{uuid.uuid4().hex[:12]}"
        rows = self._merged(self._data(hit), entries)
        rows.repartitionByRange(*self.keys).sortWithinPartitions(*self.keys).write.option("compression", "zstd").parquet(f"{self.path}/{folder}")
        self._publish(files=[*[f for f in files if f not in names], *self._files_in(self.spark, f"{self.path}/{folder}")], changes=[])
        return hit
