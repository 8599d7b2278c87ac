"""Migration that publishes all tables at once and can be started again.

A target is a folder of table folders and of manifests.  A manifest names the
folders that make up every table; the newest complete one is what readers see.
A run exports, checks and loads table by table into new folders, notes every
finished step in a journal, and publishes one manifest at its end.  So a run
that fails half-way changes nothing for readers, and the next run with the same
journal takes the finished steps from it, deletes what the failed step left, and
goes on there.  After the publication it finds the journal closed and does
nothing, so no rows are loaded twice.

Manifests and journal entries are small JSON datasets that Spark writes; one is
complete when its success marker exists, which is written last on every file
system.  Only table names, folders and counts pass through the driver.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.cascade import Reference, dependents
from . import io as IO
from . import schemas as S


class _Notes:
    """Named JSON values under a folder, complete or absent."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self, path: str):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder, folder.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def names(self) -> list[str]:
        folder, fs = self._fs(self.path)
        if not fs.exists(folder):
            return []
        found = sorted(f.getPath().getName() for f in fs.listStatus(folder))
        return [n for n in found if fs.exists(self._fs(f"{self.path}/{n}/_SUCCESS")[0])]

    def read(self, name: str):
        return json.loads(self.spark.read.text(f"{self.path}/{name}").first()[0])

    def write(self, name: str, value) -> None:
        """An incomplete note of that name is replaced; a complete one is an error."""
        if name in self.names():
            raise ValueError(f"{self.path}/{name} is already there")
        note = self.spark.createDataFrame([(json.dumps(value, sort_keys=True),)], "value string")
        note.coalesce(1).write.mode("overwrite").text(f"{self.path}/{name}")

    def delete(self, path: str) -> None:
        folder, fs = self._fs(path)
        fs.delete(folder, True)


class Target:
    """Published tables under a folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.manifests = _Notes(spark, f"{self.path}/manifests")

    def version(self) -> int:
        """Number of the newest complete manifest; 0 if nothing is published."""
        return max((int(n) for n in self.manifests.names()), default=0)

    def folders(self) -> dict[str, list[str]]:
        """The folders of every published table."""
        version = self.version()
        return self.manifests.read(f"{version:08d}") if version else {}

    def read(self, name: str, schema: T.StructType | None = None, folders: Mapping[str, list[str]] | None = None) -> DataFrame:
        """A published table (or the one that other ``folders`` would make); one that was emptied has no rows."""
        folders = self.folders() if folders is None else folders
        if name not in folders:
            raise KeyError(f"{name} is not published in {self.path}")
        schema = schema or S.SCHEMAS[name]
        own = [f"{self.path}/{f}" for f in folders[name]]
        return self.spark.read.schema(schema).parquet(*own) if own else self.spark.createDataFrame([], schema)

    def publish(self, folders: Mapping[str, list[str]], after: int) -> int:
        """Make ``folders`` what readers see, if ``after`` is still the newest version."""
        if self.version() != after:
            raise ValueError(f"version {after} is not the newest one any more")
        self.manifests.write(f"{after + 1:08d}", {t: list(f) for t, f in folders.items()})
        return after + 1


REPORT = T.StructType([*IO.MIGRATION_SCHEMA.fields, T.StructField("restored", T.BooleanType(), False)])


class Migration:
    """One run of a migration, known by its journal.

    ``run`` gives one report row a step: rows of the source, of the checked
    extract and of the load, a status, and whether the step was taken from the
    journal.  A step that fails is cleaned up and reported (``failed: ..``), the
    later ones are ``skipped`` and nothing is published; run the same plan with
    the same journal again to go on.
    """

    def __init__(self, spark: SparkSession, target: str, journal: str, graph: Iterable[Reference] = ()):
        self.spark, self.target = spark, Target(spark, target)
        self.journal_path = journal.rstrip("/")
        self.journal, self.graph = _Notes(spark, f"{self.journal_path}/steps"), list(graph)

    def run(self, tables, names: Iterable[str], truncate: Mapping[str, bool] | None = None, optional: Iterable[str] = (),
            columns: Mapping[str, list[str]] | None = None,
            references: Iterable[tuple[str, str, str, str, str]] = ()) -> DataFrame:
        """Export, check and load ``names`` and ``optional`` in order, check ``references``, publish.

        A truncated table is emptied before its load together with every table
        that refers to it, directly or not, by the graph of references; those
        must not be loaded before it in the same run.
        """
        needed, optional = list(names), list(optional)
        truncate, columns = dict(truncate or {}), dict(columns or {})
        order = [*needed, *optional]
        for k, name in enumerate(order):
            lost = [d for d in dependents(self.graph, [name])[1:] if d in order[:k]] if truncate.get(name) else []
            if lost:
                raise ValueError(f"emptying {name} would empty {', '.join(lost)}, loaded before it")
        plan = {"names": needed, "optional": optional, "truncate": truncate, "columns": columns, "target": self.target.path}
        done = self.journal.names()
        if "plan" not in done:
            self.journal.write("plan", {**plan, "id": uuid.uuid4().hex[:12], "after": self.target.version()})
        held = self.journal.read("plan")
        if {k: v for k, v in held.items() if k not in ("id", "after")} != json.loads(json.dumps(plan)):
            raise ValueError(f"the journal {self.journal_path} belongs to another plan")
        rows, failed = [], False
        for step, name in enumerate(order, 1):
            if failed:
                rows.append((step, name, None, None, None, "skipped", False))
                continue
            note = f"{step:04d}-{name}"
            restored = note in done
            if not restored:
                made = self._step(tables, name, held["id"], name in needed, columns.get(name))
                if made["status"] in ("ok", "absent"):
                    self.journal.write(note, made)
            else:
                made = self.journal.read(note)
            failed = made["status"] not in ("ok", "absent")
            rows.append((step, name, made.get("source"), made.get("extract"), made.get("loaded"), made["status"], restored))
        folders = self._folders(order, truncate, {n for n, r in zip(order, rows, strict=True) if r[5] == "ok"}, held)
        for name, child, child_key, parent, parent_key in references:
            status = "skipped"
            if not failed:
                orphans = self._orphans(folders, child, child_key, parent, parent_key)
                failed = orphans > 0
                status = f"{orphans} rows without parent" if failed else "ok"
            rows.append((len(rows) + 1, name, None, None, None, status, False))
        if not failed and "published" not in done:
            # a run that was lost between the manifest and its note has published already
            if self.target.version() == held["after"] or self.target.folders() != folders:
                self.target.publish(folders, held["after"])
            self.journal.write("published", {"version": held["after"] + 1})
        return self.spark.createDataFrame(rows, REPORT)

    def _folders(self, order, truncate, loaded, held) -> dict[str, list[str]]:
        """The folders of all tables after this run."""
        before = self.target.manifests.read(f"{held['after']:08d}") if held["after"] else {}
        out = {t: list(f) for t, f in before.items()}
        for name in order:
            if truncate.get(name) and name in loaded:
                out.update({t: [] for t in dependents(self.graph, [name]) if t in out})
            if name in loaded:
                out[name] = [*out.get(name, []), f"{name}/load-{held['id']}"]
        return out

    def _step(self, tables, name: str, run: str, needed: bool, columns: list[str] | None) -> dict:
        df = IO._maybe(tables, name)
        extract, folder = f"{self.journal_path}/extracts/{name}", f"{self.target.path}/{name}/load-{run}"
        if df is None:
            if needed:
                return {"status": "missing"}
            return {"status": "absent", "extract": IO.export_optional(self.spark, tables, name, extract)}
        df = df.select(*columns) if columns else df
        made: dict = {"status": "ok"}
        try:
            written = IO.export_extract(df, extract, order_by=[c for c in S.PRIMARY_KEY.get(name, ()) if c in df.columns],
                                        codec=IO.EXTRACT_CODEC)
            made["source"] = written["rows"]
            # no reader sees the folder yet, so the extract is parsed once, for its check and its load
            found = IO.check_extract(self.spark, extract, df.schema, written["rows"], written["fingerprint"], load=folder)
            made |= {"extract": found["rows"], "bytes": found["bytes"], "lines": found["lines"], "status": found["status"]}
            if made["status"] == "ok":
                back = self.spark.read.schema(df.schema).parquet(folder)
                read = IO._print(back.agg(*IO.fingerprint(back)).first())
                made["loaded"] = read["rows"]
                made["status"] = ("ok" if read["fingerprint"] == written["fingerprint"] else
                                  "count mismatch" if read["rows"] != written["rows"] else "content mismatch")
        except PySparkException as e:
            made["status"] = f"failed: {e.getCondition() or type(e).__name__}"
        if made["status"] != "ok":
            for path in (extract, folder):
                self.journal.delete(path)
        return made

    def _orphans(self, folders, child: str, child_key: str, parent: str, parent_key: str) -> int:
        def column(table, key):
            own = [f"{self.target.path}/{f}" for f in folders.get(table, [])]
            return self.spark.read.parquet(*own).select(F.col(key).alias("k")) if own else None
        keys, have = column(child, child_key), column(parent, parent_key)
        if keys is None:
            return 0
        keys = keys.where("k is not null")
        return keys.count() if have is None else keys.join(have, "k", "left_anti").count()

    def abandon(self) -> None:
        """Delete the journal, the extracts and every unpublished load of this run."""
        done = self.journal.names()
        if "plan" in done and "published" not in done:
            held = self.journal.read("plan")
            for name in [*held["names"], *held["optional"]]:
                self.journal.delete(f"{self.target.path}/{name}/load-{held['id']}")
        self.journal.delete(self.journal_path)

    def clean(self) -> None:
        """Delete the extracts once they are published."""
        if "published" not in self.journal.names():
            raise ValueError("nothing is published yet; abandon() gives the run up")
        self.journal.delete(f"{self.journal_path}/extracts")


def collect_garbage(spark: SparkSession, target: str, keep: int = 1) -> list[str]:
    """Delete load folders that none of the newest ``keep`` manifests names, and
    older manifests; returns the folders.  No run may be under way."""
    if keep < 1:
        raise ValueError("the newest manifest is what readers see")
    goal = Target(spark, target)
    versions = goal.manifests.names()
    used = {f for v in versions[-keep:] for own in goal.manifests.read(v).values() for f in own}
    known = {f for v in versions for own in goal.manifests.read(v).values() for f in own}
    for folder in sorted(known - used):
        goal.manifests.delete(f"{goal.path}/{folder}")
    for v in versions[:-keep]:
        goal.manifests.delete(f"{goal.manifests.path}/{v}")
    return sorted(known - used)
