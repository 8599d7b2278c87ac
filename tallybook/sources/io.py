"""Sources, sinks and load jobs: typed scans, CSV export / import,
table-by-table migration with read-back reconciliation.

All reads take an explicit schema (no inference).  CSV cannot carry bytes,
so binary columns are written as lowercase hex and decoded on import.  The
only driver-side work is the loop over tables and the scalar row counts of
each step; the data itself never leaves the executors.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_path
from . import schemas as S

# NULL is written as \N so that it stays apart from the empty string ('' is
# a real value, e.g. the default of ``notes``).
CSV_OPTIONS = {"header": "true", "nullValue": "\\N", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
               "timestampFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]XXX", "dateFormat": "yyyy-MM-dd",
               "escape": '"',
               # the writer trims values unless told not to
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
# the empty string is written quoted ("") and read back as ''
CSV_WRITE_OPTIONS = {**CSV_OPTIONS, "emptyValue": '""'}
#: codec of the files that only pass between two steps of a migration; a file is one
#: partition of the sort, so none is larger than a task writes
EXTRACT_CODEC = "gzip"


def staging_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    return shared_path(spark, "tallybook-staging", f"{label}-{uuid.uuid4().hex[:12]}")


# -- typed scans -----------------------------------------------------------------------
def load_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet",
               schema: T.StructType | None = None) -> DataFrame:
    """Read one ledger table with its declared schema."""
    schema = schema or S.SCHEMAS[name]
    if fmt == "csv":
        return import_csv(spark, path, schema)
    return spark.read.schema(schema).format(fmt).load(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: Iterable[str] = (), sort_within: Iterable[str] = ()) -> None:
    """Write a table version as parquet.  ``partition_by`` gives directory
    pruning (e.g. tenant), ``sort_within`` gives row-group min/max skipping
    (e.g. account, active, date for the account ledger)."""
    out = df
    if sort_within:
        out = out.sortWithinPartitions(*sort_within)
    w = out.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.option("compression", "zstd").parquet(path)


def load_mode(df: DataFrame, path: str, truncate_first: bool) -> None:
    """Truncate-then-load (``overwrite``) or append."""
    write_table(df, path, mode="overwrite" if truncate_first else "append")


# -- CSV -------------------------------------------------------------------------------------
# Line breaks inside a text are written as \\n and \\r, and a backslash as two, so that
# every record is one line and a large file can be read by many tasks.
def _escaped(c: str):
    out = F.col(c)
    for plain, code in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        out = F.replace(out, F.lit(plain), F.lit(code))
    return out.alias(c)


def _unescaped(c: str):
    parts = F.transform(F.split(F.col(c), r"\\\\"), lambda x: F.replace(
        F.replace(x, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")))
    return F.array_join(parts, "\\").alias(c)


def _csv_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType() if isinstance(
        f.dataType, T.BinaryType) else f.dataType, True) for f in schema.fields])


def fingerprint(df: DataFrame) -> tuple:
    """Aggregates that tell the rows of ``df`` whatever their order: their number and
    two independent sums of row hashes.  A NULL is told from an absent value by its place."""
    cols = [F.col(c) for c in df.columns]
    nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in cols])
    sums = [F.coalesce(F.sum(F.xxhash64(F.lit(seed), nulls, *cols).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))
            .cast("string").alias(f"hash{seed}") for seed in (1, 2)]
    return F.count(F.lit(1)).alias("rows"), *sums


def _print(row) -> dict:
    """The aggregates of ``fingerprint`` as (rows, fingerprint)."""
    return {"rows": int(row["rows"]), "fingerprint": f"{row['hash1']}:{row['hash2']}"}


def export_csv(df: DataFrame, path: str, columns: list[str] | None = None,
               order_by: list[str] | None = None, codec: str = "none") -> int:
    """Explicit projection, ordered by key, CSV with header.  The sort is a
    distributed range sort; part files come out in key order.  Returns the
    number of rows written, observed by the write job itself (no extra pass)."""
    return _export(df, path, columns, order_by, lambda out: [F.count(F.lit(1)).alias("rows")], codec)["rows"]


def export_extract(df: DataFrame, path: str, columns: list[str] | None = None,
                   order_by: list[str] | None = None, codec: str = "none") -> dict:
    """``export_csv`` that also observes the fingerprint of the rows it writes:
    ``{"rows", "fingerprint"}``, to compare with what ``check_extract`` reads."""
    return _print(_export(df, path, columns, order_by, fingerprint, codec))


def _export(df: DataFrame, path: str, columns, order_by, measure, codec: str) -> dict:
    out = df.select(*(columns or df.columns))
    if order_by:
        out = out.orderBy(*order_by)
    # observed above the sort: only the write job carries the metric (the
    # range-partition sampling job runs the plan below the sort)
    obs = Observation("export")
    out = out.observe(obs, *measure(out))
    out = out.select(*[F.lower(F.hex(F.col(f.name))).alias(f.name) if isinstance(
        f.dataType, T.BinaryType) else _escaped(f.name) if isinstance(
        f.dataType, T.StringType) else F.col(f.name) for f in out.schema.fields])
    out.write.mode("overwrite").options(**CSV_WRITE_OPTIONS, compression=codec).csv(path)
    return obs.get


def import_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV into a typed table; a malformed row fails the job."""
    raw = (spark.read.schema(_csv_schema(schema)).options(**CSV_OPTIONS)
           .option("mode", "FAILFAST").csv(path))
    return raw.select(*[F.unhex(F.col(f.name)).alias(f.name) if isinstance(
        f.dataType, T.BinaryType) else _unescaped(f.name) if isinstance(
        f.dataType, T.StringType) else F.col(f.name) for f in schema.fields])


def _typed(field: T.StructField):
    """A field of an extract from its text, NULL where the text is none of its type."""
    c, kind = F.col(field.name), field.dataType
    if isinstance(kind, T.BinaryType):
        return F.unhex(c)
    if isinstance(kind, T.StringType):
        return _unescaped(field.name)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        fmt = CSV_OPTIONS["timestampFormat" if isinstance(kind, T.TimestampType) else "timestampNTZFormat"]
        return F.try_to_timestamp(c, F.lit(fmt)).cast(kind)
    return c.try_cast(kind)


def import_csv_rejects(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """``(rows, rejects)`` of a header CSV: typed rows, and ``(file, line, reason)`` of
    the records that are none.

    A record is rejected for a wrong number of columns, for the first column
    whose text is not of its type, or for a NULL where the schema allows none.
    The extract is parsed once, into the shared folder; together both outputs
    hold every record.  ``line`` is the record as it stands, or as its columns
    would be written.
    """
    bad = "_tb_corrupt"
    texts = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields] + [
        T.StructField(bad, T.StringType(), True)])
    raw = (spark.read.schema(texts).options(**CSV_OPTIONS).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", bad).csv(path).select("*", F.col("_metadata.file_path").alias("_tb_file")))
    typed = {f.name: _typed(f) for f in schema.fields}
    reasons = [F.when(F.col(bad).isNotNull(), "wrong number of columns")]
    reasons += [F.when(F.col(n).isNotNull() & value.isNull(), f"{n}: no {schema[n].dataType.simpleString()}") for n, value in typed.items()]
    reasons += [F.when(F.col(f.name).isNull(), f"{f.name}: null") for f in schema.fields if not f.nullable]
    line = F.coalesce(F.col(bad), F.to_csv(F.struct(*schema.names), {**CSV_WRITE_OPTIONS, "header": "false"}))
    reason = F.coalesce(*reasons)
    parsed = raw.select(reason.alias("_tb_reason"), F.when(reason.isNotNull(), line).alias("_tb_line"), "_tb_file",
                        *[F.when(reason.isNull(), value).alias(n) for n, value in typed.items()])
    staged = staging_dir(spark, "parsed")
    parsed.write.parquet(staged)
    parsed = spark.read.schema(parsed.schema).parquet(staged)
    return (parsed.where("_tb_reason is null").select(*schema.names),
            parsed.where("_tb_reason is not null").select(F.col("_tb_file").alias("file"), F.col("_tb_line").alias("line"),
                                                          F.col("_tb_reason").alias("reason")))


def load_csv(spark: SparkSession, path: str, target: str, rejects_path: str, schema: T.StructType, truncate_first: bool = False) -> dict:
    """Load an extract into ``target`` and its rejects into ``rejects_path``:
    ``{"records", "loaded", "rejected", "status"}``.  Records are counted as lines
    of the files, apart from both; ``status`` is ``ok`` if none is missing."""
    rows, rejects = import_csv_rejects(spark, path, schema)
    size, counts = extract_size(spark, path), []
    for df, place, fresh in ((rows, target, truncate_first), (rejects, rejects_path, True)):
        obs = Observation("load")
        load_mode(df.observe(obs, F.count(F.lit(1)).alias("rows")), place, fresh)
        counts.append(int(obs.get["rows"]))
    records = size["lines"] - size["headers"]
    return {"records": records, "loaded": counts[0], "rejected": counts[1],
            "status": "ok" if sum(counts) == records else "count mismatch"}


def export_optional(spark: SparkSession, tables, name: str, path: str,
                    schema: T.StructType | None = None) -> int:
    """Export an optional table; a missing table yields an empty extract with
    the fixed header.  Returns the exported row count."""
    df = _maybe(tables, name)
    if df is None:
        df = spark.createDataFrame([], _csv_schema(schema or S.SCHEMAS[name]))
    return export_csv(df, path,
                      order_by=[c for c in S.PRIMARY_KEY.get(name, ()) if c in df.columns])


def check_extract(spark: SparkSession, path: str, schema: T.StructType,
                  expected_rows: int | None = None, expected_fingerprint: str | None = None,
                  load: str | None = None) -> dict:
    """Read an extract back: it must exist and have the expected row count (any
    but none if that is not known) and content.  ``{"rows", "fingerprint",
    "bytes", "lines", "status"}``: the size of its files, and their lines with
    one header a file, of which every row must be one.  Failures of the job
    itself are raised.  The rows are loaded into the folder ``load``, if one is
    given, as they are read; the caller drops them unless the status is ``ok``."""
    found = {"rows": None, "fingerprint": None, "bytes": None, "lines": None}
    try:
        df = import_csv(spark, path, schema)
    except AnalysisException as e:
        return {**found, "status": f"unreadable: {type(e).__name__}"}
    try:
        # the fingerprint touches every column: the CSV reader parses only the columns a
        # query needs, and a bare count() would not validate any field
        if load is None:
            found.update(_print(df.agg(*fingerprint(df)).first()))
        else:
            obs = Observation("check")
            load_mode(df.observe(obs, *fingerprint(df)), load, True)
            found.update(_print(obs.get))
        found.update(extract_size(spark, path))
    except Exception as e:  # only what the file itself causes is a status
        if "MALFORMED_RECORD" not in str(e) and "PATH_NOT_FOUND" not in str(e):
            raise
        return {**found, "status": f"unreadable: {type(e).__name__}"}
    n, headers = found["rows"], found.pop("headers")
    if expected_rows is not None and n != expected_rows:
        return {**found, "status": "count mismatch"}
    if expected_rows is None and n == 0:
        return {**found, "status": "empty"}
    if found["lines"] != n + headers:
        return {**found, "status": "line mismatch"}
    if expected_fingerprint is not None and found["fingerprint"] != expected_fingerprint:
        return {**found, "status": "content mismatch"}
    return {**found, "status": "ok"}


def extract_size(spark: SparkSession, path: str) -> dict:
    """``bytes`` of an extract's files as they are stored, their ``lines``, and how many begin with a ``header``."""
    size = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv*").load(path).agg(
        F.coalesce(F.sum("length"), F.lit(0)).alias("n")).first()
    # a compressed file has bytes even if it has no line
    files = spark.read.text(path).groupBy(F.col("_metadata.file_path")).agg(F.count(F.lit(1)).alias("lines"))
    found = files.agg(F.coalesce(F.sum("lines"), F.lit(0)).alias("lines"), F.count(F.lit(1)).alias("k")).first()
    return {"bytes": int(size["n"]), "lines": int(found["lines"]), "headers": int(found["k"])}


def _maybe(tables, name):
    try:
        return tables[name] if isinstance(tables, dict) else getattr(tables, name)
    except (KeyError, AttributeError):
        return None


MIGRATION_SCHEMA = T.StructType([
    T.StructField("step", T.IntegerType(), False), T.StructField("table_name", T.StringType()),
    T.StructField("source_rows", T.LongType()), T.StructField("extract_rows", T.LongType()),
    T.StructField("loaded_rows", T.LongType()), T.StructField("status", T.StringType())])


def _rows_at(spark: SparkSession, path: str) -> int:
    """Rows of a target table; 0 if it does not exist yet."""
    try:
        return spark.read.parquet(path).count()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return 0


def migrate_tables(spark: SparkSession, tables, names: Iterable[str], target_dir: str,
                   truncate: dict[str, bool] | None = None, staging: str | None = None,
                   optional: Iterable[str] = (), columns: dict[str, list[str]] | None = None,
                   references: Iterable[tuple[str, str, str, str, str]] = ()) -> DataFrame:
    """Export -> check -> (truncate) load -> read back, per table in the
    given dependency order; stop at the first failure (later steps are
    reported as skipped).  Returns one report row per step.

    ``names`` must exist.  A table of ``optional`` that does not gives an empty
    extract with its declared header, is not loaded and is ``absent``.  A table
    is emptied before its load only where ``truncate`` says so; otherwise rows
    are appended, and ``loaded_rows`` counts those of this load.  ``columns``
    picks the columns of a table's extract.  Extracts are compressed; they stay in
    ``staging``, or go once their table is loaded if no ``staging`` is given, so
    that no more than one of them takes up room.  ``references`` ``(name, child,
    child key, parent, parent key)`` are checked on the loaded tables at the
    end; ``status`` gives the number of rows without a parent.
    """
    passing, staging = staging is None, staging or staging_dir(spark, "migrate")
    needed, rows, failed = list(names), [], False
    for name in [*needed, *optional]:
        step = len(rows) + 1
        if failed:
            rows.append((step, name, None, None, None, "skipped"))
            continue
        df, extract = _maybe(tables, name), f"{staging}/{name}"
        if df is None:
            if name in needed:
                rows.append((step, name, None, None, None, "missing"))
                failed = True
            else:
                rows.append((step, name, None, export_optional(spark, tables, name, extract), None, "absent"))
            continue
        if name in (columns or {}):
            df = df.select(*columns[name])
        n, extracted, loaded, status = _migrate_one(spark, df, name, extract, f"{target_dir}/{name}",
                                                    (truncate or {}).get(name, False))
        failed = status != "ok"
        if passing and not failed:
            folder = spark._jvm.org.apache.hadoop.fs.Path(extract)
            folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
        rows.append((step, name, n, extracted, loaded, status))
    for name, child, child_key, parent, parent_key in references:
        status = "skipped"
        if not failed:
            orphans = _orphans(spark, target_dir, child, child_key, parent, parent_key)
            failed = orphans > 0
            status = f"{orphans} rows without parent" if failed else "ok"
        rows.append((len(rows) + 1, name, None, None, None, status))
    return spark.createDataFrame(rows, MIGRATION_SCHEMA)


def _migrate_one(spark: SparkSession, df: DataFrame, name: str, extract: str, target: str, truncate: bool):
    """(rows exported, rows read back from the extract, rows loaded, status) of one table."""
    n = export_csv(df, extract, order_by=[c for c in S.PRIMARY_KEY.get(name, ()) if c in df.columns], codec=EXTRACT_CODEC)
    chk = check_extract(spark, extract, df.schema, n)
    if chk["status"] != "ok":
        return n, chk["rows"], None, chk["status"]
    before = 0 if truncate else _rows_at(spark, target)
    load_mode(import_csv(spark, extract, df.schema), target, truncate)
    loaded = _rows_at(spark, target) - before
    return n, chk["rows"], loaded, "ok" if loaded == n else "count mismatch"


def _orphans(spark: SparkSession, target_dir: str, child: str, child_key: str, parent: str, parent_key: str) -> int:
    keys = spark.read.parquet(f"{target_dir}/{child}").select(F.col(child_key).alias("k")).where("k is not null")
    have = spark.read.parquet(f"{target_dir}/{parent}").select(F.col(parent_key).alias("k"))
    return keys.join(have, "k", "left_anti").count()


def verify_core_nonempty(tables, required: Iterable[str],
                         optional: Iterable[str] = ()) -> DataFrame:
    """(table_name, row_count, required, status): required tables must have
    rows, optional ones must exist.  One count per table, unioned; a table that
    does not exist is ``missing``, without a count."""
    parts, missing = [], []
    for name, req in [(n, True) for n in required] + [(n, False) for n in optional]:
        df = _maybe(tables, name)
        if df is None:
            missing.append((name, None, req, "missing"))
            continue
        parts.append(df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", F.lit(req).alias("required"),
            F.when(F.lit(req) & (F.col("row_count") == 0), "empty").otherwise("ok")
            .alias("status")))
    from ..operators.relational import union_tree
    if missing:
        session = parts[0].sparkSession if parts else SparkSession.active()
        parts.append(session.createDataFrame(
            missing, "table_name string, row_count long, required boolean, status string"))
    return union_tree(parts)


def seed_rows(df: DataFrame, rows: list[dict], id_col: str | None = None) -> DataFrame:
    """Insert constant reference rows (columns not given are NULL); keys after
    the current maximum when ``id_col`` is given."""
    spark = df.sparkSession
    fields = [f for f in df.schema.fields if f.name != id_col]
    schema = T.StructType([T.StructField("_tb_ord", T.IntegerType(), False)]
                          + [T.StructField(f.name, f.dataType, True) for f in fields])
    new = spark.createDataFrame(
        [(i, *[r.get(f.name) for f in fields]) for i, r in enumerate(rows)], schema)
    if id_col:
        from ..operators.ids import next_ids
        new = next_ids(new, df, id_col, order_by=["_tb_ord"])
    return df.unionByName(new.drop("_tb_ord"), allowMissingColumns=True)
