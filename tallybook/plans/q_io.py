"""Registered sources, sinks and load jobs (section 2.1)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.relational import union_tree
from ..sources import io as IO
from ..sources import schemas as S
from ..sources.complete import CompleteLedger
from ..sources.migration import Migration, Target
from .catalog import REFERENCES
from .registry import PARAMS as P
from .registry import register

# Tables carried by the migration job, in dependency order (fixture subset).
MIGRATED = ("t_description", "t_account", "t_category", "t_validation_amount", "t_parameter",
            "t_transaction", "t_pending_transaction", "t_transaction_categories", "t_payment",
            "t_transfer", "t_receipt_image")


def _round_trip(lg, name):
    df = lg.table(name)
    path = IO.staging_dir(lg.spark, f"roundtrip-{name}")
    IO.export_csv(df, path, order_by=[df.columns[0]])
    return IO.import_csv(lg.spark, path, df.schema)


register("csv_round_trip", "select * from t_transaction")(
    lambda lg: _round_trip(lg, "t_transaction"))
register("csv_round_trip_receipts", "select * from t_receipt_image")(
    lambda lg: _round_trip(lg, "t_receipt_image"))
register("csv_round_trip_family", "select * from t_family_member")(
    lambda lg: _round_trip(lg, "t_family_member"))


def _migrate(lg):
    target = IO.staging_dir(lg.spark, "target")
    return IO.migrate_tables(lg.spark, lg, MIGRATED, target)


register("migrate_tables", "\nunion all\n".join(
    f"select {i} as step, '{t}' as table_name, count(*) as source_rows, count(*) as extract_rows, "
    f"count(*) as loaded_rows, 'ok' as status from {t}" for i, t in enumerate(MIGRATED, 1)))(
    _migrate)


# The whole migration of the reference: every declared column, optional tables, one of
# them absent, the truncate flags of the schema, and the reference checked after the load.
_PRESENT = [t for t in (*S.STANDARD_TABLES, *S.OPTIONAL_TABLES) if t != "t_token_blacklist"]
_RECEIPT_REFERENCE = ("fk_receipt_image", "t_transaction", "receipt_image_id", "t_receipt_image", "receipt_image_id")


def _migrate_ledger(lg):
    full = CompleteLedger.of(lg)
    tables = {t: getattr(full, t) for t in _PRESENT}
    return IO.migrate_tables(lg.spark, tables, S.STANDARD_TABLES, IO.staging_dir(lg.spark, "target"),
                             truncate=S.TRUNCATE_BEFORE_LOAD, optional=S.OPTIONAL_TABLES,
                             columns={t: S.SCHEMAS[t].names for t in _PRESENT}, references=[_RECEIPT_REFERENCE])


register("migrate_ledger", "\nunion all\n".join(
    [f"select {i} as step, '{t}' as table_name, count(*) as source_rows, count(*) as extract_rows, "
     f"count(*) as loaded_rows, 'ok' as status from full_{t}" for i, t in enumerate(_PRESENT, 1)]
    + ["select 15, 't_token_blacklist', null, 0, null, 'absent'",
       "select 16, 'fk_receipt_image', null, null, null, case when count(*) = 0 then 'ok' else "
       "cast(count(*) as varchar) || ' rows without parent' end from full_t_transaction t where receipt_image_id is not null "
       "and not exists (select 1 from full_t_receipt_image r where r.receipt_image_id = t.receipt_image_id)"]))(
    _migrate_ledger)


# A run that breaks at its last table, is started again and once more after that.
_RESTARTED = ("t_account", "t_category", "t_transaction", "t_payment")


def _restarted(lg):
    held = lg.__dict__.setdefault("_restarted", {})
    if not held:
        tables = {t: getattr(lg, t) for t in _RESTARTED}
        bad = {**tables, "t_payment": lg.t_payment.withColumn("amount", F.when(
            F.col("payment_id") >= 0, F.raise_error(F.lit("the source is gone"))).otherwise(F.col("amount")))}
        target, journal = IO.staging_dir(lg.spark, "published"), IO.staging_dir(lg.spark, "journal")
        run = lambda t: Migration(lg.spark, target, journal, REFERENCES).run(t, _RESTARTED)
        held["broken"], held["after"] = run(bad), Target(lg.spark, target).version()
        held["restarted"], held["again"], held["target"] = run(tables), run(tables), Target(lg.spark, target)
    return held


_STEPS = [(i, t) for i, t in enumerate(_RESTARTED, 1)]
register("migrate_broken", "\nunion all\n".join(
    [f"select {i} as step, '{t}' as table_name, count(*) as source_rows, count(*) as extract_rows, count(*) as loaded_rows, "
     f"'ok' as status, false as restored, 0 as version from {t}" for i, t in _STEPS[:-1]]
    + ["select 4, 't_payment', null, null, null, 'failed: USER_RAISED_EXCEPTION', false, 0"]))(
    lambda lg: _restarted(lg)["broken"].withColumn("version", F.lit(_restarted(lg)["after"])))
register("migrate_restart", "\nunion all\n".join(
    f"select {i} as step, '{t}' as table_name, count(*) as source_rows, count(*) as extract_rows, count(*) as loaded_rows, "
    f"'ok' as status, {'false' if t == _RESTARTED[-1] else 'true'} as restored from {t}" for i, t in _STEPS))(
    lambda lg: _restarted(lg)["restarted"])
for _t in ("t_transaction", "t_payment"):
    register(f"migrate_restart_{_t[2:]}", f"select * from {_t}")(
        lambda lg, t=_t: _restarted(lg)["target"].read(t, getattr(lg, t).schema))


# Parents loaded again with TRUNCATE .. CASCADE: the tables that refer to them are emptied in the same publication.
_MEDICAL = ("t_medical_provider", "t_family_member", "t_medical_expense")


def _truncated(lg):
    held = lg.__dict__.setdefault("_truncated", {})
    if not held:
        full = CompleteLedger.of(lg)
        tables = {t: getattr(full, t).select(*S.SCHEMAS[t].names) for t in _MEDICAL}
        path = IO.staging_dir(lg.spark, "truncated")
        run = lambda names, **flags: Migration(
            lg.spark, path, IO.staging_dir(lg.spark, "journal"), REFERENCES).run(tables, names, truncate=flags)
        for step, names, flags in (("first", _MEDICAL, {}), ("parent", _MEDICAL[:1], {"t_medical_provider": True}),
                                   ("both", _MEDICAL[1:], {"t_family_member": True}),
                                   ("appended", _MEDICAL[1:2], {})):
            run(names, **flags)
            folders = Target(lg.spark, path).folders()
            held[step] = {t: Target(lg.spark, path).read(t, tables[t].schema, folders) for t in _MEDICAL}
    return held


def _truncated_counts(lg):
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(step).alias("step"), F.lit(t).alias("table_name"), "row_count")
             for step, tables in _truncated(lg).items() for t, df in tables.items()]
    return union_tree(parts)


register("truncate_cascade", "\nunion all\n".join(
    f"select '{step}' as step, '{t}' as table_name, {times} * count(*) as row_count from full_{t}"
    for step, all_times in (("first", (1, 1, 1)), ("parent", (1, 1, 0)), ("both", (1, 1, 1)), ("appended", (1, 2, 1)))
    for t, times in zip(_MEDICAL, all_times)))(_truncated_counts)
register("truncate_cascade_child", "select * from full_t_medical_expense")(lambda lg: _truncated(lg)["both"]["t_medical_expense"])
register("truncate_cascade_emptied", "select * from full_t_medical_expense where false")(
    lambda lg: _truncated(lg)["parent"]["t_medical_expense"])


# Extracts checked by content: as they were written, and with one value changed in a file of as many rows.
def _extract_contents(lg):
    rows = []
    for name, column in (("t_account", "cleared"), ("t_transaction", "amount"), ("t_payment", "amount"), ("t_pending_transaction", None)):
        df, path = getattr(lg, name), IO.staging_dir(lg.spark, "contents")
        key = S.PRIMARY_KEY[name][0]
        written = IO.export_extract(df, path, order_by=[key])
        if column:  # an error of a cent in the row of the greatest key
            top = df.agg(F.max(key).alias("_tb_top"))
            wrong = df.crossJoin(F.broadcast(top)).withColumn(column, F.when(
                F.col(key) == F.col("_tb_top"), F.col(column) + F.lit(0.01).cast("decimal(3,2)")).otherwise(F.col(column)).cast(
                df.schema[column].dataType)).drop("_tb_top")
            IO.export_csv(wrong, path, order_by=[key])
        chk = IO.check_extract(lg.spark, path, df.schema, written["rows"], written["fingerprint"])
        size = IO.extract_size(lg.spark, path)
        rows.append((name, chk["rows"], size["lines"] - size["headers"], size["bytes"] == chk["bytes"] > 0, chk["status"]))
    return lg.spark.createDataFrame(rows, "table_name string, extract_rows long, record_lines long, sized boolean, status string")


register("check_extract_content", "\nunion all\n".join(
    f"select '{t}' as table_name, count(*) as extract_rows, count(*) as record_lines, true as sized, '{status}' as status from {t}"
    for t, status in (("t_account", "content mismatch"), ("t_transaction", "content mismatch"), ("t_payment", "content mismatch"),
                      ("t_pending_transaction", "ok"))))(_extract_contents)


def _extract(lg):
    df = lg.t_account
    path = IO.staging_dir(lg.spark, "extract")
    n = IO.export_csv(df, path, order_by=["account_id"])
    chk = IO.check_extract(lg.spark, path, df.schema, n)
    return lg.spark.createDataFrame([("t_account", chk["rows"], chk["status"])],
                                    "table_name string, extract_rows long, status string")


register("check_extract", """
select 't_account' as table_name, count(*) as extract_rows, 'ok' as status from t_account""")(_extract)


def _load_mode(lg):
    path = IO.staging_dir(lg.spark, "loadmode")
    IO.load_mode(lg.t_role, path, truncate_first=True)
    IO.load_mode(lg.t_role, path, truncate_first=False)
    return lg.spark.read.parquet(path)


register("load_mode_append", "select * from t_role union all select * from t_role")(_load_mode)


def _load_typed(lg):
    path = IO.staging_dir(lg.spark, "typed")
    IO.write_table(lg.t_transaction, path, partition_by=["owner"],
                   sort_within=["account_name_owner", "active_status", "transaction_date"])
    df = lg.t_transaction
    return IO.load_table(lg.spark, "t_transaction", path, schema=df.schema).select(*df.columns)


register("load_table", "select * from t_transaction")(_load_typed)

register("verify_core_nonempty", "\nunion all\n".join(
    [f"select '{t}' as table_name, count(*) as row_count, true as required, "
     f"case when count(*) = 0 then 'empty' else 'ok' end as status from {t}"
     for t in ("t_transaction", "t_account", "t_category", "t_description")]
    + [f"select '{t}', count(*), false, 'ok' from {t}"
       for t in ("t_medical_provider", "t_family_member", "t_medical_expense",
                 "t_token_blacklist")]))(
    lambda lg: IO.verify_core_nonempty(
        lg, ["t_transaction", "t_account", "t_category", "t_description"],
        ["t_medical_provider", "t_family_member", "t_medical_expense", "t_token_blacklist"]))


def _export_optional(lg):
    """One optional table that exists and one that does not."""
    full, parts = CompleteLedger.of(lg), []
    tables = {"t_medical_provider": full.t_medical_provider}
    for name in ("t_medical_provider", "t_token_blacklist"):
        path = IO.staging_dir(lg.spark, "optional")
        n = IO.export_optional(lg.spark, tables, name, path)
        back = IO.import_csv(lg.spark, path, full.t_medical_provider.schema if name in tables else S.SCHEMAS[name])
        parts.append(back.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", F.lit(n).cast("long").alias("exported_rows"),
            F.lit(len(back.columns)).alias("columns")))
    return union_tree(parts)


register("export_optional_missing", """
select 't_medical_provider' as table_name, count(*) as row_count, count(*) as exported_rows,
 (select count(*)::int from (describe select * from full_t_medical_provider)) as columns from full_t_medical_provider
union all select 't_token_blacklist', 0, 0, (select count(*)::int from (describe select * from full_t_token_blacklist))""")(
    _export_optional)
register("export_optional", "select * from full_t_medical_provider")(lambda lg: _optional_rows(lg))


def _optional_rows(lg):
    df, path = CompleteLedger.of(lg).t_medical_provider, IO.staging_dir(lg.spark, "optional")
    IO.export_optional(lg.spark, {"t_medical_provider": df}, "t_medical_provider", path)
    return IO.import_csv(lg.spark, path, df.schema)


# The provider rows the schema seeds on creation.
SEED_PROVIDERS = [
    {"provider_name": "unknown_provider", "provider_type": "general", "network_status": "unknown"},
    {"provider_name": "pharmacy_generic", "provider_type": "pharmacy", "specialty": "retail_pharmacy",
     "network_status": "unknown"},
    {"provider_name": "urgent_care_generic", "provider_type": "urgent_care",
     "network_status": "unknown"},
    {"provider_name": "hospital_generic", "provider_type": "hospital", "network_status": "unknown"},
    {"provider_name": "laboratory_generic", "provider_type": "laboratory", "specialty": "general_lab",
     "network_status": "unknown"},
]

register("seed_rows", """
select * from t_medical_provider union all
select m.top + v.ord as provider_id, v.provider_name, v.provider_type, null, null, null, v.network_status
from (values (1, 'unknown_provider', 'general', 'unknown'), (2, 'pharmacy_generic', 'pharmacy', 'unknown'),
 (3, 'urgent_care_generic', 'urgent_care', 'unknown'), (4, 'hospital_generic', 'hospital', 'unknown'),
 (5, 'laboratory_generic', 'laboratory', 'unknown')) v(ord, provider_name, provider_type, network_status),
 (select coalesce(max(provider_id), 0) as top from t_medical_provider) m""")(
    lambda lg: IO.seed_rows(lg.t_medical_provider, SEED_PROVIDERS, id_col="provider_id"))


def _seed_providers(lg):
    """The seed rows with all declared columns and defaults."""
    now = dt.datetime.fromisoformat(P["as_of"])
    filled = {**S.DEFAULTS["t_medical_provider"], "date_added": now, "date_updated": now}
    return IO.seed_rows(CompleteLedger.of(lg).t_medical_provider, [{**filled, **r} for r in SEED_PROVIDERS],
                        id_col="provider_id")


register("seed_providers", f"""
select * from full_t_medical_provider union all by name
select m.top + v.ord as provider_id, v.provider_name, v.provider_type, v.specialty, 'US' as country,
 'unknown' as network_status, true as active_status, timestamp '{P["as_of"]}' as date_added,
 timestamp '{P["as_of"]}' as date_updated
from (values (1, 'unknown_provider', 'general', null), (2, 'pharmacy_generic', 'pharmacy', 'retail_pharmacy'),
 (3, 'urgent_care_generic', 'urgent_care', null), (4, 'hospital_generic', 'hospital', null),
 (5, 'laboratory_generic', 'laboratory', 'general_lab')) v(ord, provider_name, provider_type, specialty),
 (select coalesce(max(provider_id), 0) as top from full_t_medical_provider) m""")(_seed_providers)



def _export(lg):
    df = lg.t_account
    path = IO.staging_dir(lg.spark, "export-account")
    IO.export_csv(df, path, columns=["account_id", "account_name_owner", "account_type",
                                     "active_status", "owner"], order_by=["account_id"])
    # the lines of the extract as text; every part repeats the header, and the ids make all other lines different
    return lg.spark.read.text(path).select(F.col("value").alias("line")).distinct()


register("export_csv", """
select 'account_id,account_name_owner,account_type,active_status,owner' as line union all
select concat_ws(',', cast(account_id as varchar), account_name_owner, account_type, cast(active_status as varchar), owner)
from t_account""")(_export)


def _import(lg):
    df = lg.t_pending_transaction
    path = IO.staging_dir(lg.spark, "import-pending")
    IO.export_csv(df, path, order_by=["pending_transaction_id"])
    return IO.import_csv(lg.spark, path, df.schema)


register("import_csv", "select * from t_pending_transaction")(_import)


# An extract with damaged records: texts that are no numbers or dates, a NULL where none may be, too few columns.
_DAMAGE = ((50, 7, "amount", "n/a"), (60, 11, "transaction_date", "1995-02-30"), (70, 13, "account_name_owner", None))


def _damaged(lg):
    held = lg.__dict__.setdefault("_damaged", {})
    if not held:
        df, path = lg.t_pending_transaction, IO.staging_dir(lg.spark, "damaged")
        key = F.col("pending_transaction_id")
        texts = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
        for n, rest, column, value in _DAMAGE:
            texts = texts.withColumn(column, F.when(key % n == rest, F.lit(value)).otherwise(F.col(column)))
        short = key % 80 == 17
        texts.where(~short).write.options(**IO.CSV_WRITE_OPTIONS).csv(path)
        texts.where(short).drop(df.columns[-1]).write.mode("append").options(**IO.CSV_WRITE_OPTIONS).csv(path)
        schema = T.StructType([T.StructField(f.name, f.dataType, f.name != "account_name_owner") for f in df.schema.fields])
        loaded, rejects = IO.staging_dir(lg.spark, "loaded"), IO.staging_dir(lg.spark, "rejects")
        held["report"] = IO.load_csv(lg.spark, path, loaded, rejects, schema)
        held["rows"], held["rejects"] = lg.spark.read.schema(df.schema).parquet(loaded), lg.spark.read.parquet(rejects)
    return held


_REASON = """case when pending_transaction_id % 80 = 17 then 'wrong number of columns'
 when pending_transaction_id % 60 = 11 then 'transaction_date: no date' when pending_transaction_id % 50 = 7 then 'amount: no decimal(12,2)'
 when pending_transaction_id % 70 = 13 then 'account_name_owner: null' end"""
register("import_csv_rows", f"select * from t_pending_transaction where {_REASON} is null")(lambda lg: _damaged(lg)["rows"])
register("import_csv_rejects", f"""select cast(pending_transaction_id as varchar) as record, {_REASON} as reason
from t_pending_transaction where {_REASON} is not null""")(
    lambda lg: _damaged(lg)["rejects"].select(F.split("line", ",")[0].alias("record"), "reason"))
register("import_csv_report", f"""select count(*) as records, count(*) filter ({_REASON} is null) as loaded,
 count(*) filter ({_REASON} is not null) as rejected, 'ok' as status from t_pending_transaction""")(
    lambda lg: lg.spark.createDataFrame([_damaged(lg)["report"]], "records long, loaded long, rejected long, status string"))
