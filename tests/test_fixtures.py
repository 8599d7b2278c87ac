from tallybook.operators import checks as C
from tallybook.plans import catalog as K
from tallybook.sources import complete
from tallybook.sources import schemas as S
from tallybook.sources.fixtures import FIXTURE_COLUMNS, LEDGER_TABLES


def test_fixture_columns_match_derivations(ledger):
    for name, cols in FIXTURE_COLUMNS.items():
        assert ledger.table(name).columns == cols, name


def test_every_ledger_table_is_derived(ledger):
    for name in LEDGER_TABLES:
        assert ledger.table(name).count() >= 0


def test_dimension_keys_are_dense(ledger):
    from pyspark.sql import functions as F
    d = ledger.t_description.agg(F.min("description_id"), F.max("description_id"),
                                 F.count("*")).first()
    assert (d[0], d[1]) == (1, d[2])
    c = ledger.t_category.agg(F.min("category_id"), F.max("category_id"), F.count("*")).first()
    assert (c[0], c[1]) == (0, c[2] - 1)


def test_complete_tables_have_every_declared_column(ledger):
    full = complete.CompleteLedger(ledger)
    for name, schema in S.SCHEMAS.items():
        df = getattr(full, name)
        assert df.columns[:len(schema.names)] == schema.names, name
        for f in schema.fields:
            wider = complete.WIDER.get((name, f.name))
            assert df.schema[f.name].dataType.simpleString() == (wider or f.dataType.simpleString()), (name, f.name)


def test_every_rule_of_the_catalogue_can_run(ledger):
    able, unable = C._split(complete.CompleteLedger(ledger), list(K.BY_NAME.values()))
    assert not unable and len(able) == len(K.BY_NAME)


def test_stored_ledger_is_kept_where_the_caller_says_and_can_be_released(spark, tmp_path):
    import os
    import shutil

    from tallybook.sources.fixtures import Ledger

    source, kept = str(tmp_path / "sf"), str(tmp_path / "kept")
    shutil.copytree("/root/testdata/sf0.001", source, copy_function=shutil.copyfile)  # the tables may be read-only
    os.chmod(source, 0o755)
    lg = Ledger.of(spark, source, path=kept)
    before = lg.t_role.count()
    assert Ledger.of(spark, source) is lg and len(os.listdir(kept)) == 1
    lg.source("region").limit(2).toPandas().to_parquet(f"{source}/region.parquet")
    assert Ledger.of(spark, source).t_role.count() == before  # stored
    lg.release()
    assert os.listdir(kept) == []
    again = Ledger.of(spark, source, path=kept)
    assert again is not lg and again.t_role.count() == 2
    again.release()


def test_declared_values_are_spelled_apart_from_the_catalogue():
    from tallybook.plans import oracle_checks as O

    apart = {r.name for r in K.ROW_RULES if r.kind not in ("not_null", "lowercase", "not_empty", "not_future")}
    assert apart == set(O.DECLARED)


def test_keys_references_and_columns_are_spelled_apart_from_the_catalogue():
    from tallybook.plans import oracle_checks as O

    pool = K.ALL_RULES + K.LEGACY_RULES + K.ORPHAN_RULES
    assert {r.name for r in pool if r.kind == "unique"} == set(O.KEYS)
    assert {r.name for r in pool if r.kind == "foreign_key"} == set(O.REFERENCES)
    assert {r.name for r in K.NOT_NULL_RULES} == {f"nn_{t}_{c}" for t, cs in O.NOT_NULL.items() for c in cs.split()}
    for r in pool:  # and say the same
        assert O.declared(r) == r


def test_a_joined_table_is_written_once(spark, tmp_path):
    import os

    from tallybook.sources.fixtures import Ledger

    lg = Ledger(spark, "/root/testdata/sf0.001", materialize=True, path=str(tmp_path / "kept"))
    full = complete.CompleteLedger(lg)
    assert full.t_transfer.count() == spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()
    (base,) = os.listdir(tmp_path / "kept")
    names = os.listdir(tmp_path / "kept" / base)
    assert "complete_t_transfer" in names and "t_transfer" not in names
    assert any(f.endswith(".zstd.parquet") for f in os.listdir(tmp_path / "kept" / base / "complete_t_transfer"))
    assert lg.derived("t_account") is lg.t_account  # what is stored is read


def test_a_backup_is_validated_without_writing_projections(spark, tmp_path):
    import os

    from tallybook.plans import integrity as I
    from tallybook.sources.fixtures import PROJECTIONS, Ledger

    lg = Ledger(spark, "/root/testdata/sf0.001", materialize=True, path=str(tmp_path / "kept"))
    rows = I.validate_backup(lg.once()).collect()
    (base,) = os.listdir(tmp_path / "kept")
    written = set(os.listdir(tmp_path / "kept" / base))
    assert "t_transaction" in written and not written & (set(PROJECTIONS) - {"t_account"})
    assert sorted(map(tuple, rows)) == sorted(map(tuple, I.validate_backup(lg).collect()))
