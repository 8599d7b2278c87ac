"""A migration parses an extract once, for its check and its load; what fails the check is not loaded."""

from tallybook.sources import io as IO
from tallybook.sources.migration import Migration, Target


def _rows(spark):
    return spark.createDataFrame([(1, "a\\b\nc", None), (2, "", "2020-01-01"), (2, "", "2020-01-01")],
                                 "parameter_id long, parameter_name string, since string").selectExpr(
        "parameter_id", "parameter_name", "cast(since as date) as since")


def test_rows_are_loaded_as_they_are_checked(spark):
    df, path, to = _rows(spark), IO.staging_dir(spark, "extract"), IO.staging_dir(spark, "loaded")
    written = IO.export_extract(df, path, codec=IO.EXTRACT_CODEC)
    found = IO.check_extract(spark, path, df.schema, written["rows"], written["fingerprint"], load=to)
    assert found == IO.check_extract(spark, path, df.schema, written["rows"], written["fingerprint"])
    assert found["status"] == "ok" and found["rows"] == 3
    assert sorted(spark.read.parquet(to).collect()) == sorted(df.collect(), key=lambda r: r.parameter_id)
    wrong = IO.check_extract(spark, path, df.schema, written["rows"], "1:2", load=IO.staging_dir(spark, "loaded"))
    assert wrong["status"] == "content mismatch"


def test_the_extract_of_a_migration_is_parsed_once(spark, monkeypatch):
    parsed, whole = [], IO.import_csv
    monkeypatch.setattr(IO, "import_csv", lambda *a: parsed.append(a[1]) or whole(*a))
    target = IO.staging_dir(spark, "target")
    out = Migration(spark, target, IO.staging_dir(spark, "journal")).run({"t_parameter": _rows(spark)}, ["t_parameter"]).collect()
    assert [(r.source_rows, r.extract_rows, r.loaded_rows, r.status) for r in out] == [(3, 3, 3, "ok")]
    assert len(parsed) == 1
    assert Target(spark, target).read("t_parameter", _rows(spark).schema).count() == 3


def test_a_load_that_fails_its_check_is_dropped(spark, monkeypatch):
    whole, loaded = IO.export_extract, []
    monkeypatch.setattr(IO, "export_extract", lambda *a, **b: whole(*a, **b) | {"fingerprint": "1:2"})
    put = IO.load_mode
    monkeypatch.setattr(IO, "load_mode", lambda df, path, fresh: loaded.append(path) or put(df, path, fresh))
    target = IO.staging_dir(spark, "target")
    out = Migration(spark, target, IO.staging_dir(spark, "journal")).run({"t_parameter": _rows(spark)}, ["t_parameter"]).collect()
    assert [r.status for r in out] == ["content mismatch"]
    assert Target(spark, target).version() == 0
    folder = spark._jvm.org.apache.hadoop.fs.Path(loaded[0])
    assert not folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(folder)
