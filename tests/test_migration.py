"""Published migrations: breaks, restarts, truncation, content checks, rejects."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.operators.cascade import Reference
from tallybook.sources import io as IO
from tallybook.sources import migration as M

NAMES = ["t_one", "t_two", "t_three"]


@pytest.fixture
def tables(spark):
    return {t: spark.createDataFrame([(k, f"  {t} {k} ", None if k % 3 else "") for k in range(10 * (i + 1))],
                                     "id int, name string, note string") for i, t in enumerate(NAMES)}


def broken(df):
    return df.withColumn("id", F.when(F.col("id") >= 0, F.raise_error(F.lit("gone")).cast("int")).otherwise(F.col("id")))


@pytest.fixture
def places(spark, tmp_path):
    return str(tmp_path / "target"), str(tmp_path / "journal")


def rows(target, tables, name):
    return sorted(tuple(r) for r in target.read(name, tables[name].schema).collect())


@pytest.mark.parametrize("step", [0, 1, 2])
def test_a_broken_step_publishes_nothing_and_is_taken_up_again(spark, tables, places, step):
    target, journal = places
    before = {**tables, **{t: df.limit(1) for t, df in tables.items()}}
    M.Migration(spark, target, journal + "-old").run({t: df.where("id = 0") for t, df in tables.items()}, NAMES)
    run = lambda frames: M.Migration(spark, target, journal).run(frames, NAMES).orderBy("step").collect()
    report = run({**tables, NAMES[step]: broken(tables[NAMES[step]])})
    assert [r.status for r in report] == ["ok"] * step + ["failed: USER_RAISED_EXCEPTION"] + ["skipped"] * (2 - step)
    goal = M.Target(spark, target)
    assert goal.version() == 1 and all(len(rows(goal, tables, t)) == 1 for t in before)
    report = run(tables)
    assert [(r.status, r.restored) for r in report] == [("ok", k < step) for k in range(3)]
    assert [(r.source_rows, r.extract_rows, r.loaded_rows) for r in report] == [(n, n, n) for n in (10, 20, 30)]
    want = {t: sorted([tuple(r) for r in df.collect()] + [tuple(r) for r in df.where("id = 0").collect()], key=str) for t, df in tables.items()}
    for _ in range(2):
        assert goal.version() == 2
        for t in NAMES:
            assert sorted((tuple(r) for r in goal.read(t, tables[t].schema).collect()), key=str) == want[t]
        assert all(r.restored for r in run(tables))  # once more: nothing is loaded twice


def test_a_run_lost_after_its_manifest_does_not_publish_again(spark, tables, places):
    target, journal = places
    run = M.Migration(spark, target, journal)
    run.run(tables, NAMES)
    run.journal.delete(f"{journal}/steps/published")
    run.run(tables, NAMES)
    assert M.Target(spark, target).version() == 1 and "published" in run.journal.names()


def test_another_plan_another_publisher_and_giving_up(spark, tables, places):
    target, journal = places
    run = M.Migration(spark, target, journal)
    run.run({**tables, "t_two": broken(tables["t_two"])}, NAMES)
    with pytest.raises(ValueError, match="another plan"):
        run.run(tables, NAMES[:2])
    with pytest.raises(ValueError, match="nothing is published"):
        run.clean()
    M.Migration(spark, target, journal + "2").run(tables, NAMES[:1])  # publishes meanwhile
    with pytest.raises(ValueError, match="not the newest"):
        run.run(tables, NAMES)
    run.abandon()
    assert run.journal.names() == [] and M.Target(spark, target).folders().keys() == {"t_one"}
    report = run.run(tables, NAMES).collect()
    assert not any(r.restored for r in report) and len(rows(M.Target(spark, target), tables, "t_one")) == 20
    run.clean()
    assert len(M.collect_garbage(spark, target)) == 0
    M.Migration(spark, target, journal + "3").run(tables, NAMES[:1], truncate={"t_one": True})
    assert len(M.collect_garbage(spark, target)) == 2 and len(rows(M.Target(spark, target), tables, "t_one")) == 10


def test_truncation_reaches_all_dependents_in_one_publication(spark, tables, places):
    target, journal = places
    graph = [Reference("b", "t_two", ("id",), "t_one", ("id",)), Reference("c", "t_three", ("id",), "t_two", ("id",))]
    load = lambda n, names, **truncate: M.Migration(spark, target, f"{journal}-{n}", graph).run(tables, names, truncate=truncate)
    load(1, NAMES)
    with pytest.raises(ValueError, match="would empty t_two"):
        load(2, ["t_two", "t_one"], t_one=True)
    assert M.Target(spark, target).version() == 1
    load(3, ["t_one"], t_one=True)
    count = lambda: [len(rows(M.Target(spark, target), tables, t)) for t in NAMES]
    assert count() == [10, 0, 0] and M.Target(spark, target).version() == 2
    load(4, ["t_one", "t_three"])
    assert count() == [20, 0, 30]


def test_missing_absent_and_orphans(spark, tables, places):
    target, journal = places
    report = M.Migration(spark, target, journal).run({"t_one": tables["t_one"]}, NAMES[:2]).collect()
    assert [r.status for r in report] == ["ok", "missing"] and M.Target(spark, target).version() == 0
    odd = {"t_one": tables["t_one"], "t_two": tables["t_two"]}
    report = M.Migration(spark, target, journal + "2").run(odd, NAMES[:2], references=[("fk", "t_two", "id", "t_one", "id")]).collect()
    assert report[2].status == "10 rows without parent" and M.Target(spark, target).version() == 0
    report = M.Migration(spark, target, journal + "3").run(odd, NAMES[:1], optional=["t_token_blacklist"],
                                                           columns={"t_one": ["id"]}).collect()
    assert [(r.status, r.extract_rows) for r in report] == [("ok", 10), ("absent", 0)]
    assert M.Target(spark, target).read("t_one", tables["t_one"].select("id").schema).columns == ["id"]


def test_content_of_an_extract(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 0.5), (2, None, None), (3, "", -0.0), (4, " \\ x\n\t\"q,\" ", float("nan")), (4, "\\N", 1e-300)],
                               "id int, t string, d double")
    path = str(tmp_path / "x")
    made = IO.export_extract(df, path, order_by=["id"])
    good = IO.check_extract(spark, path, df.schema, made["rows"], made["fingerprint"])
    assert good["status"] == "ok" and good["rows"] == 5 and good["bytes"] > 50 and good["lines"] >= 6
    assert made["fingerprint"] == IO._print(df.orderBy(F.desc("id")).repartition(3).agg(*IO.fingerprint(df)).first())["fingerprint"]
    for changed in (df.withColumn("t", F.when(F.col("id") == 1, "b").otherwise(F.col("t"))),
                    df.withColumn("t", F.when(F.col("id") == 2, "").otherwise(F.col("t"))),
                    df.withColumn("t", F.when(F.col("id") == 3, None).otherwise(F.col("t"))),
                    df.where("id < 4").union(df.where("id = 4").limit(1)).union(df.where("id = 4").limit(1))):
        IO.export_csv(changed, path, order_by=["id"])
        assert IO.check_extract(spark, path, df.schema, 5, made["fingerprint"])["status"] == "content mismatch"
        assert IO.check_extract(spark, path, df.schema, 5)["status"] == "ok"
    assert IO.check_extract(spark, path, df.schema, 6)["status"] == "count mismatch"
    assert IO.check_extract(spark, str(tmp_path / "none"), df.schema, 6)["status"].startswith("unreadable")
    (tmp_path / "y").mkdir()
    (tmp_path / "y" / "p.csv").write_text("id,t,d\n1,a,0.5\n\n2,b,1.0\n")  # an empty line is no record
    assert IO.check_extract(spark, str(tmp_path / "y"), df.schema, 2)["status"] == "line mismatch"


def test_records_are_loaded_or_rejected(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.IntegerType(), False), T.StructField("d", T.DateType()), T.StructField("b", T.BinaryType()),
                           T.StructField("t", T.StringType()), T.StructField("n", T.DecimalType(5, 2)), T.StructField("at", T.TimestampNTZType())])
    lines = ["id,d,b,t,n,at", "1,2024-02-29,00ff,x\\ny,1.25,2024-01-01 10:00:00", "2,2023-02-29,00,x,1,2024-01-01 10:00:00", "x,,,,,",
             "4,\\N,zz,x,1,\\N", "5,\\N,\\N,\\N,99999.5,\\N", "6,\\N,\\N,\"a,b\",\\N,noon", "\\N,\\N,\\N,x,\\N,\\N", "8,1", "9,,,,,,,",
             "10,\\N,\\N,\" \",\\N,\\N"]
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("\n".join(lines) + "\n")
    report = IO.load_csv(spark, str(folder), str(tmp_path / "out"), str(tmp_path / "bad"), schema)
    assert report == {"records": 10, "loaded": 2, "rejected": 8, "status": "ok"}
    good = spark.read.schema(schema).parquet(str(tmp_path / "out")).orderBy("id").collect()
    assert [(r.id, r.t) for r in good] == [(1, "x\ny"), (10, " ")] and bytes(good[0].b) == b"\x00\xff" and good[0].at.hour == 10
    bad = {r.line.split(",")[0]: r for r in spark.read.parquet(str(tmp_path / "bad")).collect()}
    assert {k: r.reason for k, r in bad.items()} == {
        "2": "d: no date", "x": "id: no int", "4": "b: no binary", "5": "n: no decimal(5,2)", "6": "at: no timestamp_ntz", "\\N": "id: null",
        "8": "wrong number of columns", "9": "wrong number of columns"}
    assert bad["8"].line == "8,1" and all(r.file.endswith("a.csv") for r in bad.values())


def test_extracts_of_a_migration_are_compressed_and_pass(spark, tables, tmp_path):
    import os

    journal, kept = str(tmp_path / "journal"), str(tmp_path / "kept")
    report = M.Migration(spark, str(tmp_path / "target"), journal).run(tables, NAMES).orderBy("step").collect()
    assert [r.status for r in report] == ["ok"] * 3
    files = os.listdir(f"{journal}/extracts/t_two")
    assert any(f.endswith(".csv.gz") for f in files) and not any(f.endswith(".csv") for f in files)
    IO.migrate_tables(spark, tables, NAMES, str(tmp_path / "a"), staging=kept)
    assert sorted(os.listdir(kept)) == sorted(NAMES)  # the caller's folder keeps them
    before = IO.staging_dir
    made = []
    try:
        IO.staging_dir = lambda *a: made.append(before(*a)) or made[-1]
        report = IO.migrate_tables(spark, tables, NAMES, str(tmp_path / "b")).orderBy("step").collect()
    finally:
        IO.staging_dir = before
    assert [(r.loaded_rows, r.status) for r in report] == [(10, "ok"), (20, "ok"), (30, "ok")]
    assert made and not any(os.listdir(m.removeprefix("file:")) for m in made)
    size = IO.extract_size(spark, f"{kept}/t_two")
    assert size["lines"] - size["headers"] == 20 and size["bytes"] > 0
