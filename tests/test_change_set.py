"""Keyed change rows against whole rewrites."""

import os

import pytest
from pyspark.sql import functions as F

from tallybook.operators import joins as J
from tallybook.operators import mutations as M
from tallybook.sources.change_set import ChangedTable


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def source(spark):
    return spark.range(0, 1000, numPartitions=4).select(
        "id", F.when(F.col("id") % 10 > 0, F.concat(F.lit("n"), F.col("id") % 3)).alias("name"),
        (F.col("id") % 7).cast("decimal(8,2)").alias("amount"))


def test_changes_equal_the_whole_rewrite_and_touch_only_their_files(spark, source, tmp_path):
    path = str(tmp_path / "t")
    source.repartitionByRange(5, "id").write.parquet(str(tmp_path / "five"))
    five = spark.read.parquet(str(tmp_path / "five"))
    held = ChangedTable.create(five.repartitionByRange(5, "id"), path, ["id"], clustered=False)
    assert len(held.manifest["files"]) == 5
    stamps = {f: os.stat(f"{path}/{f}").st_mtime_ns for f in held.manifest["files"]}
    lookup = spark.createDataFrame([(5, "x", 1), (7, None, 0), (8, "n2", 8), (250, "y", 3), (5000, "z", 1)], "id long, new_name string, v int")
    want = J.update_from_join(source, lookup, ["id"], {"name": "new_name", "amount": "v"})
    assert held.update_from(lookup, ["id"], {"name": "new_name", "amount": "v"}) == 4
    assert rows(held.read()) == rows(want)
    assert held.update_from(lookup, ["id"], {"name": "new_name"}) == 0  # nothing changes, nothing is written
    assert held.delete(F.col("id").between(240, 249)) == 10
    want = want.where("id not between 240 and 249")
    assert rows(ChangedTable(spark, path).read()) == rows(want)
    log = {(r.id, r.column): (r.kind, r.old, r.new) for r in held.changes().collect()}
    assert log[250, "name"] == ("update", None, "y") and log[7, "name"] == ("update", "n1", None)
    assert (5, "amount") in log and (8, "name") not in log and log[240, None] == ("delete", None, None)
    before = list(held.manifest["files"])
    hit = held.compact()
    assert 1 <= len(hit) <= 2 and set(before) - set(hit) <= set(held.manifest["files"]) and not set(hit) & set(held.manifest["files"])
    assert {f: os.stat(f"{path}/{f}").st_mtime_ns for f in stamps} == stamps  # no file is written again
    assert rows(ChangedTable(spark, path).read()) == rows(want) and held.compact() == [] and held.changes().count() == 0
    held.insert(spark.createDataFrame([(5000, "new", 1)], "id int, name string, amount int"))
    assert held.delete("id = 5000 or name = 'y'") == 2
    assert rows(held.read()) == rows(want.where("name is null or name != 'y'"))
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "id long, new_name string")
    with pytest.raises(Exception, match="not unique"):
        held.update_from(twice, ["id"], {"name": "new_name"})


def test_an_empty_table_and_everything_deleted(spark, source, tmp_path):
    held = ChangedTable.create(source.where("false"), str(tmp_path / "e"), ["id"])
    assert held.read().count() == 0 and held.delete("id > 0") == 0 and held.compact() == []
    held = ChangedTable.create(source, str(tmp_path / "t"), ["id"])
    assert held.delete("true") == 1000 and held.read().count() == 0
    held.compact()
    assert ChangedTable(spark, str(tmp_path / "t")).read().count() == 0


def test_account_fields_by_changes_equal_the_mutation(spark, ledger, tmp_path):
    t, a = ledger.t_transaction, ledger.t_account
    held = ChangedTable.create(t, str(tmp_path / "t"), ["transaction_id"])
    n = held.update_from(a.select("account_name_owner", F.col("account_id").alias("x"), F.col("account_type").alias("y")),
                         ["account_name_owner"], {"account_id": "x", "account_type": "y"})
    want = M.refresh_account_fields(t, a)
    assert rows(held.read().select(*t.columns)) == rows(want)
    assert n == want.exceptAll(t).count()


def test_rows_without_a_change_are_not_joined(spark, source, tmp_path, monkeypatch):
    from tallybook.operators import cascade as C

    held = ChangedTable.create(source, str(tmp_path / "t"), ["id"])
    held.update_from(spark.createDataFrame([(5, "x"), (7, None)], "id long, new_name string"), ["id"], {"name": "new_name"})
    held.delete("id between 20 and 29")
    plain = rows(held.read())
    assert [e["rows"] for e in held.manifest["changes"]] == [2, 10]
    monkeypatch.setattr(C, "_FEW", 0)
    assert rows(held.read()) == plain
    near, far = C.rows_apart(source, ["id"], spark.range(5, 8), 3)
    assert far.count() > 900 and {5, 6, 7} <= {r.id for r in near.collect()}


def test_the_merged_table_is_made_without_the_compacted_one(spark):
    from tallybook.plans import q_mutations as Q
    from tallybook.sources.fixtures import Ledger

    lg = Ledger(spark, "/root/testdata/sf0.001")
    assert Q._changed(lg, "merged").read().count() > 0 and set(lg.__dict__["_changed"]) == {"merged"}
