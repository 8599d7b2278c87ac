"""Summaries kept up to date against full runs on the tables as they are then."""

import random

import pytest

from tallybook.operators import checks as C
from tallybook.operators.check_state import CheckState
from tallybook.operators.checks import Rule

RULES = [Rule("pk", "p", "unique", ("id",)), Rule("uq", "p", "unique", ("o", "name")), Rule("c_uq", "c", "unique", ("id", "pid")),
         Rule("fk", "c", "foreign_key", ("pid",), ref_table="p", ref_columns=("id",)),
         Rule("fk2", "c", "foreign_key", ("o", "name"), ref_table="p", ref_columns=("o", "name")),
         Rule("self", "p", "foreign_key", ("up",), ref_table="p", ref_columns=("id",)),
         Rule("nn", "c", "not_null", ("name",)), Rule("low", "p", "lowercase", ("name",)),
         Rule("warn", "c", "foreign_key", ("o",), ref_table="p", ref_columns=("o",), severity="warning")]
COLUMNS = {"p": "id int, o string, name string, up long", "c": "id int, o string, name string, pid long"}


def rows(rng, table, n):
    maybe = lambda x: None if rng.random() < 0.1 else x
    hot = lambda k: 3 if rng.random() < 0.33 else k
    return [(maybe(rng.randrange(60)), maybe(rng.choice("xyz")), maybe(rng.choice("aAbBcdef")), maybe(hot(rng.randrange(80))))
            for _ in range(n)]


def found(df):
    return {r.rule: (r.severity, r.violations, r.table) for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_changes_give_the_summary_of_a_full_run(spark, tmp_path, seed):
    rng = random.Random(seed)
    now = {t: rows(rng, t, 120) for t in "pc"}
    frame = lambda t, r: spark.createDataFrame(r, COLUMNS[t])
    state = CheckState.create(spark, str(tmp_path), {t: frame(t, r) for t, r in now.items()}, RULES)
    assert found(state.summary()) == found(C.summary({t: frame(t, r) for t, r in now.items()}, RULES))
    for step in range(3):
        new = {t: rows(rng, t, 12) for t in ("pc", "p", "c")[step]}
        gone = {t: rng.sample(now[t], 30) for t in ("c", "pc", "p")[step]}
        for t, r in gone.items():
            for row in r:
                now[t].remove(row)
        for t, r in new.items():
            now[t] += r
        got = found(state.update({t: frame(t, r) for t, r in new.items()}, {t: frame(t, r) for t, r in gone.items()}))
        full = found(C.summary({t: frame(t, r) for t, r in now.items()}, RULES))
        assert got == full
        if step == 1:
            state.compact()
            assert found(state.summary()) == full
    assert any(n for _, n, _ in full.values())
    assert found(state.update()) == full
    # rows that come and go at once change nothing
    same = {"p": frame("p", rows(rng, "p", 5))}
    assert found(state.update(same, same)) == full


def test_a_change_reads_no_table(spark, tmp_path):
    source = str(tmp_path / "source")
    spark.createDataFrame([(1, "x", "a", None), (2, "x", "b", 1)], COLUMNS["p"]).write.parquet(f"{source}/p")
    spark.createDataFrame([(1, "x", "a", 1), (2, "x", "z", 9)], COLUMNS["c"]).write.parquet(f"{source}/c")
    tables = {t: spark.read.parquet(f"{source}/{t}") for t in "pc"}
    state = CheckState.create(spark, str(tmp_path / "state"), tables, RULES)
    import shutil
    shutil.rmtree(source)  # the test's own folder
    got = found(state.update({"p": spark.createDataFrame([(9, "x", "z", 2), (2, "y", "b", None)], COLUMNS["p"])}))
    assert got["fk"][1] == 0 and got["fk2"][1] == 0 and got["pk"][1] == 1 and got["self"][1] == 0


def test_a_change_that_fails_leaves_the_last_summary(spark, tmp_path):
    from pyspark.sql import functions as F

    tables = {"p": spark.createDataFrame([(1, "x", "a", None)], COLUMNS["p"]), "c": spark.createDataFrame([], COLUMNS["c"])}
    state = CheckState.create(spark, str(tmp_path), tables, RULES)
    before = found(state.summary())
    bad = tables["p"].withColumn("o", F.when(F.col("id") == 1, F.raise_error(F.lit("gone")).cast("string")).otherwise("q"))
    with pytest.raises(Exception, match="gone"):
        state.update({"p": bad})
    assert found(state.summary()) == before
    assert found(state.update({"p": tables["p"]}))["pk"][1] == 1  # and the next one counts its own rows only
