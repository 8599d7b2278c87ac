"""What the check summary shuffles and writes, and that its counts stay those of all rows."""

import random

import pytest

from tallybook.operators import checks as C
from tallybook.operators.checks import Rule
from tallybook.plans import catalog as K
from tallybook.sources.complete import PARENT, CompleteLedger
from tallybook.sources.fixtures import Ledger

REFS = [Rule("wide", "c", "foreign_key", ("o", "name", "pid"), ref_table="p", ref_columns=("o", "name", "id")),
        Rule("middle", "c", "foreign_key", ("name", "o"), ref_table="p", ref_columns=("name", "o")),
        Rule("one", "c", "foreign_key", ("pid",), ref_table="p", ref_columns=("id",)),
        Rule("crossed", "c", "foreign_key", ("o",), ref_table="p", ref_columns=("name",))]
UNIQUE = [Rule("-".join(s), "c", "unique", s) for s in (("name",), ("o", "name"), ("o", "name", "pid"), ("pid",), ("o", "pid", "n"))]


def test_only_keys_that_may_repeat_are_shuffled_whole(spark):
    df = spark.range(5000).selectExpr("concat('name-', id) as name", "cast(id % 3 as string) as o", "id")
    twice = df.union(df.where("id in (7, 8)")).union(spark.sql("select null, 'x', 1"))
    left = C._may_repeat(twice, ("o", "name"))
    assert left.count() < 50
    counts = C._repeat_counts(twice, [("name",), ("name", "o")])
    for ks in (("name",), ("name", "o")):
        assert sorted((r.name, r._tb_n) for r in counts[ks].where("_tb_n > 1").collect()) == [("name-7", 2), ("name-8", 2)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_counts_are_those_of_every_row_by_itself(spark, seed):
    rng = random.Random(seed)
    maybe = lambda x: None if rng.random() < 0.1 else x
    make = lambda n: [(maybe(rng.choice("xyz")), maybe(rng.choice("xyzabcd")), maybe(3 if rng.random() < 0.3 else rng.randrange(40)),
                       maybe(rng.randrange(4))) for _ in range(n)]
    child, parent = make(300), make(60) * 2
    columns = ("o", "name", "pid", "n")
    got = {r.rule: r.violations for r in C.summary({
        "c": spark.createDataFrame(child, "o string, name string, pid long, n int"),
        "p": spark.createDataFrame(parent, "o string, name string, id int, n int")}, REFS + UNIQUE).collect()}
    expected = {}
    for r in REFS:
        held = {tuple(row[("o", "name", "id", "n").index(c)] for c in r.ref_columns) for row in parent}
        keys = [tuple(row[columns.index(c)] for c in r.columns) for row in child]
        expected[r.name] = sum(None not in k and k not in held for k in keys)
    for r in UNIQUE:
        keys = [tuple(row[columns.index(c)] for c in r.columns) for row in child]
        expected[r.name] = len({k for k in keys if None not in k and keys.count(k) > 1})
    assert got == expected


@pytest.mark.parametrize("name", sorted(PARENT))
def test_joined_tables_are_judged_before_the_join(spark, ledger, name):
    rules = [r for r in K.ROW_RULES if r.table == name]
    keys = tuple(dict.fromkeys(c for r in K.ALL_RULES + K.LEGACY_RULES if r.table == name and r.kind in C.SET_KINDS for c in r.columns))
    full, once = getattr(CompleteLedger.of(ledger), name), CompleteLedger.once(ledger)
    judged = once.judged(name, keys, tuple(rules), "1998-06-01")
    assert judged.columns == [*keys, C.BROKEN]  # neither images nor amounts that are no key
    assert [f.dataType for f in judged.schema.fields[:-1]] == [full.schema[c].dataType for c in keys]
    whole = full.select(*keys, C.broken_bits([*enumerate(rules)], "1998-06-01").alias(C.BROKEN))
    assert judged.count() == whole.count()
    assert judged.exceptAll(whole).count() == 0
    # the verdict reads what the summary has written
    assert once.judged(name, keys, tuple(rules), "1998-06-01") is judged and CompleteLedger.once(ledger) is once


def test_projections_and_clusters_are_not_written_for_the_summary(spark, tmp_path):
    lg = Ledger(spark, "/root/testdata/sf0.001", materialize=True, path=str(tmp_path))
    once = CompleteLedger.once(lg)
    assert once.t_payment.count() and once.t_token_blacklist.count() and once.t_transaction.count()
    written = {p.parent.name for p in tmp_path.glob("*/unclustered/*/_SUCCESS")}
    assert written and not written & {"t_payment", "t_token_blacklist", "t_account_billing"}
    assert not list(tmp_path.glob("*/t_transaction"))
    lg.release()
    assert not list(tmp_path.iterdir())
