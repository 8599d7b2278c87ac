"""Hard negatives against scores of every anchor with every row."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybook.llm import hard_negatives as H
from tallybook.llm.queries import ship


def plain(rows, positives=5, negatives=3, window=(50, 95)):
    """(anchor, positive, rank, negative, scores) of rows (id, label, vector, anchor), by whole-number arithmetic."""
    rows = [(k, *r) for k, r in enumerate(rows) if r[1] is not None and r[2] is not None and None not in r[2]]
    out = Counter()
    for k, i, label, v, anchor in rows:
        if not anchor:
            continue
        scored = [(-sum(int(x) * int(y) for x, y in zip(v, w)), j is None, j or 0, n, j, other)
                  for n, j, other, w, _ in rows if n != k and len(w) == len(v)]
        best = sorted((s for s in scored if s[5] == label), key=lambda s: s[:4])[:positives]
        for p in best:
            inside = [s for s in scored if s[5] != label and window[0] * -p[0] <= 100 * -s[0] <= window[1] * -p[0]]
            for rank, s in enumerate(sorted(inside, key=lambda s: s[:4])[:negatives], 1):
                out[i, p[4], rank, s[4], -p[0], -s[0]] += 1
    return out


def test_a_spanning_tree_is_minimal_and_visits_parents_first():
    rng = np.random.default_rng(2)
    points = rng.normal(size=(40, 5))
    order, parent, edge = H.spanning_tree(points)
    place = np.argsort(order)
    assert sorted(order) == list(range(40)) and parent[order[0]] == -1
    assert all(place[parent[k]] < place[k] for k in order[1:])
    assert np.allclose(edge[order[1:]], np.linalg.norm(points[order[1:]] - points[parent[order[1:]]], axis=1))
    pairs = sorted((float(np.linalg.norm(points[i] - points[j])), i, j) for i in range(40) for j in range(i))
    root, total = list(range(40)), 0.0
    for d, i, j in pairs:  # by the shortest edges first
        if root[i] != root[j]:
            total, root = total + d, [root[i] if r == root[j] else r for r in root]
    assert edge.sum() == pytest.approx(total)


@pytest.mark.parametrize("spread, scale", [(0.02, 100), (0.3, 100), (3.0, 100), (0.0, 7), (0.1, 3 * 10 ** 8)])
def test_bounds_lose_no_candidate_and_save_scores(spread, scale):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(5, 8))
    make = lambda n: np.floor(scale * (centres[rng.integers(0, 5, n)] + spread * rng.normal(size=(n, 8)))).astype(np.int64)
    part = H.Slice(np.arange(600), rng.permutation(600), np.arange(600) % 50 == 0, rng.integers(0, 3, 600), make(600))
    anchors = make(30)
    every = part.vectors.astype(object) @ anchors.T.astype(object)
    if scale > 100:  # beyond doubles, within 64 bits
        assert max(abs(x) for x in every.ravel()) > 2 ** 53
    for same in (True, False):
        lo, hi = (H.LOWEST, H.HIGHEST) if same else (int(np.quantile(every.astype(float), 0.90)), int(np.quantile(every.astype(float), 0.97)))
        block = {"rows": np.arange(1000, 1030), "labels": rng.integers(0, 3, 30), "vectors": anchors, "of": np.arange(30),
                 "lo": np.full(30, lo), "hi": np.full(30, hi), "floor": np.full(30, H.LOWEST)}
        block["rows"][3] = 17  # an anchor among the candidates
        part.scored = 0
        got = [(a, p, s) for a, _, p, s in H.search(block, part, same, 4)]
        assert part.scored < 30 * 600 or spread > 0.2 or scale != 100
        want = []
        for a in range(30):
            fits = [p for p in range(600) if (part.labels[p] == block["labels"][a]) == same and lo <= every[p, a] <= hi
                    and not (same and part.rows[p] == block["rows"][a])]
            fits.sort(key=lambda p: (-every[p, a], part.nulls[p], part.ids[p], part.rows[p]))
            want += [(a, p, int(every[p, a])) for p in fits[:4]]
        assert Counter(got) == Counter(want)


def test_whole_table_with_nulls_ties_repeats_and_widths(spark, monkeypatch):
    ship(spark)
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(6, 7))
    rows = [(k, int(rng.integers(0, 3)), [int(x) for x in np.floor(40 * (centres[k % 6] + 0.3 * rng.normal(size=7)))], k % 9 == 0)
            for k in range(300)]
    rows += [(1000 + k, 1, rows[9][2], k % 4 == 0) for k in range(40)]  # a hot vector, all ties
    rows += [(1100 + k, 2, rows[9][2], False) for k in range(10)]
    rows += [(9, rows[9][1], rows[9][2], True), (9, rows[9][1], rows[9][2], True), (None, 1, rows[18][2], True)]
    rows += [(2000, None, [1] * 7, True), (2001, 1, None, True), (2002, 1, [1, None, 1, 1, 1, 1, 1], True), (2003, 1, [], True)]
    rows += [(3000 + k, k % 2, [k, 1], k < 3) for k in range(12)] + [(3100, 0, [0] * 7, True), (3101, 5, [7] * 7, None)]
    df = spark.createDataFrame(rows, "vec_id long, label int, vector array<long>, anchor boolean").coalesce(1)
    df = df.withColumns({c: F.lit("x") for c in ("row", "cell", "slice", "block", "id", "v", "key", "score")})
    got = Counter(tuple(r) for r in H.hard_negatives(df).collect())
    assert got == plain(rows) and len(got) > 300
    monkeypatch.setattr(H, "POSITIVES", 5)
    few = Counter(tuple(r) for r in H.hard_negatives(df, positives=2, negatives=1, window=(10, 100)).collect())
    assert few == plain(rows, 2, 1, (10, 100))
    assert H.hard_negatives(df.where("false")).count() == 0
    assert H.hard_negatives(df.where("not anchor")).count() == 0


def test_query_rows_follow_the_contract(spark):
    rows = [(7, [0.5, -0.001], 9), (50, [1.0, float("nan")], 1), (100, None, 1), (150, [1.0, None], 1), (0, [0.1, 0.2], None), (350, [], 2)]
    got = {r.vec_id: (r.label, r.vector, r.anchor) for r in H.prepared(
        spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    assert got == {7: (0, [128, -1], False), 0: (None, [25, 51], True), 350: (3, [], True)}


def test_slices_and_blocks_are_bounded(spark, monkeypatch):
    """More rows than a slice and a block hold, in one cell, cut as a task would."""
    import pyarrow as pa

    from pyspark import TaskContext

    monkeypatch.setattr(H, "SLICE", 10)
    monkeypatch.setattr(H, "BLOCK", 3)
    monkeypatch.setattr(TaskContext, "get", staticmethod(lambda: type("T", (), {"partitionId": lambda self: 0})()))
    n = 47
    anchor = [k % 2 == 0 for k in range(n)]
    cells = [0] * 30 + [1] * 17
    batch = pa.record_batch([pa.array(range(n)), pa.array(range(n)), pa.array([1] * n), pa.array(anchor), pa.array([1] * n, pa.int32()),
                             pa.array([np.array([k], np.int64).tobytes() for k in range(n)], pa.binary()), pa.array(cells, pa.int32())],
                            schema=H._DEALT)
    out = [r for b in H._number(iter([batch.slice(0, 33), batch.slice(33)])) for r in b.to_pylist()]
    rows = [r for r in out if r["row"] is not None]
    assert [r["row"] for r in rows] == list(range(n)) and all((r["block"] is None) != r["anchor"] for r in rows)
    for name, limit in (("slice", 10), ("block", 3)):
        held = {}
        for r in rows:
            if r[name] is not None:
                held.setdefault(r[name], []).append(r["row"])
        marks = {r[name]: r for r in out if r["row"] is None and r[name] is not None}
        assert marks.keys() == held.keys() and max(map(len, held.values())) == limit
        for k, own in held.items():
            assert len({cells[r] for r in own}) == 1
            assert marks[k]["centre"] == [pytest.approx(np.mean(own))]
            assert marks[k]["radius"] == pytest.approx(max(abs(r - np.mean(own)) for r in own))
