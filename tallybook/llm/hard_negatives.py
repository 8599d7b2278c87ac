"""Hard negatives by bounds along spanning trees of anchors.

Rows are dealt to cells by their nearest pivot; the pivots are a hash sample of
anchors that grows with the square root of their number.  A cell's rows are
numbered into slices of ``SLICE`` rows and its anchors into blocks of ``BLOCK``,
each with its centre and covering radius.  The bound of a block and a slice,
centre product plus or minus radii times norms, decides from those summaries
alone whether any anchor's search can need the slice; only then are the block's
anchors sent there.

In a task the anchors of a block form a minimum spanning tree.  The root is
scored against the whole slice.  A child's scores lie within its parent's bounds
plus or minus the edge's length times the candidate's norm; only candidates
whose bounds overlap a window that is searched are scored, exactly, the others
hand their wider bounds on.

Both searches, for positives (same label, best scores) and negatives (other
labels, a window below the positive's score), first run on the slices of the
anchor's own cell.  What they find there is a floor for all other slices.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import numbered, store

#: rows of a slice and anchors of a block: what a task holds at once
SLICE = 16384
BLOCK = 256
#: numbers of a table of distances that is made at once
TABLE = 4 << 20
POSITIVES = 5
NEGATIVES = 3
#: a negative scores from the first to the second of these shares of its positive's score, in percent
WINDOW = (50, 95)
#: room for rounding in bounds, relative and absolute
ROOM, LEAST_ROOM = 1e-9, 1e-6
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1


def spanning_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimum spanning tree from the point nearest the mean: order of visit, parent and edge length of each."""
    n = len(points)
    near = int(((points - points.mean(axis=0)) ** 2).sum(axis=1).argmin())
    order, parent, edge = np.zeros(n, np.int64), np.full(n, -1), np.zeros(n)
    best, of, left = np.full(n, np.inf), np.full(n, near), np.ones(n, bool)
    for k in range(n):
        order[k], left[near] = near, False
        parent[near], edge[near] = (of[near], best[near]) if k else (-1, 0.0)
        d = np.sqrt(((points - points[near]) ** 2).sum(axis=1))
        closer = left & (d < best)
        best[closer], of[closer] = d[closer], near
        if k < n - 1:
            near = int(np.where(left, best, np.inf).argmin())
    return order, parent, edge


class Slice:
    """Candidates: numbers of their rows, ids (null last), labels and whole-number vectors."""

    def __init__(self, rows, ids, nulls, labels, vectors):
        self.rows, self.ids, self.nulls, self.labels, self.vectors = rows, ids, nulls, labels, vectors
        self.norms = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
        self.floats = vectors.astype(np.float64)
        self.scored = 0

    def scores(self, vector: np.ndarray, own=slice(None)) -> np.ndarray:
        """Exact inner products: in double precision where every sum stays below 2 ** 53."""
        length = math.sqrt(float((vector.astype(np.float64) ** 2).sum()))
        floats = self.floats[own]
        self.scored += len(floats)
        if length * (self.norms.max() if len(self.norms) else 0.0) < 2.0 ** 52:
            return floats @ vector.astype(np.float64)
        made = [sum(int(x) * int(y) for x, y in zip(v, vector, strict=True)) for v in self.vectors[own]]
        if any(not LOWEST <= s <= HIGHEST for s in made):
            raise ValueError("a score does not fit 64 bits")
        return np.array(made, object)

    def best(self, own: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
        """Places among ``own`` of the k best: higher scores, then smaller ids, then earlier rows."""
        if len(own) > 4 * k and scores.dtype != object:
            own_best = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
        else:
            own_best = np.arange(len(own))
        sub = own[own_best]
        order = sorted(range(len(sub)), key=lambda j: (-scores[own_best[j]], self.nulls[sub[j]], self.ids[sub[j]], self.rows[sub[j]])) \
            if scores.dtype == object else np.lexsort((self.rows[sub], self.ids[sub], self.nulls[sub], -scores[own_best]))
        return own_best[order[:k]]


def search(block: dict, part: Slice, same: bool, k: int) -> Iterator[tuple[int, int, int, int]]:
    """``(anchor, query, place in the slice, score)``: the k best of every query's window.

    ``block`` holds arrays: rows, labels, vectors of anchors; per query its
    anchor's place and lo, hi, floor: scores from the greater of lo and floor up
    to hi are searched.  With ``same`` the candidates are the other rows of the
    anchor's label, else the rows of other labels.
    """
    points = block["vectors"].astype(np.float64)
    order, parent, edge = spanning_tree(points)
    children = np.bincount(parent[parent >= 0], minlength=len(points))
    queries: dict[int, list[int]] = {}
    for q, a in enumerate(block["of"].tolist()):
        queries.setdefault(a, []).append(q)
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for a in order.tolist():
        vector, up = block["vectors"][a], int(parent[a])
        if up >= 0:
            room = edge[a] * (1 + ROOM) * part.norms + LEAST_ROOM
            low, high = held[up][0] - room, held[up][1] + room
            children[up] -= 1
            if not children[up]:
                del held[up]
        own = queries.get(a, [])
        if up < 0:
            need = np.ones(len(part.rows), bool)
        elif own:
            fits = part.labels == block["labels"][a]
            fits = fits & (part.rows != block["rows"][a]) if same else ~fits
            least = min(max(block["lo"][q], block["floor"][q]) for q in own)
            most = max(block["hi"][q] for q in own)
            need = fits & (high >= least) & (low <= most)
            if same and fits.sum() > k:  # one window, open above: k lower bounds are a floor too
                need &= high >= np.partition(low[fits], -k)[-k]
        else:
            need = np.zeros(len(part.rows), bool)
        if need.sum() * 4 > len(need):
            scores = part.scores(vector)
            places, scores = np.arange(len(need)), scores
            bounds = scores.astype(np.float64)
            if children[a]:
                room = np.abs(bounds) * ROOM if scores.dtype == object else 0.0
                held[a] = bounds - room, bounds + room
        else:
            places = np.flatnonzero(need)
            scores = part.scores(vector, places)
            if children[a]:
                bounds = scores.astype(np.float64)
                room = np.abs(bounds) * ROOM if scores.dtype == object else 0.0
                low[places], high[places] = bounds - room, bounds + room
                held[a] = low, high
        if not own:
            continue
        fits = part.labels[places] == block["labels"][a]
        fits = fits & (part.rows[places] != block["rows"][a]) if same else ~fits
        places, scores = places[fits], scores[fits]
        for q in own:
            inside = np.flatnonzero((scores >= max(block["lo"][q], block["floor"][q])) & (scores <= block["hi"][q]))
            for j in part.best(places[inside], scores[inside], k).tolist():
                yield a, q, int(places[inside[j]]), int(scores[inside[j]])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int64).reshape(len(column), width)


_DEALT = pa.schema([("row", pa.int64()), ("id", pa.int64()), ("label", pa.int64()), ("anchor", pa.bool_()),
                    ("width", pa.int32()), ("v", pa.binary()), ("cell", pa.int32())])


def _dealer(pivots: dict[int, np.ndarray]):
    """Adds the nearest pivot of the same width to every row; rows of other widths share a cell."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch["v"].value_lengths().to_numpy()
            for width in np.unique(lengths).tolist():
                own = batch.filter(pa.array(lengths == width))
                points = own["v"].flatten().to_numpy().reshape(-1, width) if width else np.zeros((own.num_rows, 0), np.int64)
                cells = np.zeros(own.num_rows, np.int32)
                if width in pivots:
                    centres = pivots[width].astype(np.float64)
                    squares, step = (centres ** 2).sum(axis=1), max(1, TABLE // len(centres))
                    for at in range(0, len(points), step):
                        some = points[at:at + step].astype(np.float64)
                        cells[at:at + step] = (squares - 2 * some @ centres.T).argmin(axis=1)
                yield pa.record_batch([own["row"], own["id"], own["label"], own["anchor"],
                                       pa.array(np.full(own.num_rows, width, np.int32)),
                                       pa.array([p.tobytes() for p in points], pa.binary()), pa.array(cells)], schema=_DEALT)
    return deal


_NUMBERED = pa.schema([*_DEALT, ("slice", pa.int64()), ("block", pa.int64()), ("centre", pa.list_(pa.float64())),
                       ("radius", pa.float64())])


def _summary(width: int, cell: int, name: str, number: int, points: np.ndarray) -> pa.RecordBatch:
    centre = points.mean(axis=0, dtype=np.float64)
    radius = float(np.sqrt(((points - centre) ** 2).sum(axis=1)).max())
    made = {"width": width, "cell": cell, name: number, "centre": centre.tolist(), "radius": radius}
    return pa.record_batch([pa.array([made.get(f.name)], f.type) for f in _NUMBERED], schema=_NUMBERED)


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by width and cell: numbers slices and blocks, and gives a summary row of each."""
    from pyspark import TaskContext

    made = TaskContext.get().partitionId() << 32
    now, open_rows, open_anchors, slice_no, block_no = None, [], [], -1, -1

    def close(rows: bool, anchors: bool):
        if rows and open_rows:
            yield _summary(*now, "slice", slice_no, np.concatenate(open_rows))
            open_rows.clear()
        if anchors and open_anchors:
            yield _summary(*now, "block", block_no, np.concatenate(open_anchors))
            open_anchors.clear()

    for batch in batches:
        at = 0
        keys = np.column_stack([batch["width"].to_numpy(), batch["cell"].to_numpy()])
        anchor = batch["anchor"].to_numpy(zero_copy_only=False)
        while at < len(keys):
            key = tuple(keys[at].tolist())
            if key != now:
                yield from close(True, True)
                now = key
            end = at + int(np.append((keys[at:] != keys[at]).any(axis=1), True).argmax())
            end = min(end, at + SLICE - sum(map(len, open_rows)))
            inside = np.cumsum(anchor[at:end])
            room = BLOCK - sum(map(len, open_anchors))
            if len(inside) and inside[-1] > room:
                end = at + int(np.searchsorted(inside, room, side="right"))
            if end == at:  # the block is full
                yield from close(False, True)
                continue
            own = batch.slice(at, end - at)
            points, marks = _matrix(own["v"], now[0]), anchor[at:end]
            if not open_rows:
                slice_no, made = made, made + 1
            if marks.any() and not open_anchors:
                block_no, made = made, made + 1
            open_rows.append(points)
            if marks.any():
                open_anchors.append(points[marks])
            n = end - at
            yield pa.record_batch([*own.columns, pa.array(np.full(n, slice_no)), pa.array(np.full(n, block_no), mask=~marks),
                                   pa.nulls(n, pa.list_(pa.float64())), pa.nulls(n, pa.float64())], schema=_NUMBERED)
            at = end
            yield from close(sum(map(len, open_rows)) >= SLICE, sum(map(len, open_anchors)) >= BLOCK)
    yield from close(True, True)


_FOUND = pa.schema([("row", pa.int64()), ("key", pa.int64()), ("other", pa.int64()), ("other_id", pa.int64()), ("score", pa.int64())])


def _searcher(same: bool, k: int):
    """Rows by slice: its candidates, then by block the anchors with their queries."""
    def blocks(batches):
        now, rows = None, []
        for batch in batches:
            unit = np.column_stack([batch["slice"].to_numpy(), batch["kind"].to_numpy(), batch["block"].to_numpy()])
            edges = np.flatnonzero((np.diff(unit, axis=0) != 0).any(axis=1)) + 1
            for a, b in zip([0, *edges], [*edges, len(unit)], strict=True):
                if a == b:
                    continue
                key = tuple(unit[a].tolist())
                if key != now and rows:
                    yield now, pa.Table.from_batches(rows).combine_chunks()
                    rows = []
                now = key
                rows.append(batch.slice(a, b - a))
        if rows:
            yield now, pa.Table.from_batches(rows).combine_chunks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = None
        for (_, kind, _), table in blocks(batches):
            vectors = _matrix(table["v"], table["width"][0].as_py())
            rows, labels = table["row"].to_numpy(), table["label"].to_numpy()
            if not kind:
                part = Slice(rows, table["id"].fill_null(0).to_numpy(), table["id"].is_null().to_numpy(), labels, vectors)
                names = table["id"]
                continue
            sizes = table["queries"].combine_chunks().value_lengths().to_numpy()
            asked = table["queries"].combine_chunks().flatten().flatten()
            key, lo, hi, floor = (c.to_numpy() for c in asked)
            block = {"rows": rows, "labels": labels, "vectors": vectors, "of": np.repeat(np.arange(len(rows)), sizes),
                     "lo": lo, "hi": hi, "floor": floor}
            found = np.array(list(search(block, part, same, k)), np.int64).reshape(-1, 4)
            if len(found):
                yield pa.record_batch([pa.array(rows[found[:, 0]]), pa.array(key[found[:, 1]]), pa.array(part.rows[found[:, 2]]),
                                       names.take(pa.array(found[:, 2])).combine_chunks(), pa.array(found[:, 3])], schema=_FOUND)
    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best of every anchor row and key, numbered from 1."""
    order = Window.partitionBy("row", "key").orderBy(F.col("score").desc(), F.col("other_id").asc_nulls_last(), "other")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


class Rows:
    """Stored rows with their slices and blocks, and the summaries of both."""

    def __init__(self, held: DataFrame):
        spark = held.sparkSession
        n = held.where("anchor").count()
        sample = held.where("anchor").orderBy(F.xxhash64("row"), "row").limit(math.ceil(math.sqrt(n))).select("v").collect()
        pivots: dict[int, list] = {}
        for (v,) in sample:
            pivots.setdefault(len(v), []).append(v)
        pivots = {w: np.array(p, np.int64).reshape(len(p), w) for w, p in pivots.items()}
        dealt = held.mapInArrow(_dealer(pivots), "row long, id long, label long, anchor boolean, width int, v binary, cell int")
        made = store(store(dealt, "cells").repartitionByRange("width", "cell", "row")
                     .sortWithinPartitions("width", "cell", "row").mapInArrow(
            _number, "row long, id long, label long, anchor boolean, width int, v binary, cell int, slice long, block long, "
                     "centre array<double>, radius double"), "slices")
        self.rows = made.where("row is not null").drop("centre", "radius")
        length = F.sqrt(F.aggregate("centre", F.lit(0.0), lambda s, x: s + x * x))
        both = made.where("row is null").withColumn("length", length)
        slices, blocks = (both.where(f"{c} is not null").select(
            "width", F.col("cell").alias(f"{c}_cell"), c, F.col("centre").alias(f"{c}_centre"), F.col("radius").alias(f"{c}_radius"),
            F.col("length").alias(f"{c}_length")) for c in ("slice", "block"))
        middle = F.aggregate(F.zip_with("slice_centre", "block_centre", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
        off = (F.col("slice_radius") * F.col("block_length") + F.col("block_radius") * F.col("slice_length")
               + F.col("slice_radius") * F.col("block_radius"))
        off = off + F.lit(ROOM) * (off + F.abs("middle") + F.col("slice_length") * F.col("block_length")) + LEAST_ROOM
        # one row a block and a slice: summaries alone
        self.units = store(blocks.join(slices, "width").withColumn("middle", middle).select(
            "block", "slice", (F.col("slice_cell") == F.col("block_cell")).alias("home"),
            (F.col("middle") - off).alias("least"), (F.col("middle") + off).alias("most")), "units")
        self.spark = spark

    def find(self, queries: DataFrame, same: bool, k: int) -> DataFrame:
        """The k best rows in the window of every query ``(row, key, lo, hi)``; ``key`` tells an anchor's apart."""
        asked = queries.withColumn("floor", F.lit(LOWEST))
        home = store(self._run(self.units.where("home"), asked, same, k), "found-home")
        floors = _best(home, k).where(F.col("rank") == k).select("row", "key", F.col("score").alias("floor"))
        asked = queries.join(floors, ["row", "key"], "left").withColumn("floor", F.coalesce("floor", F.lit(LOWEST)))
        asked = store(asked, "floors")
        wanted = asked.join(self.rows.where("anchor").select("row", "block"), "row").groupBy("block").agg(
            F.min(F.greatest("lo", "floor")).alias("from"), F.max("hi").alias("to"))
        others = self.units.where("not home").join(wanted, "block").where(
            "most >= from and least <= to").select("block", "slice")
        return _best(home.unionByName(self._run(others, asked, same, k)), k)

    def _run(self, units: DataFrame, asked: DataFrame, same: bool, k: int) -> DataFrame:
        lists = asked.groupBy("row").agg(F.collect_list(F.struct("key", "lo", "hi", "floor")).alias("queries"))
        anchors = self.rows.where("anchor").join(lists, "row").drop("slice")
        sent = units.select("block", "slice").join(anchors, "block").select(
            "slice", F.lit(1).alias("kind"), "block", "row", "id", "label", "width", "v", "queries")
        parts = self.rows.join(units.select("slice").distinct(), "slice").select(
            "slice", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("block"), "row", "id", "label", "width", "v",
            F.lit(None).cast(sent.schema["queries"].dataType).alias("queries"))
        return (parts.unionByName(sent).repartition("slice").sortWithinPartitions("slice", "kind", "block", "row")
                .mapInArrow(_searcher(same, k), "row long, key long, other long, other_id long, score long"))


def _percent(score: str, share: int, up: bool) -> Column:
    """A share of a whole score in percent, rounded to a whole number inside the window."""
    exact = F.col(score).cast("decimal(20,0)") * F.lit(share) / F.lit(100)
    return (F.ceil(exact) if up else F.floor(exact)).cast("long")


def hard_negatives(vectors: DataFrame, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "vector",
                   anchor_col: str = "anchor", positives: int = POSITIVES, negatives: int = NEGATIVES,
                   window: tuple[int, int] = WINDOW) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vector_col`` is an array of whole numbers, ``anchor_col`` says which rows
    are anchors (null: not).  Rows whose label, vector or any component is null
    take no part; vectors of different length have no score.  A positive is one
    of the ``positives`` best rows of the anchor's label other than itself;
    higher scores come first, then smaller ids, null ids last, then the rows'
    order.  Rows that repeat an id are separate rows, so an anchor may list an
    id twice.  An anchor without positives, or whose windows are empty, has no
    row; an empty table gives an empty result.  A score beyond 64 bits
    that is computed is an error.
    """
    source = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                            F.col(vector_col).cast("array<long>").alias("v"),
                            F.coalesce(F.col(anchor_col), F.lit(False)).alias("anchor"))
    held, row = numbered(source.where(F.col("label").isNotNull() & F.col("v").isNotNull()
                                      & F.forall("v", lambda x: x.isNotNull())))
    rows = Rows(held.withColumnRenamed(row, "row"))
    everything = rows.rows.where("anchor").select("row", F.lit(0).cast("long").alias("key"), F.lit(LOWEST).alias("lo"),
                                                  F.lit(HIGHEST).alias("hi"))
    chosen = store(rows.find(everything, True, positives).select(
        "row", F.col("other").alias("positive"), F.col("other_id").alias("positive_id"),
        F.col("score").alias("positive_score")), "positives")
    # positives of one score have one window
    low, high = _percent("positive_score", window[0], True), _percent("positive_score", window[1], False)
    windows = chosen.select("row", F.col("positive_score").alias("key"), low.alias("lo"), high.alias("hi")).where(
        "lo <= hi").distinct()
    found = store(rows.find(windows, False, negatives), "negatives")
    names = rows.rows.where("anchor").select("row", F.col("id").alias("anchor_id"))
    return (chosen.join(found, (chosen["row"] == found["row"]) & (F.col("positive_score") == F.col("key")))
            .select(chosen["row"], "positive_id", F.col("rank").cast("int").alias("rank"), F.col("other_id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score"))
            .join(names, "row")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def prepared(embeddings: DataFrame) -> DataFrame:
    """The query's rows: labels moved where 7 divides the id, components in 256ths, anchors where 50 divides it."""
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return embeddings.where(finite).select("vec_id", label.alias("label"), F.transform(x, lambda c: F.floor(c * 256)).alias("vector"),
                                           (F.col("vec_id") % 50 == 0).alias("anchor"))


QUERY_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
             CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % 50 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
n AS (SELECT p.anchor_id, p.other AS positive_id, s.other AS negative_id, p.score AS positive_score, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, p.other ORDER BY s.score DESC, s.other) AS place
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
       AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE place <= 3
"""
