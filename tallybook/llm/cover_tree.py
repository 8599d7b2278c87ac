"""Exact cosine links between vectors by dual traversal of cover trees.

Vectors are scaled to length one, where cosine c is distance sqrt(2 - 2c).  A
cover tree of a sample gives the upper levels: nested sets of centres with
halving radii, of which the finest with at most so many centres deals all
vectors into cells.  Their number grows with the square root of the number of
distinct vectors (``CELLS`` at least), and so do sample and centres, which is
all that passes through the driver.  Cells are split into chunks of about
``CHUNK`` vectors, and each chunk grows its own lower levels, again nested with halving radii,
down to single vectors or ``FINEST``.  Every node knows its covering radius, the
exact largest distance from its centre to a vector below it.

Pairs of nodes descend together, level by level: a pair whose centres are
further apart than threshold + both radii is pruned, one whose centres plus
radii lie within the threshold links all its vectors at once, and what is left
at the bottom is compared vector by vector in double precision.  Pairs of cells
are pruned by the same bound before any vector is sent to them.  Chunks lie in
blocks of up to ``BLOCK`` components; a task compares the chunks of two blocks, so a
chunk is sent once for each block it has a partner in, not for each partner.

Equal vectors are one class with a weight, and a task returns a count per
vector and one link of each vector to its part, never all pairs.  Where the
vectors have no structure below the threshold, no metric bound prunes anything
and the work grows with the square of the distinct vectors, spread over tasks
of bounded size.  A chunk's tree is grown once and stored with its vectors.
"""

from __future__ import annotations

import itertools
import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_of, numbered, rows_of, store
from .components import components

COSINE = 0.9
#: sampled vectors to a cell
SAMPLE = 16
CELLS = 256
CHUNK = 4096
#: vector components (32 MB) of a block of chunks that a task holds while the chunks of another pass by
BLOCK = 1 << 22
#: radius below which a node is not split further
FINEST = 0.05
#: room for rounding: bounds this close to the threshold are compared exactly
SLACK = 1e-7


def net(points: np.ndarray, radius: float, start: list[int]) -> tuple[list[int], np.ndarray]:
    """Greedy net: centres further than ``radius`` apart that cover all points.

    ``start`` are centres to begin with (nesting).  Returns the centres and the
    number of the nearest one per point.
    """
    centres = list(start)
    best = np.full(len(points), np.inf)
    near = np.zeros(len(points), np.int64)
    for k, c in enumerate(centres):
        _closer(points, c, k, best, near)
    while len(points):
        far = int(best.argmax())
        if best[far] <= radius:
            break
        centres.append(far)
        _closer(points, far, len(centres) - 1, best, near)
    return centres, near


def _closer(points: np.ndarray, centre: int, number: int, best: np.ndarray, near: np.ndarray) -> None:
    d = np.sqrt(np.maximum(2 - 2 * (points @ points[centre]), 0))
    d[centre] = 0
    own = d < best
    best[own], near[own] = d[own], number


def upper_centres(sample: np.ndarray, cells: int = CELLS) -> np.ndarray:
    """Centres of the finest nested level with at most ``cells`` of them."""
    if not len(sample):
        return sample
    centres, radius = [0], 2.0
    while radius > FINEST:
        finer = list(centres)
        best, near = np.full(len(sample), np.inf), np.zeros(len(sample), np.int64)
        for k, c in enumerate(finer):
            _closer(sample, c, k, best, near)
        while best.max() > radius and len(finer) <= cells:
            far = int(best.argmax())
            finer.append(far)
            _closer(sample, far, len(finer) - 1, best, near)
        if len(finer) > cells:
            break
        centres, radius = finer, radius / 2
    return sample[centres]


class Tree:
    """Nested levels of a chunk.  ``levels[k]``: centre, radius and members of each node;
    ``children[k][i]``: nodes of level k + 1 below node i of level k."""

    def __init__(self, points: np.ndarray):
        self.points = points
        members, centres = [np.arange(len(points))], [0]
        radius = self._cover(members[0], 0) if len(points) else 0.0
        self.levels, self.children = [(np.array(centres), np.array([radius]), members)], []
        while radius > FINEST:
            radius /= 2
            new_centres, new_members, below = [], [], []
            for centre, own in zip(centres, members, strict=True):
                if len(own) == 1 or self._cover(own, centre) <= FINEST:
                    parts = [(centre, own)]
                else:
                    at = int(np.flatnonzero(own == centre)[0])
                    found, near = net(points[own], radius, [at])
                    order = np.argsort(near, kind="stable")
                    cuts = np.searchsorted(near[order], np.arange(1, len(found)))
                    parts = [(int(own[f]), own[g]) for f, g in zip(found, np.split(order, cuts), strict=True)]
                below.append(np.arange(len(new_centres), len(new_centres) + len(parts)))
                new_centres += [c for c, _ in parts]
                new_members += [m for _, m in parts]
            centres, members = new_centres, new_members
            radii = np.array([self._cover(m, c) if len(m) > 1 else 0.0 for c, m in zip(centres, members, strict=True)])
            self.children.append(below)
            self.levels.append((np.array(centres), radii, members))
            if radii.max() <= FINEST:
                break

    def _cover(self, own: np.ndarray, centre: int) -> float:
        return float(np.sqrt(np.maximum(2 - 2 * (self.points[own] @ self.points[centre]), 0)).max())


def dual_links(a: Tree, b: Tree, cosine: float = COSINE) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Pairs of member lists: (members of a, members of b, all linked).

    Without the flag the pair must be compared.  With a is b every unordered
    pair of nodes comes once, a node with itself included.
    """
    limit = np.sqrt(2 - 2 * cosine)
    same = a is b
    left, right = np.array([0]), np.array([0])
    depth = max(len(a.levels), len(b.levels))
    for k in range(depth):
        ka, kb = min(k, len(a.levels) - 1), min(k, len(b.levels) - 1)
        (ca, ra, ma), (cb, rb, mb) = a.levels[ka], b.levels[kb]
        keep, joint = [], []
        for s in range(0, len(left), 1 << 16):
            x, y = left[s:s + (1 << 16)], right[s:s + (1 << 16)]
            dot = np.einsum("ij,ij->i", a.points[ca[x]], b.points[cb[y]])
            d = np.sqrt(np.maximum(2 - 2 * dot, 0))
            reach = ra[x] + rb[y]
            keep.append(d - reach <= limit + SLACK)
            joint.append(d + reach <= limit - SLACK)
        if not keep:
            return
        keep, joint = np.concatenate(keep), np.concatenate(joint)
        for i, j in zip(left[joint].tolist(), right[joint].tolist(), strict=True):
            yield ma[i], mb[j], True
        keep &= ~joint
        left, right = left[keep], right[keep]
        if k == depth - 1:
            for i, j in zip(left.tolist(), right.tolist(), strict=True):
                yield ma[i], mb[j], False
            return
        left, right = _descend(a, ka, b, kb, left, right, same)


def _descend(a: Tree, ka: int, b: Tree, kb: int, left: np.ndarray, right: np.ndarray, same: bool):
    """Child pairs of node pairs, pruned in blocks so that no pair list outgrows what survives."""
    limit = np.sqrt(2 - 2 * COSINE)
    deeper_a, deeper_b = ka < len(a.children), kb < len(b.children)
    (ca, ra, _), (cb, rb, _) = a.levels[ka + deeper_a], b.levels[kb + deeper_b]
    out_l, out_r = [], []
    order = np.argsort(left, kind="stable")
    left, right = left[order], right[order]
    cuts = np.flatnonzero(np.diff(left)) + 1
    for run in np.split(np.arange(len(left)), cuts):
        if not len(run):
            continue
        i = int(left[run[0]])
        xs = a.children[ka][i] if deeper_a else np.array([i])
        ys = np.concatenate([b.children[kb][j] if deeper_b else np.array([j]) for j in right[run].tolist()])
        widest = rb[ys].max()
        for s in range(0, len(xs), 1024):
            part = xs[s:s + 1024]
            dot = a.points[ca[part]] @ b.points[cb[ys]].T
            # the widest partner's bound first, then each pair's own
            p, q = np.nonzero(dot >= 1 - (limit + SLACK + ra[part] + widest)[:, None] ** 2 / 2 - SLACK)
            near = np.sqrt(np.maximum(2 - 2 * dot[p, q], 0)) <= limit + SLACK + ra[part[p]] + rb[ys[q]]
            if same:
                near &= part[p] <= ys[q]
            p, q = p[near], q[near]
            out_l.append(part[p])
            out_r.append(ys[q])
    none = np.empty(0, np.int64)
    return (np.concatenate(out_l), np.concatenate(out_r)) if out_l else (none, none)


_ROW = pa.schema([("a", pa.int64()), ("n", pa.int64()), ("b", pa.int64())])


class Chunk:
    """Classes of a chunk, their weights and the tree of their vectors, from ``(class, weight, vector)`` members."""

    def __init__(self, members: list[tuple]):
        self.classes = np.array([m[0] for m in members], dtype=np.int64)
        self.weights = np.array([m[1] for m in members], dtype=np.int64)
        self.tree = Tree(np.array([m[2] for m in members], dtype=np.float64))


def unit_links(first: Chunk, second: Chunk | None, cosine: float = COSINE) -> Iterator[tuple[int, int, int]]:
    """``(class, weight linked, a class of its part)`` for every linked class of one or two chunks.

    ``second`` None: within ``first``.
    """
    chunks = [first] if second is None else [first, second]
    a, b = chunks[0].tree, chunks[-1].tree
    offset = 0 if second is None else len(first.classes)
    classes = np.concatenate([c.classes for c in chunks])
    weight = np.concatenate([c.weights for c in chunks])
    linked = np.zeros(len(classes), np.int64)
    part = np.arange(len(classes))

    def find(x: int) -> int:
        while part[x] != x:
            part[x] = part[part[x]]
            x = part[x]
        return x

    def unite(xs, ys) -> None:
        for x, y in zip(xs, ys, strict=True):
            x, y = find(int(x)), find(int(y))
            part[max(x, y)] = min(x, y)

    for xs, ys, joint in dual_links(a, b, cosine):
        if joint:
            gx, gy = xs, ys + offset
            linked[gx] += weight[gy].sum()
            if second is None and xs is ys:
                linked[gx] -= weight[gx]
            else:
                linked[gy] += weight[gx].sum()
            unite(gx[1:], gx[:-1])
            unite(gy[1:], gy[:-1])
            unite(gx[:1], gy[:1])
            continue
        for s in range(0, len(xs), 512):
            hits = a.points[xs[s:s + 512]] @ b.points[ys].T >= cosine
            if second is None and xs is ys:
                hits &= xs[s:s + 512][:, None] < ys[None, :]
            p, q = np.nonzero(hits)
            gx, gy = xs[s:s + 512][p], ys[q] + offset
            np.add.at(linked, gx, weight[gy])
            np.add.at(linked, gy, weight[gx])
            unite(gx, gy)
    for k in np.flatnonzero(linked).tolist():
        yield int(classes[k]), int(linked[k]), int(classes[find(k)])


_CHUNK = pa.schema([("cell", pa.int64()), ("chunk", pa.int32()), ("grown", pa.binary())])


def _grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``cell, chunk, class, weight, vector`` sorted by chunk: each chunk with its tree."""
    def rows():
        for (cell, chunk), run in itertools.groupby(rows_of(batches), key=lambda r: r[:2]):
            yield cell, chunk, pickle.dumps(Chunk([row[2:] for row in run]), pickle.HIGHEST_PROTOCOL)
    return batches_of(rows(), _CHUNK, 1)


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``block a, block b, side, cell, chunk, partners, chunk with tree`` sorted by the first five: the chunks
    of block a are held, those of block b pass by, each compared with its partners."""
    def rows():
        for _, run in itertools.groupby(rows_of(batches), key=lambda r: r[:2]):
            held, own = {}, []
            for _, _, side, cell, chunk, partners, grown in run:
                here, at = pickle.loads(grown), (cell, chunk)
                if side == 0:
                    held[at] = here
                    own += [(tuple(p.values()), at) for p in partners]  # within the block: once all are held
                    continue
                for p in partners:
                    yield from unit_links(held[tuple(p.values())], here)
            for a, b in own:
                yield from unit_links(held[a], held[b] if a != b else None)
    return batches_of(rows(), _ROW)


def _dealer(centres: dict[int, np.ndarray]):
    """Scales vectors to length one and adds their cell: their length in the upper half, their nearest centre below."""
    schema = pa.schema([("class", pa.int64()), ("weight", pa.int64()), ("unit", pa.list_(pa.float64())),
                        ("cell", pa.int64()), ("off", pa.float64())])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for cls, weight, vector in rows_of(batches):
                v = np.array(vector)
                v /= np.sqrt(v @ v)
                cell, off = len(v) << 32, 2.0  # a length that the sample lacks is one cell
                if len(v) in centres:
                    d = np.sqrt(np.maximum(2 - 2 * (centres[len(v)] @ v), 0))
                    near = int(d.argmin())
                    cell, off = cell + near, float(d[near])
                yield cls, weight, v, cell, off
        return batches_of(rows(), schema, 1024)
    return deal


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                 cosine: float = COSINE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors``.

    A vector that is null, empty, zero or holds a null or non-finite component
    links with nothing; vectors of different length do not link.  Rows with a
    null id take part; a component without any id has a null one.  Rows that
    repeat an id are separate vectors, of which the first is the one kept.
    """
    if cosine != COSINE:
        raise ValueError(f"bounds are set up for cosine {COSINE}")
    held, row = numbered(vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")))
    held = held.withColumnRenamed(row, "row")
    good = (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) \
        & F.exists("v", lambda x: x != 0)
    # the largest component becomes 1, so that squares neither overflow nor vanish
    scaled = held.where(good).withColumn("v", F.transform("v", lambda x: x / F.array_max(F.transform("v", F.abs)) + 0.0))
    classes = scaled.groupBy("v").agg(F.min("row").alias("class"), F.count(F.lit(1)).alias("weight"))
    classes = store(classes, "vector-classes")
    rows = store(_links_of(classes), "vector-links")
    member = store(scaled.join(classes, "v").select("row", "vec_id", "class", "weight"), "vector-members")
    roots = components(rows.select("a", "b"))
    sums = rows.groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("n"))
    labelled = (member.join(sums, "class", "left").join(roots.withColumnRenamed("node", "class"), "class", "left")
                .select("row", (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
                        F.coalesce("root", "class").alias("root")))
    full = held.select("row", "vec_id").join(labelled, "row", "left").select(
        "row", "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("root", "row").alias("root"))
    full = store(full, "vector-rows")
    least = full.groupBy("root").agg(F.min(F.struct(F.col("vec_id").isNull(), "vec_id", "row")).alias("least"))
    return full.join(least, "root").select("vec_id", "n_links", F.col("least.vec_id").alias("component_id"),
                                           (F.col("row") == F.col("least.row")).alias("kept"))


def _links_of(classes: DataFrame) -> DataFrame:
    """``a, n, b`` rows (see ``unit_links``); cells of vectors of one length are compared."""
    spark, count = classes.sparkSession, classes.count()
    cells = max(CELLS, math.isqrt(count))
    sample: dict[int, list] = {}
    for (v,) in classes.orderBy(F.xxhash64("class"), "class").limit(SAMPLE * cells).select("v").collect():
        sample.setdefault(len(v), []).append(v)
    centres = {}
    for width, vectors in sample.items():
        units = np.array(vectors)
        centres[width] = upper_centres(units / np.sqrt((units * units).sum(axis=1))[:, None], cells)
    dealt = store(classes.select("class", "weight", "v").mapInArrow(
        _dealer(centres), "class long, weight long, unit array<double>, cell long, off double"), "vector-cells")
    named = spark.createDataFrame([(w << 32 | k, c.tolist()) for w, own in centres.items() for k, c in enumerate(own)],
                                  "cell long, centre array<double>")
    sizes = store(dealt.groupBy("cell").agg(F.count(F.lit(1)).alias("held"), F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks"),
                                            F.max("off").alias("radius"))
                  .join(named, "cell", "left"), "vector-sizes")
    # vectors of the cells before each, by which its chunks go to blocks
    each = sizes.select("cell", "held").orderBy("cell").collect()
    before = itertools.accumulate((r.held for r in each), initial=0)
    sizes = sizes.join(spark.createDataFrame([(r.cell, n) for r, n in zip(each, before)], "cell long, before long"), "cell")
    # pairs of cells by their summaries alone
    a, b = (sizes.select(F.shiftright("cell", 32).alias("width"), *[F.col(c).alias(f"{c}_{s}") for c in sizes.columns]) for s in "ab")
    dot = F.aggregate(F.zip_with("centre_a", "centre_b", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    gap = F.sqrt(F.greatest(F.lit(2.0) - 2 * dot, F.lit(0.0)))
    near = gap - F.col("radius_a") - F.col("radius_b") <= float(np.sqrt(2 - 2 * COSINE)) + SLACK
    span = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    partners = a.join(b, "width").where((F.col("cell_a") == F.col("cell_b")) | (F.col("cell_a") < F.col("cell_b")) & near)
    block = _block(count, max(sample, default=1), spark.sparkContext.defaultParallelism)
    at = lambda s: F.floor((F.col(f"before_{s}") + F.floor(F.col(f"c{s}") * F.col(f"held_{s}") / F.col(f"chunks_{s}"))) / block)
    units = store(partners.withColumn("ca", F.explode(span("chunks_a"))).withColumn("cb", F.explode(span("chunks_b")))
                  .where("cell_a != cell_b or ca <= cb").select(
                      at("a").alias("block_a"), at("b").alias("block_b"), F.col("cell_a").alias("a"), "ca", F.col("cell_b").alias("b"), "cb"),
                  "vector-units")
    sent = store(_sent(units), "vector-sent")
    member = dealt.join(sizes.select("cell", "chunks"), "cell").withColumn(
        "chunk", F.pmod(F.xxhash64("class"), F.col("chunks")).cast("int"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts, count = (max(1, min(n, max(tasks, n // 64))) for n in (units.select("block_a", "block_b").distinct().count(),
                                                                  sizes.agg(F.coalesce(F.sum("chunks"), F.lit(0))).first()[0]))
    grown = store(member.select("cell", "chunk", "class", "weight", "unit").repartition(count, "cell", "chunk")
                  .sortWithinPartitions("cell", "chunk", "class").mapInArrow(_grow, "cell long, chunk int, grown binary"),
                  "vector-chunks")
    return (sent.join(grown, ["cell", "chunk"]).select("block_a", "block_b", "side", "cell", "chunk", "partners", "grown")
            .repartition(parts, "block_a", "block_b").sortWithinPartitions("block_a", "block_b", "side", "cell", "chunk")
            .mapInArrow(_links, "a long, n long, b long"))


def _block(vectors: int, width: int, cores: int) -> int:
    """Vectors of a block: ``BLOCK`` components, or fewer where that would make less than some four pairs of blocks a core."""
    return max(1, min(BLOCK // width, vectors // math.isqrt(8 * cores)))


def _sent(units: DataFrame) -> DataFrame:
    """Chunks that each pair of blocks needs, once each: ``side`` 0 those of the first block, 1 those of the second,
    and the chunks of the first one (``partners``) that each is compared with."""
    partner = F.struct("a", "ca")
    sides = (units.select("block_a", "block_b", F.lit(0).alias("side"), F.col("a").alias("cell"), F.col("ca").alias("chunk"),
                          F.when(F.lit(False), partner).alias("partner")),
             units.select("block_a", "block_b", (F.col("block_a") != F.col("block_b")).cast("int").alias("side"),
                          F.col("b").alias("cell"), F.col("cb").alias("chunk"), partner.alias("partner")))
    return sides[0].union(sides[1]).groupBy("block_a", "block_b", "side", "cell", "chunk").agg(F.collect_list("partner").alias("partners"))


QUERY_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a, v b
         WHERE a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach(vec, other) AS (SELECT a, b FROM link UNION SELECT r.vec, l.b FROM reach r JOIN link l ON l.a = r.other),
comp AS (SELECT vec, min(other) AS least FROM reach GROUP BY vec),
deg AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT e.vec_id, coalesce(d.n, 0) AS n_links, least(e.vec_id, coalesce(c.least, e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce(c.least, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN deg d ON d.a = e.vec_id LEFT JOIN comp c ON c.vec = e.vec_id
"""
