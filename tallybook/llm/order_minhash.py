"""Near-duplicates by Order MinHash, verified by a banded alignment.

A document is its sequence of five-word shingles, each labelled with its
occurrence number, so that all labelled shingles of a text differ.  Each of
``SKETCHES`` hash functions picks the ``SAMPLE`` labelled shingles with the
smallest values and keeps them in text order; the ordered sample is a bucket
key.  Texts that share a bucket are candidates.  Candidates are verified by
aligning their labelled shingles within the band that the required similarity
leaves open; the similarity is aligned / (all - aligned), the Jaccard
similarity of the shingles that keep their order.

With three shingles a sample, drawn without replacement, a pair with c of u
shingles in common and in order shares one of 16 buckets with probability
1 - (1 - C(c, 3) / C(u, 3))^16.  At 0.8 that is 0.99972 for 4 of 5, 0.99996 for
8 of 10, 0.99997 for 12 of 15, 0.99998 for 16 of 20 and rises with the length
to 1 - (1 - 0.8^3)^16 = 0.99999.

Short texts are joined exactly besides: two texts of similarity s or more have
at least s of either one's shingles in common, so they share one of the first
n - ceil(s n) + 1 of their n shingles in any fixed order.  Every text of up to
``SHORT`` shingles, and of up to ``SHORT`` / s, which is all that such a text can
be similar to, also enters a bucket for each of those, by the order of a hash.

Equal word sequences are one class first, so copies cost nothing further.
Buckets are split into units of at most two chunks of ``CHUNK`` classes; every
pair of a bucket is in some unit.  A unit counts common shingles of all its
pairs at once and emits only the links that join different parts, never all
pairs.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_of, numbered, rows_of, store, without
from .components import components
from .words import labelled, mix, shingles, word_hashes

SHINGLE_WORDS = 5
SIMILARITY = 0.8
SKETCHES = 16
SAMPLE = 3
#: texts of up to so many shingles lose no link
SHORT = 20
CHUNK = 512
#: shingles hashed at a time, which bounds the memory that a long text needs
STRIDE = 1 << 16

_RNG = np.random.default_rng(20240607)
_XOR = _RNG.integers(0, 2**63, SKETCHES, dtype=np.int64).astype(np.uint64)[:, None]
_MUL = (_RNG.integers(0, 2**63, SKETCHES, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1))[:, None]


def order_sketch(units: np.ndarray) -> np.ndarray:
    """``SKETCHES`` keys, each of the smallest ``SAMPLE`` values in text order."""
    n = len(units)
    best_at = np.empty((SKETCHES, 0), np.int64)
    best = np.empty((SKETCHES, 0), np.uint64)
    for start in range(0, n, STRIDE):
        part = units[start:start + STRIDE]
        values = (part[None, :] ^ _XOR) * _MUL
        if len(part) > SAMPLE:
            at = np.argpartition(values, SAMPLE - 1, axis=1)[:, :SAMPLE]
            values = np.take_along_axis(values, at, 1)
        else:
            at = np.tile(np.arange(len(part)), (SKETCHES, 1))
        best, best_at = np.hstack([best, values]), np.hstack([best_at, at + start])
        if best.shape[1] > SAMPLE:
            keep = np.argpartition(best, SAMPLE - 1, axis=1)[:, :SAMPLE]
            best, best_at = np.take_along_axis(best, keep, 1), np.take_along_axis(best_at, keep, 1)
    best_at.sort(axis=1)
    keys = _XOR[:, 0].copy()
    for k in range(best_at.shape[1]):
        keys = (keys ^ units[best_at[:, k]]) * _MUL[:, 0]
        keys ^= keys >> np.uint64(29)
    return keys


def prefix_keys(units: np.ndarray, similarity: float = SIMILARITY) -> np.ndarray:
    """Bucket keys of a short text's first shingles in hash order; none for texts beyond ``SHORT`` / similarity."""
    n = len(units)
    if n > SHORT / similarity + 1e-9:
        return units[:0]
    first = n - int(np.ceil(similarity * n - 1e-9)) + 1
    return np.sort(mix(units ^ _XOR[0]))[:first]


def least_aligned(n: int, m: int, similarity: float = SIMILARITY) -> int:
    """Fewest aligned shingles with which lengths n and m reach the similarity."""
    return int(np.ceil(similarity * (n + m) / (1 + similarity) - 1e-9))


def aligned(a: np.ndarray, b: np.ndarray, least: int) -> int:
    """Longest common subsequence of two labelled sequences inside the band.

    Labelled shingles are unique within a text, so the matches are a partial
    permutation and the subsequence is its longest increasing run.  An
    alignment of at least ``least`` leaves out at most len(a) - least and
    len(b) - least shingles, which bounds how far a match can be off the
    diagonal.
    """
    _, at_a, at_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    off = at_a - at_b
    inside = (off <= len(a) - least) & (off >= least - len(b))
    at_a, at_b = at_a[inside], at_b[inside]
    if len(at_a) < least:
        return len(at_a)
    line = at_b[np.argsort(at_a)]
    if (np.diff(line) > 0).all():
        return len(line)
    ends: list[int] = []
    for x in line.tolist():
        k = bisect_left(ends, x)
        if k == len(ends):
            ends.append(x)
        else:
            ends[k] = x
    return len(ends)


def links_within(members: list[tuple[int, np.ndarray]]) -> list[tuple[int, int]]:
    """Links that connect what similar pairs connect: a spanning forest."""
    size = np.array([len(u) for _, u in members])
    if len(members) < 2 or not size.sum():
        return []
    codes, inverse = np.unique(np.concatenate([u for _, u in members]), return_inverse=True)
    own = np.repeat(np.arange(len(members)), size)
    order = np.argsort(inverse, kind="stable")
    starts = np.searchsorted(inverse[order], np.arange(len(codes) + 1))
    postings, span = own[order], np.diff(starts)
    first = np.concatenate([[0], np.cumsum(size)])
    part = np.arange(len(members))
    found = []
    for x in range(1, len(members)):
        ids = inverse[first[x]:first[x + 1]]
        if not len(ids):
            continue
        lengths = span[ids]
        flat = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        common = np.bincount(postings[np.repeat(starts[ids], lengths) + flat], minlength=len(members))[:x]
        least = np.ceil(SIMILARITY * (size[:x] + size[x]) / (1 + SIMILARITY) - 1e-9)
        for y in np.flatnonzero((common >= least) & (part[:x] != part[x])).tolist():
            if part[x] != part[y] and aligned(members[x][1], members[y][1], int(least[y])) >= least[y]:
                found.append((members[y][0], members[x][0]))
                part[part == part[x]] = part[y]
    return found


def _units(text: str | None) -> np.ndarray:
    return labelled(shingles(word_hashes(text), SHINGLE_WORDS))


_SKETCH = pa.schema([("row", pa.int64()), ("words1", pa.int64()), ("words2", pa.int64()),
                     ("keys", pa.list_(pa.int64()))])


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for row, text in rows_of(batches):
            hashes = word_hashes(text)
            digest = np.frombuffer(xxhash.xxh128_digest(hashes.tobytes()), np.int64)
            units = labelled(shingles(hashes, SHINGLE_WORDS))
            keys = np.unique(np.concatenate([order_sketch(units), prefix_keys(units)])) if len(units) else units
            yield row, int(digest[0]), int(digest[1]), keys.view(np.int64)
    return batches_of(rows(), _SKETCH)


_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``unit, part, class, text`` sorted by unit: links of each unit."""
    def rows():
        unit, held = None, []
        for bucket, low, high, cls, text in rows_of(batches):
            if (bucket, low, high) != unit:
                yield from links_within(held)
                unit, held = (bucket, low, high), []
            held.append((cls, _units(text)))
        yield from links_within(held)
    return batches_of(rows(), _LINK)


def near_groups(held: DataFrame, row: str, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``row, doc_id, group_id, group_size, kept`` of a table with row numbers.

    ``group_id`` is the smallest ``doc_id`` of the group (null if none of its
    rows has one).  The row with the smallest id stays (null last, then the
    first row).  A null text counts as empty; texts without words are equal to
    each other and link with nothing else.  Repeated rows are one group; an
    empty table gives an empty result.  ``held`` must be a stored table.
    """
    texts = held.select(F.col(row).alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    sketches = store(texts.select("row", "text").mapInArrow(
        _sketch, "row long, words1 long, words2 long, keys array<long>"), "sketches")
    classes = store(sketches.groupBy("words1", "words2").agg(
        F.min("row").alias("class"), F.first("keys").alias("keys")), "classes")
    entries = classes.select("class", F.explode("keys").alias("bucket"))
    # buckets with the same members are one: most copies meet in several
    sized = entries.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.min("class").alias("low"), F.max("class").alias("high"),
        F.sum(F.xxhash64("class").cast("decimal(20,0)")).alias("s1"),
        F.sum(F.xxhash64(F.lit(1), "class").cast("decimal(20,0)")).alias("s2")).where("n > 1")
    shared = sized.groupBy("n", "low", "high", "s1", "s2").agg(F.min("bucket").alias("bucket")).select("bucket", "n")
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    member = (entries.join(shared, "bucket").select("class", "bucket", chunks.alias("chunks"))
              .withColumn("chunk", F.pmod(F.xxhash64("class"), F.col("chunks")).cast("int")))
    units = member.select("class", "bucket", F.explode(
        F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda other: F.struct(
            F.least("chunk", other).alias("low"), F.greatest("chunk", other).alias("high")))).alias("u")).select(
        "class", "bucket", "u.low", "u.high")
    units = store(units, "units")
    wanted = texts.join(units.select(F.col("class").alias("row")).distinct().hint("merge"), "row", "left_semi")
    parts = int(held.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    links = (units.join(wanted.select(F.col("row").alias("class"), "text").hint("merge"), "class")
             .select("bucket", "low", "high", "class", "text")
             .repartition(parts, "bucket", "low", "high")
             .sortWithinPartitions("bucket", "low", "high", "class")
             .mapInArrow(_verify, "a long, b long"))
    roots = components(links)
    member_of = (sketches.select("row", "words1", "words2")
                 .join(classes.select("words1", "words2", "class"), ["words1", "words2"])
                 .join(roots.withColumnRenamed("node", "class"), "class", "left")
                 .select("row", F.coalesce("root", "class").alias("root"))
                 .join(texts.select("row", "doc_id"), "row"))
    member_of = store(member_of, "members")
    groups = member_of.groupBy("root").agg(
        F.min("doc_id").alias("group_id"), F.count(F.lit(1)).alias("group_size"),
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("keep"))
    return member_of.join(groups, "root").select(
        "row", "doc_id", "group_id", "group_size", (F.col("row") == F.col("keep.row")).alias("kept"))


def near_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id, group_id, group_size, kept`` for every row of ``docs``."""
    held, row = numbered(docs.select(id_col, text_col))
    return near_groups(held, row, text_col, id_col).drop("row")


def drop_near_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, columns as they were."""
    held, row = numbered(docs)
    return without(held, row, near_groups(held, row, text_col, id_col).where("not kept"))
