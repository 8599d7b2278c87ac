"""Exact duplicates by deterministic block naming (DataFrame functions only).

Every text is cut into blocks of a fixed number of bytes.  The distinct blocks
are sorted and numbered; the numbers are their names.  Then adjacent names are
paired, the distinct pairs sorted and numbered again, and so on until each
document is down to one name.  Two documents have the same name at the same
level if and only if their bytes are equal: names are numbers of distinct
values, not hashes.

The distinct blocks are combined within each task before the one shuffle of
text.  Documents find the names of their blocks through two 64-bit
fingerprints, which are used only once they have been shown to differ for all
different blocks of this input; otherwise other seeds are tried.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import numbered, store, without

BLOCK_BYTES = 4096


def block_names(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                row_col: str | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per input row: ``row, doc_id, text_sha256, level, name``.

    ``(level, name)`` is equal for two rows exactly if their texts are.  A null
    text counts as empty, which is one block without bytes.  ``row`` numbers
    the rows (``row_col`` if given), so null and repeated ids are kept apart.
    Other columns are not read.  An empty table gives an empty result.
    """
    source = docs.select(
        (F.col(row_col) if row_col else F.monotonically_increasing_id()).alias("row"),
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    seed = 0
    while True:
        names = store(_named_blocks(source, block_bytes, seed), "block-names")
        clash = names.groupBy("f1", "f2").count().where("count > 1").limit(1).count()
        if not clash:
            break
        seed += 2
    rows = store(source.select(
        "row", "doc_id", F.sha2("text", 256).alias("text_sha256"),
        *_cut("text", block_bytes)).select(
        "row", "doc_id", "text_sha256",
        F.transform(F.sequence(F.lit(0), F.col("n") - 1),
                    lambda i: F.struct(*_prints(_block(i, block_bytes), seed))).alias("prints")), "block-rows")
    most = rows.agg(F.max(F.size("prints"))).first()[0] or 0
    current = store(rows.select("row", F.size("prints").alias("m"), F.posexplode("prints").alias("i", "p"))
                    .select("row", "m", "i", "p.*").join(names, ["f1", "f2"])
                    .select("row", "m", "i", "name"), "names-0")
    level, done = 0, []
    while True:
        done.append(current.where("m = 1").select("row", F.lit(level).alias("level"), "name"))
        if most <= 1:
            break
        level, most = level + 1, (most + 1) // 2
        current = store(_pair(current.where("m > 1")), f"names-{level}")
    return rows.drop("prints").join(reduce(DataFrame.union, done), "row")


def exact_groups(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                 row_col: str | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``row, doc_id, keep_id, group_size, kept, text_sha256`` for every row.

    Of equal texts the row with the largest ``doc_id`` stays; null is smaller
    than any id, and among rows with equal ids the first row stays, so each
    group keeps exactly one row.
    """
    named = block_names(docs, text_col, id_col, row_col, block_bytes)
    groups = named.groupBy("level", "name").agg(
        F.max(F.struct("doc_id", (-F.col("row")).alias("back"))).alias("keep"),
        F.count(F.lit(1)).alias("group_size"))
    return named.join(groups, ["level", "name"]).select(
        "row", "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == -F.col("keep.back")).alias("kept"), "text_sha256")


def drop_exact_copies(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they were."""
    held, row = numbered(docs)
    return without(held, row, exact_groups(held, text_col, id_col, row_col=row).where("not kept"))


def _cut(text_col: str, block_bytes: int) -> list[Column]:
    size = F.octet_length(text_col)
    return [F.col(text_col).cast("binary").alias("bytes"),
            F.greatest(F.lit(1), F.ceil(size / block_bytes).cast("int")).alias("n")]


def _block(i: Column, block_bytes: int) -> Column:
    return F.substring(F.col("bytes"), i * block_bytes + 1, F.lit(block_bytes))


def _prints(block: Column, seed: int) -> list[Column]:
    return [F.xxhash64(F.lit(seed), block).alias("f1"), F.xxhash64(F.lit(seed + 1), block).alias("f2")]


def _named_blocks(source: DataFrame, block_bytes: int, seed: int) -> DataFrame:
    """``f1, f2, name`` of the distinct blocks, numbered in sorted order."""
    blocks = (source.select(*_cut("text", block_bytes))
              .select("bytes", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("i"))
              .select(_block(F.col("i"), block_bytes).alias("block")))
    return (blocks.distinct().sortWithinPartitions("block")
            .select(*_prints(F.col("block"), seed), F.monotonically_increasing_id().alias("name")))


def _pair(current: DataFrame) -> DataFrame:
    """Name adjacent pairs: half as many names per row.  -1: no right neighbour."""
    half = F.expr("i div 2").cast("int")
    pairs = current.groupBy("row", "m", half.alias("i")).agg(
        F.max(F.expr("case when i % 2 = 0 then name end")).alias("a"),
        F.coalesce(F.max(F.expr("case when i % 2 = 1 then name end")), F.lit(-1)).alias("b"))
    names = store(pairs.select("a", "b").distinct().sortWithinPartitions("a", "b")
                  .withColumn("name", F.monotonically_increasing_id()), "pair-names")
    return pairs.join(names, ["a", "b"]).select(
        "row", F.expr("(m + 1) div 2").cast("int").alias("m"), "i", "name")


QUERY_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
