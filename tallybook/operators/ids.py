"""Surrogate key allocation without a single-task window.

``row_number() over (order by ...)`` with no partition clause moves every row
into one task.  Here the rows are range-sorted across all partitions, each row
gets ``monotonically_increasing_id`` (partition index in the upper 31 bits,
position inside the partition in the lower 33), the sorted frame is
checkpointed so the numbering is stable on re-execution and executor loss,
and a per-partition row count (one row per partition -- bounded by the
partition count, not by the data) gives each partition its starting offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_LOW_BITS = (1 << 33) - 1


def sequential_ids(df: DataFrame, order_by: list[str | Column], id_col: str,
                   start: int | Column = 1, first: bool = True) -> DataFrame:
    """Add ``id_col`` = start, start+1, ... in ``order_by`` order.

    ``start`` is a literal or a column (e.g. a broadcast 1-row maximum).
    The sorted frame is always checkpointed: the rows and the counts per
    partition are read from it separately, and two runs of a range sort may
    cut its partitions at different places, which would lose rows.
    """
    # a tiebreak inside equal keys lets the range partitioner split a hot
    # group of equal keys over many partitions instead of one task
    ordered = (df.withColumn("_tb_tie", F.monotonically_increasing_id())
               .orderBy(*order_by, "_tb_tie").drop("_tb_tie")
               .withColumn("_tb_mid", F.monotonically_increasing_id()))
    ensure_checkpoint_dir(df.sparkSession)
    ordered = ordered.checkpoint(eager=True)
    pid = F.shiftright(F.col("_tb_mid"), 33)
    per_part = ordered.groupBy(pid.alias("_tb_pid")).agg(F.count(F.lit(1)).alias("_tb_n"))
    # one row per partition: a window over it is bounded by the partition count
    w = Window.orderBy("_tb_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select("_tb_pid", F.coalesce(F.sum("_tb_n").over(w), F.lit(0))
                              .alias("_tb_off"))
    start_col = start if isinstance(start, Column) else F.lit(start)
    out = (ordered.join(F.broadcast(offsets), pid == F.col("_tb_pid"))
           .withColumn(id_col, (start_col + F.col("_tb_off")
                                + F.col("_tb_mid").bitwiseAND(F.lit(_LOW_BITS))).cast("long"))
           .drop("_tb_mid", "_tb_pid", "_tb_off"))
    if first:
        out = out.select(id_col, *[c for c in out.columns if c != id_col])
    return out


def next_ids(new_rows: DataFrame, existing: DataFrame, id_col: str,
             order_by: list[str | Column] | None = None) -> DataFrame:
    """Allocate keys for ``new_rows`` after ``max(existing.id_col)``.

    ``COALESCE(MAX(id), 0) + 1`` is the first new key, so an empty table starts
    at 1 -- the sequence-reset arithmetic of the backup job.  The maximum is a
    1-row aggregate joined by broadcast (size bound: one row).
    """
    top = existing.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("long").alias("_tb_top"))
    cols = [c for c in new_rows.columns if c != id_col]
    base = new_rows.select(*cols).crossJoin(F.broadcast(top))
    out = sequential_ids(base, order_by or cols[:1], id_col,
                         start=F.col("_tb_top") + F.lit(1))
    return out.drop("_tb_top")
