"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def store(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the session's shared folder and read it back.

    Cuts the lineage at a table that survives the loss of executors, and fixes
    values such as row numbers that a recomputation could assign differently.
    """
    spark = df.sparkSession
    path = shared_path(spark, "llm", f"{label}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(taken: Iterable[str], name: str) -> str:
    """``name``, with underscores added until no column in ``taken`` has it."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name += "_"
    return name


def numbered(docs: DataFrame, label: str = "numbered") -> tuple[DataFrame, str]:
    """``docs`` stored with a unique row number; returns it and the column's name."""
    row = fresh(docs.columns, "row")
    return store(docs.withColumn(row, F.monotonically_increasing_id()), label), row


def without(held: DataFrame, row: str, out: DataFrame) -> DataFrame:
    """The rows of ``held`` whose number is not in ``out``, in one merge join at every size."""
    return held.join(out.select(F.col("row").alias(row)).hint("merge"), row, "left_anti").drop(row)


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of Arrow batches as tuples, one batch in memory at a time."""
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def batches_of(rows: Iterable[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Tuples as Arrow batches of at most ``size`` rows."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)],
                           schema=schema)
