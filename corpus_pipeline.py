"""Corpus pipeline: documents to packed training sequences.

``STAGES`` lists (name, function) in order.  Each function takes
``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return the
columns of ``docs``.  ``run`` writes each stage's result as Parquet to the
session's shared folder and reads it back as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallybook.llm import exact_dedup, mixing, order_minhash, packing, resampling
from tallybook.llm.common import read, store
from tallybook.llm.queries import ship, tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling keeps (operator 10)."""
    ship(spark)
    return resampling.drop_low_quality(docs, read(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts (operator 2)."""
    return exact_dedup.drop_exact_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (operator 9)."""
    ship(spark)
    return order_minhash.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the temperature mixture draws them (operator 1)."""
    return mixing.mix_sources(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces packed into sequences of 4096 tokens (operator 8)."""
    ship(spark)
    return packing.pack(docs, tokenizer_path())


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("mix", mix), ("sequences", sequences)]

#: The learned ratio model, the sketches and the tokenizer have no SQL form;
#: tests/llm/test_brute_force.py holds every stage, run on its predecessor's
#: output, against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
