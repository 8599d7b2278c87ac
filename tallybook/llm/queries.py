"""Registered queries of the corpus operators: one per operator, whole tables."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (alignment, cover_tree, exact_dedup, hard_negatives, langid, main_text, mixing, order_minhash, packing, planes,
               resampling, surrogates, warc)
from .common import read

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def ship(spark: SparkSession) -> None:
    """Send this package's code to the session's Python workers, once a session."""
    context = spark.sparkContext
    if getattr(context, "_tallybook_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root = os.path.dirname(package)
    target = os.path.join(tempfile.mkdtemp(), "tallybook-code.zip")  # read by the driver only, which serves it
    with zipfile.ZipFile(target, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, root))
    context.addPyFile(target)
    context._tallybook_shipped = True


def op1_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, source, tokens, epoch, mix_order of every draw."""
    return mixing.draws(read(spark, sf_dir, "documents").select("doc_id", "source", "text")).select(
        "doc_id", "source", "tokens", "epoch", "mix_order")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every document."""
    return exact_dedup.exact_groups(read(spark, sf_dir, "documents")).drop("row")


def op3_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text, n_entities, entities of every document, personal data replaced."""
    return surrogates.anonymise(read(spark, sf_dir, "documents"))


def op4_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector."""
    return cover_tree.near_vectors(read(spark, sf_dir, "embeddings"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record read back."""
    records, payloads = warc.build_archive(read(spark, sf_dir, "pages"))
    return warc.read_warc(spark, warc.write_warc(records, payloads)).drop("url")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    learnt = docs.where(~langid.held_out())
    return langid.identify(docs, langid.train(learnt))


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    return main_text.main_text(read(spark, sf_dir, "pages"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece."""
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer_path())


def op9_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, group_id, group_size, kept of every document."""
    return order_minhash.near_duplicates(read(spark, sf_dir, "documents"))


def op10_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, log_weight, gumbel_key, kept of every document."""
    docs = read(spark, sf_dir, "documents").withColumn("row", F.lit(0).cast("long"))
    return resampling.resample(docs, read(spark, sf_dir, "labels"), "row").drop("row")


def op11_id_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from the files."""
    return planes.read_ids(spark, planes.write_ids(read(spark, sf_dir, "documents"), tokenizer_path()))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    return hard_negatives.hard_negatives(hard_negatives.prepared(read(spark, sf_dir, "embeddings")))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document."""
    return alignment.align(read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"),
                           tokenizer_path("piece_bpe_32k.model"))


_QUERIES = {f.__name__: f for f in (op1_temperature_mixing, op2_exact_dedup, op3_surrogates, op4_cover_tree, op5_warc,
                                    op6_language_id, op7_main_text, op8_packing, op9_order_minhash, op10_resampling,
                                    op11_id_planes, op12_hard_negatives, op13_token_alignment)}


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of corpus_pipeline.py over documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def shipped(fn):
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)
        return query
    return {name: shipped(fn) for name, fn in {**_QUERIES, "pipeline": pipeline}.items()}


def oracle_sql() -> dict[str, str]:
    return {"op2_exact_dedup": exact_dedup.QUERY_SQL, "op4_cover_tree": cover_tree.QUERY_SQL,
            "op5_warc": warc.QUERY_SQL, "op12_hard_negatives": hard_negatives.QUERY_SQL}
