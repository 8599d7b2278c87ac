"""Quality by importance resampling of hashed n-grams.

Two bag-of-n-grams models over the same hashed features are counted: the raw
model over all documents and the target model over labelled good documents.
The importance of a document is the ratio of its likelihoods under the two, and
documents are drawn without replacement with those weights by the Gumbel top-k
rule: add independent Gumbel noise to the log weight, keep the k largest.

Features are three kinds of n-grams of white-space separated tokens: the word
(lower case, outer punctuation off), the pair of words, and the triple of token
forms (case, punctuation around the word, repeats of the token before).  The
log ratio is averaged over each kind, so that long texts do not drift, and
scaled by ``EVIDENCE``, the n-grams a document counts for.

The target model smooths with the raw model, so a feature that the labelled
documents never show counts against a document by at most
log(1 + labelled n-grams / PRIOR).

Labelled rows: at most ``LABELLED`` of each class, those with the smallest hash
of their id, train the target model and set the operating point.  The raw
model counts all documents, and k is the number of documents beyond the
operating point, found by counting over all documents.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_of, numbered, rows_of, store, without
from .words import CACHE_WORDS, mix

LABELLED = 20_000
WORDS, PAIRS, FORMS = 1 << 14, 1 << 15, 1 << 14
BUCKETS = WORDS + PAIRS + FORMS
PRIOR = 2_000.0
EVIDENCE = 200.0
SEED = 7
#: width of the bins in which the k-th largest key is sought, and bins per pass
BINS = 1024


def _form(token: str, core: str) -> int:
    """Case of the word, punctuation before and after it, as one number below 64."""
    if not core:
        return 63
    if any(c.isdigit() for c in core):
        case = 4
    elif core.islower():
        case = 0
    elif core.isupper():
        case = 2 if len(core) > 1 else 1
    else:
        case = 1 if core[1:].islower() else 3
    at = token.find(core)
    tail = token[at + len(core):]
    after = 0 if not tail else 1 if tail in ",;:" else 2 if tail in ".?!" else 3 if len(tail) == 1 else 4
    return (case * 5 + after) * 2 + (at > 0)


class _Tokens(dict):
    """token -> word hash in the upper 56 bits, form in the lower 8."""

    def __missing__(self, token: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        core = token.strip(string.punctuation)
        value = (xxhash.xxh64_intdigest((core or token).lower()) & ~0xFF) | _form(token, core)
        self[token] = value
        return value


_CACHE = _Tokens()


def features(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket numbers of the words, pairs and forms of a whole text."""
    tokens = (text or "").split()
    x = np.fromiter(map(_CACHE.__getitem__, tokens), np.uint64, len(tokens))
    if not len(x):
        none = np.empty(0, np.int64)
        return none, none, none
    word, form = x >> np.uint64(8), (x & np.uint64(0xFF)).astype(np.int64)
    form[1:] += 64 * (x[1:] == x[:-1])
    words = (word % np.uint64(WORDS)).astype(np.int64)
    pairs = (mix(word[:-1] * np.uint64(3) ^ word[1:]) % np.uint64(PAIRS)).astype(np.int64) + WORDS
    padded = np.concatenate([[127, 127], form]).astype(np.uint64)
    forms = (mix((padded[:-2] << np.uint64(14)) | (padded[1:-1] << np.uint64(7)) | padded[2:])
             % np.uint64(FORMS)).astype(np.int64) + WORDS + PAIRS
    return words, pairs, forms


def log_ratio(text: str | None, weights: np.ndarray) -> float:
    """Sum over the three kinds of the mean log ratio; 0 for a text without tokens."""
    return float(sum(weights[f].mean() for f in features(text) if len(f)))


_COUNTS = pa.schema([("bucket", pa.int32()), ("raw", pa.int64()), ("target", pa.int64())])


def ratio_weights(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log of target over raw probability of every bucket, each kind normalised."""
    out = np.zeros(BUCKETS)
    for lo, hi in ((0, WORDS), (WORDS, WORDS + PAIRS), (WORDS + PAIRS, BUCKETS)):
        p = (raw[lo:hi] + 0.5) / (raw[lo:hi] + 0.5).sum()
        out[lo:hi] = np.log((target[lo:hi] + PRIOR * p) / (target[lo:hi].sum() + PRIOR)) - np.log(p)
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Feature counts of a task: rows ``bucket, raw, target``."""
    total = np.zeros((2, BUCKETS), np.int64)
    held: list[list[np.ndarray]] = [[], []]

    def add():
        for k in (0, 1):
            if held[k]:
                total[k] += np.bincount(np.concatenate(held[k]), minlength=BUCKETS)
                held[k] = []

    waiting = 0
    for text, good in rows_of(batches):
        found = features(text)
        held[0] += found
        if good:
            held[1] += found
        waiting += 3 * len(found[0])
        if waiting > 4 * BUCKETS:
            add()
            waiting = 0
    add()
    at = np.flatnonzero(total[0])
    yield pa.record_batch([pa.array(at.astype(np.int32)), pa.array(total[0][at]), pa.array(total[1][at])], schema=_COUNTS)


def labelled_sample(labels: DataFrame, limit: int = LABELLED) -> DataFrame:
    """At most ``limit`` labelled ids of each class: ``doc_id, quality``.

    Rows without id or label are left out; an id labelled both ways is bad.
    """
    clean = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
             .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    mixed = F.xxhash64(F.lit(SEED), "doc_id")
    return clean.where("quality = 1").orderBy(mixed, "doc_id").limit(limit).union(
        clean.where("quality = 0").orderBy(mixed, "doc_id").limit(limit))


def resample(docs: DataFrame, labels: DataFrame, row: str, text_col: str = "text", id_col: str = "doc_id",
             limit: int = LABELLED) -> DataFrame:
    """``row, doc_id, log_weight, gumbel_key, kept`` for every row of ``docs``.

    ``kept`` marks the k rows with the largest keys (all rows that tie with the
    k-th).  k is the number of rows beyond the score that best separates the
    labelled good from the bad; where one class is missing nothing is rejected.
    A null text counts as empty and scores 0.  Repeated rows tie and are kept or
    rejected together; an empty table gives an empty result.  ``row`` names a
    column that passes through, to join on.
    """
    sample = store(labelled_sample(labels, limit), "labelled")  # at most 2 x limit rows
    flagged = docs.select(F.col(row).alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(
        F.broadcast(sample), "doc_id", "left")
    counts = (flagged.select("text", (F.col("quality") == 1).alias("good"))
              .mapInArrow(_count, "bucket int, raw long, target long")
              .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")))
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for bucket, r, t in counts.toLocalIterator():  # at most BUCKETS rows
        raw[bucket], target[bucket] = r, t
    weights = ratio_weights(raw, target)
    noise = -F.log(-F.log((F.shiftrightunsigned(F.xxhash64(F.lit(SEED), "doc_id", "text"), 11) + F.lit(0.5))
                          / F.lit(float(1 << 53))))
    scored = (flagged.select("row", "doc_id", "quality", noise.alias("noise"), "text")
              .mapInArrow(_scorer(weights), "row long, doc_id long, quality int, noise double, score double"))
    scored = store(scored.withColumn("log_weight", F.col("score") * EVIDENCE)
                   .withColumn("gumbel_key", F.col("log_weight") + F.col("noise")), "scores")
    point = operating_point(scored.where("quality is not null").select("quality", "score"))
    cut = kth_largest(scored, "gumbel_key", scored.where(F.col("score") >= point).count())
    return scored.select("row", "doc_id", "log_weight", "gumbel_key", (F.col("gumbel_key") >= cut).alias("kept"))


def _scorer(weights: np.ndarray):
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("quality", pa.int32()),
                        ("noise", pa.float64()), ("score", pa.float64())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batches_of(((*head, log_ratio(text, weights)) for *head, text in rows_of(batches)), schema)
    return score


def operating_point(labelled: DataFrame) -> float:
    """Score that misjudges the fewest labelled rows; the middle, where a gap does.

    Read from counts in 4096 bins between the extremes, whatever the rows.
    """
    ends = labelled.groupBy("quality").agg(F.min("score"), F.max("score"))
    ends = {q: (lo, hi) for q, lo, hi in ends.collect()}  # two rows
    if len(ends) < 2:
        return float("-inf")
    lo, hi = min(e[0] for e in ends.values()), max(e[1] for e in ends.values())
    step = (hi - lo) / 4096 or 1.0
    bins = np.zeros((2, 4098))
    at = F.floor((F.col("score") - lo) / step).cast("int")
    for q, b, n in labelled.groupBy("quality", at.alias("bin")).count().collect():  # 2 x 4097 at most
        bins[q][b] += n
    bad_above = bins[0].sum() - np.concatenate([[0], np.cumsum(bins[0])])
    good_below = np.concatenate([[0], np.cumsum(bins[1])])
    errors = bad_above + good_below
    best = np.flatnonzero(errors == errors.min())
    return float(lo + step * (best[0] + best[-1]) / 2)


def kth_largest(df: DataFrame, col: str, k: int) -> float:
    """The k-th largest value of ``col`` by counting in ever narrower bins.

    Each pass sends at most ``BINS`` counts to the driver.  k = 0: above all.
    """
    lo, hi, n = df.agg(F.min(col), F.max(col), F.count(col)).first()
    if not n or k >= n:
        return float("-inf")
    if k <= 0:
        return float("inf")
    above = 0
    while True:
        step = (hi - lo) / BINS
        if step <= 0 or lo + step <= lo:
            return lo
        at = F.least(F.floor((F.col(col) - lo) / step), F.lit(BINS - 1))
        counts = {b: (c, a, z) for b, c, a, z in
                  df.where(F.col(col).between(lo, hi)).groupBy(at.alias("bin"))
                  .agg(F.count(F.lit(1)), F.min(col), F.max(col)).collect()}
        for b in sorted(counts, reverse=True):
            c, a, z = counts[b]
            if above + c >= k:
                if above + c == k or a == z:
                    return a
                lo, hi = a, z
                break
            above += c


def drop_low_quality(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` without the rows that the resampling rejects, columns as they were."""
    held, row = numbered(docs)
    return without(held, row, resample(held, labels, row, text_col, id_col).where("not kept"))
