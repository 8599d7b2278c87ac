"""Mixing sources by temperature, realised as budgeted block permutations.

Weights are the sources' token shares raised to an exponent and normalised.
Exponent 1 keeps the shares, 0 makes all sources equal.  The exponent is
bisected to meet a target entropy, and raised further if at that exponent some
source would be repeated more often than the limit.  All sums over sources are
Spark aggregates of the source table; only their few numbers reach the driver.

A weight times the total budget is a source's budget of tokens.  The source's
documents form blocks of ``BLOCK_IDS`` consecutive ids; every pass over a
source takes its blocks in a new order given by a keyed digest.  Full passes
take all blocks, the last one takes blocks until the budget is met (a block is
taken if more than half of it fits).

Where the last pass ends is one digest value per source.  It is found by adding
up tokens in ``4096`` ranges of the digest, then in order within the single
range that holds the end, so that no task sees all blocks of a large source.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import store

#: target entropy of the mixture, as a share of the largest possible
ENTROPY = 0.95
#: passes over one source, at most
REPEATS = 4.0
BLOCK_IDS = 16
HALVINGS = 30
SEED = "mix-1"


def count_tokens(text_col: str) -> Column:
    """White-space separated words; a null text has none."""
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit("[^ \\t\\n\\r\\f]+")), F.lit(0)).cast("long")


def solve_exponent(sources: DataFrame, entropy: float = ENTROPY, repeats: float = REPEATS,
                   budget_ratio: float = 1.0) -> tuple[float, float, float]:
    """``(exponent, sum of share^exponent, tokens)`` for rows ``(source, tokens)``.

    ``budget_ratio`` is the budget over all tokens.  The exponent is the larger
    of the one that meets the entropy and the one that meets the limit on
    repeats, within [0, 1]; at 1 no source is repeated more than the ratio.
    """
    n, total, least = sources.where("tokens > 0").agg(
        F.count(F.lit(1)), F.sum("tokens"), F.min("tokens")).first()
    if not n:
        return 1.0, 1.0, 0.0
    share = F.col("tokens") / F.lit(float(total))

    def sums(exponents: list[float]) -> list[tuple[float, float]]:
        """Per exponent: sum of share^a, and sum of share^a ln share."""
        row = sources.where("tokens > 0").agg(*[f for a in exponents for f in (
            F.sum(F.pow(share, F.lit(a))), F.sum(F.pow(share, F.lit(a)) * F.log(share)))]).first()
        return list(zip(row[::2], row[1::2], strict=True))

    def flat_enough(a: float, z: float, l: float) -> bool:
        return math.log(z) - a * l / z >= entropy * math.log(n)

    def repeated(a: float, z: float) -> bool:
        return budget_ratio * (least / total) ** (a - 1) / z > repeats

    def bisect(low_side, lo: float = 0.0, hi: float = 1.0) -> float:
        """Largest step of 2^-HALVINGS for which ``low_side`` holds, 5 halvings a pass."""
        if low_side(hi, *sums([hi])[0]):
            return hi
        for _ in range(HALVINGS // 5):
            inner = [lo + (hi - lo) * k / 32 for k in range(33)]
            held = [low_side(a, *s) for a, s in zip(inner, sums(inner), strict=True)]
            k = max((i for i, ok in enumerate(held) if ok), default=0)
            lo, hi = inner[k], inner[min(k + 1, 32)]
        return lo

    exponent = max(bisect(flat_enough), bisect(lambda a, z, l: repeated(a, z)))
    return exponent, sums([exponent])[0][0], float(total)


def draws(docs: DataFrame, entropy: float = ENTROPY, repeats: float = REPEATS, budget_ratio: float = 1.0,
          text_col: str = "text", id_col: str = "doc_id", source_col: str = "source",
          block_ids: int = BLOCK_IDS) -> DataFrame:
    """All columns of ``docs`` plus ``tokens``, ``epoch`` and ``mix_order`` (see below), one row per draw.

    A document is drawn once in each pass that takes its block.  Sorting by
    ``mix_order`` (0 to 10^9) interleaves the sources in proportion to their
    budgets.  Null sources are one source of their own; rows without id form
    blocks by their text; sources without tokens have weight 0 and are left out.
    Names among the columns of ``docs`` that clash are replaced.  Rows that are
    repeated are drawn each; an empty table gives an empty result.
    """
    keep = [c for c in docs.columns if c.lower() not in ("tokens", "epoch", "mix_order")]
    name = F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("null"))
    block = F.coalesce(F.floor(F.col(id_col) / block_ids).cast("string"),
                       F.concat(F.lit("t"), F.substring(F.sha2(F.coalesce(text_col, F.lit("")), 256), 1, 8)))
    spread = docs.select(F.struct(*keep).alias("doc"), name.alias("name"), block.alias("block"),
                         count_tokens(text_col).alias("tokens"))
    blocks = store(spread.groupBy("name", "block").agg(F.sum("tokens").alias("tokens")), "blocks")
    sources = store(blocks.groupBy("name").agg(F.sum("tokens").alias("tokens")), "sources")
    exponent, z, total = solve_exponent(sources, entropy, repeats, budget_ratio)
    weight = F.pow(F.col("tokens") / F.lit(total or 1.0), F.lit(exponent)) / F.lit(z)
    budgets = sources.where("tokens > 0").select(
        "name", F.col("tokens").alias("have"),
        F.floor(weight * F.lit(total * budget_ratio) + 0.5).cast("long").alias("budget"))
    budgets = budgets.select("name", "have", "budget", F.expr("budget div have").alias("full"),
                             F.expr("budget % have").alias("rest"))
    plan = store(budgets.join(_ends(blocks, budgets), "name", "left"), "budgets")  # one row a source
    drawn = (spread.join(plan, "name")
             .withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("full"))))
             .withColumn("place", _place(F.col("name"), F.col("epoch"), F.col("block")))
             .where("epoch < full or place <= end"))
    order = F.floor((F.col("epoch") + F.conv(F.substring("place", 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32)))
                    / (F.col("budget") / F.col("have")) * F.lit(1e9)).cast("long")
    return drawn.select("doc.*", "tokens", "epoch", order.alias("mix_order"))


def _place(name: Column, epoch: Column, block: Column) -> Column:
    """A block's place in a source's order of one pass: a keyed digest, with the block to break ties."""
    return F.concat(F.sha2(F.concat_ws("|", F.lit(SEED), name, epoch.cast("string"), block), 256), block)


def _ends(blocks: DataFrame, budgets: DataFrame) -> DataFrame:
    """``name, end``: the last place that the part pass of a source takes."""
    last = (blocks.join(budgets.where("rest > 0"), "name")
            .select("name", "rest", "tokens", _place(F.col("name"), F.col("full"), F.col("block")).alias("place"))
            .withColumn("span", F.substring("place", 1, 3)))
    spans = last.groupBy("name", "span").agg(F.sum("tokens").alias("sum"), F.first("rest").alias("rest"))
    run = Window.partitionBy("name").orderBy("span")  # at most 4096 spans a source
    spans = spans.select("name", "span", "rest", (F.sum("sum").over(run) - F.col("sum")).alias("before"),
                         F.sum("sum").over(run).alias("upto"))
    inner = (last.join(spans.where("before < rest and upto >= rest").select("name", "span", "before"), ["name", "span"])
             .select("name", "rest", "place", "tokens",
                     (F.col("before") + F.sum("tokens").over(Window.partitionBy("name").orderBy("place"))
                      - F.col("tokens")).alias("sofar")))
    taken = inner.where("sofar + tokens / 2 <= rest").groupBy("name").agg(F.max("place").alias("inner_end"))
    whole = spans.where("upto < rest").groupBy("name").agg(F.max("span").alias("span"))
    # all places of a whole span come before its successor, so "~" (above any digit) ends it
    return (budgets.select("name").join(whole, "name", "left").join(taken, "name", "left")
            .select("name", F.coalesce("inner_end", F.concat("span", F.lit("~"))).alias("end")))


def mix_sources(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with every row as often as the mixture draws it, columns as they were."""
    names = docs.columns
    clash = [c for c in names if c.lower() in ("tokens", "epoch", "mix_order")]
    if clash:  # carry such columns under other names
        held = docs.withColumnsRenamed({c: f"__kept_{c}" for c in clash})
        return draws(held, **options).select(*[F.col(f"__kept_{c}").alias(c) if c in clash else c for c in names])
    return draws(docs, **options).select(*names)
