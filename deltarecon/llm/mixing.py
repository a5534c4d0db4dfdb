"""Mixing sources to target weights (DataFrame functions only).

Sources are weighted by temperature: with token shares p, the weight of a
source is p ** a / sum(p ** a). The exponent a is bisected between 0 (all
sources alike) and 1 (as they are): the weights' entropy falls as a grows,
so it is lowered until the entropy reaches a target share of ln(number of
sources). A smaller a repeats small sources more often, so a second bisection
raises it until no source is read more than ``max_repeats`` times. The larger
exponent holds. It is never over 1: a corpus more even than the target stays as it
is. A budget of more than ``max_repeats`` times all tokens can't be drawn within the
limit and raises an error.

The weights times the token budget are then drawn. The documents of a source
are dealt to blocks of about ``block_tokens`` by hash; an epoch is a
permutation of the blocks and, in each, of its documents, and every epoch has its
own. A source is read for as many whole epochs as its budget has, then along
one more until the budget is met.

Scale: what is kept per source is one row, written once; each pass of the
bisection evaluates all midpoints that ``DEPTH`` halvings can visit in one
aggregate of one row. Offsets along a permutation are sums over groups of
blocks, over blocks of a group, and over documents of a block, so a source with
a third of all tokens is spread over its blocks and no window holds a whole
source. Blocks follow tokens: documents without any lie in the blocks of the others,
and rows equal in id and number of tokens share one.

Cases: a null ``source`` is a source of its own; null and empty texts have no
tokens and are drawn with the block they are in; sources without any token get
no weight and aren't drawn; one source gets weight 1; repeated rows are drawn
each; a null ``doc_id`` is drawn like any other; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deltarecon.llm.common import words
from deltarecon.session import materialize

TARGET_ENTROPY = 0.97  # share of ln(number of sources)
MAX_REPEATS = 4.0
BLOCK_TOKENS = 1 << 14
GROUP_BLOCKS = 1 << 8
HALVINGS = 40
DEPTH = 4
SEED = "mix-1"


def _midpoints(low: float, high: float, depth: int) -> list[float]:
    if not depth:
        return []
    mid = (low + high) / 2
    return [*_midpoints(low, mid, depth - 1), mid, *_midpoints(mid, high, depth - 1)]


def _bisect(sources: DataFrame, measure: Callable[[float], Column], low_side: Callable[[float], bool]) -> float:
    """The exponent in [0, 1] where ``low_side(measure)`` turns: true means go up."""
    low, high = 0.0, 1.0
    for _ in range(HALVINGS // DEPTH):
        at = _midpoints(low, high, DEPTH)
        row = sources.agg(*(measure(a).alias(f"m{i}") for i, a in enumerate(at))).first()
        value = dict(zip(at, row))
        for _ in range(DEPTH):
            mid = (low + high) / 2
            low, high = (mid, high) if low_side(value[mid]) else (low, mid)
    return (low + high) / 2


def _entropy(a: float) -> Column:
    """Of weights p ** a / z: ln z - a * sum(p ** a * ln p) / z."""
    power = F.pow("share", F.lit(a))
    return F.log(F.sum(power)) - a * F.sum(power * F.log("share")) / F.sum(power)


def _most_repeats(a: float, budget: float) -> Column:
    """weight * budget / tokens of the source for which that is largest."""
    return F.max(F.pow("share", F.lit(a)) / F.col("tokens")) * budget / F.sum(F.pow("share", F.lit(a)))


def _digest(*parts: Column) -> Column:
    return F.md5(F.concat_ws("/", F.lit(SEED), *(F.coalesce(p.cast("string"), F.lit("-")) for p in parts)))


def _uniform(digest: Column) -> Column:
    """Thirty-two bits of a digest as a number in [0, 1)."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(1 << 32)


def source_key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source), F.lit("null"))


def source_weights(tokens: DataFrame, target_entropy: float, max_repeats: float,
                   budget_tokens: int | None = None) -> DataFrame:
    """One row per source with tokens, from rows of ``(key, n_tokens)``:
    ``tokens``, ``docs``, ``share``, ``exponent``, ``weight``, ``budget``."""
    sums = tokens.groupBy("key").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs"))
    sums = materialize(sums.filter("tokens > 0"), "sources")
    total, n = sums.agg(F.sum("tokens"), F.count("*")).first()
    total = int(total or 0)
    budget = total if budget_tokens is None else int(budget_tokens)
    if total and budget > max_repeats * total:
        raise ValueError(f"{budget} tokens are more than {max_repeats:g} times the {total} there are")
    sums = sums.withColumn("share", F.col("tokens") / F.lit(float(total or 1)))
    exponent = 1.0
    if n > 1:
        goal = target_entropy * math.log(n)
        exponent = _bisect(sums, _entropy, lambda h: h > goal)
        floor = _bisect(sums, lambda a: _most_repeats(a, budget), lambda r: r > max_repeats)
        exponent = max(exponent, floor)
    z = sums.agg(F.sum(F.pow("share", F.lit(exponent)))).first()[0] or 1.0
    weight = F.pow("share", F.lit(exponent)) / F.lit(float(z))
    return sums.select("key", "tokens", "docs", "share", F.lit(round(exponent, 9)).alias("exponent"),
                       weight.alias("weight"), F.floor(weight * F.lit(float(budget)) + 0.5).alias("budget"))


def _running(df: DataFrame, within: list[str], order: list[str], amount: str) -> Column:
    w = Window.partitionBy(*within).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(amount).over(w), F.lit(0))


def mix(docs: DataFrame, target_entropy: float = TARGET_ENTROPY, max_repeats: float = MAX_REPEATS,
        budget_tokens: int | None = None, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per draw: ``doc_id``, ``source``, ``n_tokens``, ``epoch`` (from 0),
    ``start_token`` (within the source's stream), ``weight``, and ``mix_at``: the
    place from 0 to 1 in the source's budget. Sorting by it interleaves the
    sources so that every stretch has the target weights.

    ``budget_tokens``: tokens to draw, all the corpus has if None.
    """
    rows = docs.select("doc_id", "source", source_key(F.col("source")).alias("key"),
                       F.size(words(F.col("text"))).cast("long").alias("n_tokens"))
    rows = materialize(rows, "mix-rows")
    sources = materialize(source_weights(rows, target_entropy, max_repeats, budget_tokens), "mix-weights")

    # Sources are few rows against documents, but their number isn't bounded: a plain join.
    plan = sources.select("key", "tokens", "weight", "budget",
                          F.ceil(F.col("tokens") / F.lit(float(block_tokens))).cast("long").alias("blocks"),
                          F.floor(F.col("budget") / F.col("tokens")).cast("long").alias("whole"))
    dealt = rows.join(plan, "key").withColumn(
        "block", F.floor(_uniform(_digest(F.lit("block"), F.col("doc_id"), F.col("n_tokens"))) * F.col("blocks")))
    dealt = materialize(dealt, "mix-blocks")

    # Whole epochs need no offsets but to be placed in the stream; the last one is cut.
    block_sums = dealt.groupBy("key", "block", "whole", "tokens", "budget").agg(F.sum("n_tokens").alias("amount"))
    block_sums = block_sums.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole"))))
    block_sums = block_sums.filter("epoch * tokens < budget")
    # The permutation of an epoch: blocks by digest, in groups that hold a range of digests.
    place = _digest(F.lit("epoch"), F.col("epoch"), F.col("key"), F.col("block"))
    n_groups = F.ceil(F.col("tokens") / F.lit(float(block_tokens)) / GROUP_BLOCKS)
    block_sums = block_sums.withColumn("place", place).withColumn("grp", F.floor(_uniform(F.col("place")) * n_groups))
    groups = block_sums.groupBy("key", "epoch", "grp").agg(F.sum("amount").alias("amount"))
    groups = groups.withColumn("group_start", _running(groups, ["key", "epoch"], ["grp"], "amount")).drop("amount")
    starts = block_sums.withColumn("in_group", _running(block_sums, ["key", "epoch", "grp"], ["place", "block"], "amount"))
    starts = starts.join(groups, ["key", "epoch", "grp"]).select(
        "key", "block", "epoch", (F.col("group_start") + F.col("in_group")).alias("block_start"))

    drawn = dealt.join(starts, ["key", "block"])
    drawn = drawn.withColumn("turn", _digest(F.lit("turn"), F.col("epoch"), F.col("doc_id"), F.col("n_tokens")))
    inner = _running(drawn, ["key", "epoch", "block"], ["turn", "doc_id", "n_tokens"], "n_tokens")
    drawn = drawn.withColumn("start_token", F.col("epoch") * F.col("tokens") + F.col("block_start") + inner)
    drawn = drawn.filter("start_token < budget")
    return drawn.select(
        "doc_id", "source", "n_tokens", "epoch", "start_token", F.round("weight", 9).alias("weight"),
        F.round((F.col("start_token") + F.col("n_tokens") / 2) / F.col("budget"), 9).alias("mix_at"))
