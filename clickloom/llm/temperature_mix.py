"""Mixing sources by temperature: weights, and the blocks that realise them. Native.

A source's weight is its share of tokens raised to an exponent and normalised; exponent 1
keeps the shares, 0 makes all sources equal. The exponent is narrowed down, 64 parts at a
time, to the largest that reaches a target entropy, or the smallest that repeats no source
more often than a limit. Each source then fills its part of the token budget with whole
passes over its documents and one partial pass. A pass is a permutation in blocks:
documents fall into blocks by a hash, blocks follow each other, and within a block the
hash gives the order. So no window holds more than a block, whatever a source's size.

Only DataFrame and SQL functions are used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import stored

ENTROPY = 0.98     # of the largest possible entropy
BLOCK_DOCS = 4096
PARTS, TURNS = 64, 6


def token_count(text: str = "text") -> Column:
    """Blank-separated pieces of a text; none if it is null or empty."""
    return F.when(F.length(text) > 0, F.size(F.split(text, " "))).otherwise(0).cast("long")


def exponent(sources: DataFrame, budget: float, target_entropy: float | None = None,
             max_repeats: float | None = None) -> float:
    """Exponent for ``sources(source, tokens)``, with exactly one of the two targets.

    ``target_entropy`` is a share of log(number of sources): the largest exponent in [0, 1]
    whose weights reach it. ``max_repeats``: the smallest exponent in [0, 1] at which no
    source is passed more often; 1 if even the shares themselves repeat more. Each turn is
    one aggregation over the sources for 65 exponents. Sources without tokens do not count.
    """
    if (target_entropy is None) == (max_repeats is None):
        raise ValueError("give a target entropy or a limit of repeats")
    used = sources.where("tokens > 0")
    total, n = used.agg(F.sum("tokens"), F.count("*")).head()
    if not n:
        return 1.0
    low, high = 0.0, 1.0
    for _ in range(TURNS):
        grid = [low + (high - low) * k / PARTS for k in range(PARTS + 1)]
        p = F.col("tokens") / F.lit(float(total))
        power = F.pow(p, F.col("a"))
        measured = (used.select("tokens", F.explode(F.array(*map(F.lit, grid))).alias("a"))
                    .groupBy("a").agg(F.sum(power).alias("z"), F.sum(power * F.log(p)).alias("zl"),
                                      F.max(power / F.col("tokens")).alias("most"))
                    .select("a", (F.log("z") - F.col("a") * F.col("zl") / F.col("z")).alias("entropy"),
                            (F.lit(float(budget)) * F.col("most") / F.col("z")).alias("repeats")))
        if target_entropy is not None:
            met = measured.where(F.col("entropy") >= target_entropy * math.log(n) - 1e-12).agg(F.max("a")).head()[0]
            low = 0.0 if met is None else met
            high = min(1.0, low + (high - grid[0]) / PARTS)
        else:
            met = measured.where(F.col("repeats") <= max_repeats + 1e-12).agg(F.min("a")).head()[0]
            if met is None:
                return 1.0
            low, high = max(0.0, met - (high - low) / PARTS), met
    return low if target_entropy is not None else high


def weights(sources: DataFrame, budget: float, target_entropy: float | None = None,
            max_repeats: float | None = None) -> DataFrame:
    """``sources`` with ``weight`` (sums to 1) and ``passes``, how often each source is read."""
    a = exponent(sources, budget, target_entropy, max_repeats)
    total = sources.agg(F.sum("tokens")).head()[0] or 0
    power = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(float(total or 1)), F.lit(a))).otherwise(0.0)
    z = sources.agg(F.sum(power)).head()[0] or 1.0
    return sources.withColumn("weight", power / F.lit(z)).withColumn(
        "passes", F.when(F.col("tokens") > 0, F.col("weight") * F.lit(float(budget)) / F.col("tokens")).otherwise(0.0))


def _order(epoch: str = "epoch") -> Column:
    return F.md5(F.concat_ws("-", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col(epoch).cast("string")))


def mixture(docs: DataFrame, budget: int | None = None, target_entropy: float | None = ENTROPY,
            max_repeats: float | None = None) -> DataFrame:
    """``(doc_id, source, n_tokens, epoch, block, mix_at)``: one row for each use of a document
    of ``docs(doc_id, source, text)``.

    ``budget`` is the number of tokens to draw, by default those of ``docs``. A source takes
    ``weight * budget`` tokens; the last partial pass takes documents while the tokens before
    them are under what is left, so a source exceeds its part by less than one document.
    ``mix_at`` in [0, 1) is the document's place in its source's stream; sorting by it mixes
    the streams in proportion. Documents without tokens are not drawn. A null source is a
    source of its own; a null ``doc_id`` is drawn like any other; repeated rows are drawn
    each; other columns are ignored.
    """
    counted = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", token_count().alias("n_tokens"))
                     .where("n_tokens > 0"), "mix-counts")
    sources = stored(counted.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs")), "mix-sources")
    total = sources.agg(F.sum("tokens")).head()[0] or 0
    budget = total if budget is None else budget
    plan = stored(weights(sources, budget, target_entropy, max_repeats).select(
        F.col("source").alias("s"), "tokens", "weight", "passes",
        F.ceil(F.col("docs") / BLOCK_DOCS).alias("blocks")), "mix-plan")
    uses = (counted.join(plan, F.col("source").eqNullSafe(F.col("s"))).where("passes > 0")
            .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.floor("passes").cast("int"))))
            .withColumn("key", _order())
            .withColumn("block", F.conv(F.substring("key", 1, 8), 16, 10).cast("long") % F.col("blocks")))
    # tokens before each block, from one row per source, pass and block
    sizes = uses.groupBy("s", "epoch", "block").agg(F.sum("n_tokens").alias("size"))
    before = Window.partitionBy("s", "epoch").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col("s").alias("os"), F.col("epoch").alias("oe"), F.col("block").alias("ob"),
                           F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    own = Window.partitionBy("s", "epoch", "block").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = (uses.withColumn("inside", F.coalesce(F.sum("n_tokens").over(own), F.lit(0)))
              .join(offsets, F.col("s").eqNullSafe(F.col("os")) & (F.col("epoch") == F.col("oe")) & (F.col("block") == F.col("ob")))
              .withColumn("at", F.col("epoch") * F.col("tokens") + F.col("offset") + F.col("inside"))
              .withColumn("quota", F.col("passes") * F.col("tokens")))
    return placed.where("at < quota - 1e-6").select(
        "doc_id", "source", "n_tokens", F.col("epoch").cast("int").alias("epoch"), "block",
        F.round(F.col("at") / F.col("quota"), 6).alias("mix_at"))
