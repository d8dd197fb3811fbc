"""Mixing sources to target weights by repetition rates and hash-seeded copies.

Words are summed per source, targets follow from the weights, and a document is taken
floor(rate) times plus one more time when its hash falls below the fraction of the rate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import numbered, stored, unused

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
SEEDS = 16

# Draws are whole numbers below 2^32: a multiple of the id's hash, one multiplier per seed.
_RANGE = 1 << 32


def multiplier(seed: int) -> int:
    return (2654435761 * (2 * seed + 1)) % (1 << 31) | 1


def word_count(text: Column) -> Column:
    """Runs of anything but space and the controls from tab to carriage return; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _draw(doc_id: Column, seed: Column | int) -> Column:
    base = F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 8), 16, 10).cast("long")
    return base * seed % F.lit(_RANGE)


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """``target`` words of each source, given one row per ``source`` with its ``source_size``.

    Sources in code point order, null last, weigh ``weights`` in turn and share the words of
    all of them.  A target stops at ``most`` times the size of its source and the excess is
    shared by weight again.  That has one level: a target is the smaller of its bound and
    level times weight.  The level is found by rounds of two sums over the sources.
    """
    ranked = numbered(sources, [F.col("source").isNull(), F.col("source")], "_rank", "sources")
    kinds = F.array(*[F.lit(weight) for weight in weights])
    weighed = stored(
        ranked.withColumn("_weight", F.element_at(kinds, (F.col("_rank") % len(weights) + 1).cast("int"))).drop("_rank"),
        "weights",
    )
    bound, level = F.col("source_size") * most, 0.0
    words = weighed.agg(F.sum("source_size")).first()[0] or 0
    while words:
        capped = bound < F.col("_weight") * F.lit(level)
        free = weighed.agg(
            F.sum(F.when(capped, bound).otherwise(0)).alias("held"),
            F.sum(F.when(capped, 0).otherwise(F.col("_weight"))).alias("weight"),
        ).first()
        raised = (words - free["held"]) / free["weight"]
        if raised <= level:
            break
        level = raised
    return weighed.withColumn("target", F.least(bound.cast("double"), F.col("_weight") * F.lit(level))).drop("_weight")


def mixing_plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """Rows of ``docs`` (doc_id, source, text) with ``_mix``: size, source_size, target, copies.

    Per source the seed among ``SEEDS`` is used whose copies come nearest to the target.
    Null texts have size 0; null is a source of its own; rows with the same id are drawn
    alike; a source without words is kept once.  Other columns stay as they are; the new one gets
    underscores behind its name until no column has it.
    """
    rows = docs.select(F.struct("*").alias("_row"), "doc_id", "source", word_count(F.col("text")).alias("size"))
    sizes = stored(rows.drop("_row"), "sizes")
    targets = source_targets(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    rated = targets.select(
        F.col("source").alias("_source"),
        "source_size",
        "target",
        F.when(F.col("source_size") == 0, 1.0)
        .otherwise(F.col("target") / F.greatest("source_size", F.lit(1)))
        .alias("_rate"),
    )
    whole = F.floor("_rate")
    fraction = (F.col("_rate") - whole) * _RANGE
    joined = sizes.join(rated, F.col("source").eqNullSafe(F.col("_source")))
    drawn = [
        F.sum(F.when(_draw(F.col("doc_id"), multiplier(seed)) < fraction, F.col("size")).otherwise(0)).alias(f"s{seed}")
        for seed in range(SEEDS)
    ]
    tried = joined.groupBy("_source", "source_size", "target", "_rate").agg(*drawn)
    miss = [
        F.struct(F.abs(F.col(f"s{seed}") + F.col("source_size") * whole - F.col("target")), F.lit(multiplier(seed)))
        for seed in range(SEEDS)
    ]
    # ties go to the first seed, so the order of the candidates is part of the result
    ranked = [F.struct(m["col1"].alias("miss"), F.lit(i).alias("i"), m["col2"].alias("by")) for i, m in enumerate(miss)]
    chosen = stored(
        tried.select("_source", "source_size", "target", "_rate", F.array_min(F.array(*ranked))["by"].alias("_by")),
        "rates",
    )
    extra = (_draw(F.col("doc_id"), F.col("_by")) < fraction).cast("long")
    return rows.join(chosen, F.col("source").eqNullSafe(F.col("_source"))).select(
        "_row.*",
        F.struct("size", "source_size", "target", (whole + extra).cast("long").alias("copies")).alias(unused(docs, "_mix")),
    )


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """Every document as often as the mix takes it, in the columns of ``docs``."""
    plan, mix = mixing_plan(docs, weights, most), unused(docs, "_mix")
    copies = F.sequence(F.lit(1).cast("long"), F.col(f"{mix}.copies"))
    return plan.filter(F.col(f"{mix}.copies") > 0).withColumn(mix, F.explode(copies)).drop(mix)


def mix_report(docs: DataFrame) -> DataFrame:
    """One row per document with the words that the mix takes of it."""
    return mixing_plan(docs.select("doc_id", "source", "text")).select(
        "doc_id",
        "_mix.size",
        "_mix.source_size",
        "_mix.target",
        (F.col("_mix.size") * F.col("_mix.copies")).alias("taken"),
    )
