"""Mixing sources to target weights by temperature (DataFrame functions only).

Token shares p of the sources are raised to an exponent and normalised. The
entropy of the weights falls, and so does the repetition of the rarest source,
as the exponent grows, so either target is met by bisection; each step is one
aggregation over the small table of sources. The weights are realised over a
token budget: the documents of a source are repeated in epochs, each a
permutation of its own, up to the source's share of the budget. The stream is
cut into blocks in which every source has its share, and each block is permuted.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import without
from tidemark.sinks.tables import materialize

STEPS = 4096  # exponents are multiples of 1 / STEPS
STEEPEST = 4  # largest exponent tried
WORD = "[^\\x20\\x09-\\x0D]+"


def n_words(text: Column) -> Column:
    """Tokens of a document: its words, at least one, so that no document is free (null: one)."""
    return F.greatest(F.lit(1), F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0))).cast("long")


def source_totals(docs: DataFrame) -> DataFrame:
    """``(source, total, share)`` of rows ``(source, n_tokens)``; a null source is one of its own."""
    totals = docs.groupBy("source").agg(F.sum("n_tokens").alias("total")).where("total > 0")
    return materialize(totals.withColumn("share", F.col("total") / F.sum("total").over(Window.partitionBy())), "mixing")


def _measure(totals: DataFrame, exponent: float, n: int, budget: float | None) -> dict:
    """Normaliser, relative entropy and the most epochs of any source at one exponent."""
    p = F.pow("share", F.lit(exponent))
    s = totals.agg(F.sum(p).alias("z"), F.sum(p * F.log("share")).alias("plogp"),
                   F.max(p / F.col("total")).alias("steep"), F.max(F.col("total") / p).alias("flat")).first()
    entropy = 1.0 if n < 2 else (math.log(s["z"]) - exponent * s["plogp"] / s["z"]) / math.log(n)
    spend = s["flat"] * s["z"] if budget is None else budget
    return {"z": s["z"], "entropy": entropy, "epochs": s["steep"] / s["z"] * spend, "spend": spend}


def _bisect(holds, low: int, high: int) -> int:
    """Smallest grid point above ``low`` where ``holds`` is true, given that it is at ``high`` and stays so."""
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (low, mid) if holds(mid) else (mid, high)
    return high


def mixing_weights(totals: DataFrame, *, entropy: float | None = None, max_epochs: float | None = None,
                   budget: int | None = None) -> DataFrame:
    """``(source, total, weight, budget, epochs)`` of the sources in ``totals`` (see ``source_totals``).

    ``entropy``: the exponent is the largest of at most ``STEEPEST`` whose
    weights still have this share (0 to 1) of the largest possible entropy.
    ``max_epochs``: no source is repeated more often; the exponent is moved
    towards 1, where all sources repeat alike, as far as that needs, whatever
    the entropy. Neither: exponent 1. ``budget``: tokens of the whole mixture; None
    spends as much as keeps every source whole at least once.
    """
    n = totals.count()
    if not n:
        return totals.select("source", "total", F.lit(0.0).alias("weight"), F.lit(0).cast("long").alias("budget"),
                             F.lit(0).alias("epochs"))

    @functools.cache
    def at(k: int) -> dict:
        return _measure(totals, k / STEPS, n, None if budget is None else float(budget))

    k = STEPS
    if entropy is not None or max_epochs is not None:
        k = 0
    if entropy is not None and at(0)["entropy"] >= entropy:
        k = STEEPEST * STEPS
        if at(k)["entropy"] < entropy:
            k = _bisect(lambda m: at(m)["entropy"] < entropy, 0, k) - 1
    if max_epochs is not None and at(k)["epochs"] > max_epochs:
        if at(STEPS)["epochs"] > max_epochs:
            raise ValueError("the budget needs more epochs than max_epochs")
        if k < STEPS:  # flatter: the rarest source repeats most
            k = _bisect(lambda m: at(m)["epochs"] <= max_epochs, k, STEPS)
        else:  # steeper: the largest source does
            k = _bisect(lambda m: at(m)["epochs"] > max_epochs, STEPS, k) - 1
    m = at(k)
    weight = F.round(F.pow("share", F.lit(k / STEPS)) / F.lit(m["z"]), 12)
    own = F.floor(F.col("weight") * F.lit(m["spend"]) + 0.5).cast("long")
    least = F.col("total") if budget is None else F.lit(1)
    return (totals.select("source", "total", weight.alias("weight")).withColumn("budget", F.greatest(own, least))
            .withColumn("epochs", F.ceil(F.col("budget") / F.col("total")).cast("int")))


def mix(df: DataFrame, *, id_col: str = "doc_id", source: str = "source", tokens: Column,
        entropy: float | None = None, max_epochs: float | None = None, budget: int | None = None,
        block_tokens: int = 1 << 20, seed: int = 42) -> DataFrame:
    """The realised mixture: one row per copy of a document.

    Returns ``doc_id``, ``source``, ``n_tokens``, ``epoch`` (from 0), ``block``
    (from 0) and ``place`` (from 0 in the block). A source's epochs are
    permutations by md5 of seed, epoch and id; copies are taken in that order
    while the tokens before them are within the source's budget, so a source
    overspends by less than a document. A block holds about ``block_tokens``
    tokens, of every source its share. See ``mixing_weights`` for the targets.

    ``tokens`` gives a row's tokens; rows of none (or null) are counted as one.
    A null source is a source, a null id is one id; rows with equal ids and
    tokens are interchangeable. Other columns are ignored. Empty table: no rows.

    Prefix sums run over range partitions and their totals, so that one source
    may hold any part of the rows; blocks are bounded by their tokens.
    """
    docs = materialize(df.select(F.col(id_col).alias("doc_id"), F.col(source).alias("source"),
                                 F.greatest(F.lit(1), F.coalesce(tokens, F.lit(1))).cast("long").alias("n_tokens")),
                       "mixing")
    weights = materialize(mixing_weights(source_totals(docs), entropy=entropy, max_epochs=max_epochs, budget=budget),
                          "mixing")
    w = weights.select(F.col("source").alias("__s"), F.col("budget").alias("__b"), F.col("epochs").alias("__e"))
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epoch").cast("string"), F.col("doc_id").cast("string")))
    copies = (docs.join(w, F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
              .withColumn("epoch", F.explode(F.expr("sequence(0, __e - 1)"))).withColumn("__key", key))
    order = ["epoch", "__key", "doc_id", "n_tokens"]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(copies.repartitionByRange(parts, "source", *order, F.monotonically_increasing_id())
                         .withColumn("__part", F.spark_partition_id()), "mixing")
    before = Window.partitionBy("source").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    heads = (ranged.groupBy("__part", "source").agg(F.sum("n_tokens").alias("t"))  # partitions and sources meet once
             .withColumn("__head", F.coalesce(F.sum("t").over(before), F.lit(0)))
             .select(F.col("__part").alias("__p"), F.col("source").alias("__s"), "__head"))
    inside = Window.partitionBy("__part", "source").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = (ranged.withColumn("__own", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
              .join(heads, (F.col("__part") == F.col("__p")) & F.col("source").eqNullSafe(F.col("__s")))
              .withColumn("__at", F.col("__head") + F.col("__own")).where("__at < __b"))
    spent = weights.agg(F.sum("budget").alias("b")).first()["b"] or 0
    blocks = max(1, -(-spent // block_tokens))
    block = F.floor(F.col("__at").cast("double") / F.col("__b") * F.lit(blocks)).cast("int")
    shuffled = F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit("block"), F.col("epoch").cast("string"),
                                 F.col("doc_id").cast("string")))
    in_block = Window.partitionBy("block").orderBy("__mix", "doc_id", "epoch", "source", "n_tokens")
    return (placed.withColumn("block", block).withColumn("__mix", shuffled)
            .withColumn("place", (F.row_number().over(in_block) - 1).cast("long"))
            .select("doc_id", "source", "n_tokens", "epoch", "block", "place"))


def mixed_rows(df: DataFrame, *, id_col: str = "doc_id", source: str = "source", tokens: Column, **targets) -> DataFrame:
    """The rows of ``df``, each as often as the mixture holds its id; columns as they are.

    All rows of one id go together: the first source in order and the most
    tokens stand for the id.
    """
    one = df.select(F.col(id_col).alias("doc_id"), F.col(source).alias("source"), tokens.alias("t")).groupBy(
        "doc_id").agg(F.min("source").alias("source"), F.max("t").alias("t"))
    taken = mix(one, tokens=F.col("t"), **targets).groupBy(F.col("doc_id").alias("__id")).agg(F.count("*").alias("__n"))
    rows = without(df, ["__id", "__n"])
    return (rows.join(taken, F.col(id_col).eqNullSafe(F.col("__id")))
            .withColumn("__n", F.explode(F.expr("sequence(1, __n)"))).select(*rows.columns))
