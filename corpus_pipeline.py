"""A training-corpus pipeline of five stages over ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, mixing, queries, rows, sharding, simhash, toxicity
from tidemark.llm.common import small_batches
from tidemark.sinks.tables import discard, intermediates, materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SHARDS = 16
ROW = rows.ROW


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` keyed by file and row: ids may be null or repeated, and texts stay where they are read."""
    return rows.keyed(docs.select(*COLUMNS))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity by compression distance: documents scored 0.5 or more go."""
    model = queries.toxicity_model(spark, docs, sf_dir)
    keyed = _keyed(docs)
    scored = toxicity.score(keyed.select(ROW, "text"), model, out="__score")
    with small_batches(spark):
        gone = materialize(scored.where("not coalesce(__score < 0.5, false)").select(ROW), "pipeline")
    return rows.join_rows(keyed, gone, "left_anti").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-duplicates: of each group the one row of least id stays (a row without an id only if none has one)."""
    keyed = _keyed(docs)
    found = simhash.near_duplicates(keyed.select(ROW, "text"), id_col=ROW, shingle=3, distance=3).select(
        F.col("doc_id").alias(ROW), "component_id")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", ROW)
    ranked = materialize(found.join(keyed.select(ROW, "doc_id"), ROW).select("component_id", rank.alias("rank")), "pipeline")
    least = ranked.groupBy("component_id").agg(F.min("rank").alias("least"))
    gone = materialize(ranked.join(least, "component_id").where(f"rank.{ROW} <> least.{ROW}").select(f"rank.{ROW}"), "pipeline")
    return rows.join_rows(keyed, gone, "left_anti").select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: rows that hold a benchmark item go, whatever their id."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    keyed = _keyed(docs)
    found = decontaminate.contaminated(keyed.select(ROW, "text"), items, id_col=ROW)
    gone = materialize(found.select(F.col("doc_id").alias(ROW)).distinct(), "pipeline")
    return rows.join_rows(keyed, gone, "left_anti").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Temperature mixing: rare sources are repeated, at most twice; the budget keeps every row at least once."""
    keyed = _keyed(docs)
    thin = keyed.select(ROW, "source", mixing.n_words(F.col("text")).alias("n"))
    mixed = mixing.mix(thin, id_col=ROW, tokens=F.col("n"), entropy=0.95, max_epochs=2.0)
    copies = mixed.groupBy(F.col("doc_id").alias(ROW)).agg(F.count("*").alias("__copies"))
    repeated = materialize(copies.where("__copies > 1"), "pipeline")  # the budget holds every row once
    joined = rows.join_rows(keyed, repeated, "left")
    return joined.withColumn("__copy", F.explode(F.expr("sequence(1L, coalesce(__copies, 1L))"))).select(*COLUMNS)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contiguous shards of near-equal bytes: the documents with ``size``, ``shard`` and ``slot``."""
    keyed = _keyed(docs)
    thin = keyed.select(ROW, "doc_id", sharding.text_size(F.col("text")).alias("size"))
    placed = sharding.byte_shards(thin, SHARDS, order_by=["doc_id", ROW], size=F.col("size"))
    placed = materialize(placed.select(ROW, "size", "shard", "slot"), "pipeline")
    return rows.join_rows(keyed, placed, "inner").select(*COLUMNS, "size", "shard", "slot")


STAGES = [("toxicity", drop_toxic), ("simhash near-dedup", drop_near_duplicates),
          ("decontamination", drop_contaminated), ("mixing", mix_sources), ("sharding", shard)]

ORACLE_SQL = None  # the first and third stage learn models, which SQL cannot express


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again.

    Once a stage is written, what it was computed from is deleted: its
    intermediate tables and the output of the stage before. So a failed run can
    go on from the last finished stage, and the disk holds two stages at most.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before: list[str] = []
    for _, stage in STAGES:
        with intermediates() as made:
            after = stage(spark, docs, sf_dir)
        with intermediates() as out:
            docs = materialize(after, "pipeline")
        discard(spark, [*made, *before])
        before = out
    return docs
