"""Queries over stored tables: merges of touched files, differences, rejects, sized exports and read splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.differences import find_differences
from tidemark.operators.loading import REPLICATION_COLUMN
from tidemark.plans import oracle as O
from tidemark.plans.fixtures import Fixtures
from tidemark.plans.flows import LoadPlan, run_load
from tidemark.plans.q_load import _COLS, MERGE_KEY
from tidemark.plans.registry import register
from tidemark.sinks import tables
from tidemark.sources.splits import read_splits, split_counts

# Which orders the payload changes, adds (with and without a key) and leaves alone.
CHANGED, ADDED, KEYLESS = "o_orderkey % 50 = 3", "o_orderkey % 40 = 7", "o_orderkey % 60 = 9"


def _merge_payload(orders: DataFrame) -> DataFrame:
    same = [c for c in _COLS if c not in ("o_orderkey", "o_totalprice")]
    return (orders.where(CHANGED).select("o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice"), *same)
            .unionByName(orders.where(ADDED).select((-F.col("o_orderkey")).alias("o_orderkey"), "o_totalprice", *same))
            .unionByName(orders.where(KEYLESS).select(F.lit(None).cast("bigint").alias("o_orderkey"), "o_totalprice", *same)))


@register("load_merge_pk_files", f"""
SELECT CASE WHEN o_orderkey % 75 = 0 THEN NULL ELSE o_orderkey END AS o_orderkey, o_custkey, o_orderstatus,
  CASE WHEN {CHANGED} AND o_orderkey % 75 <> 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderdate,
  o_orderpriority, CAST(o_orderkey % 1000 AS BIGINT) AS "{REPLICATION_COLUMN}" FROM orders
UNION ALL
SELECT -o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, NULL FROM orders WHERE {ADDED}
UNION ALL
SELECT NULL, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, NULL FROM orders WHERE {KEYLESS}
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1, o_orderdate, o_orderpriority, NULL FROM orders
WHERE {CHANGED} AND o_orderkey % 75 = 0""")
def q_load_merge_pk_files(spark, sf_dir):
    """Key merge into a target with the replication column and null keys, rewriting only files that hold a payload key."""
    orders = Fixtures(spark, sf_dir).table("orders").select(*_COLS)
    key = F.when(F.col(MERGE_KEY) % 75 != 0, F.col(MERGE_KEY)).alias(MERGE_KEY)
    rest = [c for c in _COLS if c != MERGE_KEY]
    path = tables.publish(orders.select(key, *rest, (F.col(MERGE_KEY) % 1000).alias(REPLICATION_COLUMN)), name="merge_files")
    tables.merge_touched_files(spark, path, _merge_payload(orders), MERGE_KEY)
    return spark.read.parquet(path)


@register("load_differences", O.with_views("""
SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey,
  CASE WHEN t.o_orderkey IS NULL THEN 'missing' WHEN s.o_orderkey IS NULL THEN 'extra' ELSE 'changed' END AS difference,
  CASE WHEN s.o_orderkey IS NOT NULL AND t.o_orderkey IS NOT NULL THEN concat_ws(',',
    CASE WHEN s.o_custkey IS DISTINCT FROM t.o_custkey THEN 'o_custkey' END,
    CASE WHEN s.o_totalprice IS DISTINCT FROM t.o_totalprice THEN 'o_totalprice' END,
    CASE WHEN s.o_orderpriority IS DISTINCT FROM t.o_orderpriority THEN 'o_orderpriority' END) END AS changed_columns
FROM orders s FULL JOIN damaged t ON s.o_orderkey = t.o_orderkey
WHERE s.o_orderkey IS NULL OR t.o_orderkey IS NULL OR s.o_totalprice IS DISTINCT FROM t.o_totalprice
   OR s.o_orderpriority IS DISTINCT FROM t.o_orderpriority""", extra={"damaged": """
SELECT CASE WHEN o_orderkey % 301 = 5 THEN -o_orderkey ELSE o_orderkey END AS o_orderkey, o_custkey, o_orderstatus,
  CASE WHEN o_orderkey % 211 = 2 THEN o_totalprice + 0.5 ELSE o_totalprice END AS o_totalprice, o_orderdate,
  CASE WHEN o_orderkey % 401 = 3 THEN NULL ELSE o_orderpriority END AS o_orderpriority
FROM orders WHERE o_orderkey % 307 <> 11"""}))
def q_load_differences(spark, sf_dir):
    """Missing, extra and changed orders of a damaged load."""
    orders = Fixtures(spark, sf_dir).table("orders").select(*_COLS)
    k = F.col(MERGE_KEY)
    damaged = tables.publish(orders.where(k % 307 != 11).withColumns({
        "o_totalprice": F.when(k % 211 == 2, F.col("o_totalprice") + 0.5).otherwise(F.col("o_totalprice")),
        "o_orderpriority": F.when(k % 401 != 3, F.col("o_orderpriority")),
        MERGE_KEY: F.when(k % 301 == 5, -k).otherwise(k)}), name="damaged")
    found = find_differences(orders, spark.read.parquet(damaged), MERGE_KEY)
    return found.select(MERGE_KEY, "difference", F.array_join("changed_columns", ",").alias("changed_columns"))


# Fixed value: the text table's types once loaded.
TEXT_TARGET = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_totalprice", T.DecimalType(15, 2)),
                            T.StructField("o_orderdate", T.DateType())])


@register("load_rejects", """
SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(15, 2)) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
  CAST(NULL AS VARCHAR) AS reject_reason
FROM orders WHERE o_orderkey % 90 NOT IN (1, 2, 3)
UNION ALL
SELECT NULL, NULL, NULL, CASE o_orderkey % 90 WHEN 1 THEN 'o_totalprice is not decimal(15,2)'
  WHEN 2 THEN 'o_orderdate is not date' ELSE 'o_orderkey is not bigint; o_orderdate is not date' END
FROM orders WHERE o_orderkey % 90 IN (1, 2, 3)""")
def q_load_rejects(spark, sf_dir):
    """Malformed text rows in a load: the good ones become the table, the others are kept with their reasons."""
    orders = Fixtures(spark, sf_dir).table("orders")
    k = F.col("o_orderkey")
    text = orders.select(
        F.when(k % 90 == 3, F.concat(F.lit("no "), k.cast("string"))).otherwise(k.cast("string")).alias("o_orderkey"),
        F.when(k % 90 == 1, "12,5").otherwise(F.col("o_totalprice").cast("decimal(15,2)").cast("string")).alias("o_totalprice"),
        F.when(k % 90 >= 4, F.col("o_orderdate").cast("date").cast("string")).when(k % 90 < 2, F.col("o_orderdate").cast("date").cast("string"))
        .otherwise("31.12.1999").alias("o_orderdate"))
    target = spark.createDataFrame([], TEXT_TARGET)
    res = run_load(spark, text, target, LoadPlan("SRC.ORDERS", "JDBC"), keep_rejects=True)
    if res.path is None or res.num_records + res.rejected != text.count():
        raise RuntimeError(res.error or "rows were lost")
    return spark.read.parquet(res.path).unionByName(res.rejects.select("reject_reason"), allowMissingColumns=True)


LEAST_FILES = 6


@register("stage_export_sized", """
SELECT 'narrow' AS kind, count(*) AS records, true AS sized FROM orders
UNION ALL SELECT 'wide', count(*), true FROM orders""")
def q_stage_export_sized(spark, sf_dir):
    """Exports of narrow and wide rows: files of about the same bytes, whatever a row's width."""
    orders = Fixtures(spark, sf_dir).table("orders")
    wide = orders.select("*", *[F.sha2(F.concat(F.col("o_orderkey").cast("string"), F.lit(f":{i}")), 256).alias(f"w{i}") for i in range(8)])
    out = None
    for kind, df in (("narrow", orders), ("wide", wide)):
        # a few files of a small table, which 16 MB would make one of; never more than that, as a file is one task's
        path, rows, width = tables.export_sized(df)
        target = max(1, min(tables.STAGE_OBJECT_BYTES, int(rows * width / LEAST_FILES)))
        path, rows, width = tables.export_sized(df, path, target_bytes=target)  # in the place of the first, so the disk holds one
        wanted = max(LEAST_FILES, round(rows * width / target))
        sizes = tables.folder_bytes(spark, path)
        # small files have their own dictionaries and footers, so they are a little over their share
        sized = len(sizes) == wanted and max(sizes) < 2 * target and max(sizes) < 1.25 * min(sizes)
        part = tables.stage_file_counts(spark, path).agg(F.lit(kind).alias("kind"), F.sum("records").alias("records"),
                                                         F.lit(sized and rows > 0).alias("sized"))
        out = part if out is None else out.unionByName(part)
    return out


SPLITS = 12


@register("read_splits", """
SELECT kind, count(*) AS rows, count(*) AS satisfied, true AS even FROM (
  SELECT 'skewed' AS kind FROM lineitem UNION ALL SELECT 'heavy' FROM lineitem UNION ALL SELECT 'shipdate' FROM lineitem) t
GROUP BY kind""")
def q_read_splits(spark, sf_dir):
    """Splits of lineitem by an uneven key, a key that a third of the rows share (and nulls), and a time: every row
    in exactly one predicate, and no split of several values far over its share."""
    lines = Fixtures(spark, sf_dir).table("lineitem")
    k = F.col("l_orderkey")
    wide = k.cast("double")  # the cube of a key over two million is no bigint
    kinds = {"skewed": (wide * wide * wide).alias("c"), "shipdate": F.col("l_shipdate").alias("c"),
             "heavy": F.when(k % 3 == 0, 7).when(k % 11 == 1, None).otherwise(k).cast("bigint").alias("c")}
    out = None
    for kind, column in kinds.items():
        rows = lines.select(column)
        counts = split_counts(rows, read_splits(rows, "c", SPLITS))
        ranges = ~F.col("predicate").rlike("^c = |IS NULL$")
        part = counts.agg(F.sum("rows").alias("rows"), F.sum("satisfied").alias("satisfied"),
                          F.max(F.when(ranges, F.col("rows"))).alias("most"))  # a dozen splits
        part = part.select(F.lit(kind).alias("kind"), "rows", "satisfied",
                           (F.col("most") <= 1.1 * F.col("rows") / SPLITS + 8).alias("even"))
        out = part if out is None else out.unionByName(part)
    return out
