"""Staged Parquet scan: explicit string-first schema, then cast to the target types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.operators.projection import staging_schema, typed_projection


def staged_scan(spark: SparkSession, path: str, target_schema: T.StructType) -> DataFrame:
    """Read an export folder with the staging schema (never inferred) and cast to the target.

    The export holds dates and times as text (see ``source_text_projection``),
    which is why the staging schema reads them as strings.
    """
    raw = spark.read.schema(staging_schema(target_schema)).parquet(path)
    return typed_projection(raw, target_schema)
