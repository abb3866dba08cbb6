"""Ad-hoc SQL over named DataFrames (the result stays a DataFrame, never collected)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def adhoc_sql(spark: SparkSession, sql: str, views: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Register ``views`` as session temp views and run ``sql`` on them."""
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql)
