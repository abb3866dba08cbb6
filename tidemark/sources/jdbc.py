"""JDBC source scans, read in parallel by the executors.

The reference fetches every row of a direct load into driver memory. Here the
source is a JDBC relation split on a numeric/date column into
``num_partitions`` range reads, so rows go straight to the executors; the
predicate and the column list are pushed into the source query by Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed value: the source's non-blocking read prefix.
ACCESS_LOCK_PREFIX = "LOCKING ROW FOR ACCESS "


def jdbc_options(url: str, *, table: str | None = None, query: str | None = None, where: str | None = None,
                 partition_column: str | None = None, lower_bound=None, upper_bound=None,
                 num_partitions: int | None = None, lock_rows: bool = False, fetch_size: int = 10_000,
                 driver: str | None = None, **extra: str) -> dict[str, str]:
    """Reader options for one source table or query.

    ``where`` wraps a table into a query; ``lock_rows`` adds the access-lock
    prefix through ``prepareQuery`` (the prefix goes in front of the query
    Spark generates). Partitioned reads need column, bounds and count together.
    """
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table or query")
    opts: dict[str, str] = {"url": url, "fetchsize": str(fetch_size)}
    if where:
        query = f"SELECT * FROM {table} WHERE {where}" if table else f"SELECT * FROM ({query}) q WHERE {where}"
        table = None
    if table is not None:
        opts["dbtable"] = table
    else:
        opts["query"] = query
    parts = [partition_column, lower_bound, upper_bound, num_partitions]
    if any(p is not None for p in parts):
        if any(p is None for p in parts):
            raise ValueError("partition_column, lower_bound, upper_bound and num_partitions go together")
        if query is not None:
            # Spark does not split a `query` option; partitioned reads go through dbtable.
            opts.pop("query")
            opts["dbtable"] = f"({query}) tm_src"
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                    upperBound=str(upper_bound), numPartitions=str(num_partitions))
    if lock_rows:
        opts["prepareQuery"] = ACCESS_LOCK_PREFIX
    if driver:
        opts["driver"] = driver
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def jdbc_scan(spark: SparkSession, url: str, **kwargs) -> DataFrame:
    """A JDBC relation (lazy); see ``jdbc_options``."""
    return spark.read.format("jdbc").options(**jdbc_options(url, **kwargs)).load()


def jdbc_bounds(spark: SparkSession, url: str, table: str, column: str, **kwargs):
    """(min, max) of the split column, read as one tiny row."""
    q = f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}"
    row = jdbc_scan(spark, url, query=q, **kwargs).first()
    return row["lo"], row["hi"]
