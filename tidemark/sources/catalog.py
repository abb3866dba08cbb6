"""Catalog lookups: target schema, table existence, column dictionary of a relation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.operators.loading import REPLICATION_COLUMN
from tidemark.operators.projection import ColumnSpec


def target_schema(spark: SparkSession, table: str | DataFrame) -> T.StructType:
    """Schema of the target (catalog name or DataFrame) without the replication column."""
    df = spark.table(table) if isinstance(table, str) else table
    return T.StructType([f for f in df.schema.fields if f.name != REPLICATION_COLUMN])


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def dictionary_from_schema(schema: T.StructType) -> list[ColumnSpec]:
    """A source column dictionary derived from a relation's schema (e.g. a JDBC table)."""
    out = []
    for f in schema.fields:
        dt = f.dataType
        if isinstance(dt, (T.StringType, T.VarcharType, T.CharType)):
            out.append(ColumnSpec(f.name, "CV"))
        elif isinstance(dt, T.DateType):
            out.append(ColumnSpec(f.name, "DA", 10))
        elif isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
            out.append(ColumnSpec(f.name, "TS", 26))
        elif isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType)):
            out.append(ColumnSpec(f.name, "I"))
        elif isinstance(dt, T.LongType):
            out.append(ColumnSpec(f.name, "I8"))
        elif isinstance(dt, T.DecimalType):
            out.append(ColumnSpec(f.name, "D", digits=dt.precision, fraction=dt.scale))
        elif isinstance(dt, (T.DoubleType, T.FloatType)):
            out.append(ColumnSpec(f.name, "F"))
        else:
            raise ValueError(f"column {f.name}: no dictionary type for {dt.simpleString()}")
    return out
