"""Typed projections: source-to-text by type code, string-first staging, casts to target.

The column dictionary is per-column metadata (one entry per column), so it is
a small Python list; the data itself never leaves the executors.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Source dictionary type codes and how each is handled.
TEXT_WITH_LENGTH = ("TS", "SZ", "MI", "DH", "DM", "DS", "DY", "HM", "HS", "TZ")
TIME_OF_DAY = ("AT",)
DATE_CODES = ("DA",)
FIXED_TEXT = ("CF", "CO")
NUMERIC = ("D", "N")
STRING_TARGET = ("SZ", "MI", "DH", "DM", "DS", "DY", "HM", "HS", "AT", "TZ", "CV", "CF", "CO", "JN")
INT_TARGET = ("I", "I1", "I2")
LONG_TARGET = ("I8",)
FLOAT_TARGET = ("F",)
TIME_OF_DAY_LENGTH = 32
UNBOUNDED_STRING_LENGTH = 256
STAGING_AS_STRING = ("varchar", "char", "timestamp", "date", "interval")


@dataclass(frozen=True)
class ColumnSpec:
    """One row of the source column dictionary."""
    name: str
    type_code: str
    max_length: int | None = None
    format: str | None = None
    digits: int | None = None
    fraction: int | None = None

    @classmethod
    def from_row(cls, row: Mapping) -> ColumnSpec:
        def num(v):
            return None if v is None or str(v).strip() == "" else int(v)
        return cls(str(row["Column Dictionary Name"]).strip(), str(row["Type"]).strip(), num(row.get("Max Length")),
                   row.get("Format"), num(row.get("Decimal Total Digits")), num(row.get("Decimal Fractional Digits")))


def _fixed_len(fmt: str | None) -> int | None:
    if not fmt:
        return None
    inner = fmt.replace("X(", "").replace(")", "").strip()
    return int(inner) if inner.isdigit() else None


def _text(c: Column, n: int | None) -> Column:
    s = c.cast("string")
    return F.substring(s, 1, n) if n else s


def _bounded_decimal(spec: ColumnSpec) -> bool:
    return spec.digits is not None and spec.fraction is not None and spec.digits >= 0 and spec.fraction >= 0


def source_text_expr(spec: ColumnSpec, target_schema: T.StructType | None = None) -> Column:
    """The select-side expression for one dictionary column."""
    c, code = F.col(spec.name), spec.type_code
    if code in TEXT_WITH_LENGTH:
        out = _text(c, spec.max_length)
    elif code in TIME_OF_DAY:
        out = _text(c, TIME_OF_DAY_LENGTH)
    elif code in DATE_CODES:
        out = c.cast("date").cast("string")
    elif code in FIXED_TEXT:
        out = _text(c, _fixed_len(spec.format))
    elif code in NUMERIC and _bounded_decimal(spec):
        out = c.cast(T.DecimalType(spec.digits, spec.fraction))
    elif code in NUMERIC:
        # Unbounded number: take the type the target declares for the column.
        if target_schema is None:
            raise ValueError(f"column {spec.name}: unbounded number needs the target schema")
        field = _field(target_schema, spec.name)
        dt = field.dataType
        if isinstance(dt, (T.StringType, T.VarcharType, T.CharType)):
            out = _text(c, UNBOUNDED_STRING_LENGTH if isinstance(dt, T.StringType) else None)
        else:
            out = c.cast(dt)
    else:
        out = c
    return out.alias(spec.name)


def source_text_projection(df: DataFrame, dictionary: Sequence[ColumnSpec],
                           target_schema: T.StructType | None = None) -> DataFrame:
    """Project the source by its dictionary: times, dates, chars as text; decimals cast."""
    return df.select(*[source_text_expr(s, target_schema) for s in dictionary])


def target_type(spec: ColumnSpec) -> T.DataType:
    code = spec.type_code
    if code in STRING_TARGET:
        return T.StringType()
    if code in DATE_CODES:
        return T.DateType()
    if code == "TS":
        return T.TimestampNTZType()
    if code in INT_TARGET:
        return T.IntegerType()
    if code in LONG_TARGET:
        return T.LongType()
    if code in NUMERIC:
        return T.DecimalType(spec.digits, spec.fraction) if _bounded_decimal(spec) else T.StringType()
    if code in FLOAT_TARGET:
        return T.DoubleType()
    raise ValueError(f"column {spec.name}: unexpected source type {code!r}")


def target_schema_from_dictionary(dictionary: Sequence[ColumnSpec]) -> T.StructType:
    """The target table schema implied by the source dictionary."""
    return T.StructType([T.StructField(s.name, target_type(s)) for s in dictionary])


def staging_schema(target_schema: T.StructType) -> T.StructType:
    """String-first staging: char/varchar/timestamp/date/interval fields are read as text."""
    def staged(f: T.StructField) -> T.StructField:
        name = f.dataType.simpleString().lower()
        return T.StructField(f.name, T.StringType() if name.startswith(STAGING_AS_STRING) else f.dataType)
    return T.StructType([staged(f) for f in target_schema.fields])


def _field(schema: T.StructType, name: str) -> T.StructField:
    for f in schema.fields:
        if f.name.lower() == name.lower():
            return f
    raise ValueError(f"column {name!r} not found in {schema.simpleString()}")


def _resolve(df: DataFrame, name: str) -> str:
    by_lower = {c.lower(): c for c in df.columns}
    if name.lower() not in by_lower:
        raise ValueError(f"column {name!r} missing from the payload {df.columns}")
    return by_lower[name.lower()]


def typed_projection(df: DataFrame, target_schema: T.StructType) -> DataFrame:
    """``CAST(col AS target type) AS col`` for every target column (names match case-insensitively).

    Spark 4 casts are ANSI: malformed text fails the job; use
    ``split_rejects`` for a bulk load that must keep going.
    """
    return df.select(*[F.col(_resolve(df, f.name)).cast(f.dataType).alias(f.name)
                       for f in target_schema.fields])


def split_rejects(df: DataFrame, target_schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(typed rows, rejected rows): a row is rejected when a non-null value does not cast."""
    casts = {f.name: F.col(_resolve(df, f.name)).try_cast(f.dataType) for f in target_schema.fields}
    bad = F.lit(False)
    for f in target_schema.fields:
        bad = bad | (F.col(_resolve(df, f.name)).isNotNull() & casts[f.name].isNull())
    flagged = df.withColumn("_tm_bad", bad)
    good = flagged.where(~F.col("_tm_bad")).select(*[casts[f.name].alias(f.name) for f in target_schema.fields])
    rejects = flagged.where(F.col("_tm_bad")).drop("_tm_bad")
    return good, rejects


def with_reject_reason(df: DataFrame, target_schema: T.StructType, reason: str = "reject_reason") -> DataFrame:
    """Typed columns of the target, the payload's own text as ``raw`` and why a row is rejected (null: it is not).

    A row is rejected when a non-null value does not cast; the reason names the columns and their types.
    """
    casts = {f.name: F.col(_resolve(df, f.name)).try_cast(f.dataType) for f in target_schema.fields}
    wrong = [F.when(F.col(_resolve(df, f.name)).isNotNull() & casts[f.name].isNull(),
                    F.lit(f"{f.name} is not {f.dataType.simpleString()}")) for f in target_schema.fields]
    raw = F.to_json(F.struct(*[F.col(c) for c in df.columns]))
    text = F.concat_ws("; ", *wrong)
    return df.select(*[casts[f.name].alias(f.name) for f in target_schema.fields],
                     F.when(text != "", raw).alias("raw"), F.when(text != "", text).alias(reason))
