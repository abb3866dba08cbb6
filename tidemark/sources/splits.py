"""Read splits of equal depth: disjoint predicates that share out a table's rows.

A split column is seldom uniform, so equal ranges of its values make unequal
reads. Here the bounds are quantiles from a mergeable sketch (one pass, a small
summary per task), values that alone fill a split get one of their own, and
nulls another. The predicates are text for a source's own SQL, such as the
``predicates`` of a JDBC read, and each row satisfies exactly one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ACCURACY = 10_000  # of the quantile sketch: a rank is off by at most one in so many


@dataclass(frozen=True)
class Split:
    number: int
    predicate: str


def _quoted(value) -> str:
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return repr(value)
    return "'" + str(value).replace("'", "''") + "'"


def read_splits(df: DataFrame, column: str, splits: int) -> list[Split]:
    """Disjoint predicates over ``column`` that together cover every row of ``df``.

    Ranges hold about one in ``splits`` of the rows. A value met at two
    neighbouring quantiles fills a range alone and is read by an equality.
    Nulls have a split if there are any; a table without rows has one split. The
    column must be a number, a date or a time, as the sketch takes no other.
    """
    if splits < 1:
        raise ValueError("splits must be positive")
    if not isinstance(df.schema[column].dataType, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        raise ValueError(f"{column} is not a number, a date or a time")
    c = F.col(column)
    at = [i / splits for i in range(1, splits)]
    row = df.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(c.isNull(), 1)).alias("nulls"),
                 (F.percentile_approx(c, at, ACCURACY) if at else F.lit(None)).alias("cuts")).first()
    cuts = [v for v in row["cuts"] or [] if v is not None]
    heavy = [v for v in sorted(set(cuts)) if cuts.count(v) > 1]
    bounds = sorted(set(cuts))
    out: list[str] = []
    # a cut is the last value of its range, as a quantile is a value that is reached
    low = None
    for b in bounds:
        above = "" if low is None else f"{column} > {_quoted(low)}"
        if b in heavy:
            below = f"{column} < {_quoted(b)}"
            out += [" AND ".join(x for x in (above, below) if x), f"{column} = {_quoted(b)}"]
        else:
            out.append(" AND ".join(x for x in (above, f"{column} <= {_quoted(b)}") if x))
        low = b
    out.append(f"{column} IS NOT NULL" if low is None else f"{column} > {_quoted(low)}")
    if row["nulls"]:
        out.append(f"{column} IS NULL")
    return [Split(i, p) for i, p in enumerate(out)]


def split_number(splits: list[Split]) -> Column:
    """The number of the split that a row belongs to."""
    number = F.lit(None).cast("int")
    for s in reversed(splits):
        number = F.when(F.coalesce(F.expr(s.predicate), F.lit(False)), F.lit(s.number)).otherwise(number)
    return number


def split_counts(df: DataFrame, splits: list[Split]) -> DataFrame:
    """``(split, predicate, rows, satisfied)``: the rows of each split, and how many predicates they satisfy together.

    One pass; ``satisfied`` equals ``rows`` if no row belongs to two splits.
    """
    names = df.sparkSession.createDataFrame([(s.number, s.predicate) for s in splits], "split int, predicate string")
    hits = F.lit(0)
    for s in splits:
        hits = hits + F.when(F.coalesce(F.expr(s.predicate), F.lit(False)), 1).otherwise(0)
    counts = (df.select(split_number(splits).alias("split"), hits.alias("hits")).groupBy("split")
              .agg(F.count(F.lit(1)).alias("rows"), F.sum("hits").alias("satisfied")))
    return names.join(counts, "split", "left").na.fill(0, ["rows", "satisfied"])
