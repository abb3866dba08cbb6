"""Rows of Parquet files by place, so that thin results find their texts where these are read.

A row's key is made of the number of its file and its index in the file. It
needs no copy of the table, does not change with the way a scan is split, and
thin tables over keys can be broadcast to the files they speak of, whatever
their number: files are taken in groups whose thin rows have a bounded size. So no text is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tidemark.llm.common import without
from tidemark.sinks.tables import materialize

ROW, FILE, PATH = "__row", "__file", "__path"
BITS = 40  # rows of a file below, files above
BROADCAST_ROWS = 1 << 20  # thin rows of a group of files


def keyed(df: DataFrame) -> DataFrame:
    """``df`` with its rows' keys ``__row``, and ``__file`` and ``__path`` of their files.

    ``df`` should be read straight from files; anything else is written once.
    Input columns of these names are replaced. The numbers of the files are
    broadcast, a row per file, as the driver lists them anyway.
    """
    spark = df.sparkSession
    try:
        df.select("_metadata.row_index").schema
    except AnalysisException:
        df = materialize(df, "rows")
    # sorted: neighbouring files make groups, and the order is that of the names, whatever the listing
    paths = sorted(r["path"] for r in df.select(F.col("_metadata.file_path").alias("path")).distinct().collect())
    numbers = spark.createDataFrame([(p, i) for i, p in enumerate(paths)], f"{PATH} string, {FILE} long")
    plain = [c for c in df.columns if c.lower() not in (ROW, FILE, PATH)]
    placed = df.select(*[F.col(f"`{c.replace('`', '``')}`") for c in plain], F.col("_metadata.file_path").alias(PATH),
                       F.col("_metadata.row_index").alias(ROW))
    return placed.join(F.broadcast(numbers), PATH).withColumn(
        ROW, F.shiftleft(F.col(FILE), BITS).bitwiseOR(F.col(ROW)))


def join_rows(df: DataFrame, thin: DataFrame, how: str, most: int | None = None) -> DataFrame:
    """Joins a keyed table with a thin one over ``__row`` without moving the rows of ``df``.

    ``thin`` should be written (it is counted first) and have a row per key at
    most. It is broadcast in parts: of neighbouring files, as many as have at
    most ``most`` thin rows together (a file with more is a part of its own, so a part is bounded by that
    or by a file's rows).
    """
    most = BROADCAST_ROWS if most is None else most
    file = F.shiftright(ROW, BITS)
    counts = {r["file"]: r["n"] for r in thin.groupBy(file.alias("file")).agg(F.count("*").alias("n")).collect()}
    cuts, held = [], 0  # files at which a new part begins
    for f in sorted(counts):
        if held and held + counts[f] > most:
            cuts.append(f)
            held = 0
        held += counts[f]
    out = None
    for low, high in zip([None, *cuts], [*cuts, None]):
        own, rows = df, thin
        if low is not None:
            own, rows = own.where(F.col(FILE) >= low), rows.where(file >= low)
        if high is not None:
            own, rows = own.where(F.col(FILE) < high), rows.where(file < high)
        part = own.join(F.broadcast(rows), ROW, how)
        out = part if out is None else out.unionByName(part)
    return out


def unkeyed(df: DataFrame) -> DataFrame:
    """``df`` without the columns of the keys."""
    return without(df, [ROW, FILE, PATH])
