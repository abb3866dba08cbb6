"""Writes: published table versions, appends, partition replacement, staged exports.

A load never overwrites the folder it reads from: every new table state goes
to a new folder below the shared work folder, so a lost executor or a retried
job re-runs into a clean place and readers of the old version are not broken.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import reduce
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from tidemark.session import work_path

# Staged export format of the reference (snappy Parquet, 16 MB objects).
STAGE_COMPRESSION = "snappy"
STAGE_OBJECT_BYTES = 16 * 1024 * 1024
# A large export is dealt in so many parts, of so many files at least; a task buffers so much of each while it parts rows.
EXPORT_PARTS, PART_FILES = 8, 16
PART_BUFFER_BYTES = 4 * 1024 * 1024


def publish(df: DataFrame, path: str | None = None, *, partition_by: list[str] | None = None,
            name: str = "tables") -> str:
    """Write ``df`` as a new table version (Parquet) and return its path."""
    path = path or work_path(df.sparkSession, name)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def point_view(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Point a session view at a published version (readers switch in one step)."""
    df = spark.read.parquet(path)
    df.createOrReplaceTempView(name)
    return df


def materialize(df: DataFrame, name: str = "materialized") -> DataFrame:
    """Write ``df`` once to a new folder under the shared work folder and read it back.

    Cuts lineage like a reliable checkpoint, but computes the input only once
    (``checkpoint(eager=True)`` on an unpersisted plan computes it twice: once
    for the eager count, once to write the files). Every later use reads the
    same rows, and a lost executor re-reads files instead of recomputing.
    """
    path = work_path(df.sparkSession, name)
    for made in _WATCHED.get():
        made.append(path)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


_WATCHED: ContextVar[tuple[list[str], ...]] = ContextVar("watched", default=())


@contextmanager
def intermediates() -> Iterator[list[str]]:
    """Lists the folders that ``materialize`` makes inside the block, so that ``discard`` can delete them
    once a result that was computed from them is written."""
    made: list[str] = []
    token = _WATCHED.set((*_WATCHED.get(), made))
    try:
        yield made
    finally:
        _WATCHED.reset(token)


def discard(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete folders, wherever Spark keeps them; a missing one is fine."""
    jvm = spark._jvm
    for path in paths:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def publish_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int, path: str | None = None) -> str:
    """Publish a table version bucketed (and sorted) by its primary key.

    Later merges into it join on the key without shuffling the target: only
    the payload's keys are hash-partitioned into the same buckets. The files go
    to ``path`` (default: a new folder in the shared work folder), the name to
    the session catalog.
    """
    path = path or work_path(df.sparkSession, "bucketed")
    (df.repartition(buckets, *keys)  # a bucket is one task's, so it is one file
       .write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table))
    return table


def append(df: DataFrame, path: str, *, expect_schema: StructType | None = None) -> str:
    """Bulk append (forced reload, no schema merge): the payload schema must equal the table's."""
    if expect_schema is not None and _shape(df.schema) != _shape(expect_schema):
        raise ValueError(f"payload schema {df.schema.simpleString()} does not match the table "
                         f"{expect_schema.simpleString()}")
    df.write.mode("append").parquet(path)
    return path


def _shape(schema: StructType) -> list[tuple[str, str]]:
    return [(f.name.lower(), f.dataType.simpleString()) for f in schema.fields]


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table at ``path``, or an empty table of ``schema`` when none exists yet
    (a missing queue has length 0, an absent history has no rows)."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if not path_missing(e):
            raise
        return spark.createDataFrame([], schema)


def path_missing(e: AnalysisException) -> bool:
    """Whether a read failed because nothing is at its path (anything else there is an error)."""
    return e.getCondition() == "PATH_NOT_FOUND"


def create_if_absent(spark: SparkSession, path: str, schema: StructType) -> bool:
    """Create an empty control table (queue, history) unless one exists; True when created.

    Parquet has no primary-key constraint: uniqueness is checked by a query
    (``queue_key_check``).
    """
    try:
        spark.read.parquet(path).schema
        return False
    except AnalysisException as e:
        if not path_missing(e):
            raise
        spark.createDataFrame([], schema).write.mode("errorifexists").parquet(path)
        return True


def replace_partitions(df: DataFrame, path: str, partition_by: list[str]) -> str:
    """Overwrite only the partitions present in ``df`` (dynamic partition overwrite)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_by).parquet(path))
    return path


def truncate(spark: SparkSession, path: str, like: DataFrame) -> str:
    """Replace the table at ``path`` with an empty table of the same schema."""
    spark.createDataFrame([], like.schema).write.mode("overwrite").parquet(path)
    return path


def truncate_load(spark: SparkSession, path: str, payload: DataFrame) -> str:
    """Empty the table at ``path`` and load ``payload``, as one overwrite of a staged copy.

    The payload is written to the work folder before the table is touched, so
    a load that fails for its payload leaves the table alone, and one that fails
    later can be repeated from the copy.
    """
    staged = materialize(payload, "truncate_load")
    staged.write.mode("overwrite").parquet(path)
    return path


def rows_per_file(row_bytes: float, object_bytes: int = STAGE_OBJECT_BYTES) -> int:
    """Rows per export file so that files stay near the object size."""
    return max(1, int(object_bytes // max(1, row_bytes)))


def measured_row_bytes(df: DataFrame, probe_rows: int = 50_000) -> tuple[float, int]:
    """Bytes a row takes in an export, and the rows measured: a first part of at most ``probe_rows``
    rows, written in the same format to the work folder."""
    spark = df.sparkSession
    probe = work_path(spark, "stage_probe")
    seen = Observation("tm_probe")
    (df.limit(probe_rows).observe(seen, F.count(F.lit(1)).alias("rows")).coalesce(1).write.mode("overwrite")
       .option("compression", STAGE_COMPRESSION).parquet(probe))
    rows = int(seen.get["rows"])
    width = sum(folder_bytes(spark, probe)) / max(1, rows)
    discard(spark, [probe])
    return width, rows


def export_stage(df: DataFrame, path: str | None = None, *, max_records_per_file: int | None = None,
                 row_bytes: float | None = None) -> tuple[str, int]:
    """Export to snappy Parquet with bounded files; returns (path, rows written).

    Without a bound in rows it follows from the object size and the bytes a row
    takes, which are measured on a first part unless given. The row count comes
    from an ``Observation`` on the write itself.
    """
    path = path or work_path(df.sparkSession, "stage")
    obs = Observation("tm_export")
    n = max_records_per_file or rows_per_file(row_bytes or measured_row_bytes(df)[0])
    (df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
       .option("compression", STAGE_COMPRESSION).option("maxRecordsPerFile", n).parquet(path))
    return path, int(obs.get["rows"])


def stage_file_counts(spark: SparkSession, path: str) -> DataFrame:
    """Record count per exported file (file_path, records)."""
    return (spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file_path"))
            .agg(F.count(F.lit(1)).alias("records")))


def replace_where_in_place(spark: SparkSession, path: str, payload: DataFrame, where: str,
                           partition_by: list[str]) -> str:
    """Delete-by-predicate + append on a partitioned table, rewriting only touched partitions.

    Touched partitions are those holding a target row or a payload row that
    matches the predicate (one small distinct list). Their next content (target
    rows kept by ``coalesce(p, false) = false`` plus matching payload rows) is
    first written to the shared work folder, which cuts the lineage to the
    files about to be replaced, then swapped in by dynamic partition overwrite.
    Untouched partitions are neither read back nor rewritten. A dynamic overwrite
    writes no files to a partition that the load leaves empty, so the folders of
    those are deleted after the swap. A null partition value is a partition like
    any other.
    """
    p = F.expr(where)
    target = spark.read.parquet(path)
    fresh = materialize(payload.where(p).select(*target.columns), "payload")  # one snapshot of the payload
    touched = materialize(target.where(F.coalesce(p, F.lit(False))).select(*partition_by)
                          .unionByName(fresh.select(*partition_by)).distinct(), "touched")
    kept = _partitions(target, touched, partition_by, "left_semi").where(~F.coalesce(p, F.lit(False)))
    staged = materialize(kept.unionByName(fresh), "replace_where")
    emptied = _partitions(touched, staged.select(*partition_by).distinct(), partition_by, "left_anti")
    folders = (_partitions(target.select(*partition_by, F.col("_metadata.file_path").alias("_tm_file")), emptied,
                           partition_by, "left_semi")
               .select(F.regexp_replace("_tm_file", "/[^/]*$", "").alias("folder")).distinct().collect())
    replace_partitions(staged.select(*target.columns), path, partition_by)
    jvm = spark._jvm
    for r in folders:  # one folder per emptied partition
        folder = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(r["folder"]))
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return path


def _partitions(df: DataFrame, touched: DataFrame, partition_by: list[str], how: str) -> DataFrame:
    """Semi or anti join on the partition columns, where null equals null."""
    other = touched.select(*[F.col(c).alias(f"_tm_p_{c}") for c in partition_by])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_tm_p_{c}")) for c in partition_by])
    return df.join(other, same, how)


def merge_in_place(spark: SparkSession, path: str, payload: DataFrame, primary_key, partition_by: list[str],
                   check_moves: bool = True) -> str:
    """Primary-key MERGE into a partitioned table, rewriting only the partitions the payload touches.

    Only target partitions holding a payload row are read (a semi join on the
    partition columns, which Spark prunes dynamically), merged, staged in the
    shared work folder and swapped in by dynamic partition overwrite. This
    needs every key to stay in its partition; ``check_moves`` verifies that no
    payload key exists in an untouched partition by reading key and partition
    columns only, and refuses the load otherwise (use ``merge_pk`` + ``publish``).
    """
    from tidemark.operators.loading import duplicate_keys, key_columns, merge_pk, payload_schema

    keys = key_columns(primary_key)
    target = spark.read.parquet(path)
    payload = materialize(payload.select(*payload_schema(target).fieldNames()), "payload")  # one snapshot for every use below
    if not duplicate_keys(payload, keys).isEmpty():
        raise ValueError(f"payload has duplicate keys for {keys}")
    touched = payload.select(*partition_by).distinct()
    if check_moves:
        elsewhere = (_partitions(target.select(*keys, *partition_by), touched, partition_by, "left_anti")
                     .join(payload.select(*keys), keys, "left_semi"))
        if not elsewhere.isEmpty():
            raise ValueError("payload keys exist in partitions the payload does not touch")
    current = _partitions(target, touched, partition_by, "left_semi")
    staged = materialize(merge_pk(current, payload, keys), "merge")
    return replace_partitions(staged.select(*target.columns), path, partition_by)


def merge_touched_files(spark: SparkSession, path: str, payload: DataFrame, primary_key,
                        partition_by: list[str] | None = None) -> list[str]:
    """Primary-key MERGE that rewrites only the files holding a payload key; returns those.

    The files are found from key columns alone (a semi join with the payload's
    keys, on which Spark may place a runtime filter). Their next content and the
    new keys are written to new files beside them, and the old ones are deleted after that. All other files keep
    their names and times. A key that moved to another partition is merged like any other, as all files with it are
    rewritten. The content is staged first, so the lineage does not
    end in files about to go. A job that dies between the two steps leaves old and new files:
    the rows of the old ones are then there twice, and merging again does not remove those without payload.
    """
    from tidemark.operators.loading import duplicate_keys, key_columns, merge_pk, payload_schema

    keys = key_columns(primary_key)
    target = spark.read.parquet(path)
    payload = materialize(payload.select(*payload_schema(target).fieldNames()), "payload")
    if not duplicate_keys(payload, keys).isEmpty():
        raise ValueError(f"payload has duplicate keys for {keys}")
    found = (target.select(*keys, F.col("_metadata.file_path").alias("_tm_file"))
             .join(payload.select(*keys), keys, "left_semi").select("_tm_file").distinct().collect())
    touched = sorted(r["_tm_file"] for r in found)  # a name per rewritten file
    current = spark.read.schema(target.schema).option("basePath", path).parquet(*touched) if touched else target.limit(0)
    staged = materialize(merge_pk(current, payload, keys), "merge").select(*target.columns)
    writer = staged.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    jvm = spark._jvm
    for name in touched:
        file = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        file.getFileSystem(spark._jsc.hadoopConfiguration()).delete(file, False)
    return touched


def folder_bytes(spark: SparkSession, path: str, suffix: str = ".parquet") -> list[int]:
    """Sizes of the data files directly in a folder."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    return [f.getLen() for f in files if f.isFile() and f.getPath().getName().endswith(suffix)]


def export_sized(df: DataFrame, path: str | None = None, *, target_bytes: int = STAGE_OBJECT_BYTES,
                 probe_rows: int = 50_000) -> tuple[str, int, float]:
    """Export to snappy Parquet files near a size in bytes; returns (path, rows, bytes a row).

    Bytes a row are measured (``measured_row_bytes``) on dealt rows, as rows in the input's order may
    compress far better than the files' rows. The rows are then dealt
    evenly to as many files as the target asks for, so no file depends on how
    the input happened to be split. The rows written come from an ``Observation``.

    Rows on their way to a file are on disk twice more, sorted and shuffled. So a large export is dealt in
    parts, one after another, and beside its files the disk holds an eighth of that, and a packed copy of the
    rows still to come.
    """
    spark = df.sparkSession
    path = path or work_path(spark, "stage")
    width, rows = measured_row_bytes(df.limit(probe_rows).repartition(2), probe_rows)
    total = rows if rows < probe_rows else df.count()
    files = max(1, round(total * width / target_bytes))
    parts = min(EXPORT_PARTS, files // PART_FILES)
    if parts < 2:
        return path, _deal(df, path, files), width
    if _reads(df, path):  # Spark sees that where the rows are not written twice
        raise AnalysisException(f"cannot overwrite {path}, which the exported rows are read from")
    discard(spark, [path])  # an overwrite's first step, taken before the rows are copied
    staged, column = work_path(spark, "stage_parts"), f"_tm_part_{uuid.uuid4().hex}"  # no column of any table
    shares = Counter(place * parts // files for place in range(files))  # files of each part
    written = 0
    try:
        _write_parts(df, staged, column, files, parts)
        for part, share in sorted(shares.items()):
            folder = f"{staged}/{column}={part}"
            written += _deal(read_or_empty(spark, folder, df.schema), path, share, "append" if part else "overwrite",
                             last=part == parts - 1)
            discard(spark, [folder])
    finally:
        discard(spark, [staged])
    return path, written, width


def _deal(df: DataFrame, path: str, files: int, mode: str = "overwrite", last: bool = True) -> int:
    """Write rows dealt evenly to ``files`` files, and the mark of a finished export if this is the last of it; returns the rows."""
    obs = Observation("tm_export_sized")
    unmarked = {} if last else {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}
    # shuffle files go once the rows are written, else they stay until the driver collects garbage
    with _settings(df.sparkSession, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        (df.repartition(files).observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode)
           .option("compression", STAGE_COMPRESSION).options(**unmarked).parquet(path))
    return int(obs.get["rows"])


def _reads(df: DataFrame, path: str) -> bool:
    """Whether files below ``path`` are read for ``df``."""
    folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path).toUri().getPath()
    return any(unquote(urlsplit(f).path).startswith(f"{folder}/") for f in df.inputFiles())


def _write_parts(df: DataFrame, path: str, column: str, files: int, parts: int) -> None:
    """Write rows once, where they are read, in folders ``column`` = 0 to ``parts`` - 1: of as many neighbours as there
    are ``files``, each part takes its files' share. Tasks write all parts side by side, so they sort nothing."""
    place = f"pmod(monotonically_increasing_id() + hash(spark_partition_id()), {files})"
    with _settings(df.sparkSession, {"spark.sql.maxConcurrentOutputFileWriters": str(parts + 1)}):  # at that many they sort
        (df.withColumn(column, F.expr(f"{place} * {parts} div {files}")).write.mode("overwrite").partitionBy(column)
           .option("compression", "zstd").option("parquet.compression.codec.zstd.level", 1)
           .option("parquet.block.size", PART_BUFFER_BYTES).option("parquet.enable.dictionary", "false").parquet(path))


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Writes inside run with these settings; the session's own come back after."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def write_split(flagged: DataFrame, reason: str, path: str | None = None) -> tuple[str, int, int]:
    """One write of accepted and rejected rows, by whether column ``reason`` is null; returns (path, accepted, rejected).

    Both counts come from one ``Observation`` of that write. Read the parts with ``read_split``.
    """
    path = path or work_path(flagged.sparkSession, "split")
    bad = F.col(reason).isNotNull()
    obs = Observation("tm_split")
    (flagged.withColumn("_tm_rejected", bad)
        .observe(obs, F.count(F.when(~bad, 1)).alias("accepted"), F.count(F.when(bad, 1)).alias("rejected"))
        .write.mode("overwrite").partitionBy("_tm_rejected").parquet(path))
    return path, int(obs.get["accepted"]), int(obs.get["rejected"])


def read_split(spark: SparkSession, path: str, schema: StructType, rejected: bool) -> DataFrame:
    """The accepted or rejected rows of ``write_split`` (a part without rows has no folder: empty)."""
    return read_or_empty(spark, f"{path}/_tm_rejected={str(rejected).lower()}", schema)
