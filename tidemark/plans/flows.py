"""One table load, end to end: extract -> (stage) -> load rewrite -> publish -> report.

Direct flow: the payload is the source relation filtered by the planned
predicate (pushed into the scan), written once as a snapshot so every later
step sees the same rows of the live source, then loaded.
Staged flow: the payload is first exported as text Parquet (bounded files),
read back with the string-first schema, then loaded; without a predicate the
target is truncated first, so a keyed load becomes a plain insert.
A primary key wins over a predicate in both flows (merge, nothing deleted).

The driver only orchestrates: every step is a distributed Spark job, and the
result is a new table version folder plus a one-row report.
"""

from __future__ import annotations

import datetime as dt
import time
import traceback
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.timeexpr import from_epoch
from tidemark.operators import loading, projection
from tidemark.operators.planning import extract_where
from tidemark.operators.reconcile import count_reconcile
from tidemark.schemas import FAILED, REPORT, STAGED, SUCCESS
from tidemark.session import work_path
from tidemark.sinks import tables
from tidemark.sources.catalog import dictionary_from_schema, table_exists
from tidemark.sources.staged import staged_scan


@dataclass(frozen=True)
class LoadPlan:
    """One table's load. ``full``: empty the target first (True), never (False), or as
    the flow does by default (None: staged loads without a predicate do, direct
    loads do not, so rows deleted at the source survive a direct keyed load)."""
    source_table: str
    strategy: str
    where_clause: str = ""
    primary_key: str = ""
    full: bool | None = None
    target_table: str = ""

    @property
    def truncate_first(self) -> bool:
        if self.full is not None:
            return self.full
        return self.strategy == STAGED and not self.where_clause

    @property
    def stage_parts(self) -> list[str]:
        """Where a staged export goes below the work folder, before the id of the run: the target's catalog and the source."""
        catalog = self.target_table.split(".")[0] if self.target_table else "tables"
        return ["stage", catalog, "__".join(self.source_table.split("."))]

    @property
    def mode(self) -> str:
        if self.primary_key:
            return "merge"
        return "replace_where" if self.where_clause else "overwrite"


@dataclass
class LoadResult:
    path: str | None
    report: DataFrame
    check: DataFrame | None = None
    status: str = SUCCESS
    error: str = ""
    num_records: int = 0
    start: float = 0.0  # epoch seconds
    end: float = 0.0
    rejects: DataFrame | None = None  # rows that did not cast, as ``raw`` text with their ``reject_reason``
    rejected: int = 0


def _payload(spark: SparkSession, source: DataFrame, target: DataFrame, plan: LoadPlan,
             dictionary=None, max_records_per_file: int | None = None) -> tuple[DataFrame, int | None]:
    # a load that empties the target first must bring all of the source
    extracted = extract_where(source, "" if plan.truncate_first else plan.where_clause)
    if plan.strategy != STAGED:
        # One snapshot of the live source: the key check, the anti join, the
        # append and the count must all see the same rows.
        snap = tables.materialize(extracted, "extract")
        return snap, None
    text = projection.source_text_projection(extracted, dictionary or dictionary_from_schema(extracted.schema),
                                             target.schema)
    path, written = tables.export_stage(text, work_path(spark, *plan.stage_parts), max_records_per_file=max_records_per_file)
    return staged_scan(spark, path, target.schema), written


def run_load(spark: SparkSession, source: DataFrame, target: DataFrame, plan: LoadPlan, *,
             dictionary=None, max_records_per_file: int | None = None, validate: bool = False,
             check_keys: bool = True, bucket: tuple[str, int] | None = None, keep_rejects: bool = False) -> LoadResult:
    """Load one table and publish the next target version; never raises for load errors.

    ``keep_rejects``: rows with values that do not cast to the target's types are
    written beside the good ones, with reasons and in the same write, instead
    of failing the load; the report counts the good ones.

    ``bucket=(name, buckets)`` publishes a keyed target bucketed by its primary
    key, so the next merge does not shuffle it. Every version is a table of its
    own; the session view ``name`` points at the last one.
    """
    start = time.time()
    status, error, path, n, check = SUCCESS, "", None, 0, None
    rejects, rejected = None, 0
    try:
        if keep_rejects:
            payload, rejects, written, rejected = _split_payload(spark, source, target, plan, dictionary, max_records_per_file)
        else:
            payload, written = _payload(spark, source, target, plan, dictionary, max_records_per_file)
        mode = plan.mode
        base = target
        if plan.truncate_first:
            base = target.limit(0)  # truncate first
            mode = "merge" if plan.primary_key else "overwrite"
        if mode == "merge" and check_keys and not loading.duplicate_keys(payload, plan.primary_key).isEmpty():
            raise ValueError(f"payload of {plan.source_table} has duplicate keys for {plan.primary_key}")
        nxt = loading.apply_load(mode, base, payload, {"where_clause": plan.where_clause,
                                                       "primary_key": plan.primary_key})
        if bucket and plan.primary_key:
            path = tables.work_path(spark, "loads")
            version = f"{bucket[0]}_{uuid.uuid4().hex[:12]}"
            tables.publish_bucketed(nxt, version, loading.key_columns(plan.primary_key), bucket[1], path)
            after = spark.table(version)
            after.createOrReplaceTempView(bucket[0])
        else:
            path = tables.publish(nxt, name="loads")
            after = spark.read.parquet(path)
        n = written if written is not None else payload.count()
        if validate:
            check = count_reconcile(mode, payload, base, after, where=plan.where_clause or None,
                                    primary_key=plan.primary_key or None)
    except Exception as e:  # noqa: BLE001 - a failed load is reported, not raised
        status, error = FAILED, f"{type(e).__name__}: {e}"
        traceback.print_exc()
    end = time.time()
    report = spark.createDataFrame([(plan.source_table, plan.strategy.lower(), status, None, None, int(n), error)],
                                   REPORT)
    report = report.withColumn("start", from_epoch(F.lit(int(start)))).withColumn("end", from_epoch(F.lit(int(end))))
    return LoadResult(path, report, check, status, error, int(n), start, end, rejects, rejected)


def _split_payload(spark: SparkSession, source: DataFrame, target: DataFrame, plan: LoadPlan, dictionary,
                   max_records_per_file: int | None) -> tuple[DataFrame, DataFrame, int, int]:
    """The payload's good rows, its rejects, and both counts, from one write."""
    schema = loading.payload_schema(target)
    raw = extract_where(source, "" if plan.truncate_first else plan.where_clause)
    if plan.strategy == STAGED:
        text = projection.source_text_projection(raw, dictionary or dictionary_from_schema(raw.schema), target.schema)
        path, _ = tables.export_stage(text, work_path(spark, *plan.stage_parts), max_records_per_file=max_records_per_file)
        raw = spark.read.schema(projection.staging_schema(schema)).parquet(path)
    flagged = projection.with_reject_reason(raw, schema)
    path, good, bad = tables.write_split(flagged, "reject_reason")
    accepted = tables.read_split(spark, path, flagged.schema, False).select(*schema.fieldNames())
    rejects = tables.read_split(spark, path, flagged.schema, True).select("raw", "reject_reason")
    return accepted, rejects, good, bad


# ---------------------------------------------------------------- claimed rows
COMPLETION = ("source_table string, event_time timestamp_ntz, status string, finish_time timestamp_ntz, "
              "duration_min double, num_records bigint, error string")
Resolve = Callable[[str, str], tuple[DataFrame, DataFrame]]


def load_claim(spark: SparkSession, claim, resolve: Resolve, **options) -> LoadResult:
    """Load the table of one claim row. ``resolve(source_table, target_table)`` gives source and target.

    Never raises: a claim whose tables cannot even be found is a failed load with its error and its times.
    """
    start = time.time()
    try:
        source, target = resolve(claim["source_table"], claim["target_table"])
        plan = LoadPlan(claim["source_table"], claim["strategy"], claim["where_clause"] or "", claim["primary_key"] or "",
                        target_table=claim["target_table"] or "")
    except Exception as e:  # noqa: BLE001 - reported as the claim's outcome
        return LoadResult(None, spark.createDataFrame([], REPORT), None, FAILED, f"{type(e).__name__}: {e}", 0, start, time.time())
    return run_load(spark, source, target, plan, **options)


def catalog_resolve(spark: SparkSession, source: Callable[[str], DataFrame]) -> Resolve:
    """Targets by their name in the catalog; a target that does not exist is an error of its claim."""
    def resolve(source_table: str, target_table: str) -> tuple[DataFrame, DataFrame]:
        if not table_exists(spark, target_table):
            raise LookupError(f"target {target_table} does not exist")
        return source(source_table), spark.table(target_table)

    return resolve


def load_claims(spark: SparkSession, claims: DataFrame, resolve: Resolve, *, threads: int = 4,
                **options) -> tuple[DataFrame, dict[str, LoadResult]]:
    """Load all claimed tables and return their completions, and the results by source table.

    Claims are bounded by the worker slots; each load is a distributed job of
    its own, and ``threads`` of them run at a time, as workers would.
    """
    rows = claims.collect()  # at most as many as there are slots
    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        results = list(pool.map(lambda r: load_claim(spark, r, resolve, **options), rows))
    done = [(r["source_table"], r["event_time"], x.status, _instant(x.end), round((x.end - x.start) / 60, 2),
             x.num_records, x.error) for r, x in zip(rows, results)]
    return spark.createDataFrame(done, COMPLETION), {r["source_table"]: x for r, x in zip(rows, results)}


def _instant(epoch: float) -> dt.datetime:
    return dt.datetime.fromtimestamp(int(epoch), dt.timezone.utc).replace(tzinfo=None)
