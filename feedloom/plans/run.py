"""Running feeds: load, audit row, run status."""

from __future__ import annotations

import logging
import threading
import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from datetime import UTC, datetime
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.audit import LOG_SCHEMA, RUN_SCHEMA, classify_errors, run_events
from feedloom.operators.checks import LAYERS, validate_config
from feedloom.operators.metadata import due_pipelines, status_content, status_name
from feedloom.operators.project import target_schema
from feedloom.operators.rules import COLUMN_RULES, apply_rules
from feedloom.operators.watermark import high_water_mark
from feedloom.plans.config import feeds_from_config
from feedloom.plans.feed import latest_rows, mark_goes_first, source_rows
from feedloom.plans.load import LoadResult, create_table, load, staging_copy
from feedloom.sources.scan import FILE_KINDS, TABLE_KINDS, WORKBOOK_KINDS
from feedloom.specs import FeedSpec, LoadSpec, SourceSpec

log = logging.getLogger(__name__)

# Status ids and names of a run.
PIPELINE_SUCCESS_ID, RUN_SUCCESS_ID, RUN_FAILURE_ID = 1, 3, 4
PIPELINE_FAILURE = "PIPELINE_FAILURE"
PIPELINE_FAILURE_ID = 2


def run_feed(
    spark: SparkSession, spec: FeedSpec, root: str, staging_folder: str | None = None
) -> tuple[LoadResult, int]:
    """Load one feed; returns the load's counts and the number of source rows.

    Source rows are counted while they are loaded. Only where a high-water mark can
    be pushed down to a columnar scan, or a query may leave the source's rows unread,
    is the count a job of its own. With ``staging_folder`` the rows before the rules
    are kept there, and the load goes on from that copy.
    """
    if spec.layer not in LAYERS:
        raise ValueError(f"pipeline {spec.feed_id} has a layer that is not known: {spec.layer}")
    rows = source_rows(spark, spec)
    target, mark = spec.load, None
    early = mark_goes_first(spec) and target.mode.strip().lower() in ("append", "incremental")
    if early and spark.catalog.tableExists(target.target):
        kind = next(f.dataType for f in rows.schema.fields if f.name.lower() == target.watermark.lower())
        mark = high_water_mark(spark.table(target.target), target.watermark, kind)
    columnar = spec.source.kind.strip().lower() in TABLE_KINDS
    seen, source_count = None, 0
    queries = any(r.op == "sql_update" for r in spec.rules)
    if queries or target.custom_query() or (mark is not None and columnar):
        source_count = rows.count()
    else:
        seen = Observation()
        rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
    latest = latest_rows(rows, spec, mark)
    if staging_folder:
        latest = staging_copy(spark, latest, staging_folder, target.target)
    shaped = apply_rules(latest, spec.rules, spec.strict_rules)
    keys = {k.lower() for k in spec.keys}
    unique = bool(keys) and all(
        r.op in COLUMN_RULES and r.output.lower() not in keys for r in spec.rules
    )
    if mark is not None:
        target = replace(target, watermark=None)
    schema = shaped.schema if spec.rules else target_schema(spec.mappings, spec.legacy_types)
    result = load(spark, target, shaped, root, schema, unique)
    return result, source_count if seen is None else seen.get["rows"]


def append_rows(spark: SparkSession, rows: DataFrame, table: str, root: str) -> None:
    """Append to an audit table, creating it when it is missing."""
    if not spark.catalog.tableExists(table):
        create_table(spark, LoadSpec("append", table), rows.schema, root)
    rows.write.insertInto(table)


def update_rows(
    spark: SparkSession, rows: DataFrame, table: str, keys: tuple[str, ...], root: str
) -> LoadResult:
    """Update the rows of a table by unique keys; columns not given keep their values."""
    return load(spark, LoadSpec("incremental", table, keys), rows, root, unique=True)


def log_row(run_id: str, feed_id: str, layer: str, started: datetime, **values: Any) -> tuple:
    """One audit row of a pipeline attempt, in the order of the log table."""
    ended = datetime.now(UTC)
    failed = values.get("error") is not None
    return (
        str(uuid.uuid4()), feed_id, started, ended, values["status"], values["status_id"], run_id,
        None, None, None, None, values.get("error"), "ERROR" if failed else None,
        ended if failed else None, values.get("source", 0), values.get("after", 0),
        values.get("inserted", 0), values.get("updated", 0), values.get("deleted", 0), 1,
        values.get("trigger", "SCHEDULED"), ended, layer,
    )


def archive_files(spark: SparkSession, spec: FeedSpec) -> int:
    """Move a loaded file, or the files of a loaded folder, below the feed's archive path.

    The names stay; a file of that name in the archive is replaced. Only file sources
    have something to move. Returns the number of files and folders moved.
    """
    if not spec.archive_path or spec.source.kind.strip().lower() not in (*FILE_KINDS, *WORKBOOK_KINDS):
        return 0
    make = spark._jvm.org.apache.hadoop.fs.Path
    source, kept = make(spec.source.path), make(spec.archive_path)
    files = source.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(source):
        return 0
    # A single file is moved; of a folder what is in it, so that the folder can be filled again.
    found = files.listStatus(source)
    files.mkdirs(kept)
    moved = 0
    for i in range(len(found)):
        path = found[i].getPath()
        if path.getName().startswith(("_", ".")):
            continue
        goal = make(kept, path.getName())
        if files.exists(goal):
            files.delete(goal, True)
        if not files.rename(path, goal):
            raise OSError(f"{path} was not moved to {goal}")
        moved += 1
    return moved


def run_due(
    spark: SparkSession,
    config: Mapping[str, DataFrame],
    root: str,
    now: datetime,
    connections: Mapping[str, Mapping[str, Any]] | None = None,
    log_table: str = "LOG",
    run_table: str = "MASTERLOG",
    event_table: str | None = None,
    event_settings: Mapping[str, str] | None = None,
    parallel: int = 4,
) -> str | None:
    """Run every due pipeline once and write the audit tables.

    Returns the run id, or None when nothing is due. Up to ``parallel`` feeds run at
    a time; those of one target run one after another, in order of their id. The log
    rows of a pipeline are written as soon as it ends. A pipeline that fails is logged and
    the others go on; retrying belongs to whatever starts the run. The run table only
    grows: a run has a row when it opens and one when it closes, and
    ``latest_rows(runs, "MASTERLOGID", "ENDDATETIME")`` is its state. With
    ``event_table`` each pipeline's event document is appended there.
    """
    ids = due_pipelines(config["PIPELINE"], config["CRON"], now).select("PIPELINEID").distinct()
    due = [r[0] for r in ids.orderBy("PIPELINEID").collect()]
    if not due:
        return None
    status = config["STATUSMESSAGE"]
    run_id, started = str(uuid.uuid4()), datetime.now(UTC)
    findings: dict[str, list[str]] = {}
    for finding in validate_config(config, ids).orderBy("pipeline_id", "message").collect():
        findings.setdefault(finding["pipeline_id"], []).append(finding["message"])
    success = status_name(status, PIPELINE_SUCCESS_ID)

    opening = (run_id, f"run_{run_id}", started, None, None, None, len(due))
    append_rows(spark, spark.createDataFrame([opening], RUN_SCHEMA), run_table, root)
    feeds = feeds_from_config(config, [i for i in due if str(i) not in findings], connections)
    by_target: dict[str, list[Any]] = {}
    for feed_id in due:
        spec = feeds.get(str(feed_id))
        goal = spec.load.target.lower() if isinstance(spec, FeedSpec) else f"\0{feed_id}"
        by_target.setdefault(goal, []).append(feed_id)
    writing = threading.Lock()

    def run_all(group: list[Any]) -> bool:
        failed = False
        for feed_id in group:
            spec = feeds.get(str(feed_id))
            rows = _run_logged(spark, status, success, root, run_id, feed_id, spec, findings.get(str(feed_id), []))
            with writing:
                append_rows(spark, spark.createDataFrame(rows, LOG_SCHEMA), log_table, root)
                if event_table:
                    events = _events(spark, rows, spec, event_settings or {})
                    append_rows(spark, events, event_table, root)
            failed = failed or any(row[11] is not None for row in rows)
        return failed

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        failed = any([*pool.map(run_all, by_target.values())])
    name = status_name(status, RUN_FAILURE_ID if failed else RUN_SUCCESS_ID)
    closing = (run_id, f"run_{run_id}", started, datetime.now(UTC), name, status_content(status, name), len(due))
    append_rows(spark, spark.createDataFrame([closing], RUN_SCHEMA), run_table, root)
    return run_id


def _run_logged(spark, status, success, root, run_id, feed_id, spec, problems) -> list[tuple]:
    started, layer = datetime.now(UTC), "UNKNOWN"
    if problems:
        return [
            log_row(run_id, str(feed_id), layer, started, error=message,
                    status=PIPELINE_FAILURE, status_id=PIPELINE_FAILURE_ID)
            for message in problems
        ]
    try:
        if isinstance(spec, Exception):
            raise spec
        layer = spec.layer
        result, source_count = run_feed(spark, spec, root)
        archive_files(spark, spec)
    except Exception as error:
        log.exception("pipeline %s failed", feed_id)
        message = spark.createDataFrame([(str(error),)], "message string")
        found = classify_errors(message, "message", status, RUN_FAILURE_ID).first()
        return [
            log_row(run_id, str(feed_id), layer, started, error=str(error),
                    status=PIPELINE_FAILURE, status_id=found["STATUSMESSAGEID"])
        ]
    return [
        log_row(run_id, str(feed_id), layer, started, source=source_count, after=result.after,
                inserted=result.inserted, updated=result.updated, deleted=result.deleted,
                status=success, status_id=PIPELINE_SUCCESS_ID)
    ]


def _events(spark, rows, spec, settings) -> DataFrame:
    """The event documents of a pipeline's log rows."""
    known = isinstance(spec, FeedSpec)
    source, load_spec = (spec.source, spec.load) if known else (SourceSpec(""), LoadSpec("", ""))
    made = [
        (row[6], spec.name if known else "", source.path, source.kind, load_spec.custom_query(), load_spec.target,
         load_spec.target, load_spec.mode, "F" if row[11] is not None else "C", row[15], row[2], row[3], row[21])
        for row in rows
    ]
    schema = (
        "job_id string, pipeline_name string, source_path string, source_type string, source_text string, "
        "target_path string, target_name string, load_type string, status string, record_count bigint, "
        "started timestamp, ended timestamp, now timestamp"
    )
    defaults = {"system": "", "database": "", "email": ""}
    return run_events(spark.createDataFrame(made, schema), {**defaults, **settings})
