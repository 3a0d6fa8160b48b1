"""Whole runs: from configuration tables, and of landed files."""

from __future__ import annotations

import uuid
from datetime import datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.audit import latest_rows
from feedloom.plans.run import run_due
from feedloom.queries import register, table
from feedloom.queries.loading import detached
from feedloom.session import shared_folder
from feedloom.specs import ColumnMapping, FeedSpec, LoadSpec, ReadOptions, Rule, SourceSpec
from feedloom.streaming.landing import load_landed


def _write_orders(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Orders as semicolon-separated text with a header."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o_orderdate"),
    )
    orders.write.csv(path, sep=";", header=True, escape='"')


def order_config(spark: SparkSession, source: str, target: str) -> dict[str, DataFrame]:
    """Configuration tables of one feed: the latest order of each customer and status."""
    columns = [
        ("O_CustKey", "customer_id", "BIGINT"),
        ("o_orderstatus", "status", "VARCHAR(1)"),
        ("o_orderkey", "order_id", "BIGINT"),
        ("o_orderpriority", "priority", "VARCHAR(20)"),
        ("o_orderdate", "ordered_at", "TIMESTAMP_NTZ"),
    ]
    rules = [
        ("map:{'O': 'open', 'F': 'filled', 'P': 'pending'}", "status", "status_text"),
        ("regexp_replace:^[0-9]-,", "priority", None),
        ("lower", "priority", None),
        ("day_name", "ordered_at", "weekday"),
    ]
    tables = {
        "PIPELINE": (
            [(1, "orders", 1, 1, 10, 11, 1, "customer_id, status", "ordered_at", True)],
            "PIPELINEID int, PIPELINENAME string, SOURCEID int, DESTINATIONID int, LOADTYPEID int, LAYERID int, "
            "CRONID int, UNIQUEKEYCOLUMNS string, WATERMARKCOLUMN string, ACTIVE boolean",
        ),
        "SOURCE": (
            [(1, "orders", source, 12, 13, 1, True)],
            "SOURCEID int, SOURCENAME string, SOURCEPATH string, SOURCETYPEID int, FORMATTYPEID int, "
            "SECRETID int, ACTIVE boolean",
        ),
        "DESTINATION": (
            [(1, "core", target, 1, 13, True)],
            "DESTINATIONID int, DESTINATIONNAME string, DESTINATIONPATH string, DESTINATIONTYPEID int, "
            "FORMATTYPEID int, ACTIVE boolean",
        ),
        "LOOKUP": (
            [(10, "LoadType", "Incremental", True), (11, "Layer", "Silver", True),
             (12, "SourceType", "SFTP", True), (13, "FormatType", "csv", True)],
            "LOOKUPID int, LOOKUPNAME string, LOOKUPVALUE string, ACTIVE boolean",
        ),
        "SECRET": ([(1, "s", "k", True)], "SECRETID int, SECRETNAME string, SECRETKEY string, ACTIVE boolean"),
        "SOURCECOLUMN": (
            [(i, s, i, kind, True) for i, (s, _, kind) in enumerate(columns, 1)],
            "SOURCECOLUMNID int, SOURCECOLUMNNAME string, SOURCECOLUMNSEQUENCE int, "
            "SOURCECOLUMNDATATYPE string, ACTIVE boolean",
        ),
        "DESTINATIONCOLUMN": (
            [(i, 1, t, i, kind, True) for i, (_, t, kind) in enumerate(columns, 1)],
            "DESTINATIONCOLUMNID int, DESTINATIONID int, DESTINATIONCOLUMNNAME string, "
            "DESTINATIONCOLUMNSEQUENCE int, DESTINATIONCOLUMNDATATYPE string, ACTIVE boolean",
        ),
        "COLUMNMAPPING": (
            [(i, i, True) for i in range(1, len(columns) + 1)],
            "SOURCECOLUMNID int, DESTINATIONCOLUMNID int, ACTIVE boolean",
        ),
        "PIPELINEPROPERTIES": ([(1, 1), (1, 2)], "PIPELINEID int, PROPERTYID int"),
        "PROPERTIES": (
            [(1, "Delimiter", ";"), (2, "MultiLine", "0")],
            "PROPERTYID int, PROPERTYNAME string, PROPERTYVALUE string",
        ),
        "VALIDATION": (
            [(1, "transform", True, *rule, i) for i, rule in enumerate(rules)],
            "PIPELINEID int, OPERATIONTYPE string, ACTIVE boolean, TRANSFORMATIONRULES string, "
            "OPERATIONCOLUMNS string, OPERATIONTARGET string, SEQ int",
        ),
        "CRON": (
            [(1, "0 6 * * *", "UTC", datetime(2024, 1, 1), True)],
            "CRONID int, CRONEXPRESSION string, TIMEZONE string, NEXTRUN timestamp, ACTIVE boolean",
        ),
        "STATUSMESSAGE": (
            [(1, "PIPELINE_SUCCESS", "ok"), (2, "PIPELINE_FAILURE", "failed"), (3, "MASTER_SUCCESS", "all ok"),
             (4, "MASTER_FAILURE", "some failed")],
            "STATUSMESSAGEID bigint, STATUSMESSAGENAME string, STATUSMESSAGECONTENT string",
        ),
    }
    return {name: _small_table(spark, rows, schema) for name, (rows, schema) in tables.items()}


def _small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Rows as a local relation, whose size Spark knows, as it does of stored tables."""
    names = spark.createDataFrame([], schema).columns
    return spark.createDataFrame(pa.Table.from_pylist([dict(zip(names, row, strict=True)) for row in rows]), schema)


def _run_orders(spark: SparkSession, sf_dir: str, events: str | None = None) -> tuple[str, str, str]:
    """One run of the configured feed; the names of its target, log and run tables."""
    folder = shared_folder(spark, "run")
    source = f"{folder}/orders.csv"
    _write_orders(spark, sf_dir, source)
    target, log, runs = (f"{kind}_{uuid.uuid4().hex}" for kind in ("target", "log", "runs"))
    config = order_config(spark, source, target)
    run_due(
        spark, config, f"{folder}/tables", datetime(2024, 1, 2), log_table=log, run_table=runs, event_table=events
    )
    return target, log, runs


_LATEST = """
    SELECT * FROM orders QUALIFY row_number() OVER (
      PARTITION BY o_custkey, o_orderstatus
      ORDER BY o_orderdate DESC, o_orderkey DESC, o_orderpriority DESC) = 1
"""


@register(
    f"""
    SELECT o_custkey AS customer_id, o_orderstatus AS status, o_orderkey AS order_id,
           lower(regexp_replace(o_orderpriority, '^[0-9]-', '')) AS priority, o_orderdate AS ordered_at,
           CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'filled' WHEN 'P' THEN 'pending' END AS status_text,
           dayname(o_orderdate) AS weekday
    FROM ({_LATEST})
    """
)
def configured_run(spark, sf_dir):
    """A feed read from configuration tables: text file, mapping, key, rules, merge."""
    target, log, runs = _run_orders(spark, sf_dir)
    for name in (log, runs):
        spark.sql(f"DROP TABLE {name}")
    return detached(spark, target)


@register(
    f"""
    WITH rows AS (SELECT count(*) AS n FROM orders), kept AS (SELECT count(*) AS k FROM ({_LATEST}))
    SELECT 'PIPELINE_SUCCESS' AS "PIPELINESTATUS", CAST(1 AS BIGINT) AS "STATUSMESSAGEID", 'silver' AS "LAYER",
           n AS "SOURCECOUNT", k AS "DESTINATIONCOUNT", k AS "INSERTEDCOUNT",
           CAST(0 AS BIGINT) AS "UPDATEDCOUNT", CAST(0 AS BIGINT) AS "DELETEDCOUNT"
    FROM rows, kept
    """
)
def configured_run_log(spark, sf_dir):
    """The audit row of that run: source rows, and what the merge did."""
    target, log, runs = _run_orders(spark, sf_dir)
    for name in (target, runs):
        spark.sql(f"DROP TABLE {name}")
    return detached(spark, log).select(
        "PIPELINESTATUS", "STATUSMESSAGEID", "LAYER", "SOURCECOUNT", "DESTINATIONCOUNT", "INSERTEDCOUNT",
        "UPDATEDCOUNT", "DELETEDCOUNT",
    )


@register(
    """
    SELECT 'MASTER_SUCCESS' AS "STATUS", 'all ok' AS "MESSAGE", CAST(1 AS INT) AS "TOTALPIPELINECOUNT",
           count(*) > 0 AS has_rows FROM orders
    """
)
def configured_run_master(spark, sf_dir):
    """The state of that run: the latest of the rows that the run table got."""
    target, log, runs = _run_orders(spark, sf_dir)
    loaded = not detached(spark, target).isEmpty()
    spark.sql(f"DROP TABLE {log}")
    state = latest_rows(detached(spark, runs), "MASTERLOGID", "ENDDATETIME")
    return state.select("STATUS", "MESSAGE", "TOTALPIPELINECOUNT", F.lit(loaded).alias("has_rows"))


@register(
    f"""
    WITH kept AS (SELECT count(*) AS k FROM ({_LATEST}))
    SELECT 'orders' AS pipeline, 'Incremental' AS operation, 'C' AS status, CAST(k AS VARCHAR) AS records FROM kept
    """
)
def configured_run_events(spark, sf_dir):
    """The event document that the run appends for its feed."""
    events = f"events_{uuid.uuid4().hex}"
    for name in _run_orders(spark, sf_dir, events):
        spark.sql(f"DROP TABLE {name}")
    job = "$.sourceJobConfig[0]"
    fields = {
        "pipeline": f"{job}.description", "operation": f"{job}.operationType",
        "status": f"{job}.sourceAlertLog[0].jobStatus", "records": f"{job}.sourceAlertLog[0].pF2",
    }
    return detached(spark, events).select(*[F.get_json_object("event", p).alias(n) for n, p in fields.items()])


@register("SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status FROM orders")
def landed_append_by_mark(spark, sf_dir):
    """Two runs in one session, the second with all rows again: the mark of the first holds."""
    folder, name = shared_folder(spark, "landed"), f"landed_{uuid.uuid4().hex}"
    columns = ["o_orderkey", "o_custkey", "o_orderstatus"]
    orders = table(spark, sf_dir, "orders").select(*columns)
    spec = FeedSpec(
        "landed", "landed",
        SourceSpec("sftp", f"{folder}/landing", ReadOptions(pattern="*.csv", multiline=False)),
        tuple(ColumnMapping(s, t, k, i) for i, (s, t, k) in enumerate(
            zip(columns, ("order_id", "customer_id", "status"), ("BIGINT", "BIGINT", "VARCHAR"), strict=True))),
        LoadSpec("append", name, (), "order_id"),
    )
    half = orders.agg(F.max("o_orderkey")).first()[0] // 2
    for part in (orders.filter(F.col("o_orderkey") <= half), orders):
        part.write.mode("append").csv(f"{folder}/landing", header=True)
        load_landed(spark, spec, f"{folder}/tables", f"{folder}/checkpoint").awaitTermination()
    return detached(spark, name)


@register(
    """
    SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status,
           upper(o_orderpriority) AS priority, o_orderdate AS ordered_at
    FROM orders
    """
)
def landed_files_load(spark, sf_dir):
    """Landed text files, each loaded once and archived; a second run finds none."""
    folder, name = shared_folder(spark, "landed"), f"landed_{uuid.uuid4().hex}"
    _write_orders(spark, sf_dir, f"{folder}/landing")
    columns = [
        ("o_orderkey", "order_id", "BIGINT"), ("o_custkey", "customer_id", "BIGINT"),
        ("o_orderstatus", "status", "VARCHAR"), ("o_orderpriority", "priority", "VARCHAR"),
        ("o_orderdate", "ordered_at", "TIMESTAMP_NTZ"),
    ]
    spec = FeedSpec(
        "landed", "landed",
        SourceSpec("sftp", f"{folder}/landing", ReadOptions(delimiter=";", pattern="*.csv", multiline=False)),
        tuple(ColumnMapping(s, t, kind, i) for i, (s, t, kind) in enumerate(columns)),
        LoadSpec("append", name, ("order_id",)),
        (Rule.parse("upper", "priority"),),
        archive_path=f"{folder}/archive",
    )
    for _ in range(2):
        load_landed(spark, spec, f"{folder}/tables", f"{folder}/checkpoint").awaitTermination()
    return detached(spark, name)
