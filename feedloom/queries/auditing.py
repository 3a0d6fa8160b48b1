"""Audit roll-ups, error classes and run events."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.operators.audit import classify_errors, latest_rows, run_events, run_status
from feedloom.operators.metadata import attach_status
from feedloom.queries import register, table


@register(
    """
    SELECT user_id, count(*) AS row_count, count(*) FILTER (WHERE event_type = 'error') AS failure_count,
           CASE WHEN bool_or(event_type = 'error') THEN 'MASTER_FAILURE' ELSE 'MASTER_SUCCESS' END AS run_status
    FROM events GROUP BY user_id
    """
)
def audit_rollup(spark, sf_dir):
    """A run fails if one of its rows failed; here a user is a run and an error a failure."""
    failed = F.col("event_type") == "error"
    return run_status(table(spark, sf_dir, "events"), "user_id", failed, "MASTER_SUCCESS", "MASTER_FAILURE")


@register("SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def audit_latest(spark, sf_dir):
    """The current row per key of an append-only table."""
    return latest_rows(table(spark, sf_dir, "events"), "user_id", "ts")


@register(
    """
    SELECT event_id,
           CAST(CASE event_type WHEN 'signup' THEN 11 WHEN 'view' THEN 12 WHEN 'purchase' THEN 12 ELSE 4 END
             AS BIGINT) AS "STATUSMESSAGEID",
           CASE event_type WHEN 'signup' THEN 'pipeline_failure_auth_failed'
                WHEN 'view' THEN 'pipeline_failure_table_not_found'
                WHEN 'purchase' THEN 'pipeline_failure_table_not_found' ELSE 'master_failure' END
             AS "STATUSMESSAGENAME"
    FROM events
    """
)
def classify_messages(spark, sf_dir):
    """Error texts to statuses by pattern, over a log of one message per event."""
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    message = (
        F.when(kind == "signup", F.concat(F.lit("Login FAILED for user "), user))
        .when(kind == "view", F.concat(F.lit("Object T"), user, F.lit(" does not exist")))
        .when(kind == "purchase", F.concat(F.lit("Invalid object name 'T"), user, F.lit("'")))
        .when(kind == "click", F.concat(F.lit("time limit reached by "), user))
    )
    log = table(spark, sf_dir, "events").select("event_id", message.alias("message"))
    # Status rows, in the order of their ids.
    status = table(spark, sf_dir, "region").selectExpr(
        "decode(r_regionkey, 0, 4L, 1, 11L, 2, 12L, 90L + r_regionkey) AS STATUSMESSAGEID",
        "decode(r_regionkey, 0, 'master_failure', 1, 'pipeline_failure_auth_failed', "
        "2, 'pipeline_failure_table_not_found', r_name) AS STATUSMESSAGENAME",
    )
    return classify_errors(log, "message", status).drop("message")


@register(
    """
    SELECT user_id,
           CAST(CASE WHEN bool_or(event_type = 'error') THEN 4 ELSE 3 END AS BIGINT) AS "STATUSMESSAGEID",
           CASE WHEN bool_or(event_type = 'error') THEN 'MASTER_FAILURE' ELSE 'MASTER_SUCCESS' END
             AS "STATUSMESSAGENAME"
    FROM events GROUP BY user_id
    """
)
def audit_status_text(spark, sf_dir):
    """The roll-up joined to the status table."""
    status = table(spark, sf_dir, "region").selectExpr(
        "bigint(r_regionkey) AS STATUSMESSAGEID",
        "decode(r_regionkey, 3, 'MASTER_SUCCESS', 4, 'MASTER_FAILURE', r_name) AS STATUSMESSAGENAME",
    )
    rolled = audit_rollup(spark, sf_dir).select("user_id", "run_status")
    return attach_status(rolled, status, "run_status", 4).drop("run_status")


_NOW = "'2024-01-01T00:00:00Z'"


@register(
    f"""
    WITH runs AS (
      SELECT o_orderkey, o_custkey, o_orderpriority, o_orderdate,
             substring('run_' || o_orderkey || '_' || repeat('x', 60), 1, 45) AS job,
             strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS started,
             strftime(o_orderdate + INTERVAL 1500 MILLISECOND, '%Y-%m-%dT%H:%M:%S.%fZ') AS ended,
             CASE o_orderkey % 2 WHEN 0 THEN 'C' ELSE 'F' END AS status
      FROM orders)
    SELECT o_orderkey, CAST(json_object(
      'sourceConfig', json_object(
        'sourceSystemName', 'feedloom', 'sourceType', 'sftp', 'description', 'no text',
        'helpdeskAlert', 'Y', 'hostAddress', 'string', 'connectionConfig', 'string',
        'databaseType', 'main', 'isEnabled', 'A', 'insertedDateTime', {_NOW}, 'importedDateTime', {_NOW}),
      'sourceJobConfig', json_array(json_object(
        'jobIDDetails', job, 'sourceSystemName', 'feedloom', 'targetSystemName', 'warehouse',
        'description', o_orderpriority, 'criticalFlag', 4, 'severity', 1, 'completedAlert', 'Y',
        'failedAlert', 'Y', 'delayedAlert', 'Y', 'validationlAlert', 'N',
        'sourceSystemLocation', 'in/2024/orders.csv', 'targetSystemLocation', 'main.core.orders',
        'sourceSchemaName', NULL, 'sourceTableName', 'orders.csv', 'targetSchemaName', 'core',
        'targetTableName', 'orders', 'operationType', 'full', 'isBusinessAlert', 'Y',
        'businessAlertEmail', '', 'helpDeskConfigID', 1, 'runSchedule', 'Y', 'day', 'Daily',
        'time', '00:00', 'estimatedTime', strftime(o_orderdate, '%H:%M:%S'), 'isEnabled', 'S',
        'insertedDateTime', {_NOW}, 'importedDateTime', {_NOW},
        'sourceAlertLog', json_array(json_object(
          'jobIDDetails', job, 'uniqueJobIDReference', job, 'sourceSystemName', 'feedloom',
          'transactionStatus', status, 'jobStatus', status, 'reportedDateTime', ended,
          'sourceRecordCount', o_custkey, 'startDateTime', started, 'endDateTime', ended,
          'message', job || '_feedloom', 'pF1', CASE status WHEN 'C' THEN 'success' ELSE 'failed' END,
          'pF2', CAST(o_custkey AS VARCHAR), 'pF3', 'automated'))))) AS VARCHAR) AS event
    FROM runs
    """
)
def event_json(spark, sf_dir):
    """Runs as nested documents, compared as whole JSON texts."""
    key = F.col("o_orderkey").cast("string")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.rpad(F.concat(F.lit("run_"), key, F.lit("_")), 60, "x").alias("job_id"),
        F.col("o_orderpriority").alias("pipeline_name"),
        F.lit("in/2024/orders.csv").alias("source_path"),
        F.lit("sftp").alias("source_type"),
        F.lit(" ").alias("source_text"),
        F.lit("main.core.orders").alias("target_path"),
        F.lit("warehouse").alias("target_name"),
        F.lit("full").alias("load_type"),
        F.when(F.col("o_orderkey") % 2 == 0, "C").otherwise("F").alias("status"),
        F.col("o_custkey").alias("record_count"),
        F.col("o_orderdate").alias("started"),
        F.expr("o_orderdate + INTERVAL '1.5' SECOND").alias("ended"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("now"),
    )
    events = run_events(rows, {"system": "feedloom", "description": "no text", "database": "main"})
    return events.select(F.split("job_id", "_")[1].cast("bigint").alias("o_orderkey"), "event")
