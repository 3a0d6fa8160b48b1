"""Audit rows, run status and run events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.casts import lenient_cast
from feedloom.functions.messages import error_status
from feedloom.functions.moments import rfc3339
from feedloom.functions.names import source_name, target_name
from feedloom.operators.dedupe import keep_latest
from feedloom.operators.metadata import attach_status

# The audit tables, in column order. Row counts are 64 bits wide, as a
# table may hold more than two thousand million rows.
RUN_SCHEMA = (
    "MASTERLOGID string, RUNID string, STARTDATETIME timestamp, ENDDATETIME timestamp, "
    "STATUS string, MESSAGE string, TOTALPIPELINECOUNT int"
)
LOG_SCHEMA = (
    "LOGID string NOT NULL, PIPELINEID string NOT NULL, PIPELINESTARTDATETIME timestamp, "
    "PIPELINEENDDATETIME timestamp, PIPELINESTATUS string, STATUSMESSAGEID bigint NOT NULL, "
    "MASTERLOGID string NOT NULL, INSTANCEID string, INSTANCESTARTDATETIME timestamp, "
    "INSTANCEENDDATETIME timestamp, INSTANCESTATUS string, ERRORMESSAGE string, "
    "ERRORSEVERITY string, ERRORDATETIME timestamp, SOURCECOUNT bigint, DESTINATIONCOUNT bigint, "
    "INSERTEDCOUNT bigint, UPDATEDCOUNT bigint, DELETEDCOUNT bigint, TOTALINSTANCECOUNT int, "
    "TRIGGERTYPE string, LOGDATETIME timestamp NOT NULL, LAYER string"
)


def run_status(log: DataFrame, run: str, failed: Column, success_name: str, failure_name: str) -> DataFrame:
    """One row per run: failure if any of its rows failed, with row counts."""
    rolled = log.groupBy(run).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(failed).alias("failure_count"),
    )
    status = F.when(F.col("failure_count") > 0, failure_name).otherwise(success_name)
    return rolled.withColumn("run_status", status)


def latest_rows(log: DataFrame, key: str, moment: str) -> DataFrame:
    """The current row of each key in an append-only table."""
    return keep_latest(log, [key], [moment])


def classify_errors(log: DataFrame, message: str, status: DataFrame, default_id: int = 4) -> DataFrame:
    """Attach the status that an error message stands for."""
    named = log.withColumn("__status", error_status(F.col(message)))
    return attach_status(named, status, "__status", default_id).drop("__status")


def run_events(rows: DataFrame, settings: dict[str, str]) -> DataFrame:
    """Each run as a nested document: a source object and an array of job objects.

    ``rows`` has the columns job_id, pipeline_name, source_path, source_type,
    source_text, target_path, target_name, load_type, status, record_count,
    started, ended, now. ``settings`` names the system, its database and an e-mail
    address. The result is (job_id, event), the document being JSON text.
    """
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    source, target = source_name(F.col("source_path")), target_name(F.col("target_path"))
    # Texts that occur several times in the document are worked out once, up front.
    rows = rows.withColumns(
        {
            "__job": F.substring("job_id", 1, 45),
            "__now": rfc3339(F.col("now"), kinds["now"]),
            "__started": rfc3339(F.col("started"), kinds["started"]),
            "__ended": rfc3339(F.col("ended"), kinds["ended"]),
            "__source": source,
            "__target": target,
        }
    )
    system, job, now = F.lit(settings["system"]), F.col("__job"), F.col("__now")
    started, ended = F.coalesce("__started", now), F.coalesce("__ended", now)
    source, target = F.col("__source"), F.col("__target")
    count = F.coalesce(F.col("record_count"), F.lit(0)).cast("bigint")

    def text(**fields: Column | str | int) -> Column:
        return F.struct(*[(v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in fields.items()])

    # Field names and constant fields of the event document.
    log_entry = text(
        jobIDDetails=job,
        uniqueJobIDReference=job,
        sourceSystemName=system,
        transactionStatus=F.col("status"),
        jobStatus=F.col("status"),
        reportedDateTime=ended,
        sourceRecordCount=count,
        startDateTime=started,
        endDateTime=ended,
        message=F.concat_ws("_", job, system),
        pF1=F.when(F.col("status") == "C", "success").otherwise("failed"),
        pF2=count.cast("string"),
        pF3="automated",
    )
    job_entry = text(
        jobIDDetails=job,
        sourceSystemName=system,
        targetSystemName=F.col("target_name"),
        description=F.coalesce(F.col("pipeline_name"), F.lit("")),
        criticalFlag=4,
        severity=1,
        completedAlert="Y",
        failedAlert="Y",
        delayedAlert="Y",
        validationlAlert="N",
        sourceSystemLocation=F.coalesce(F.col("source_path"), F.lit("")),
        targetSystemLocation=F.col("target_path"),
        sourceSchemaName=source["schema"],
        sourceTableName=source["table"],
        targetSchemaName=target["schema"],
        targetTableName=target["table"],
        operationType=F.coalesce(F.col("load_type"), F.lit("ETL")),
        isBusinessAlert="Y",
        businessAlertEmail=settings.get("email", ""),
        helpDeskConfigID=1,
        runSchedule="Y",
        day="Daily",
        time=F.substring(lenient_cast(F.col("now"), kinds["now"], "time"), 1, 5),
        estimatedTime=lenient_cast(F.col("started"), kinds["started"], "time"),
        isEnabled="S",
        insertedDateTime=now,
        importedDateTime=now,
        sourceAlertLog=F.array(log_entry),
    )
    source_entry = text(
        sourceSystemName=system,
        sourceType=F.col("source_type"),
        description=F.coalesce(
            F.nullif(F.trim("source_text"), F.lit("")), F.lit(settings.get("description", ""))
        ),
        helpdeskAlert="Y",
        hostAddress="string",
        connectionConfig="string",
        databaseType=settings.get("database", ""),
        isEnabled="A",
        insertedDateTime=now,
        importedDateTime=now,
    )
    event = F.to_json(
        F.struct(source_entry.alias("sourceConfig"), F.array(job_entry).alias("sourceJobConfig")),
        {"ignoreNullFields": "false"},
    )
    return rows.select("job_id", event.alias("event"))
