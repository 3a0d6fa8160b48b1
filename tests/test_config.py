"""Configuration checks, resolution, audit rows and whole runs."""

import uuid
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from feedloom.functions.casts import lenient_cast
from feedloom.functions.messages import error_status
from feedloom.functions.moments import rfc3339
from feedloom.functions.names import qualified_name, source_name, target_name
from feedloom.functions.predicates import custom_query_text, is_active, is_blank, same_name
from feedloom.operators.audit import LOG_SCHEMA, RUN_SCHEMA, classify_errors, run_events, run_status
from feedloom.operators.checks import (
    check_active,
    check_domain,
    check_reference,
    check_required,
    validate_config,
)
from feedloom.operators.metadata import (
    attach_status,
    due_pipelines,
    overlay_defaults,
    resolve_properties,
    status_content,
    status_name,
    system_properties,
)
from feedloom.plans.config import feed_from_config
from feedloom.plans.run import run_due
from feedloom.specs import Rule

NOW = datetime(2024, 5, 1, 12)


def column(spark, values, kind, build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    kinds = {f.name: f.dataType for f in df.schema.fields}
    out = df.select("i", build(F.col("v"), kinds["v"]).alias("out")).orderBy("i")
    return [r["out"] for r in out.collect()]


def test_predicates(any_mode):
    texts = ["", " \t", "a", None]
    assert column(any_mode, texts, "string", lambda c, _: is_blank(c)) == [True, True, False, True]
    flags = ["true", " Y ", "1", "t", "YES", "0", "no", "active", "", None]
    assert column(any_mode, flags, "string", lambda c, _: is_active(c)) == [True] * 5 + [False] * 5
    assert column(any_mode, [True, False, None], "boolean", lambda c, _: is_active(c)) == [True, False, False]
    assert column(any_mode, ["Ab", None], "string", lambda c, _: same_name(c, "aB")) == [True, None]
    words = ["Null", " none", "", "  ", "SELECT 1", None]
    assert column(any_mode, words, "string", lambda c, _: custom_query_text(c)) == [None] * 4 + ["SELECT 1", None]


def test_names(any_mode):
    names = ["t", "s.t", "d.s.t", "a.d.s.t", "", None]
    full = column(any_mode, names, "string", lambda c, _: qualified_name(c, "db", "sc"))
    assert [tuple(r) if r else r for r in full] == [
        ("DB", "SC", "T"), ("DB", "S", "T"), ("D", "S", "T"), ("DB", "SC", "A"), ("DB", "SC", ""), None,
    ]
    targets = column(any_mode, names, "string", lambda c, _: target_name(c))
    assert [tuple(r) for r in targets] == [("", ""), ("s", "t"), ("s", "t"), ("s", "t"), ("", ""), ("", "")]
    paths = ["folder/file.csv", "a.b.c", "plain", "", None, "x/y/"]
    sources = column(any_mode, paths, "string", lambda c, _: source_name(c))
    assert [tuple(r) for r in sources] == [
        (None, "file.csv"), ("a.b", "c"), (None, "plain"), (None, ""), (None, ""), (None, ""),
    ]


def test_moments(any_mode):
    moments = [datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2, 3, 4, 5, 60), None]
    wanted = ["2024-01-02T03:04:05Z", "2024-01-02T03:04:05.000060Z", None]
    assert column(any_mode, moments, "timestamp_ntz", rfc3339) == wanted
    texts = ["2024-01-02T03:04:05+00:00", "2024-01-02T03:04:05+00:00Z", "x", None]
    assert column(any_mode, texts, "string", rfc3339) == ["2024-01-02T03:04:05Z", "2024-01-02T03:04:05Z", "x", None]
    df = any_mode.sql("SELECT TIMESTAMP'2024-06-01 12:00:00 +02:00' AS t")
    any_mode.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert df.select(rfc3339(F.col("t"), df.schema["t"].dataType)).first()[0] == "2024-06-01T10:00:00Z"
    finally:
        any_mode.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
def test_moments_need_no_session_zone(spark, zone):
    """Hours that the session's zone skips or has twice come out as they are."""
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql(
            "SELECT TIMESTAMP_NTZ'2024-03-10 02:30:00.5' AS n, t AS l, TIMESTAMP_NTZ'2024-03-10 02:30:00' AS c "
            "FROM VALUES (TIMESTAMP'2024-11-03T05:30:00Z'), (TIMESTAMP'2024-11-03T06:30:00Z') v(t)"
        )
        kinds = {f.name: f.dataType for f in df.schema.fields}
        out = df.select(
            rfc3339(F.col("n"), kinds["n"]).alias("n"),
            rfc3339(F.col("l"), kinds["l"]).alias("l"),
            lenient_cast(F.col("c"), kinds["c"], "time").alias("c"),
        ).orderBy("l").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [r["l"] for r in out] == ["2024-11-03T05:30:00Z", "2024-11-03T06:30:00Z"]
    assert {(r["n"], r["c"]) for r in out} == {("2024-03-10T02:30:00.500000Z", "02:30:00")}


def test_due_in_another_zone(spark):
    pipelines = spark.createDataFrame([(1, 1, 1, True)], "PIPELINEID int, LAYERID int, CRONID int, ACTIVE boolean")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for kind in ("TIMESTAMP_NTZ'2024-05-01 12:00:00'", "TIMESTAMP'2024-05-01T12:00:00Z'"):
            crons = spark.sql(f"SELECT 1 AS CRONID, {kind} AS NEXTRUN, true AS ACTIVE, '' AS CRONEXPRESSION, '' AS TIMEZONE")
            assert due_pipelines(pipelines, crons, NOW).count() == 1
            assert due_pipelines(pipelines, crons, NOW.replace(tzinfo=UTC)).count() == 1
            assert due_pipelines(pipelines, crons, NOW - timedelta(microseconds=1)).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_error_classes(any_mode):
    messages = ["Login failed for user", "Invalid object name 'x'", "Object T does not exist", "table not found",
                "boom", None]
    found = column(any_mode, messages, "string", lambda c, _: error_status(c))
    assert found == ["PIPELINE_FAILURE_AUTH_FAILED"] + ["PIPELINE_FAILURE_TABLE_NOT_FOUND"] * 3 + ["MASTER_FAILURE"] * 2


def test_checks(spark, rows):
    df = spark.createDataFrame([(1, " ", "y"), (2, "a", None), (3, None, "0")], "k int, name string, ACTIVE string")
    required = check_required(df, "SECRET", "k", ["NAME", "gone"]).select("row_key", "message")
    text = "{} in Secret table is mandatory; empty values are not permitted."
    assert rows(required) == [
        ("1", text.format("NAME")), ("1", text.format("gone")), ("2", text.format("gone")),
        ("3", text.format("NAME")), ("3", text.format("gone")),
    ]
    assert [r["row_key"] for r in check_active(df, "T", "k").orderBy("row_key").collect()] == ["2", "3"]
    assert check_active(df.drop("ACTIVE"), "T", "k").count() == 3
    modes = spark.createDataFrame([(1, " Full"), (2, "upsert"), (3, None)], "k int, m string")
    assert [r["row_key"] for r in check_domain(modes, "T", "k", "m", ["full"]).orderBy("row_key").collect()] == ["2", "3"]
    child = spark.createDataFrame([(1,), (9,), (9,), (None,)], "r int")
    parent = spark.createDataFrame([(1,), (1,), (2,)], "id int")
    found = check_reference(child, "C", "r", parent, "id")
    assert rows(found) == [("C", "9", "r", "Invalid r=9", 2)]


def test_properties(spark, rows):
    links = spark.createDataFrame([(1, 10), (1, 11), (2, 10), (2, 99)], "PIPELINEID int, PROPERTYID int")
    props = spark.createDataFrame(
        [(10, "Delimiter", ";"), (11, "DELIMITER", "|")], "PROPERTYID int, PROPERTYNAME string, PROPERTYVALUE string"
    )
    assert rows(resolve_properties(links, props)) == [(1, "delimiter", "|"), (2, "delimiter", ";")]
    settings = spark.createDataFrame(
        [("a", "1", True), ("b", "", True), ("c", "3", False), (None, "4", True), ("", "5", True), ("d", "6", None)],
        "PROPERTYKEY string, PROPERTYVALUE string, ACTIVE boolean",
    )
    active = system_properties(settings)
    assert rows(active) == [("A", "1"), ("B", "")]
    defaults = spark.createDataFrame([("A", "x"), ("b", "y"), ("c", None)], "property_key string, default_value string")
    assert rows(overlay_defaults(active, defaults)) == [("A", "1"), ("B", "y"), ("C", None)]


def test_due(spark, rows):
    pipelines = spark.createDataFrame(
        [(1, 1, "p", True), (2, 1, "f", True), (3, 1, "n", True), (4, 1, "e", True), (5, 1, "p", False),
         (6, 1, "x", True), (7, 1, "p", True)],
        "PIPELINEID int, LAYERID int, CRONID string, ACTIVE boolean",
    )
    hour = timedelta(hours=1)
    crons = spark.createDataFrame(
        [("p", NOW - hour, True), ("f", NOW + hour, True), ("n", None, True), ("e", NOW, True), ("x", None, False)],
        "CRONID string, NEXTRUN timestamp, ACTIVE boolean",
    ).selectExpr("*", "'0 * * * *' AS CRONEXPRESSION", "'UTC' AS TIMEZONE")
    assert rows(due_pipelines(pipelines, crons, NOW).select("PIPELINEID")) == [(1,), (3,), (4,), (7,)]


STATUS = [
    (1, "PIPELINE_SUCCESS", "ok"), (2, "PIPELINE_FAILURE", "bad"), (3, "MASTER_SUCCESS", "all went well"),
    (4, "MASTER_FAILURE", "some failed"), (5, "Pipeline_Failure_Table_Not_Found", "gone"),
]


def status_table(spark):
    return spark.createDataFrame(
        STATUS, "STATUSMESSAGEID bigint, STATUSMESSAGENAME string, STATUSMESSAGECONTENT string"
    )


def test_status(spark, rows):
    status = status_table(spark)
    names = spark.createDataFrame([("master_success",), ("nothing",), (None,)], "n string")
    out = attach_status(names, status, "n", 4)
    assert rows(out) == [(None, 4, "MASTER_FAILURE"), ("master_success", 3, "MASTER_SUCCESS"), ("nothing", 4, "MASTER_FAILURE")]
    assert status_name(status, 3) == "MASTER_SUCCESS"
    assert status_content(status, "master_failure") == "some failed"
    assert status_content(status, "x") is None
    with pytest.raises(ValueError, match="no status message"):
        status_name(status, 77)
    log = spark.createDataFrame([("Table not found: T",)], "m string")
    assert classify_errors(log, "m", status).first()["STATUSMESSAGEID"] == 5


def test_run_status(spark, rows):
    log = spark.createDataFrame([("a", "ok"), ("a", "bad"), ("b", "ok")], "run string, s string")
    out = run_status(log, "run", F.col("s") == "bad", "fine", "failed")
    assert rows(out) == [("a", 2, 1, "failed"), ("b", 1, 0, "fine")]


def test_event_without_moments(spark):
    rows = spark.createDataFrame(
        [("j" * 50, None, None, None, None, None, "t", None, "F", None, None, None, NOW)],
        "job_id string, pipeline_name string, source_path string, source_type string, source_text string, "
        "target_path string, target_name string, load_type string, status string, record_count int, "
        "started timestamp_ntz, ended timestamp_ntz, now timestamp_ntz",
    )
    event = run_events(rows, {"system": "sys", "description": "none given"}).first()["event"]
    job = spark.sql("SELECT 1").select(
        *[F.get_json_object(F.lit(event), p) for p in (
            "$.sourceJobConfig[0].jobIDDetails", "$.sourceJobConfig[0].sourceAlertLog[0].startDateTime",
            "$.sourceConfig.description", "$.sourceJobConfig[0].operationType",
            "$.sourceJobConfig[0].sourceAlertLog[0].pF2")]
    ).first()
    assert tuple(job) == ("j" * 45, "2024-05-01T12:00:00Z", "none given", "ETL", "0")
    assert '"sourceSchemaName":null' in event


def build_config(spark, source_path, target, **changes):
    """Configuration of one healthy pipeline, 1, and one with flaws, 2."""
    def of(data, schema):
        return spark.createDataFrame(data, schema)

    mode = changes.get("mode", 11)
    return {
        "PIPELINE": of(
            [(1, "good", 1, 1, mode, 12, "c", True, "id", None, changes.get("watermark")),
             (2, " ", 9, 1, mode, 12, "c", True, "id", None, None)],
            "PIPELINEID int, PIPELINENAME string, SOURCEID int, DESTINATIONID int, LOADTYPEID int, LAYERID int, "
            "CRONID string, ACTIVE boolean, UNIQUEKEYCOLUMNS string, CUSTOMQUERY string, WATERMARKCOLUMN string",
        ),
        "SOURCE": of([(1, "src", source_path, 13, 14, 1, "Y")],
                     "SOURCEID int, SOURCENAME string, SOURCEPATH string, SOURCETYPEID int, FORMATTYPEID int, "
                     "SECRETID int, ACTIVE string"),
        "DESTINATION": of([(1, "dst", target, 1, 14, True)],
                          "DESTINATIONID int, DESTINATIONNAME string, DESTINATIONPATH string, "
                          "DESTINATIONTYPEID int, FORMATTYPEID int, ACTIVE boolean"),
        "LOOKUP": of([(10, "LoadType", "Full", True), (11, "LoadType", "append", True), (15, "LoadType", "incremental", True),
                      (12, "Layer", "Bronze", True), (13, "SourceType", "SFTP", True),
                      (14, "FormatType", "csv", True)],
                     "LOOKUPID int, LOOKUPNAME string, LOOKUPVALUE string, ACTIVE boolean"),
        "SECRET": of([(1, "s", "key", True)], "SECRETID int, SECRETNAME string, SECRETKEY string, ACTIVE boolean"),
        "SOURCECOLUMN": of([(1, "ID", 1, "INT", True), (2, "note", 2, "VARCHAR", True), (3, "w", 3, "INT", True)],
                           "SOURCECOLUMNID int, SOURCECOLUMNNAME string, SOURCECOLUMNSEQUENCE int, "
                           "SOURCECOLUMNDATATYPE string, ACTIVE boolean"),
        "DESTINATIONCOLUMN": of([(1, 1, "id", 2, "INT", True), (2, 1, "note", 1, "VARCHAR(9)", True), (3, 1, "w", 3, "INT", True)],
                                "DESTINATIONCOLUMNID int, DESTINATIONID int, DESTINATIONCOLUMNNAME string, "
                                "DESTINATIONCOLUMNSEQUENCE int, DESTINATIONCOLUMNDATATYPE string, ACTIVE boolean"),
        "COLUMNMAPPING": of([(1, 1, True), (2, 2, True), (3, 3, True)],
                            "SOURCECOLUMNID int, DESTINATIONCOLUMNID int, ACTIVE boolean"),
        "PIPELINEPROPERTIES": of([(1, 1), (1, 2)], "PIPELINEID int, PROPERTYID int"),
        "PROPERTIES": of([(1, "Delimiter", ";"), (2, "SKIPHEADER", "1")],
                         "PROPERTYID int, PROPERTYNAME string, PROPERTYVALUE string"),
        "VALIDATION": of([(1, "transform", True, "fillna:Empty", "note", None, None, 2),
                          (1, "transform", True, "upper", "note", None, None, 1),
                          (1, "transform", False, "lower", "note", None, None, 3),
                          (1, "check", True, "lower", "note", None, None, 4)],
                         "PIPELINEID int, OPERATIONTYPE string, ACTIVE boolean, TRANSFORMATIONRULES string, "
                         "OPERATIONCOLUMNS string, OPERATIONTARGET string, QUERY string, SEQ int"),
        "CRON": of([("c", "0 * * * *", "UTC", None, True)],
                   "CRONID string, CRONEXPRESSION string, TIMEZONE string, NEXTRUN timestamp, ACTIVE boolean"),
        "STATUSMESSAGE": status_table(spark),
    }


def test_validate_config(spark, rows):
    config = build_config(spark, "a.csv", "t")
    asked = spark.createDataFrame([(1,), (2,), (3,)], "PIPELINEID int")
    text = "{} in {} table is mandatory; empty values are not permitted."
    assert rows(validate_config(config, asked)) == [
        ("2", text.format("PIPELINENAME", "PIPELINE")),
        ("2", text.format("SOURCEID", "SOURCE")),
        ("3", text.format("PIPELINEID", "PIPELINE")),
    ]
    assert validate_config(config).count() == 2
    config["LOOKUP"] = config["LOOKUP"].withColumn("ACTIVE", F.lit("no"))
    messages = {r["message"] for r in validate_config(config).filter("pipeline_id = '1'").collect()}
    assert messages == {"The values in the ACTIVE column of the LOOKUP table are not set to active."}


def test_feed_from_config(spark):
    spec = feed_from_config(build_config(spark, "in/a.csv", "t"), 1)
    assert (spec.name, spec.layer, spec.keys, spec.load.mode) == ("good", "bronze", ("id",), "append")
    assert (spec.source.kind, spec.source.options.delimiter) == ("SFTP", ";")
    assert [m.target for m in sorted(spec.mappings, key=lambda m: m.sequence)] == ["note", "id", "w"]
    assert spec.rules == (Rule("upper", ("note",), seq=0), Rule("fillna", ("note",), ("Empty",), seq=1))
    with pytest.raises(ValueError, match="no pipeline has"):
        feed_from_config(build_config(spark, "a.csv", "t"), 8)
    with pytest.raises(ValueError, match="SOURCEID .* leads to no"):
        feed_from_config(build_config(spark, "a.csv", "t"), 2)


@pytest.fixture
def names(spark):
    made = [f"{kind}_{uuid.uuid4().hex}" for kind in ("target", "log", "run")]
    yield made
    for name in made:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


@pytest.mark.parametrize("mode, inserted, updated", [(10, 2, 0), (11, 0, 0), (15, 0, 0)])
def test_runs(spark, tmp_path, rows, names, mode, inserted, updated):
    target, log, run = names
    path = tmp_path / "a.csv"
    path.write_text("id;note;w\n1;x;5\n1;y;6\n2;;7\n", encoding="utf-8")
    config = build_config(spark, str(path), target, mode=mode, watermark="w")
    tables = {"log_table": log, "run_table": run}
    first = run_due(spark, config, str(tmp_path), NOW, **tables)
    assert rows(spark.table(target)) == [("Empty", 2, 7), ("Y", 1, 6)]
    second = run_due(spark, config, str(tmp_path), NOW, **tables)
    assert first != second and spark.table(target).count() == 2

    logged = spark.table(log).filter(F.col("MASTERLOGID") == second).orderBy("PIPELINEID", "ERRORMESSAGE").collect()
    good, *bad = logged
    assert spark.table(log).schema.fieldNames() == spark.createDataFrame([], LOG_SCHEMA).schema.fieldNames()
    assert (good["PIPELINESTATUS"], good["STATUSMESSAGEID"], good["LAYER"]) == ("PIPELINE_SUCCESS", 1, "bronze")
    assert (good["SOURCECOUNT"], good["DESTINATIONCOUNT"]) == (3, 2)
    assert (good["INSERTEDCOUNT"], good["UPDATEDCOUNT"]) == (inserted, updated)
    assert [b["PIPELINEID"] for b in bad] == ["2", "2"] and {b["STATUSMESSAGEID"] for b in bad} == {2}
    closing = spark.table(run).filter(F.col("MASTERLOGID") == second).first()
    assert closing.__fields__ == spark.createDataFrame([], RUN_SCHEMA).columns
    assert (closing["STATUS"], closing["MESSAGE"], closing["TOTALPIPELINECOUNT"]) == ("MASTER_FAILURE", "some failed", 2)


def test_run_logs_errors(spark, tmp_path, names):
    target, log, run = names
    config = build_config(spark, str(tmp_path / "missing.csv"), target)
    config["PIPELINE"] = config["PIPELINE"].filter("PIPELINEID = 1")
    run_due(spark, config, str(tmp_path), NOW, log_table=log, run_table=run)
    row = spark.table(log).first()
    assert row["STATUSMESSAGEID"] == 5 and "does not exist" in row["ERRORMESSAGE"]


def test_nothing_due(spark, tmp_path):
    config = build_config(spark, "a.csv", "t")
    config["CRON"] = config["CRON"].withColumn("ACTIVE", F.lit(False))
    assert run_due(spark, config, str(tmp_path), NOW) is None
