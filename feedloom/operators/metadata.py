"""Joins that resolve configuration tables."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions.moments import utc_literal
from feedloom.functions.predicates import is_active, same_name
from feedloom.operators.dedupe import keep_latest

# The default slowly-changing type, when none is given or known.
DEFAULT_SCD = (21, "NONE")


def resolve_mappings(
    destination_columns: DataFrame, mapping: DataFrame, source_columns: DataFrame
) -> DataFrame:
    """Source name, destination name, type and sequence of every mapped column."""
    return (
        destination_columns.join(mapping, ["DESTINATIONCOLUMNID"])
        .join(source_columns, ["SOURCECOLUMNID"])
        .select(
            "DESTINATIONID",
            "SOURCECOLUMNNAME",
            "DESTINATIONCOLUMNNAME",
            "DESTINATIONCOLUMNDATATYPE",
            "DESTINATIONCOLUMNSEQUENCE",
        )
    )


def resolve_properties(pipeline_properties: DataFrame, properties: DataFrame) -> DataFrame:
    """One (PIPELINEID, key, value) row per lower-cased key; the highest id wins."""
    rows = pipeline_properties.join(properties, ["PROPERTYID"]).select(
        "PIPELINEID",
        F.lower("PROPERTYNAME").alias("property_key"),
        F.col("PROPERTYVALUE").alias("property_value"),
        "PROPERTYID",
    )
    return keep_latest(rows, ["PIPELINEID", "property_key"], ["PROPERTYID"]).drop("PROPERTYID")


def system_properties(df: DataFrame) -> DataFrame:
    """Active settings as (property_key, property_value), keys in upper case."""
    if "ACTIVE" in {c.upper() for c in df.columns}:
        df = df.filter(is_active(F.col("ACTIVE")))
    rows = df.filter(F.col("PROPERTYKEY") != "").select(
        F.upper("PROPERTYKEY").alias("property_key"),
        F.col("PROPERTYVALUE").cast("string").alias("property_value"),
    )
    return keep_latest(rows, ["property_key"])


def overlay_defaults(settings: DataFrame, defaults: DataFrame) -> DataFrame:
    """The defaults, each replaced by a setting of the same key that is not empty."""
    wanted = defaults.select(F.upper("property_key").alias("property_key"), "default_value")
    value = F.coalesce(F.nullif(F.col("property_value"), F.lit("")), F.col("default_value"))
    return wanted.join(settings, "property_key", "left").select(
        "property_key", value.alias("property_value")
    )


def due_pipelines(pipelines: DataFrame, schedules: DataFrame, now: datetime) -> DataFrame:
    """Active pipelines whose active schedule has no next run, or one that has come.

    Moments without a zone count as UTC.
    """
    moment = utc_literal(now, schedules.schema["NEXTRUN"].dataType)
    work = pipelines.filter(is_active(F.col("ACTIVE"))).select("PIPELINEID", "LAYERID", "CRONID")
    plan = schedules.filter(is_active(F.col("ACTIVE"))).select(
        "CRONID", "CRONEXPRESSION", "TIMEZONE", "NEXTRUN"
    )
    due = F.col("NEXTRUN").isNull() | (F.col("NEXTRUN") <= moment)
    return work.join(plan.filter(due), "CRONID")


def attach_lookup(
    df: DataFrame,
    lookup: DataFrame,
    domain: str,
    id_column: str,
    output: str,
    default: str | None = None,
) -> DataFrame:
    """Add the text of an id within one lookup domain; unknown ids get the default."""
    codes = lookup.filter(F.col("LOOKUPNAME") == domain)
    codes = codes.groupBy(F.col("LOOKUPID").cast("string").alias("__code")).agg(
        F.max("LOOKUPVALUE").alias("__text")
    )
    value = F.col("__text") if default is None else F.coalesce("__text", F.lit(default))
    joined = df.join(codes, F.col(id_column).cast("string") == F.col("__code"), "left")
    return joined.withColumn(output, value).drop("__code", "__text")


def attach_status(
    df: DataFrame, status: DataFrame, name_column: str, default_id: int
) -> DataFrame:
    """Add STATUSMESSAGEID and STATUSMESSAGENAME by name, or those of the default id."""
    names = keep_latest(
        status.select(
            F.upper("STATUSMESSAGENAME").alias("__name"),
            F.col("STATUSMESSAGEID").cast("bigint").alias("__id"),
            F.col("STATUSMESSAGENAME").alias("__shown"),
        ),
        ["__name"],
    )
    fallback = status.filter(F.col("STATUSMESSAGEID") == default_id).agg(F.first("STATUSMESSAGENAME"))
    joined = df.join(names, F.upper(name_column) == F.col("__name"), "left")
    shown = F.coalesce(F.col("__shown"), fallback.scalar())
    return joined.select(
        *df.columns,
        F.coalesce(F.col("__id"), F.lit(default_id).cast("bigint")).alias("STATUSMESSAGEID"),
        shown.alias("STATUSMESSAGENAME"),
    )


def status_content(status: DataFrame, name: str) -> str | None:
    """Content text of a status name, letter case ignored."""
    row = status.filter(same_name(F.col("STATUSMESSAGENAME"), name)).select("STATUSMESSAGECONTENT").first()
    return row[0] if row else None


def status_name(status: DataFrame, status_id: int) -> str:
    """Name of a status id; an unknown id is an error."""
    row = status.filter(F.col("STATUSMESSAGEID") == status_id).select("STATUSMESSAGENAME").first()
    if row is None:
        raise ValueError(f"no status message has the id {status_id}")
    return row[0]


def transform_rules(rules: DataFrame, pipeline_id: str | int | None = None) -> DataFrame:
    """Active rules of operation type 'transform', for one pipeline or for all."""
    chosen = rules.filter((F.col("OPERATIONTYPE") == "transform") & is_active(F.col("ACTIVE")))
    if pipeline_id is not None:
        chosen = chosen.filter(F.col("PIPELINEID").cast("string") == str(pipeline_id))
    return chosen


def resolve_pipelines(config: Mapping[str, DataFrame]) -> DataFrame:
    """Every pipeline with its source, destination, secrets and lookup texts.

    One joined query for all pipelines. A NULL text marks an id that is unknown.
    """
    lookup, secret = config["LOOKUP"], config["SECRET"]
    secrets = secret.groupBy(F.col("SECRETID").cast("string").alias("__secret")).agg(
        F.max("SECRETKEY").alias("SECRETKEY")
    )

    def with_secret(df: DataFrame, output: str) -> DataFrame:
        if "SECRETID" not in df.columns:
            return df.withColumn(output, F.lit(None).cast("string"))
        joined = df.join(secrets, F.col("SECRETID").cast("string") == F.col("__secret"), "left")
        return joined.withColumn(output, F.col("SECRETKEY")).drop("__secret", "SECRETKEY")

    sources = with_secret(config["SOURCE"], "SOURCE_SECRET_KEY")
    sources = attach_lookup(sources, lookup, "SourceType", "SOURCETYPEID", "SOURCE_TYPE")
    sources = attach_lookup(sources, lookup, "FormatType", "FORMATTYPEID", "FORMAT_TYPE")
    source_names = ("SOURCEID", "SOURCENAME", "SOURCEPATH", "SOURCE_TYPE", "FORMAT_TYPE", "SOURCE_SECRET_KEY")

    targets = with_secret(config["DESTINATION"], "TARGET_SECRET_KEY")
    scd = next((c for c in ("SCDTYPE", "SCDTYPEID") if c in targets.columns), None)
    if scd is None:
        targets = targets.withColumn("SCD_TYPE", F.lit(DEFAULT_SCD[1]))
    else:
        targets = attach_lookup(targets, lookup, "ScdType", scd, "SCD_TYPE", DEFAULT_SCD[1])
    target_names = ("DESTINATIONID", "DESTINATIONNAME", "DESTINATIONPATH", "SCD_TYPE", "TARGET_SECRET_KEY")

    rows = config["PIPELINE"]
    rows = attach_lookup(rows, lookup, "LoadType", "LOADTYPEID", "LOAD_TYPE")
    rows = attach_lookup(rows, lookup, "Layer", "LAYERID", "LAYER")
    rows = rows.join(sources.select(*source_names), "SOURCEID", "left")
    return rows.join(targets.select(*target_names), "DESTINATIONID", "left")
