"""Metadata joins."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from feedloom.functions.names import qualified_name, source_name, target_name
from feedloom.functions.predicates import custom_query_text
from feedloom.operators.metadata import (
    attach_lookup,
    attach_status,
    due_pipelines,
    overlay_defaults,
    resolve_mappings,
    resolve_pipelines,
    resolve_properties,
    system_properties,
)
from feedloom.queries import register, table
from feedloom.queries.checking import config_tables


@register(
    """
    SELECT o_custkey AS "DESTINATIONID", p_name AS "SOURCECOLUMNNAME", o_orderpriority AS "DESTINATIONCOLUMNNAME",
           o_orderstatus AS "DESTINATIONCOLUMNDATATYPE", o_orderkey % 50 AS "DESTINATIONCOLUMNSEQUENCE"
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey
    """
)
def mapping_resolve(spark, sf_dir):
    """Destination columns to source columns through the mapping; lineitem links the two."""
    return resolve_mappings(
        table(spark, sf_dir, "orders").selectExpr(
            "o_orderkey AS DESTINATIONCOLUMNID", "o_custkey AS DESTINATIONID",
            "o_orderpriority AS DESTINATIONCOLUMNNAME", "o_orderstatus AS DESTINATIONCOLUMNDATATYPE",
            "o_orderkey % 50 AS DESTINATIONCOLUMNSEQUENCE",
        ),
        table(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS DESTINATIONCOLUMNID", "l_partkey AS SOURCECOLUMNID"),
        table(spark, sf_dir, "part").selectExpr("p_partkey AS SOURCECOLUMNID", "p_name AS SOURCECOLUMNNAME"),
    )


@register(
    """
    SELECT l_suppkey AS "PIPELINEID", lower(p_brand) AS property_key, p_type AS property_value
    FROM lineitem JOIN part ON l_partkey = p_partkey
    QUALIFY row_number() OVER (
      PARTITION BY l_suppkey, lower(p_brand) ORDER BY p_partkey DESC, p_type DESC) = 1
    """
)
def property_resolve(spark, sf_dir):
    """Key/value settings, keys in lower case, the highest id winning."""
    return resolve_properties(
        table(spark, sf_dir, "lineitem").selectExpr("l_suppkey AS PIPELINEID", "l_partkey AS PROPERTYID"),
        table(spark, sf_dir, "part").selectExpr(
            "p_partkey AS PROPERTYID", "p_brand AS PROPERTYNAME", "p_type AS PROPERTYVALUE"
        ),
    )


@register(
    """
    SELECT upper(c_name) AS property_key,
           CASE WHEN c_acctbal > 0 AND c_custkey % 10 <> 0 THEN c_mktsegment ELSE 'none' END AS property_value
    FROM customer
    """
)
def settings_overlay(spark, sf_dir):
    """Active settings over defaults; an empty setting gives way to the default."""
    customer = table(spark, sf_dir, "customer")
    settings = customer.selectExpr(
        "lower(c_name) AS PROPERTYKEY", "if(c_custkey % 10 = 0, '', c_mktsegment) AS PROPERTYVALUE",
        "c_acctbal > 0 AS ACTIVE",
    )
    defaults = customer.selectExpr("c_name AS property_key", "'none' AS default_value")
    return overlay_defaults(system_properties(settings), defaults)


@register(
    """
    SELECT s_suppkey AS "CRONID", c_custkey AS "PIPELINEID", c_nationkey AS "LAYERID",
           s_name AS "CRONEXPRESSION", 'UTC' AS "TIMEZONE",
           CASE WHEN s_suppkey % 4 <> 0
                THEN TIMESTAMP '2024-01-01' + to_days(CAST(s_suppkey % 28 AS INTEGER)) END AS "NEXTRUN"
    FROM customer JOIN supplier ON c_custkey % 100 = s_suppkey
    WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND s_nationkey <> 3
      AND (s_suppkey % 4 = 0 OR s_suppkey % 28 <= 14)
    """
)
def due_selection(spark, sf_dir):
    """Active work whose active schedule has come, or has no next run."""
    pipelines = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS PIPELINEID", "c_nationkey AS LAYERID", "c_custkey % 100 AS CRONID",
        "decode(c_mktsegment, 'BUILDING', 'Y', 'MACHINERY', ' true', 'FURNITURE', 'n') AS ACTIVE",
    )
    schedules = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS CRONID", "s_name AS CRONEXPRESSION", "'UTC' AS TIMEZONE",
        "if(s_suppkey % 4 <> 0, timestampadd(DAY, int(s_suppkey % 28), timestamp_ntz'2024-01-01'), NULL) AS NEXTRUN",
        "s_nationkey <> 3 AS ACTIVE",
    )
    return due_pipelines(pipelines, schedules, datetime(2024, 1, 15))


@register(
    """
    SELECT c_custkey, c.n_name AS nation_text, coalesce(r.r_name, 'NONE') AS region_text
    FROM customer
    LEFT JOIN nation c ON c.n_nationkey = c_nationkey AND c.n_nationkey % 4 <> 0
    LEFT JOIN region r ON r.r_regionkey = c_nationkey
    """
)
def lookup_join_default(spark, sf_dir):
    """The text of an id in a domain; one domain has a default for unknown ids."""
    codes = (
        table(spark, sf_dir, "nation")
        .selectExpr(
            "n_nationkey AS LOOKUPID", "if(n_nationkey % 4 = 0, 'Other', 'Nation') AS LOOKUPNAME",
            "n_name AS LOOKUPVALUE",
        )
        .unionByName(
            table(spark, sf_dir, "region").selectExpr(
                "r_regionkey AS LOOKUPID", "'Region' AS LOOKUPNAME", "r_name AS LOOKUPVALUE"
            )
        )
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    named = attach_lookup(customer, codes, "Nation", "c_nationkey", "nation_text")
    return attach_lookup(named, codes, "Region", "c_nationkey", "region_text", "NONE").drop("c_nationkey")


@register(
    """
    SELECT event_id, CAST(coalesce(n_nationkey, 4) AS BIGINT) AS "STATUSMESSAGEID",
           coalesce(n_name, (SELECT n_name FROM nation WHERE n_nationkey = 4)) AS "STATUSMESSAGENAME"
    FROM events LEFT JOIN nation ON n_nationkey = event_id % 40
    """
)
def status_default(spark, sf_dir):
    """A status by name, letter case ignored; an unknown name gets the default id."""
    status = table(spark, sf_dir, "nation").selectExpr(
        "bigint(n_nationkey) AS STATUSMESSAGEID", "n_name AS STATUSMESSAGENAME"
    )
    names = status.selectExpr("STATUSMESSAGEID AS id", "lower(STATUSMESSAGENAME) AS wanted")
    events = table(spark, sf_dir, "events").selectExpr("event_id", "event_id % 40 AS id")
    asked = events.join(names, "id", "left").select("event_id", "wanted")
    return attach_status(asked, status, "wanted", 4).drop("wanted")


@register(
    """
    SELECT c_custkey AS "PIPELINEID", l.n_name AS "LOAD_TYPE",
           CASE WHEN s_suppkey % 5 = 0 THEN '' WHEN s_suppkey IS NOT NULL THEN 'in/a.csv' END AS "SOURCEPATH",
           CASE WHEN s_suppkey % 3 = 2 THEN '  ' WHEN s_suppkey IS NOT NULL THEN 'key' END AS "SOURCE_SECRET_KEY",
           CASE WHEN p_partkey IS NOT NULL THEN 'NONE' END AS "SCD_TYPE",
           CASE WHEN p_size <> 1 THEN 'db.t' END AS "DESTINATIONPATH"
    FROM customer
    LEFT JOIN nation l ON l.n_nationkey = c_nationkey AND l.n_nationkey % 8 <> 0 AND c_custkey % 11 <> 0
    LEFT JOIN supplier ON s_suppkey = c_custkey % 120
    LEFT JOIN part ON p_partkey = c_custkey AND c_custkey % 17 <> 0
    """
)
def config_resolve(spark, sf_dir):
    """All pipelines with their source, destination, secret and lookup texts in one query."""
    resolved = resolve_pipelines(config_tables(spark, sf_dir))
    return resolved.select(
        "PIPELINEID", "LOAD_TYPE", "SOURCEPATH", "SOURCE_SECRET_KEY", "SCD_TYPE", "DESTINATIONPATH"
    )


_PATH = "regexp_replace(regexp_replace(url, '^[a-z]+://', ''), '[?#].*$', '')"


@register(
    rf"""
    WITH names AS (
      SELECT page_id, {_PATH} AS path,
             CASE page_id % 4 WHEN 0 THEN 't' || page_id WHEN 1 THEN 's.t' || page_id
                              WHEN 2 THEN 'd.s.t' || page_id ELSE 'a.d.s.t' || page_id END AS name
      FROM pages)
    SELECT page_id,
           regexp_extract(path, '([^/]*)$', 1) AS source_table,
           CASE page_id % 4 WHEN 0 THEN '' WHEN 1 THEN 's' ELSE 's' END AS target_schema,
           CASE page_id % 4 WHEN 0 THEN '' ELSE 't' || page_id END AS target_table,
           CASE page_id % 4 WHEN 2 THEN 'D' ELSE 'MAIN' END AS name_database,
           CASE page_id % 4 WHEN 1 THEN 'S' WHEN 2 THEN 'S' ELSE 'PUBLIC' END AS name_schema,
           CASE page_id % 4 WHEN 3 THEN 'A' ELSE 'T' || page_id END AS name_table,
           CASE page_id % 4 WHEN 0 THEN NULL ELSE name END AS query
    FROM names
    """
)
def name_parse_urls(spark, sf_dir):
    """Paths and names of one to four parts, taken apart."""
    key = F.col("page_id")
    path = F.regexp_replace(F.regexp_replace("url", r"^[a-z]+://", ""), r"[?#].*$", "")
    lead = F.when(key % 4 == 0, "t").when(key % 4 == 1, "s.t").when(key % 4 == 2, "d.s.t").otherwise("a.d.s.t")
    named = table(spark, sf_dir, "pages").select(
        "page_id", path.alias("path"), F.concat(lead, key.cast("string")).alias("name")
    )
    target, full = target_name(F.col("name")), qualified_name(F.col("name"), "main", "public")
    return named.select(
        "page_id",
        source_name(F.col("path"))["table"].alias("source_table"),
        target["schema"].alias("target_schema"),
        target["table"].alias("target_table"),
        full["database"].alias("name_database"),
        full["schema"].alias("name_schema"),
        full["table"].alias("name_table"),
        custom_query_text(F.when(key % 4 == 0, " Null ").otherwise(F.col("name"))).alias("query"),
    )
