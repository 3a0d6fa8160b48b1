"""Validation findings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.operators.checks import (
    check_active,
    check_domain,
    check_reference,
    check_required,
    distinct_messages,
    referenced_rows,
    validate_config,
)
from feedloom.queries import register, table

_REQUIRED = "in DOCUMENT table is mandatory; empty values are not permitted."


def _documents(spark, sf_dir) -> DataFrame:
    """Documents with some blank fields and a flag in several spellings."""
    key = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(key % 5 == 0, " ").when(key % 5 == 1, None).otherwise(F.col("source")).alias("source"),
        F.when(key % 7 == 0, "").otherwise(F.col("lang")).alias("lang"),
        F.when(key % 4 == 0, " YES ").when(key % 4 == 1, "0").when(key % 4 == 2, "true").alias("ACTIVE"),
    )


@register(
    f"""
    SELECT 'DOCUMENT' AS table_name, CAST(doc_id AS VARCHAR) AS row_key, 'source' AS column_name,
           'source {_REQUIRED}' AS message FROM documents WHERE doc_id % 5 < 2
    UNION ALL
    SELECT 'DOCUMENT', CAST(doc_id AS VARCHAR), 'lang', 'lang {_REQUIRED}' FROM documents WHERE doc_id % 7 = 0
    UNION ALL
    SELECT 'DOCUMENT', CAST(doc_id AS VARCHAR), 'owner', 'owner {_REQUIRED}' FROM documents
    UNION ALL
    SELECT 'DOCUMENT', CAST(doc_id AS VARCHAR), 'ACTIVE',
           'The values in the ACTIVE column of the DOCUMENT table are not set to active.'
    FROM documents WHERE doc_id % 4 IN (1, 3)
    """
)
def check_required_docs(spark, sf_dir):
    """Blank required fields, an absent column, rows that are not active."""
    documents = _documents(spark, sf_dir)
    required = check_required(documents, "DOCUMENT", "doc_id", ["source", "lang", "owner"])
    return required.unionByName(check_active(documents, "DOCUMENT", "doc_id"))


@register(
    f"""
    SELECT 'DOCUMENT' AS table_name, name || ' {_REQUIRED}' AS message
    FROM (SELECT DISTINCT 'source' AS name FROM documents WHERE doc_id % 5 < 2
          UNION SELECT DISTINCT 'lang' FROM documents WHERE doc_id % 7 = 0)
    """
)
def check_messages(spark, sf_dir):
    """Each message once, however many rows give it."""
    return distinct_messages(check_required(_documents(spark, sf_dir), "DOCUMENT", "doc_id", ["source", "lang"]))


@register(
    """
    SELECT 'ORDERS' AS table_name, CAST(o_custkey AS VARCHAR) AS row_key, 'o_custkey' AS column_name,
           'Invalid o_custkey=' || o_custkey AS message, count(*) AS row_count
    FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
    GROUP BY o_custkey
    """
)
def check_fk(spark, sf_dir):
    """Ids that no parent row has: customers in debt are taken out of the parents."""
    parents = table(spark, sf_dir, "customer").filter("c_acctbal > 0")
    return check_reference(table(spark, sf_dir, "orders"), "ORDERS", "o_custkey", parents, "c_custkey")


@register("SELECT * FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def check_reachable(spark, sf_dir):
    """The rows that other rows refer to."""
    pending = table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'")
    return referenced_rows(table(spark, sf_dir, "customer"), "c_custkey", pending, "o_custkey")


@register(
    """
    SELECT 'EVENTS' AS table_name, CAST(event_id AS VARCHAR) AS row_key, 'event_type' AS column_name,
           'Unsupported event_type in EVENTS.' AS message
    FROM events WHERE event_type NOT IN ('view', 'click', 'signup')
    """
)
def check_allowed(spark, sf_dir):
    """Values outside the allowed ones."""
    events = table(spark, sf_dir, "events")
    return check_domain(events, "EVENTS", "event_id", "event_type", ["VIEW", "click", "signup"])


def config_tables(spark, sf_dir) -> dict[str, DataFrame]:
    """Configuration tables made of business tables, with flaws spread over them."""

    def of(name: str, *columns: str) -> DataFrame:
        return table(spark, sf_dir, name).selectExpr(*columns)

    return {
        "PIPELINE": of(
            "customer", "c_custkey AS PIPELINEID", "if(c_custkey % 7 = 0, ' ', c_name) AS PIPELINENAME",
            "c_custkey % 120 AS SOURCEID", "if(c_custkey % 17 = 0, -5, c_custkey) AS DESTINATIONID",
            "if(c_custkey % 11 = 0, NULL, c_nationkey) AS LOADTYPEID", "c_nationkey + 1 AS LAYERID",
        ),
        "SOURCE": of(
            "supplier", "s_suppkey AS SOURCEID", "s_name AS SOURCENAME",
            "if(s_suppkey % 5 = 0, '', 'in/a.csv') AS SOURCEPATH", "s_nationkey AS SOURCETYPEID",
            "7 AS FORMATTYPEID", "s_suppkey % 3 AS SECRETID", "s_suppkey % 4 <> 0 AS ACTIVE",
        ),
        "DESTINATION": of(
            "part", "p_partkey AS DESTINATIONID", "p_name AS DESTINATIONNAME",
            "if(p_size = 1, NULL, 'db.t') AS DESTINATIONPATH", "1 AS DESTINATIONTYPEID",
            "8 AS FORMATTYPEID", "if(p_partkey % 6 = 0, 'N', 'y') AS ACTIVE",
        ),
        "LOOKUP": of(
            "nation", "n_nationkey AS LOOKUPID", "if(n_nationkey % 8 = 0, NULL, 'LoadType') AS LOOKUPNAME",
            "n_name AS LOOKUPVALUE", "if(n_nationkey % 9 = 0, 'no', 'TRUE') AS ACTIVE",
        ),
        "SECRET": of(
            "region", "r_regionkey AS SECRETID", "r_name AS SECRETNAME",
            "if(r_regionkey = 2, '  ', 'key') AS SECRETKEY", "r_regionkey <> 1 AS ACTIVE",
        ),
        "DESTINATIONCOLUMN": of(
            "orders", "o_orderkey AS DESTINATIONCOLUMNID", "o_custkey AS DESTINATIONID",
            "if(o_orderkey % 97 = 0, '', 'c') AS DESTINATIONCOLUMNNAME", "1 AS DESTINATIONCOLUMNSEQUENCE",
            "o_orderpriority AS DESTINATIONCOLUMNDATATYPE", "o_orderkey % 101 <> 0 AS ACTIVE",
        ),
        "COLUMNMAPPING": of(
            "lineitem", "l_orderkey AS DESTINATIONCOLUMNID", "l_partkey AS SOURCECOLUMNID",
            "l_orderkey % 103 <> 0 AS ACTIVE",
        ),
        "SOURCECOLUMN": of(
            "part", "p_partkey AS SOURCECOLUMNID", "p_name AS SOURCECOLUMNNAME",
            "if(p_partkey % 107 = 0, NULL, p_size) AS SOURCECOLUMNSEQUENCE",
            "p_type AS SOURCECOLUMNDATATYPE", "p_partkey % 109 <> 0 AS ACTIVE",
        ),
    }


def _message(column: str, table_name: str) -> str:
    return f"'{column} in {table_name} table is mandatory; empty values are not permitted.'"


def _inactive(table_name: str) -> str:
    return f"'The values in the ACTIVE column of the {table_name} table are not set to active.'"


@register(
    f"""
    WITH pipe AS (
      SELECT CAST(c_custkey AS VARCHAR) AS pipeline_id, c_custkey AS id, c_custkey % 120 AS src,
             CASE WHEN c_custkey % 17 = 0 THEN -5 ELSE c_custkey END AS dst, CASE WHEN c_custkey % 11 <> 0 THEN c_nationkey END AS load_type,
             c_nationkey + 1 AS layer
      FROM customer),
    src AS (SELECT s_suppkey AS id, s_nationkey AS kind, s_suppkey % 3 AS secret FROM supplier),
    dst AS (SELECT p_partkey AS id, p_size FROM part),
    used AS (
      SELECT pipeline_id, load_type AS id FROM pipe UNION SELECT pipeline_id, layer FROM pipe
      UNION SELECT pipeline_id, kind FROM pipe JOIN src ON src = src.id
      UNION SELECT pipeline_id, 7 FROM pipe JOIN src ON src = src.id
      UNION SELECT pipeline_id, 8 FROM pipe JOIN dst ON dst = dst.id),
    dcol AS (SELECT o_orderkey AS id, o_custkey AS dst FROM orders),
    cmap AS (SELECT DISTINCT l_orderkey AS col, l_partkey AS src FROM lineitem)
    SELECT DISTINCT pipeline_id, message FROM (
      SELECT pipeline_id, {_message('PIPELINENAME', 'PIPELINE')} AS message FROM pipe WHERE id % 7 = 0
      UNION ALL SELECT pipeline_id, {_message('LOADTYPEID', 'PIPELINE')} FROM pipe WHERE load_type IS NULL
      UNION ALL SELECT pipeline_id, {_message('SOURCEID', 'SOURCE')} FROM pipe
                WHERE src NOT IN (SELECT id FROM src)
      UNION ALL SELECT pipeline_id, {_message('SOURCEPATH', 'SOURCE')} FROM pipe JOIN src ON src = src.id
                WHERE src.id % 5 = 0
      UNION ALL SELECT pipeline_id, {_inactive('SOURCE')} FROM pipe JOIN src ON src = src.id WHERE src.id % 4 = 0
      UNION ALL SELECT pipeline_id, {_message('DESTINATIONID', 'DESTINATION')} FROM pipe
                WHERE dst NOT IN (SELECT id FROM dst)
      UNION ALL SELECT pipeline_id, {_message('DESTINATIONPATH', 'DESTINATION')} FROM pipe
                JOIN dst ON dst = dst.id WHERE p_size = 1
      UNION ALL SELECT pipeline_id, {_inactive('DESTINATION')} FROM pipe JOIN dst ON dst = dst.id
                WHERE dst.id % 6 = 0
      UNION ALL SELECT pipeline_id, {_message('LOOKUPNAME', 'LOOKUP')} FROM used JOIN nation ON id = n_nationkey
                WHERE n_nationkey % 8 = 0
      UNION ALL SELECT pipeline_id, {_inactive('LOOKUP')} FROM used JOIN nation ON id = n_nationkey
                WHERE n_nationkey % 9 = 0
      UNION ALL SELECT pipeline_id, {_message('SECRETKEY', 'Secret')} FROM pipe JOIN src ON src = src.id
                WHERE secret = 2
      UNION ALL SELECT pipeline_id, {_inactive('Secret')} FROM pipe JOIN src ON src = src.id WHERE secret = 1
      UNION ALL SELECT pipeline_id, {_message('DESTINATIONCOLUMNNAME', 'DESTINATIONCOLUMN')} FROM pipe
                JOIN dcol USING (dst) WHERE dcol.id % 97 = 0
      UNION ALL SELECT pipeline_id, {_inactive('DESTINATIONCOLUMN')} FROM pipe JOIN dcol USING (dst)
                WHERE dcol.id % 101 = 0
      UNION ALL SELECT pipeline_id, {_inactive('COLUMNMAPPING')} FROM pipe JOIN dcol USING (dst)
                JOIN cmap ON dcol.id = cmap.col WHERE cmap.col % 103 = 0
      UNION ALL SELECT pipeline_id, {_message('SOURCECOLUMNSEQUENCE', 'SOURCECOLUMN')} FROM pipe
                JOIN dcol USING (dst) JOIN cmap ON dcol.id = cmap.col
                JOIN part ON cmap.src = p_partkey WHERE p_partkey % 107 = 0
      UNION ALL SELECT pipeline_id, {_inactive('SOURCECOLUMN')} FROM pipe
                JOIN dcol USING (dst) JOIN cmap ON dcol.id = cmap.col
                JOIN part ON cmap.src = p_partkey WHERE p_partkey % 109 = 0)
    UNION ALL
    SELECT CAST(s_suppkey + 100000000 AS VARCHAR), {_message('PIPELINEID', 'PIPELINE')} FROM supplier
    """
)
def check_config(spark, sf_dir):
    """All findings of all pipelines at once, and ids that are no pipeline."""
    config = config_tables(spark, sf_dir)
    unknown = table(spark, sf_dir, "supplier").selectExpr("s_suppkey + 100000000 AS PIPELINEID")
    asked = reduce(DataFrame.unionByName, [config["PIPELINE"].select("PIPELINEID"), unknown])
    return validate_config(config, asked)
