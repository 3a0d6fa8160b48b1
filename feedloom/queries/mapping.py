"""Mapping projection, casts, deduplication, and a whole feed."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.operators.dedupe import keep_latest
from feedloom.operators.project import project, prune
from feedloom.plans.feed import feed_rows
from feedloom.queries import register, table
from feedloom.specs import ColumnMapping, FeedSpec, LoadSpec, Rule, SourceSpec


def mappings(*rows: tuple[str, str, str]) -> tuple[ColumnMapping, ...]:
    return tuple(ColumnMapping(s, t, kind, i + 1) for i, (s, t, kind) in enumerate(rows))


LINEITEM = mappings(
    ("L_ORDERKEY", "order_id", "BIGINT"),
    ("L_LINENUMBER", "line_no", "INT"),
    ("L_SHIPDATE", "shipped", "TIMESTAMP_NTZ"),
    ("L_QUANTITY", "quantity", "FLOAT"),
    ("L_EXTENDEDPRICE", "price", "DOUBLE"),
    ("L_TAX", "tax", "DOUBLE"),
    ("L_RETURNFLAG", "return_flag", "VARCHAR(1)"),
)


@register(
    """
    WITH latest AS (
      SELECT * FROM lineitem
      QUALIFY row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC NULLS LAST, l_quantity DESC NULLS LAST,
                 l_extendedprice DESC NULLS LAST, l_tax DESC NULLS LAST,
                 l_returnflag DESC NULLS LAST) = 1)
    SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_shipdate AS shipped,
           l_quantity AS quantity, round(l_extendedprice) AS price, l_tax AS tax,
           lower(l_returnflag) AS return_flag, l_quantity + l_linenumber AS total
    FROM latest
    """
)
def ingest_lineitem(spark, sf_dir):
    """A whole feed: scan, mapping, one row per key, rules."""
    spec = FeedSpec(
        feed_id="lineitem",
        name="lineitem",
        source=SourceSpec("parquet", f"{sf_dir}/lineitem.parquet"),
        mappings=LINEITEM,
        load=LoadSpec("full", "lineitem", ("order_id", "line_no"), "shipped"),
        rules=(
            Rule.parse("sum", "quantity,line_no", "total", seq=1),
            Rule.parse("round:0", "price", seq=2),
            Rule.parse("lower", "return_flag", seq=3),
        ),
    )
    return feed_rows(spark, spec)


@register(
    """
    SELECT o_orderkey AS order_id, CAST(o_custkey AS INTEGER) AS customer_id,
           o_orderstatus AS status, CAST(o_totalprice AS DECIMAL(12,2)) AS price,
           CAST(o_orderdate AS DATE) AS ordered_on, o_orderdate AS ordered_at,
           strftime(o_orderdate, '%H:%M:%S') AS ordered_time,
           CAST(NULL AS VARCHAR) AS comment, CAST(NULL AS BIGINT) AS clerk_id
    FROM orders
    """
)
def map_project_orders(spark, sf_dir):
    """Source names in any letter case; columns the data lacks become typed NULLs."""
    return project(
        table(spark, sf_dir, "orders"),
        mappings(
            ("O_OrderKey", "order_id", "BIGINT"),
            ("o_custkey", "customer_id", "INT"),
            ("O_ORDERSTATUS", "status", "VARCHAR(1)"),
            ("O_TOTALPRICE", "price", "NUMBER(12,2)"),
            ("O_ORDERDATE", "ordered_on", "DATE"),
            ("O_ORDERDATE", "ordered_at", "TIMESTAMP_NTZ"),
            ("O_ORDERDATE", "ordered_time", "TIME"),
            ("O_COMMENT", "comment", "VARCHAR"),
            ("O_CLERK", "clerk_id", "BIGINT"),
        ),
    )


@register(
    """
    SELECT CAST(l_orderkey AS INTEGER) AS order_id, CAST(l_partkey AS VARCHAR) AS part_id,
           l_quantity AS quantity, l_shipdate AS shipped, CAST(l_linenumber AS INTEGER) AS line_no,
           l_tax > 0.04 AS taxed, CAST(l_tax > 0.04 AS VARCHAR) AS taxed_text
    FROM lineitem
    """
)
def map_project_legacy(spark, sf_dir):
    """The substring type table: wide integers narrowed, dates as timestamps, NUMBER as text."""
    lines = table(spark, sf_dir, "lineitem").withColumn("taxed", F.col("l_tax") > 0.04)
    done = project(
        lines,
        mappings(
            ("l_orderkey", "order_id", "BIGINT"),
            ("l_partkey", "part_id", "NUMBER(38,0)"),
            ("l_quantity", "quantity", "DECIMAL(12,4)"),
            ("l_shipdate", "shipped", "DATE"),
            ("l_linenumber", "line_no", "POINT"),
            ("taxed", "taxed", "BOOLEAN"),
            ("taxed", "taxed_text", "BOOL"),
        ),
        legacy_types=True,
    )
    return done.withColumn("shipped", F.col("shipped").cast("timestamp_ntz"))


@register(
    """
    WITH texts AS (
      SELECT doc_id, CASE doc_id % 8
               WHEN 0 THEN CAST(n_chars AS VARCHAR)
               WHEN 1 THEN n_chars || '.5'
               WHEN 2 THEN '-' || n_chars || '.25'
               WHEN 3 THEN text
               WHEN 4 THEN ''
               WHEN 5 THEN '2024-03-05 01:02:03'
               WHEN 6 THEN 'Yes'
               ELSE ' ' || n_chars || ' ' END AS v
      FROM documents)
    SELECT doc_id, CAST(trunc(TRY_CAST(v AS DOUBLE)) AS INTEGER) AS v_int,
           CAST(trunc(TRY_CAST(v AS DOUBLE)) AS BIGINT) AS v_bigint,
           TRY_CAST(v AS DOUBLE) AS v_double,
           CASE WHEN lower(trim(v)) IN ('t', 'true', 'y', 'yes', '1') THEN TRUE
                WHEN lower(trim(v)) IN ('f', 'false', 'n', 'no', '0') THEN FALSE END AS v_bool,
           CASE WHEN doc_id % 8 = 5 THEN DATE '2024-03-05' END AS v_date,
           CASE WHEN doc_id % 8 = 5 THEN TIMESTAMP '2024-03-05 01:02:03' END AS v_ts,
           v AS v_text
    FROM texts
    """
)
def lenient_cast_docs(spark, sf_dir):
    """Casts of text: what cannot be read becomes NULL."""
    n, kind = F.col("n_chars").cast("string"), F.col("doc_id") % 8
    text = (
        F.when(kind == 0, n)
        .when(kind == 1, F.concat(n, F.lit(".5")))
        .when(kind == 2, F.concat(F.lit("-"), n, F.lit(".25")))
        .when(kind == 3, F.col("text"))
        .when(kind == 4, "")
        .when(kind == 5, "2024-03-05 01:02:03")
        .when(kind == 6, "Yes")
        .otherwise(F.concat(F.lit(" "), n, F.lit(" ")))
    )
    texts = table(spark, sf_dir, "documents").select("doc_id", text.alias("v"))
    # Only full dates: Spark also reads a bare number such as '2024' as a year.
    dated = F.when(F.col("doc_id") % 8 >= 3, F.col("v"))
    dated = F.when(F.col("doc_id") % 8 != 7, dated)
    return project(
        texts.withColumn("d", dated),
        mappings(
            ("doc_id", "doc_id", "BIGINT"),
            ("v", "v_int", "INT"),
            ("v", "v_bigint", "BIGINT"),
            ("v", "v_double", "FLOAT"),
            ("v", "v_bool", "BOOLEAN"),
            ("d", "v_date", "DATE"),
            ("d", "v_ts", "TIMESTAMP_NTZ"),
            ("v", "v_text", "VARIANT"),
        ),
    )


@register(
    """
    SELECT * FROM lineitem
    QUALIFY row_number() OVER (
      PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
               l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
               l_linestatus DESC) = 1
    """
)
def dedupe_lineitem_latest(spark, sf_dir):
    """One row per key, the latest; ties broken by all other columns."""
    return keep_latest(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@register("SELECT doc_id % 500 AS bucket, text, lang, source, n_chars FROM documents GROUP BY ALL")
def distinct_documents(spark, sf_dir):
    """Without a key, whole rows are compared: every row is there twice."""
    documents = table(spark, sf_dir, "documents").withColumn("bucket", F.col("doc_id") % 500).drop("doc_id")
    return keep_latest(documents.union(documents), [])


@register("SELECT c_acctbal, c_custkey, c_mktsegment FROM customer")
def pruned_scan_customer(spark, sf_dir):
    """Mapped columns and the always kept one, sorted by name."""
    return prune(table(spark, sf_dir, "customer"), ["c_mktsegment", " c_acctbal "], "c_custkey")
