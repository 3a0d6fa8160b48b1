"""Sources, read from files that Spark derives from the tables."""

from __future__ import annotations

import io
import sys
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F

from feedloom.operators.nested import normalize
from feedloom.queries import register, table
from feedloom.session import shared_folder
from feedloom.sources.documents import body_rows, scan_json, scan_pages
from feedloom.sources.files import scan_delimited, scan_parquet, scan_query, union_by_name
from feedloom.sources.scan import scan
from feedloom.sources.workbooks import workbook_rows
from feedloom.specs import MISSING_WORDS, ColumnMapping, ReadOptions, SourceSpec

# The workbook functions travel with the tasks, so workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_MISSING = ", ".join(f"'{word}'" for word in MISSING_WORDS)


def _cell(column: str) -> str:
    return f"CASE WHEN {column} NOT IN ({_MISSING}) THEN {column} END AS {column}"


_DOCUMENTS = f"""
    SELECT CAST(doc_id AS VARCHAR) AS doc_id, {_cell('text')}, {_cell('lang')},
           CASE WHEN doc_id % 3 <> 0 THEN source END AS source
    FROM documents
"""


def _round_trip(spark, sf_dir, separator: str):
    """Write documents as separated text, then scan that."""
    path = shared_folder(spark, "delimited")
    source = F.when(F.col("doc_id") % 3 != 0, F.col("source")).alias("source")
    rows = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", source)
    rows.write.csv(
        path,
        sep=separator,
        header=True,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    options = ReadOptions.from_properties(
        {"Delimiter": separator, "SkipHeader": "1", "QuoteChar": '"', "Pattern": "*.csv"}
    )
    return scan_delimited(spark, path, options, ["doc_id", "text", "lang", "source"])


@register(_DOCUMENTS)
def csv_roundtrip(spark, sf_dir):
    """Whole texts with quotes, separators and line breaks in them."""
    return _round_trip(spark, sf_dir, ",")


@register(_DOCUMENTS)
def psv_roundtrip(spark, sf_dir):
    return _round_trip(spark, sf_dir, "|")


@register("SELECT CAST(item_id AS VARCHAR) AS item, trim(line) AS line FROM ("
          "SELECT item_id, unnest(string_split(replace(text, '. ', '.' || chr(10)), chr(10))) AS line FROM benchmark)"
          " WHERE trim(line) <> ''")
def csv_quoted_lines(spark, sf_dir):
    """Cells of several lines in one large file, cut into records by many tasks."""
    path = shared_folder(spark, "quoted")
    lines = F.regexp_replace("text", r"\. ", ".\n")
    table(spark, sf_dir, "benchmark").select("item_id", lines.alias("text")).coalesce(1).write.csv(path, header=True, escape='"')
    found = scan_delimited(spark, path, ReadOptions(pattern="*.csv", missing_words=()))
    line = F.explode(F.split("text", "\n"))
    return found.select(F.col("item_id").alias("item"), line.alias("line")).select("item", F.trim("line").alias("line")).where("line <> ''")


@register(
    """
    SELECT p_partkey AS id, p_name AS name FROM part
    UNION ALL
    SELECT n_nationkey, n_name FROM nation
    """
)
def json_mixed_layouts(spark, sf_dir):
    """A pretty-printed file among files with a document on every line: all rows of both."""
    path = shared_folder(spark, "layouts") + ".json"
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    part.select(F.to_json(F.struct("id", "name"))).write.text(path)
    nation = F.struct(F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("name"))
    pretty = table(spark, sf_dir, "nation").agg(F.to_json(F.collect_list(nation), {"pretty": "true"}))
    pretty.write.mode("append").text(path)
    return scan(spark, SourceSpec("sftp", path, schema="id bigint, name string"))


@register(
    """
    SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_mktsegment AS segment FROM customer
    UNION ALL
    SELECT CAST(s_suppkey AS VARCHAR), s_name, NULL FROM supplier
    """
)
def csv_mixed_columns(spark, sf_dir):
    """Files whose columns differ in order and number are put together by name."""
    path = shared_folder(spark, "columns") + ".csv"
    customer = table(spark, sf_dir, "customer")
    customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")).write.csv(path, header=True)
    supplier = table(spark, sf_dir, "supplier")
    supplier.select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("id")).write.mode("append").csv(path, header=True)
    return scan(spark, SourceSpec("sftp", path)).select("id", "name", "segment")


@register("SELECT p_partkey, p_name, p_retailprice FROM part WHERE p_size > 10")
def parquet_scan(spark, sf_dir):
    """Three columns and one filter reach the scan."""
    rows = scan_parquet(spark, f"{sf_dir}/part.parquet")
    return rows.filter("p_size > 10").select("p_partkey", "p_name", "p_retailprice")


@register(
    """
    SELECT n_name, count(*) AS supplier_count, CAST(max(s_suppkey) AS BIGINT) AS last_supplier
    FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name
    """
)
def query_scan(spark, sf_dir):
    """A query over frames that it names."""
    return scan_query(
        spark,
        "SELECT n_name, count(*) AS supplier_count, max(s_suppkey) AS last_supplier "
        "FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey GROUP BY n_name",
        supplier=table(spark, sf_dir, "supplier"),
        nation=table(spark, sf_dir, "nation"),
    )


@register(
    """
    SELECT CAST(c_custkey AS VARCHAR) AS "RecordId", c_name AS "Name",
           CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS "MktSegment", CAST(NULL AS VARCHAR) AS absent
    FROM customer
    UNION ALL
    SELECT 'n' || c_custkey, NULL, NULL, NULL FROM customer
    """
)
def paged_envelope(spark, sf_dir):
    """Pages of two items each; properties are found by lower-cased name."""
    path = shared_folder(spark, "pages")
    key = F.col("c_custkey").cast("string")
    segment = F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment"))
    known = F.create_map(F.lit("name"), F.col("c_name"), F.lit("mktsegment"), segment)
    items = F.array(
        F.struct(key.alias("id"), known.alias("properties")),
        F.struct(F.concat(F.lit("n"), key).alias("id"), F.lit(None).cast("map<string,string>").alias("properties")),
    )
    paging = F.struct(F.struct(key.alias("after")).alias("next"))
    table(spark, sf_dir, "customer").select(items.alias("results"), paging.alias("paging")).write.json(path)
    return scan_pages(spark, path, ["RecordId", "Name", "MktSegment", "absent"])


@register(
    """
    SELECT o_orderkey AS id, CAST(o_totalprice AS DOUBLE) AS price, CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_custkey AS VARCHAR) ELSE o_orderstatus END AS mixed,
           CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS priority, CAST(NULL AS VARCHAR) AS nothing
    FROM orders
    """
)
def json_types_found(spark, sf_dir):
    """JSON lines without a declared schema: read and parsed once, types found from the parsed rows."""
    path = shared_folder(spark, "lines")
    fields = (
        F.lit('{"id":'), F.col("o_orderkey"), F.lit(',"mixed":'),
        F.when(F.col("o_orderkey") % 2 == 0, F.col("o_custkey").cast("string")).otherwise(F.concat(F.lit('"'), "o_orderstatus", F.lit('"'))),
        F.when(F.col("o_orderkey") % 3 != 0, F.concat(F.lit(',"priority":"'), "o_orderpriority", F.lit('"'))).otherwise(""),
        F.lit(',"nothing":null,"none":{},"price":'), F.col("o_totalprice").cast("decimal(18,2)"), F.lit("}"),
    )
    table(spark, sf_dir, "orders").select(F.concat(*fields)).write.text(path)
    return scan_json(spark, path).select("id", "price", "mixed", "priority", "nothing")


@register(
    """
    SELECT p_partkey AS id, p_name AS name, p_size AS size, part AS part
    FROM part, LATERAL (SELECT unnest(string_split(p_name, ' ')) AS part)
    UNION ALL
    SELECT p_partkey, p_brand, NULL, NULL FROM part
    """
)
def json_documents(spark, sf_dir):
    """JSON files with an array per line, elements of differing shape, made flat."""
    path = shared_folder(spark, "json")
    words = F.transform(F.split("p_name", " "), lambda w: F.struct(w.alias("part")))
    full = F.struct(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_size").alias("size"),
        words.alias("words"),
    )
    brief = F.struct(F.col("p_partkey").alias("id"), F.col("p_brand").alias("name"))
    line = F.concat(F.lit("["), F.to_json(full), F.lit(","), F.to_json(brief), F.lit("]"))
    table(spark, sf_dir, "part").select(line).write.text(path)
    schema = "id bigint, name string, size int, words array<struct<part string>>"
    options = ReadOptions(pattern="*.txt")
    return normalize(scan_json(spark, path, schema, options=options))


@register(
    """
    SELECT s_suppkey AS id, s_name AS name FROM supplier WHERE s_suppkey % 3 = 0
    UNION ALL SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey % 3 = 1
    UNION ALL SELECT s_suppkey + 1, NULL FROM supplier WHERE s_suppkey % 3 = 1
    """
)
def api_body_rows(spark, sf_dir):
    """Bodies that are one object, an array of objects, or no JSON at all."""
    key = F.col("s_suppkey")
    one = F.to_json(F.struct(key.alias("id"), F.col("s_name").alias("name")))
    two = F.concat(F.lit("["), one, F.lit(","), F.to_json(F.struct((key + 1).alias("id"))), F.lit("]"))
    body = F.when(key % 3 == 0, one).when(key % 3 == 1, two).otherwise(F.concat(F.lit("error "), "s_name"))
    bodies = table(spark, sf_dir, "supplier").select(body.alias("body"))
    return normalize(body_rows(bodies, "body", "id bigint, name string"))


@register(
    """
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name AS c_name,
           CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS c_mktsegment,
           CASE WHEN c_custkey % 2 = 1 THEN CAST(c_nationkey AS VARCHAR) END AS c_nationkey
    FROM customer
    """
)
def excel_scan_union(spark, sf_dir):
    """Workbooks made in tasks, with differing columns, read as one by name."""

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            even = rows["c_custkey"] % 2 == 0
            parts = [
                rows[even][["c_custkey", "c_name", "c_mktsegment"]],
                rows[~even][["c_name", "c_nationkey", "c_custkey"]],
            ]
            yield pd.DataFrame({"content": [workbook(part) for part in parts if len(part)]})

    columns = ["c_custkey", "c_name", "c_mktsegment", "c_nationkey"]
    rows = table(spark, sf_dir, "customer").select(*columns)
    books = rows.mapInPandas(make, "content binary")
    return workbook_rows(books, columns, ReadOptions(sheet="rows"))


@register(
    """
    SELECT CAST(s_suppkey AS VARCHAR) AS "0", s_name AS "1", CAST(s_nationkey AS VARCHAR) AS "2" FROM supplier
    UNION ALL
    SELECT 's_suppkey', 's_name', 's_nationkey' FROM (SELECT DISTINCT s_nationkey FROM supplier)
    """
)
def excel_folder_scan(spark, sf_dir):
    """A folder of workbooks, one for each nation, by pattern and sheet; their headers are rows."""

    def make(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"content": [workbook(rows)]})

    folder = shared_folder(spark, "workbooks")
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    books = rows.groupBy("s_nationkey").applyInPandas(make, "content binary")
    # Spark writes text as the bytes it is given; what follows the end of an archive does no harm.
    books.select(F.col("content").cast("string")).write.option("maxRecordsPerFile", 1).text(folder)
    options = ReadOptions(pattern="*part-*.txt", sheet="rows", header=False)
    mappings = [ColumnMapping(str(i), f"c{i}", "VARCHAR", i) for i in range(3)]
    return scan(spark, SourceSpec("awss3", folder, options), mappings)


def workbook(rows: pd.DataFrame) -> bytes:
    """A workbook whose second sheet, ``rows``, holds a header row and the given rows."""

    def cell(value) -> str:
        if isinstance(value, str):
            return f'<c t="inlineStr"><is><t>{escape(value)}</t></is></c>'
        return f"<c><v>{value}</v></c>"

    lines = [list(rows.columns), *rows.itertuples(index=False)]
    body = "".join(f"<row>{''.join(cell(v) for v in line)}</row>" for line in lines)
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    office = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package = "http://schemas.openxmlformats.org/package/2006/relationships"
    parts = {
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{office}"><sheets>'
        '<sheet name="notes" sheetId="1" r:id="r1"/><sheet name="rows" sheetId="2" r:id="r2"/>'
        "</sheets></workbook>",
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{package}">'
        '<Relationship Id="r1" Target="worksheets/sheet1.xml"/>'
        '<Relationship Id="r2" Target="worksheets/sheet2.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{main}"><sheetData/></worksheet>',
        "xl/worksheets/sheet2.xml": f'<worksheet xmlns="{main}"><sheetData>{body}</sheetData></worksheet>',
    }
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as book:
        for name, text in parts.items():
            book.writestr(name, f'<?xml version="1.0" encoding="UTF-8"?>{text}')
    return buffer.getvalue()


@register(
    """
    SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance
    FROM customer
    UNION ALL
    SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier
    """
)
def union_tables(spark, sf_dir):
    """Union by name; a column one side lacks is NULL there."""
    customer = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS id", "c_name AS name", "c_mktsegment AS segment"
    )
    supplier = table(spark, sf_dir, "supplier").selectExpr("s_acctbal AS balance", "s_suppkey AS id", "s_name AS name")
    return union_by_name([customer, supplier])
