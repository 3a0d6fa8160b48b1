"""One entry for all kinds of source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from feedloom.operators.nested import normalize
from feedloom.operators.project import pruned_query
from feedloom.sources import documents, files, jdbc, workbooks
from feedloom.specs import ColumnMapping, SourceSpec

# The source type names a configuration may use.
COMPRESSED = (".gz", ".bz2", ".lz4", ".snappy", ".zst", ".deflate")
OBJECT_KINDS = ("salesforce", "sf", "sfdc")
PAGE_KINDS = ("hubspot", "hubspotapi", "hubspot_rest")
WORKBOOK_KINDS = ("awss3", "aws_s3", "azureblob", "azure_blob")
FILE_KINDS = ("sftp",)
BODY_KINDS = ("restapi", "api", "http", "rest")
TABLE_KINDS = ("table", "parquet")
JDBC_PARTITIONS = 16  # ranges of a split column, unless the connection says otherwise
JDBC_KINDS = ("jdbc", *jdbc.DRIVERS, *jdbc.DIALECT_ALIASES)
SOURCE_KINDS = (
    *JDBC_KINDS, *OBJECT_KINDS, *PAGE_KINDS, *WORKBOOK_KINDS, *FILE_KINDS, *BODY_KINDS, *TABLE_KINDS,
)


def scan(spark: SparkSession, source: SourceSpec, mappings: Sequence[ColumnMapping] = ()) -> DataFrame:
    """The rows of a source, flat, before the mapping is applied."""
    kind = source.kind.strip().lower()
    names = [m.source.strip() for m in mappings if (m.source or "").strip()]
    if kind in JDBC_KINDS:
        split = source.connection.get("split_column")
        return jdbc.scan_jdbc(
            spark, kind, source.connection, source.path, split, int(source.connection.get("partitions", JDBC_PARTITIONS))
        )
    if kind in OBJECT_KINDS:
        return files.scan_query(spark, pruned_query(source.path, names))
    if kind in PAGE_KINDS:
        return documents.scan_pages(spark, source.path, names)
    if kind in WORKBOOK_KINDS:
        return workbooks.scan_workbooks(spark, source.path, names, source.options)
    if kind in BODY_KINDS:
        return normalize(documents.scan_bodies(spark, source.path, source.schema))
    if kind == "table":
        return files.scan_table(spark, source.path)
    if kind in (*FILE_KINDS, "parquet"):
        return _scan_files(spark, source, "parquet" if kind == "parquet" else _extension(source.path))
    raise ValueError(f"Unsupported source type: {source.kind}; known are {', '.join(SOURCE_KINDS)}")


def _scan_files(spark: SparkSession, source: SourceSpec, extension: str) -> DataFrame:
    if extension in ("csv", "psv"):
        return files.scan_delimited(spark, source.path, source.options)
    if extension == "json":
        rows = documents.scan_json(spark, source.path, source.schema, source.options.multiline, source.options)
        return normalize(rows)
    if extension == "parquet":
        return files.scan_parquet(spark, source.path, source.options)
    raise ValueError(f"Unsupported file extension '{extension}' of {source.path}")


def _extension(path: str) -> str:
    """The ending of a path, without that of a compression Spark unpacks."""
    name = path.rstrip("/").lower()
    for ending in COMPRESSED:
        name = name.removesuffix(ending)
    return name.rpartition(".")[2]
