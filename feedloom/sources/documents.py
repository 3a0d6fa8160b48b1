"""JSON files, API bodies and paged envelopes."""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.predicates import is_blank
from feedloom.operators.project import quoted
from feedloom.session import checkpointed
from feedloom.sources.files import file_reader, union_by_name
from feedloom.specs import ReadOptions

# The shape of a page, and the names that mean the item's own id.
PAGE_SCHEMA = (
    "results array<struct<id string, properties map<string, string>>>, "
    "paging struct<next: struct<after: string>>"
)
ID_NAMES = ("recordid", "id", "hs_object_id")
CORRUPT = "__not_json"


def scan_json(
    spark: SparkSession,
    path: str | list[str],
    schema: str | None = None,
    multiline: bool | None = None,
    options: ReadOptions | None = None,
) -> DataFrame:
    """JSON files: an object or an array of objects per line, or per file if ``multiline``.

    When ``multiline`` is not given it is found out for each file, so that both kinds
    may lie in one folder. Text that is not JSON is an error. Without a schema the lines are read and
    parsed once and kept in parsed form, of which the types are found and the columns taken; only
    files of one document, and lines that this does not take, are read by Spark's own inference.
    """
    options = options or ReadOptions()

    def read(paths: str | list[str], reader: DataFrameReader, whole: bool) -> DataFrame:
        reader = reader.option("multiLine", str(whole).lower()).option("mode", "FAILFAST")
        return (reader.schema(schema) if schema else reader).json(paths)

    if schema is None and not multiline:
        lines = file_reader(spark, options).text(path)
        found = parsed_once(lines.filter(~is_blank(F.col("value"))))
        if found is not None:
            return found
    if multiline is not None:
        return read(path, file_reader(spark, options), multiline)
    whole, lines = _layouts(spark, path, options)
    if not whole or not lines:
        return read(path, file_reader(spark, options), bool(whole))
    # Paths found below a pattern are whole, so the pattern has done its part.
    return union_by_name([read(lines, spark.read, False), read(whole, spark.read, True)])


def parsed_once(texts: DataFrame, skip: bool = False) -> DataFrame | None:
    """Rows of JSON texts (value), objects and the elements of arrays, in columns of the types found.

    The texts are parsed once and kept in parsed form below ``spark.checkpoint.dir``. Types are those that
    Spark's inference finds: fractions are doubles, columns of several kinds and of nulls only are
    text, objects without fields are left out; but an empty text is text, also beside numbers. None when a text is not JSON, holds a key
    twice, or anything but objects, unless ``skip`` leaves out what is not JSON.
    """
    value = F.col("value")
    parsed = F.try_parse_json(value)
    many = F.ltrim(value, F.lit(" \t\r\n")).startswith("[")
    # A text that is not taken by this parser may still be JSON, with a key that comes twice.
    odd = F.get_json_object(value, "$").isNotNull() if skip else F.lit(True)
    rows = texts.select(
        (parsed.isNull() & odd).alias("bad"),
        F.explode_outer(F.when(many, parsed.cast("array<variant>")).otherwise(F.array(parsed))).alias("item"),
        (many & F.coalesce(F.size(parsed.cast("array<variant>")) == 0, F.lit(False))).alias("none"),
    )
    kept = checkpointed(rows.filter("NOT none").select("bad", "item"))
    facts = kept.agg(F.schema_of_variant_agg("item").alias("kind"), F.bool_or(F.col("bad") | F.coalesce(F.is_variant_null("item"), F.lit(False))).alias("bad")).first()
    if facts["bad"] or not facts["kind"].startswith("OBJECT<"):
        return None
    kind = _known_kind(_kind_of(facts["kind"]))
    if kind is None:
        return None
    return kept.filter("item IS NOT NULL").select(F.col("item").cast(kind).alias("row")).select("row.*")


# Kinds stand at the beginning, behind the name of a field, and in arrays.
_KIND = re.compile(r"`(?:[^`]|``)*`|(?<![^ <])OBJECT<")


def _kind_of(text: str) -> T.DataType:
    """The type that ``schema_of_variant_agg`` names, whose objects are structs."""
    ddl = _KIND.sub(lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], text)
    return T.DataType.fromDDL(ddl)


def _known_kind(kind: T.DataType) -> T.DataType | None:
    """The type that Spark's JSON inference would find; None for an object without fields."""
    if isinstance(kind, T.StructType):
        fields = [(f.name, _known_kind(f.dataType)) for f in kind.fields]
        fields = [T.StructField(name, k) for name, k in fields if k is not None]
        return T.StructType(fields) if fields else None
    if isinstance(kind, T.ArrayType):
        element = _known_kind(kind.elementType)
        return None if element is None else T.ArrayType(element)
    if isinstance(kind, (T.NullType, T.VariantType)):
        return T.StringType()
    if isinstance(kind, T.DecimalType) and kind.scale > 0:
        return T.DoubleType()
    return kind


def _layouts(spark: SparkSession, path: str | list[str], options: ReadOptions) -> tuple[list[str], list[str]]:
    """The files to read as one document each, and those with a document on every line.

    The first line of a file that is not blank says it: if it is a document of its own,
    so must every line be, or the read fails. Spark numbers the rows of a task in
    their order, and a file's first line is in its first part. Only file names
    reach the driver, which lists them in any case.
    """
    lines = file_reader(spark, options).text(path)
    place = F.struct(F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("row"), "value")
    lines = lines.select("value", F.col("_metadata.file_path").alias("file"), place.alias("line"))
    first = lines.filter(~is_blank(F.col("value"))).groupBy("file").agg(F.min("line")["value"].alias("first"))
    found = first.select("file", F.try_parse_json("first").isNotNull().alias("lines")).collect()
    names = sorted((unquote(row["file"]), row["lines"]) for row in found)
    return [name for name, lines in names if not lines], [name for name, lines in names if lines]


def scan_bodies(spark: SparkSession, path: str | list[str], schema: str | None = None) -> DataFrame:
    """Landed API bodies, one per file; without a schema it is found out from the parsed bodies.

    Bodies that are not JSON give no rows.
    """
    if schema:
        return body_rows(spark.read.text(path, wholetext=True), "value", schema)
    parsed = parsed_once(spark.read.text(path, wholetext=True), skip=True)
    if parsed is not None:
        return parsed
    reader = spark.read.option("multiLine", "true").option("columnNameOfCorruptRecord", CORRUPT)
    found = reader.option("mode", "PERMISSIVE").json(path)
    kinds = T.StructType([f for f in found.schema.fields if f.name != CORRUPT])
    return body_rows(spark.read.text(path, wholetext=True), "value", kinds) if kinds.fields else found.limit(0)


def body_rows(bodies: DataFrame, column: str, schema: str | T.StructType) -> DataFrame:
    """Rows of API bodies: an object is a row, an array a row per element.

    A body that is not JSON, or is neither object nor array, gives no rows.
    """
    kind = f"array<struct<{schema}>>" if isinstance(schema, str) else T.ArrayType(schema)
    parsed = F.from_json(F.col(quoted(column)), kind)
    return bodies.select(F.inline(parsed))


def scan_pages(spark: SparkSession, path: str | list[str], names: Sequence[str], multiline: bool | None = None) -> DataFrame:
    """Items of landed pages as nullable text columns with the given names."""
    pages = scan_json(spark, path, PAGE_SCHEMA, multiline)
    return page_items(pages, names)


def page_items(pages: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per item: its id under any of the id names, else a property by lower-cased name."""
    items = pages.select(F.explode("results").alias("item"))
    columns = []
    for name in names:
        if name.lower() in ID_NAMES:
            value = F.col("item.id")
        else:
            value = F.try_element_at("item.properties", F.lit(name.lower()))
        columns.append(value.alias(name))
    return items.select(*columns)
