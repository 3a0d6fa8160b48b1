"""Delimited text, Parquet, tables and queries."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import replace
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.project import quoted
from feedloom.sources.quoted import scan_quoted
from feedloom.specs import ReadOptions


def file_reader(spark: SparkSession, options: ReadOptions) -> DataFrameReader:
    """A reader limited to the files that match the name pattern, at any depth."""
    reader = spark.read
    if options.pattern:
        reader = reader.option("pathGlobFilter", options.pattern).option("recursiveFileLookup", "true")
    return reader


def scan_delimited(
    spark: SparkSession,
    path: str | list[str],
    options: ReadOptions | None = None,
    columns: Sequence[str] = (),
) -> DataFrame:
    """Separated text as strings; the mapping casts later.

    Files are looked at one by one, in one parallel pass over the lines. Those whose
    headers differ, in order or in names, are read each by its own header and put
    together by name; a column that a file lacks is NULL there. Files with quoted
    line breaks are cut into records part by part (see ``quoted``), the others are split by
    Spark; ``multiline`` in the options says it for all. With ``columns`` the header, if
    any, is checked against them, and files whose columns are in another order fail.
    """
    options = options or ReadOptions()
    reader = file_reader(spark, options)
    if columns:
        if options.multiline is None:
            options = replace(options, multiline=has_quoted_breaks(spark, path, options))
        if options.multiline:
            return blank_out(scan_quoted(spark, reader.text(path).inputFiles(), options, columns), options.missing_words)
        reader = reader.schema(", ".join(f"{quoted(c)} string" for c in columns))
        reader = reader.option("enforceSchema", "false").options(**options.to_spark())
        return blank_out(reader.csv(path), options.missing_words)
    files = reader.text(path).inputFiles()
    if options.multiline is False and (len(files) < 2 or not options.header):
        return blank_out(reader.options(**options.to_spark()).csv(path), options.missing_words)
    groups = _layouts(spark, path, options)
    if len(groups) <= 1 and not any(broken for _, broken in groups):
        options = replace(options, multiline=False)
        return blank_out(reader.options(**options.to_spark()).csv(path), options.missing_words)
    frames = [
        scan_quoted(spark, names, options)
        if broken
        else spark.read.options(**replace(options, multiline=False).to_spark()).csv(names)
        for (_, broken), names in groups.items()
    ]
    return blank_out(union_by_name(frames), options.missing_words)


def _quotes_left_open(options: ReadOptions) -> Column:
    """Whether a line leaves a quote open, as the first line of a broken cell must.

    A doubled quote counts twice and so changes nothing. A lone quote within a cell
    also counts as open, which only costs the splitting of its file.
    """
    line = F.col("value")
    if options.escape and options.escape != options.quote:
        line = F.regexp_replace(line, f"{re.escape(options.escape)}.", "")
    quotes = F.length(line) - F.length(F.replace(line, F.lit(options.quote), F.lit("")))
    return quotes % 2 == 1 if options.quote else F.lit(False)


def _lines(spark: SparkSession, path: str | list[str], options: ReadOptions) -> DataFrame:
    reader = file_reader(spark, options)
    if options.line_separator:
        reader = reader.option("lineSep", options.line_separator)
    return reader.text(path)


def has_quoted_breaks(spark: SparkSession, path: str | list[str], options: ReadOptions) -> bool:
    """Whether some line leaves a quote open."""
    return not _lines(spark, path, options).filter(_quotes_left_open(options)).isEmpty()


def _layouts(spark: SparkSession, path: str | list[str], options: ReadOptions) -> dict[tuple[str | None, bool], list[str]]:
    """Files by header and by whether they have quoted line breaks; empty files are left out.

    Only a file's name and first line reach the driver. Spark numbers the rows of a
    task in their order, and a file's first row is in the part that begins at 0.
    """
    place = F.struct(F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("row"), "value")
    lines = _lines(spark, path, options).select(F.col("_metadata.file_path").alias("file"), place.alias("line"), _quotes_left_open(options).alias("open"))
    found = lines.groupBy("file").agg(F.min("line")["value"].alias("first"), F.bool_or("open").alias("broken")).collect()
    groups: dict[tuple[str | None, bool], list[str]] = {}
    for row in sorted(found, key=lambda r: r["file"]):
        broken = bool(row["broken"]) if options.multiline is None else options.multiline
        head = row["first"].rstrip("\r") if options.header else None
        groups.setdefault((head, broken), []).append(unquote(row["file"]))
    return groups


def blank_out(df: DataFrame, words: Sequence[str]) -> DataFrame:
    """Turn the given texts into NULL in every column."""
    if not words:
        return df
    return df.select(
        *[F.when(~F.col(quoted(c)).isin(*words), F.col(quoted(c))).alias(c) for c in df.columns]
    )


def scan_parquet(spark: SparkSession, path: str | list[str], options: ReadOptions | None = None) -> DataFrame:
    """Parquet files; pruning and filter push-down reach the scan."""
    paths = [path] if isinstance(path, str) else path
    return file_reader(spark, options or ReadOptions()).parquet(*paths)


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table."""
    return spark.table(name)


def scan_query(spark: SparkSession, text: str, **views: DataFrame) -> DataFrame:
    """The rows of a query; frames may be named in it as ``{name}``."""
    return spark.sql(text, **views)


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames; a column some frame lacks is NULL there."""
    if not frames:
        raise ValueError("there is nothing to union: no file matched")
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result
