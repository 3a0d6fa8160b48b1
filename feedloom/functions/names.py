"""Qualified names and paths taken apart with built-in string functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def qualified_name(col: Column, database: str, schema: str) -> Column:
    """Struct (database, schema, table) of a 1-, 2- or 3-part name, upper-cased.

    A name of any other length counts as a plain table name of its first part.
    """
    parts = F.split(F.upper(col), r"\.")
    size = F.size(parts)

    def part(position: int) -> Column:
        return F.try_element_at(parts, F.lit(position))

    full, two = size == 3, size == 2
    return F.when(
        col.isNotNull(),
        F.struct(
            F.when(full, part(1)).otherwise(F.lit(database.upper())).alias("database"),
            F.when(full, part(2)).when(two, part(1)).otherwise(F.lit(schema.upper())).alias("schema"),
            F.when(full, part(3)).when(two, part(2)).otherwise(part(1)).alias("table"),
        ),
    )


def target_name(col: Column) -> Column:
    """Struct (schema, table): the last two parts of a dotted path, else blanks."""
    parts = F.split(F.coalesce(col, F.lit("")), r"\.")
    enough = F.size(parts) >= 2

    def part(position: int) -> Column:
        return F.when(enough, F.try_element_at(parts, F.lit(position))).otherwise(F.lit(""))

    return F.struct(part(-2).alias("schema"), part(-1).alias("table"))


def source_name(col: Column) -> Column:
    """Struct (schema, table) of a source path.

    The base name when the path has a slash; else the last dotted part with the
    rest as schema; else the path itself.
    """
    path = F.coalesce(col, F.lit(""))
    slash, dot = path.contains("/"), path.contains(".")
    return F.struct(
        F.when(~slash & dot, F.regexp_extract(path, r"^(.*)\.[^.]*$", 1)).alias("schema"),
        F.when(slash, F.substring_index(path, "/", -1))
        .when(dot, F.substring_index(path, ".", -1))
        .otherwise(path)
        .alias("table"),
    )
