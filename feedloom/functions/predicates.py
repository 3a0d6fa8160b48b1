"""Row predicates on configuration and data columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.specs import NO_QUERY_WORDS

# The texts that mean "active".
TRUTHY = ("true", "1", "t", "y", "yes")


def is_blank(col: Column) -> Column:
    """NULL, or text of white space only."""
    return col.isNull() | col.cast("string").rlike(r"(?U)^\s*$")


def is_active(col: Column) -> Column:
    """True for a truthy flag; NULL and anything else is inactive."""
    text = F.regexp_replace(F.lower(col.cast("string")), r"(?U)^\s+|\s+$", "")
    return F.coalesce(text.isin(*TRUTHY), F.lit(False))


def same_name(col: Column, name: str) -> Column:
    """Equality that ignores letter case."""
    return F.upper(col) == F.upper(F.lit(name))


def custom_query_text(col: Column) -> Column:
    """The custom query, or NULL where the text is a word for "none"."""
    word = F.upper(F.regexp_replace(col, r"(?U)^\s+|\s+$", ""))
    return F.when(~word.isin(*NO_QUERY_WORDS), col)


def any_null(columns: list[Column]) -> Column:
    """True where at least one of the columns is NULL."""
    found = F.lit(False)
    for col in columns:
        found = found | col.isNull()
    return found
