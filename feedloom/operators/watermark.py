"""High-water marks of batch loads."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.casts import lenient_cast
from feedloom.operators.project import quoted

log = logging.getLogger(__name__)


def _field(df: DataFrame, column: str) -> T.StructField | None:
    return next((f for f in df.schema.fields if f.name.lower() == column.lower()), None)


def high_water_mark(df: DataFrame, column: str, kind: T.DataType | None = None) -> Column | None:
    """The greatest value of a column as a literal; None when there is none.

    With ``kind`` the values are read as that type first: text marks of numbers
    compare as numbers. NaN, which is above everything, is no mark. A column that
    is not there gives no mark and a warning. One value comes back to the driver. As
    a literal it reaches the next scan as a pushed-down filter, which a join or an
    unresolved subquery would not.
    """
    field = _field(df, column)
    if field is None:
        log.warning("the table has no column %s: all rows are above the mark", column)
        return None
    value, kind = F.col(quoted(field.name)), kind or field.dataType
    if kind != field.dataType:
        value = lenient_cast(value, field.dataType, kind.simpleString())
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        value = F.when(~F.isnan(value), value)
    top = F.max(value)
    if isinstance(kind, T.TimestampType):
        found = df.agg(F.unix_micros(top)).first()[0]
        return None if found is None else F.timestamp_micros(F.lit(found))
    found = df.agg(top.cast("string")).first()[0]
    return None if found is None else F.lit(found).cast(kind)


def after_mark(df: DataFrame, column: str, mark: Column | None) -> DataFrame:
    """Rows strictly above the mark; all rows, NULLs included, when there is no mark."""
    return df if mark is None else df.filter(F.col(quoted(column)) > mark)


def above_target(df: DataFrame, target: DataFrame, column: str) -> DataFrame:
    """Rows above the target's mark, read as the rows' own type."""
    field = _field(df, column)
    if field is None:
        log.warning("the rows have no column %s: none is left out", column)
        return df
    return after_mark(df, field.name, high_water_mark(target, column, field.dataType))
