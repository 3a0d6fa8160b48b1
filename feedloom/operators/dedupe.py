"""One row per key, with a total order so that the survivor is always the same."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.operators.project import quoted


def _orderable(field: T.StructField) -> Column:
    col = F.col(quoted(field.name))
    return F.to_json(col) if _holds_map(field.dataType) else col


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.MapType):
        return True
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind.fields)
    return False


def keep_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """Keep one row per key: the greatest by ``order_by``, then by every other column.

    NULL sorts last, and NULL keys form one group. Filtering ``row_number() = 1``
    lets Spark cut each task down to one row per key before the shuffle, so a key
    that holds much of the data still sends only one row per task.
    """
    if not keys and not any(_holds_map(f.dataType) for f in df.schema.fields):
        return df.distinct()
    fields = {f.name.lower(): f for f in df.schema.fields}
    named = [fields[name.lower()] for name in order_by]
    skip = {name.lower() for name in (*keys, *order_by)}
    rest = [f for f in df.schema.fields if f.name.lower() not in skip]
    order = [_orderable(f).desc_nulls_last() for f in (*named, *rest)] or [F.lit(1)]
    # Without keys the whole row is the key; a map, which cannot be compared, stands as JSON.
    by = [_orderable(fields[k.lower()]) for k in keys] or [_orderable(f) for f in df.schema.fields]
    window = Window.partitionBy(*by).orderBy(*(order if keys else [F.lit(1)]))
    rank = "__row_rank"
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) == 1).drop(rank)


def drop_duplicates(df: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """One row per value of ``columns``; whole-row duplicates when none are named."""
    return keep_latest(df, columns)
