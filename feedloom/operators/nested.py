"""Flattening of nested rows: structs to columns, arrays of structs to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.operators.project import quoted


def _free_name(name: str, used: set[str]) -> str:
    """The name itself, or with the first free suffix _1, _2, ...; ignores case."""
    chosen, count = name, 0
    while chosen.lower() in used:
        count += 1
        chosen = f"{name}_{count}"
    used.add(chosen.lower())
    return chosen


def _clash(names: list[str]) -> bool:
    return len({name.lower() for name in names}) < len(names)


def flatten_structs(df: DataFrame) -> DataFrame:
    """Replace each struct column by its fields, one level deep, without prefix."""
    fields = df.schema.fields
    if _clash(df.columns):
        # Names that differ in letter case only cannot be referred to; positions can.
        df = df.toDF(*[f"__{i}" for i in range(len(fields))])
    used: set[str] = set()
    columns: list[Column] = []
    for field, name in zip(fields, df.columns, strict=True):
        parent = F.col(quoted(name))
        if isinstance(field.dataType, T.StructType):
            for inner, value in _struct_fields(parent, field.dataType):
                columns.append(value.alias(_free_name(inner, used)))
        else:
            columns.append(parent.alias(_free_name(field.name, used)))
    return df.select(*columns)


def _struct_fields(parent: Column, kind: T.StructType) -> list[tuple[str, Column]]:
    """Name and value of each field; clashing names are reached by position."""
    names = kind.fieldNames()
    if not _clash(names):
        return [(name, parent.getField(name)) for name in names]
    places = [f"__{i}" for i in range(len(names))]
    renamed = T.StructType(
        [T.StructField(place, f.dataType) for place, f in zip(places, kind.fields, strict=True)]
    )
    return [(name, parent.cast(renamed).getField(place)) for name, place in zip(names, places, strict=True)]


def explode_first(df: DataFrame) -> DataFrame:
    """Explode the first array-of-struct column; NULL and empty arrays keep their row."""
    name = next((f.name for f in df.schema.fields if _is_struct_array(f.dataType)), None)
    return df if name is None else _replace(df, name, F.explode_outer(F.col(quoted(name))))


def join_arrays(df: DataFrame, separator: str = "|") -> DataFrame:
    """Turn every array of plain values into text; NULL arrays stay NULL.

    NULL elements are skipped; elements that are arrays become JSON text first.
    """
    columns = []
    for field in df.schema.fields:
        col = F.col(quoted(field.name))
        if isinstance(field.dataType, T.ArrayType) and not _is_struct_array(field.dataType):
            col = _joined(col, field.dataType.elementType, separator).alias(field.name)
        columns.append(col)
    return df.select(*columns)


def _joined(col: Column, element: T.DataType, separator: str) -> Column:
    if isinstance(element, (T.ArrayType, T.MapType)):
        texts = F.transform(col, lambda item: F.to_json(item))
    else:
        texts = col.cast("array<string>")
    return F.when(col.isNotNull(), F.concat_ws(separator, texts))


def normalize(
    df: DataFrame,
    explode: bool = True,
    join_primitive: bool = False,
    separator: str = "|",
) -> DataFrame:
    """Flatten and explode until the rows are flat.

    Only the schema is looked at, which is finite: the loop builds one plan and runs
    nothing. Two arrays side by side give every pairing of their elements within a
    row.
    """
    while True:
        kinds = [f.dataType for f in df.schema.fields]
        structs = any(isinstance(kind, T.StructType) for kind in kinds) or _clash(df.columns)
        if structs:
            df = flatten_structs(df)
        arrays = explode and any(_is_struct_array(f.dataType) for f in df.schema.fields)
        if arrays:
            df = explode_first(df)
        if not structs and not arrays:
            break
    return join_arrays(df, separator) if join_primitive else df


def _is_struct_array(kind: T.DataType) -> bool:
    return isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType)


def _replace(df: DataFrame, name: str, value: Column) -> DataFrame:
    return df.select(
        *[value.alias(name) if c == name else F.col(quoted(c)) for c in df.columns]
    )
