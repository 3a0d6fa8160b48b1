"""Mapping projection and scan pruning."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.casts import lenient_cast, storage_type, target_type
from feedloom.specs import ColumnMapping, in_sequence


def quoted(name: str) -> str:
    """A column name safe to pass to ``F.col``, dots and back-ticks included."""
    return "`" + name.replace("`", "``") + "`"


def project(df: DataFrame, mappings: Sequence[ColumnMapping], legacy_types: bool = False) -> DataFrame:
    """Select, rename and cast the mapped columns in destination order.

    Source names ignore letter case. A mapped column the data lacks becomes a
    typed NULL; columns without a mapping are dropped, and so never read.
    """
    fields = {f.name.lower(): f for f in df.schema.fields}
    missing = T.StructField("", T.NullType())
    columns = []
    for mapping in in_sequence(mappings):
        field = fields.get((mapping.source or "").strip().lower(), missing)
        value = F.col(quoted(field.name)) if field is not missing else F.lit(None)
        spark_type = target_type(mapping.type_text, legacy_types)
        if field is missing:
            value = value.cast(storage_type(mapping.type_text, legacy_types))
        else:
            value = lenient_cast(value, field.dataType, spark_type)
        columns.append(value.alias((mapping.target or "").strip()))
    return df.select(*columns)


def target_schema(mappings: Sequence[ColumnMapping], legacy_types: bool = False) -> T.StructType:
    """The table schema a mapping declares, in destination order."""
    return T.StructType(
        [
            T.StructField(m.target.strip(), storage_type(m.type_text, legacy_types))
            for m in in_sequence(mappings)
        ]
    )


def pruned_names(mapped: Iterable[str], always_keep: str = "Id") -> list[str]:
    """Distinct mapped names plus the always kept one, sorted by name."""
    return sorted({name.strip() for name in mapped if name and name.strip()} | {always_keep})


def pruned_query(object_text: str, mapped: Iterable[str], always_keep: str = "Id") -> str:
    """Query text for an object; text that is a SELECT already passes through."""
    text = (object_text or "").strip()
    if text.lower().startswith("select"):
        return text
    return f"SELECT {', '.join(pruned_names(mapped, always_keep))} FROM {text}"


def prune(df: DataFrame, mapped: Iterable[str], always_keep: str = "Id") -> DataFrame:
    """Keep only the mapped columns and the always kept one, sorted by name."""
    return df.select(*[quoted(name) for name in pruned_names(mapped, always_keep)])
