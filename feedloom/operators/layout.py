"""Layouts: columns computed from keys by which a table's files are kept apart.

``bucket(64, id)`` deals rows into a fixed number of buckets by a hash, ``truncate(100000, id)`` into one for each
range of that many values (of numbers, of days in dates, of leading characters in text). A merge by
a key that a layout is computed from opens and rewrites the buckets its rows fall into, and no others.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.operators.merge import typed

_SHAPE = re.compile(r"\s*(bucket|truncate)\s*\(\s*([1-9]\d*)\s*,\s*(.+?)\s*\)\s*", re.I)
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


@dataclass(frozen=True)
class Bucketing:
    """One column of a layout."""

    kind: str
    width: int
    column: str

    @classmethod
    def parse(cls, text: str) -> Bucketing:
        found = _SHAPE.fullmatch(text)
        if not found:
            raise ValueError(f"a layout is bucket(number, column) or truncate(width, column), not {text!r}")
        return cls(found[1].lower(), int(found[2]), found[3].strip("`"))

    @property
    def name(self) -> str:
        return f"__{self.kind}_{self.column}"

    def __str__(self) -> str:
        return f"{self.kind}({self.width}, {self.column})"

    def of(self, value: Column, kind: T.DataType) -> Column:
        """The bucket of a value; NULL for NULL."""
        if self.kind == "bucket":
            return F.when(value.isNotNull(), F.pmod(F.xxhash64(value), F.lit(self.width)).cast("int"))
        if isinstance(kind, _WHOLE):
            value = value.cast("bigint")
            # Numbers near the least one would go below it: they share the bucket of the least that fits.
            least = -(2**63) + self.width
            return F.when(value < least, F.lit(least)).otherwise(value - F.pmod(value, F.lit(self.width).cast("bigint")))
        if isinstance(kind, T.DateType):
            return F.date_sub(value, F.pmod(F.unix_date(value), F.lit(self.width)).cast("int"))
        if isinstance(kind, T.StringType):
            return F.substring(value, 1, self.width)
        raise ValueError(f"truncate does not apply to {self.column}, which is {kind.simpleString()}")

    def kind_of(self, kind: T.DataType) -> T.DataType:
        if self.kind == "bucket":
            return T.IntegerType()
        return T.LongType() if isinstance(kind, _WHOLE) else kind


def parse_layout(text: str | Sequence[str] | None) -> tuple[Bucketing, ...]:
    """``bucket(8, a); truncate(10, b)``, or a list of such."""
    parts = (text or "").split(";") if isinstance(text, (str, type(None))) else text
    return tuple(Bucketing.parse(p) for p in parts if p.strip())


def _field(schema: T.StructType, name: str) -> T.StructField | None:
    return next((f for f in schema.fields if f.name.lower() == name.lower()), None)


def with_fields(schema: T.StructType, layout: Sequence[Bucketing]) -> T.StructType:
    """A schema and the layout's columns behind it."""
    fields = [f for f in schema.fields if f.name not in {b.name for b in layout}]
    for b in layout:
        source = _field(schema, b.column)
        if source is None:
            raise ValueError(f"the layout's column {b.column} is not in the table")
        fields.append(T.StructField(b.name, b.kind_of(source.dataType)))
    return T.StructType(fields)


def laid_out(rows: DataFrame, target: T.StructType, layout: Sequence[Bucketing]) -> DataFrame:
    """Rows with the layout's columns, computed from values as the target will hold them."""
    for b in layout:
        given, kept = _field(rows.schema, b.column), _field(target, b.column)
        value = typed(given, kept) if given else F.lit(None).cast(kept.dataType)
        rows = rows.withColumn(b.name, b.of(value, kept.dataType).cast(b.kind_of(kept.dataType)))
    return rows


def without_layout(rows: DataFrame, layout: Sequence[Bucketing]) -> DataFrame:
    return rows.drop(*[b.name for b in layout])
