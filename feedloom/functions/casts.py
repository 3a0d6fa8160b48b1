"""Lenient casts: an unreadable value becomes NULL, with ANSI mode on or off."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Warehouse type names and the Spark type each becomes.
TYPE_NAMES = {
    "TINYINT": "int", "SMALLINT": "int", "BYTEINT": "int", "INT": "int", "INTEGER": "int",
    "BIGINT": "bigint",
    "DECIMAL": "decimal", "NUMBER": "decimal", "NUMERIC": "decimal",
    "FLOAT": "double", "FLOAT4": "double", "FLOAT8": "double", "DOUBLE": "double", "REAL": "double",
    "BOOL": "boolean", "BOOLEAN": "boolean",
    "DATE": "date",
    "DATETIME": "timestamp", "TIMESTAMP": "timestamp", "TIMESTAMP_LTZ": "timestamp",
    "TIMESTAMP_TZ": "timestamp", "TIMESTAMP_NTZ": "timestamp_ntz",
    "TIME": "time",
}

# Substring tests of the legacy type table, first hit wins.
LEGACY_TYPE_PARTS = (
    ("DATE", "timestamp"), ("TIMESTAMP", "timestamp"),
    ("INT", "int"),
    ("FLOAT", "double"), ("DOUBLE", "double"), ("DECIMAL", "double"),
    ("BOOLEAN", "boolean"),
)

# A failed cast costs an exception per row, so text and numbers that cannot be cast
# are made NULL beforehand.
_NUMBER = r"^[\s\p{Cntrl}]*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?"
_DECIMAL_TEXT = _NUMBER + r"[\s\p{Cntrl}]*$"
_DOUBLE_TEXT = _NUMBER + r"[dDfF]?[\s\p{Cntrl}]*$|^[\s\p{Cntrl}]*[+-]?(?i:nan|inf|infinity)[\s\p{Cntrl}]*$"
_BOOLEAN_TEXT = r"^[\s\p{Cntrl}]*(?i:t|true|y|yes|1|f|false|n|no|0)[\s\p{Cntrl}]*$"
_WHOLE_BITS = {"int": 31, "bigint": 63}
_TYPE_TEXT = re.compile(r"\s*(\w+)[^(]*(?:\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\))?")


def target_type(type_text: str | None, legacy: bool = False) -> str:
    """The Spark type for a destination type text; unknown text means string."""
    text = (type_text or "").upper()
    if legacy:
        return next((spark for part, spark in LEGACY_TYPE_PARTS if part in text), "string")
    match = _TYPE_TEXT.match(text)
    base = TYPE_NAMES.get(match.group(1), "string") if match else "string"
    if base == "decimal":
        precision, scale = match.group(2) or "38", match.group(3) or "0"
        return f"decimal({precision},{scale})"
    return base


def storage_type(type_text: str | None, legacy: bool = False) -> T.DataType:
    """The type a column of this type text is stored with."""
    spark_type = target_type(type_text, legacy)
    return T.DataType.fromDDL("string" if spark_type == "time" else spark_type)


def lenient_cast(col: Column, source: T.DataType, spark_type: str) -> Column:
    """Cast ``col`` (of type ``source``) to ``spark_type``; failures become NULL."""
    if spark_type == "time":
        return _clock_text(col, source)
    if spark_type == "string":
        return col.cast("string")
    if isinstance(source, T.NullType):
        return col.cast(spark_type)
    if spark_type in ("timestamp", "timestamp_ntz", "date"):
        return _to_moment(col, source, spark_type)
    if isinstance(source, T.DateType):
        return F.lit(None).cast(spark_type)
    if spark_type == "boolean":
        return _to_boolean(col, source)
    if spark_type in _WHOLE_BITS:
        return _to_whole(col, source, spark_type)
    if isinstance(source, T.StringType):
        pattern = _DECIMAL_TEXT if spark_type.startswith("decimal") else _DOUBLE_TEXT
        return F.when(col.rlike(pattern), col).try_cast(spark_type)
    return col.try_cast(spark_type)


def _to_boolean(col: Column, source: T.DataType) -> Column:
    if isinstance(source, (T.TimestampType, T.TimestampNTZType)):
        return F.lit(None).cast("boolean")
    if isinstance(source, T.StringType):
        col = F.when(col.rlike(_BOOLEAN_TEXT), col)
    return col.try_cast("boolean")


def _clock_text(col: Column, source: T.DataType) -> Column:
    if isinstance(source, T.TimestampNTZType):
        # Formatting would go through the session's zone and its missing hours.
        return F.substring(F.substring_index(col.cast("string"), " ", -1), 1, 8)
    return F.date_format(to_timestamp(col, source), "HH:mm:ss")


def _to_whole(col: Column, source: T.DataType, spark_type: str) -> Column:
    if isinstance(source, T.TimestampNTZType):
        return F.lit(None).cast(spark_type)
    if isinstance(source, T.StringType):
        # Text such as '1.5' has no direct integer cast; cut the fraction off instead.
        col = F.when(col.rlike(_DECIMAL_TEXT), col).try_cast("decimal(38,10)")
    elif not isinstance(source, T.NumericType):
        return col.try_cast(spark_type)
    # The lowest value may have a fraction, which is cut off; double holds it exactly.
    limit = 2 ** _WHOLE_BITS[spark_type]
    if isinstance(source, (T.FloatType, T.DoubleType)):
        low = col > float(-limit - 1) if spark_type == "int" else col >= float(-limit)
        fits = low & (col < float(limit))
    else:
        bound = F.lit(str(limit)).cast("decimal(20,0)")
        fits = (col > -bound - F.lit(1)) & (col < bound)
    return F.when(fits, col).try_cast(spark_type)


def _to_moment(col: Column, source: T.DataType, spark_type: str) -> Column:
    if isinstance(source, T.BooleanType):
        return F.lit(None).cast(spark_type)
    if isinstance(source, T.NumericType) and spark_type != "timestamp":
        return col.try_cast("timestamp").cast(spark_type)
    return col.try_cast(spark_type)


def to_timestamp(col: Column, source: T.DataType) -> Column:
    """Timestamp of a column; moments without a zone stay as they are."""
    if isinstance(source, (T.TimestampType, T.TimestampNTZType)):
        return col
    return lenient_cast(col, source, "timestamp")


def as_number(col: Column, source: T.DataType) -> Column:
    """Numeric operand: numbers stay as they are, everything else becomes double."""
    return col if isinstance(source, T.NumericType) else lenient_cast(col, source, "double")
