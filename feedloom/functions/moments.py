"""UTC text of moments."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def rfc3339(col: Column, source: T.DataType) -> Column:
    """UTC text ending in ``Z``; the fraction is left out when it is zero.

    A moment without a zone counts as UTC. Text is only given its ``Z`` ending.
    """
    if isinstance(source, T.StringType):
        return F.regexp_replace(col, r"\+00:00Z?$", "Z")
    utc = col if isinstance(source, T.TimestampNTZType) else utc_clock(col.cast("timestamp"))
    text = F.replace(utc.cast("string"), F.lit(" "), F.lit("T"))
    return F.concat(F.when(text.contains("."), F.rpad(text, 26, "0")).otherwise(text), F.lit("Z"))


def utc_clock(col: Column) -> Column:
    """What a UTC clock shows at a timestamp; no session zone takes part in it."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(col), epoch)


def utc_literal(moment: datetime, kind: T.DataType) -> Column:
    """A moment as a literal to compare with a column of the given type; naive is UTC."""
    aware = moment if moment.tzinfo else moment.replace(tzinfo=UTC)
    if isinstance(kind, T.TimestampNTZType):
        return F.lit(aware.astimezone(UTC).replace(tzinfo=None).isoformat(" ")).cast(kind)
    return F.lit(aware)
