"""The rows of a feed: scan, mapping, one row per key, rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from feedloom.operators.dedupe import keep_latest
from feedloom.operators.project import project
from feedloom.operators.rules import COLUMN_RULES, apply_rules
from feedloom.operators.watermark import after_mark
from feedloom.sources.scan import scan
from feedloom.specs import FeedSpec


def source_rows(spark: SparkSession, spec: FeedSpec) -> DataFrame:
    """Mapped rows of the source, before anything is dropped."""
    return project(scan(spark, spec.source, spec.mappings), spec.mappings, spec.legacy_types)


def latest_rows(rows: DataFrame, spec: FeedSpec, mark: Column | None = None) -> DataFrame:
    """One row per key, the latest by watermark.

    ``mark`` drops rows at or below a high-water mark before the shuffle. That
    gives the rows a later filter would give only where ``mark_goes_first``.
    """
    names = {c.lower() for c in rows.columns}
    watermark = spec.load.watermark
    if watermark:
        rows = after_mark(rows, watermark, mark)
    return keep_latest(rows, spec.keys, [watermark] if watermark and watermark.lower() in names else [])


def shape(rows: DataFrame, spec: FeedSpec, mark: Column | None = None) -> DataFrame:
    """One row per key, then the rules."""
    return apply_rules(latest_rows(rows, spec, mark), spec.rules, spec.strict_rules)


def mark_goes_first(spec: FeedSpec) -> bool:
    """Whether filtering by high-water mark and the later steps may change places.

    The survivor of a key is its row with the greatest watermark, so it passes the
    filter exactly if any row of the key does. Rules must leave the column alone.
    """
    watermark = (spec.load.watermark or "").lower()
    mapped = any(m.target.strip().lower() == watermark for m in spec.mappings)
    plain = all(r.op in COLUMN_RULES and r.output.lower() != watermark for r in spec.rules)
    return bool(watermark) and mapped and plain and spec.load.custom_query() is None


def feed_rows(spark: SparkSession, spec: FeedSpec) -> DataFrame:
    """The rows a feed loads, as one lazy plan."""
    return shape(source_rows(spark, spec), spec)
