"""feedloom: metadata-driven data feeds expressed as Spark DataFrame plans."""

from feedloom.specs import ColumnMapping, FeedSpec, LoadSpec, ReadOptions, Rule, SourceSpec

__all__ = ["ColumnMapping", "FeedSpec", "LoadSpec", "ReadOptions", "Rule", "SourceSpec"]
