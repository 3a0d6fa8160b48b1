"""Loading landed files once each and archiving them afterwards.

The file stream remembers which files it has loaded, and its ``archive`` option
moves a file away once its batch is committed. A run takes all files that are
there and ends; there is no process that stays up.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from feedloom.operators.project import project, quoted, target_schema
from feedloom.plans.feed import shape
from feedloom.plans.load import create_table, load
from feedloom.sources.files import blank_out
from feedloom.specs import FeedSpec


def load_landed(spark: SparkSession, spec: FeedSpec, root: str, checkpoint: str) -> StreamingQuery:
    """Load the files below the feed's path that were not loaded before.

    A batch is loaded once, under a name that the table keeps together with its rows, also when a run
    breaks off at any place and the next one gives the batch again. Spark archives a file when a later batch is committed, so the files of the last
    batch move on the next run. ``checkpoint`` must be a shared folder that is kept.
    """

    name = f"feedloom.batch.{hashlib.sha256(checkpoint.encode()).hexdigest()[:16]}"

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        # The batch has a session of its own; everything of it must be done there.
        own = batch.sparkSession
        rows = project(blank_out(batch, spec.source.options.missing_words), spec.mappings, spec.legacy_types)
        shaped = shape(rows, spec)
        schema = shaped.schema if spec.rules else target_schema(spec.mappings, spec.legacy_types)
        if not own.catalog.tableExists(spec.load.target):
            create_table(own, spec.load, schema, root)
        load(own, spec.load, shaped, root, schema, batch=f"{name}:{batch_id}")
        spark.catalog.refreshTable(spec.load.target)

    stream = landed_files(spark, spec).writeStream.foreachBatch(load_batch)
    return stream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def landed_files(spark: SparkSession, spec: FeedSpec) -> DataFrame:
    """Separated text below the feed's path as a stream of text columns.

    The feed's mappings name the columns of the files, in their order.
    """
    options = spec.source.options
    columns = [m.source.strip() for m in spec.mappings]
    reader = spark.readStream.schema(", ".join(f"{quoted(c)} string" for c in columns))
    reader = reader.options(**options.to_spark()).option("enforceSchema", "false")
    if options.pattern:
        reader = reader.option("pathGlobFilter", options.pattern)
    if spec.archive_path:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", spec.archive_path)
    return reader.csv(spec.source.path)
