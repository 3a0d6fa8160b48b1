"""Load modes, run against real catalog tables in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.dedupe import keep_latest
from feedloom.operators.merge import merge, merge_counts
from feedloom.operators.watermark import after_mark, high_water_mark
from feedloom.operators.layout import parse_layout, without_layout
from feedloom.plans.load import load, stage, staging_copy
from feedloom.queries import register, table
from feedloom.session import shared_folder
from feedloom.specs import LoadSpec

SPLIT = "ts < TIMESTAMP_NTZ '2024-01-21 00:00:00'"


def run_loads(spark: SparkSession, *loads: tuple[dict, DataFrame | None]) -> DataFrame:
    """Load the frames one after another into one new table; returns its rows."""
    root, name = shared_folder(spark, "tables"), f"feed_{uuid.uuid4().hex}"
    for options, rows in loads:
        load(spark, LoadSpec(target=name, **options), rows, root)
    return detached(spark, name)


def detached(spark: SparkSession, name: str) -> DataFrame:
    """The files of a table, whose catalog entry is dropped."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
    folder = described.filter("col_name = 'Location'").select("data_type").first()[0]
    result = spark.read.schema(spark.table(name).schema).parquet(folder)
    spark.sql(f"DROP TABLE {name}")
    return result


@register("SELECT * FROM customer")
def full_load_customer(spark, sf_dir):
    """A full and a bulk load over older rows leave exactly the new rows."""
    customer = table(spark, sf_dir, "customer")
    old = customer.filter("c_acctbal > 0").withColumn("c_name", F.lower("c_name"))
    return run_loads(spark, ({"mode": "full"}, old), ({"mode": "bulk"}, old), ({"mode": "Full"}, customer))


@register(
    """
    SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-21'
    UNION ALL
    SELECT * FROM events
    WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-21')
    """
)
def append_watermark_events(spark, sf_dir):
    """Only rows above the target's mark are added, and none of them twice."""
    events = table(spark, sf_dir, "events")
    append = {"mode": "append", "watermark": "ts"}
    return run_loads(spark, (append, events.filter(SPLIT)), (append, events), (append, events))


@register(
    """
    SELECT event_id, ts, user_id FROM events
    WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-21')
    """
)
def append_watermark_only_new(spark, sf_dir):
    """The mark reaches the scan as a pushed-down filter."""
    events = table(spark, sf_dir, "events")
    mark = high_water_mark(events.filter(SPLIT), "ts")
    return after_mark(events, "ts", mark).select("event_id", "ts", "user_id")


def _merge_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All orders as target and as source, their keys stretched so that some meet."""
    orders = table(spark, sf_dir, "orders")
    target = orders.withColumn("o_orderkey", F.col("o_orderkey") * 2)
    source = orders.select(
        (F.col("o_orderkey") * 3).alias("o_orderkey"),
        (F.col("o_totalprice") + 1).alias("o_totalprice"),
        "o_orderstatus",
    )
    return target, source


MERGED_ORDERS = """
    SELECT t.o_orderkey * 2 AS o_orderkey, t.o_custkey, coalesce(s.o_orderstatus, t.o_orderstatus) AS o_orderstatus,
           coalesce(s.o_totalprice + 1, t.o_totalprice) AS o_totalprice, t.o_orderdate, t.o_orderpriority
    FROM orders t LEFT JOIN orders s ON t.o_orderkey * 2 = s.o_orderkey * 3
    UNION ALL
    SELECT o_orderkey * 3, NULL, o_orderstatus, o_totalprice + 1, NULL, NULL
    FROM orders WHERE o_orderkey * 3 NOT IN (SELECT o_orderkey * 2 FROM orders)
"""


@register(MERGED_ORDERS)
def merge_orders(spark, sf_dir):
    """Update by key, insert the rest; columns only the target has are kept."""
    return merge(*_merge_inputs(spark, sf_dir), ["o_orderkey"])


@register(MERGED_ORDERS)
def incremental_load_orders(spark, sf_dir):
    """The same by loading, twice over: the second time changes nothing."""
    target, source = _merge_inputs(spark, sf_dir)
    step = {"mode": "incremental", "keys": ("o_orderkey",)}
    return run_loads(spark, ({"mode": "full"}, target), (step, source), (step, source))


@register(MERGED_ORDERS)
def incremental_load_bucketed(spark, sf_dir):
    """The same into a table laid out by ranges of its key: buckets that no source key falls into stay as they are."""
    target, source = _merge_inputs(spark, sf_dir)
    layout = ("truncate(20000, o_orderkey)",)
    step = {"mode": "incremental", "keys": ("o_orderkey",)}
    done = run_loads(spark, ({"mode": "full", "layout": layout}, target), (step, source), (step, source))
    return without_layout(done, parse_layout(layout))


@register(
    """
    WITH latest AS (
      SELECT * FROM events QUALIFY row_number() OVER (
        PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
    old AS (
      SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-21' QUALIFY row_number() OVER (
        PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
    SELECT user_id, ts, event_type, value FROM latest
    WHERE ts > (SELECT max(ts) FROM old) OR user_id IN (SELECT user_id FROM old)
    """
)
def incremental_load_watermark(spark, sf_dir):
    """The latest row per key, merged above the target's mark."""
    columns = ["user_id", "ts", "event_type", "value"]
    events = table(spark, sf_dir, "events")

    def latest(rows):
        return keep_latest(rows, ["user_id"], ["ts", "event_id"]).select(*columns)

    step = {"mode": "incremental", "keys": ("user_id",), "watermark": "ts"}
    return run_loads(spark, (step, latest(events.filter(SPLIT))), (step, latest(events)))


@register(
    """
    SELECT t.o_orderkey * 2 AS o_orderkey, t.o_orderstatus, coalesce(s.o_totalprice + 1, t.o_totalprice) AS o_totalprice
    FROM orders t
    LEFT JOIN orders s ON t.o_orderkey * 2 = s.o_orderkey * 3 AND t.o_orderstatus = 'F'
    UNION ALL
    SELECT o_orderkey * 3, 'F', o_totalprice + 1
    FROM orders WHERE o_orderkey * 3 NOT IN (SELECT o_orderkey * 2 FROM orders WHERE o_orderstatus = 'F')
    """
)
def incremental_load_partitioned(spark, sf_dir):
    """A merge that rewrites only the partition its source touches."""
    target, source = _merge_inputs(spark, sf_dir)
    parts = {"partition_by": ("o_orderstatus",)}
    step = {"mode": "incremental", "keys": ("o_orderkey", "o_orderstatus"), **parts}
    done = run_loads(
        spark,
        ({"mode": "full", **parts}, target.select("o_orderkey", "o_totalprice", "o_orderstatus")),
        (step, source.withColumn("o_orderstatus", F.lit("F"))),
    )
    return done.select("o_orderkey", "o_orderstatus", "o_totalprice")


@register(
    """
    WITH t AS (SELECT o_orderkey AS k, o_totalprice AS price, CAST(date_trunc('year', o_orderdate) AS DATE) AS d FROM orders),
    s AS (SELECT k * 2 AS k, price + 1 AS price, d FROM t)
    SELECT t.k, coalesce(s.price, t.price) AS price, CAST(t.d AS VARCHAR) AS d FROM t LEFT JOIN s ON t.k = s.k AND t.d = s.d
    UNION ALL
    SELECT k, price, CAST(d AS VARCHAR) FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.k = s.k AND t.d = s.d)
    """
)
def incremental_load_partitioned_typed(spark, sf_dir):
    """Partitions by DATE, a source of moments: far more distinct values than partitions."""
    year = F.date_trunc("year", F.col("o_orderdate").cast("timestamp_ntz"))
    orders = table(spark, sf_dir, "orders")
    target = orders.select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("price"), year.cast("date").alias("d"))
    moment = year + F.make_dt_interval(secs=F.col("o_orderkey") % 5000)
    source = orders.select((F.col("o_orderkey") * 2).alias("k"), (F.col("o_totalprice") + 1).alias("price"), moment.cast("timestamp_ntz").alias("d"))
    step = {"mode": "incremental", "keys": ("k", "d")}
    done = run_loads(spark, ({"mode": "full", "partition_by": ("d",)}, target), (step, source))
    return done.withColumn("d", F.col("d").cast("string"))


@register(
    """
    SELECT c_custkey, upper(c_name) AS c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_acctbal > 0
    UNION ALL
    SELECT * FROM customer WHERE c_acctbal <= 0
    """
)
def full_load_existing_partitioned(spark, sf_dir):
    """A table that is partitioned stays so when the load says nothing of it."""
    customer = table(spark, sf_dir, "customer")
    rich = customer.filter("c_acctbal > 0").withColumn("c_name", F.upper("c_name"))
    return run_loads(
        spark,
        ({"mode": "full", "partition_by": ("c_mktsegment",)}, rich.withColumn("c_mktsegment", F.lower("c_mktsegment"))),
        ({"mode": "full"}, customer),
        ({"mode": "incremental", "keys": ("c_custkey",)}, rich),
    )


@register("SELECT CAST(event_id AS VARCHAR) AS event_id, event_type FROM events")
def custom_query_append_numeric_mark(spark, sf_dir):
    """Three appends of the same query: marks kept as text compare as the numbers they are."""
    view = f"v{uuid.uuid4().hex}"
    table(spark, sf_dir, "events").createOrReplaceTempView(view)
    step = {"mode": "append", "watermark": "event_id", "query": f"SELECT event_id, event_type FROM {view}"}
    try:
        return run_loads(spark, (step, None), (step, None), (step, None))
    finally:
        spark.catalog.dropTempView(view)


@register("SELECT * FROM supplier")
def staging_copy_supplier(spark, sf_dir):
    """The copy that a load keeps and goes on from."""
    return staging_copy(spark, table(spark, sf_dir, "supplier"), shared_folder(spark, "copies"), "core.supplier")


@register(
    """
    WITH keys AS (SELECT o_orderkey * 2 AS t, o_orderkey * 3 AS s FROM orders)
    SELECT 'update' AS outcome, count(*) AS row_count FROM keys WHERE t IN (SELECT s FROM keys)
    UNION ALL SELECT 'unchanged', count(*) FROM keys WHERE t NOT IN (SELECT s FROM keys)
    UNION ALL SELECT 'insert', count(*) FROM keys WHERE s NOT IN (SELECT t FROM keys)
    """
)
def merge_metrics_orders(spark, sf_dir):
    return merge_counts(merge(*_merge_inputs(spark, sf_dir), ["o_orderkey"], "outcome"), "outcome")


@register(
    """
    WITH t AS (SELECT CASE WHEN c_custkey % 3 <> 0 THEN c_custkey * 2 END AS k, c_name AS v FROM customer),
    s AS (SELECT CASE WHEN c_custkey % 3 <> 0 THEN c_custkey * 5 END AS k, upper(c_name) AS v FROM customer)
    SELECT t.k, coalesce(s.v, t.v) AS v FROM t LEFT JOIN s ON t.k = s.k
    UNION ALL
    SELECT k, v FROM s WHERE k IS NULL OR k NOT IN (SELECT k FROM t WHERE k IS NOT NULL)
    """
)
def merge_null_keys(spark, sf_dir):
    """A third of the rows has no key: they match nothing, so the source's are inserted."""
    customer, key = table(spark, sf_dir, "customer"), F.col("c_custkey")
    target = customer.select(F.when(key % 3 != 0, key * 2).alias("k"), F.col("c_name").alias("v"))
    source = customer.select(F.when(key % 3 != 0, key * 5).alias("k"), F.upper("c_name").alias("v"))
    return merge(target, source, ["k"])


@register(
    """
    SELECT CAST(c_mktsegment AS VARCHAR) AS segment, CAST(count(*) AS VARCHAR) AS order_count
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment
    """
)
def custom_query_load(spark, sf_dir):
    """The query's rows replace the source; a table made for them holds text."""
    views = {n: f"v{uuid.uuid4().hex}" for n in ("orders", "customer")}
    for name, view in views.items():
        table(spark, sf_dir, name).createOrReplaceTempView(view)
    query = (
        f"SELECT c_mktsegment AS segment, count(*) AS order_count FROM {views['orders']} "
        f"JOIN {views['customer']} ON o_custkey = c_custkey GROUP BY c_mktsegment"
    )
    try:
        return run_loads(spark, ({"mode": "full", "query": query}, None))
    finally:
        for view in views.values():
            spark.catalog.dropTempView(view)


@register("SELECT * FROM supplier")
def staged_copy(spark, sf_dir):
    """Rows written to a shared folder and read back."""
    return stage(spark, table(spark, sf_dir, "supplier"))
