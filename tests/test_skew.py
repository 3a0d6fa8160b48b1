"""Hot keys: a third of all rows with one key, a third without a key."""

import duckdb
import pytest
from pyspark.sql import functions as F

from feedloom.operators.checks import check_reference
from feedloom.operators.dedupe import keep_latest
from feedloom.operators.merge import merge

ROWS = 120_000
SKEWED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
}


@pytest.fixture
def skewed(spark):
    for key, value in SKEWED.items():
        spark.conf.set(key, value)
    yield spark
    for key in SKEWED:
        spark.conf.unset(key)


def hot(spark, rows=ROWS):
    key = F.when(F.col("id") % 3 == 0, F.lit(-1)).when(F.col("id") % 3 == 1, F.col("id"))
    return spark.range(0, rows, 1, 8).select(
        key.alias("k"), F.pmod(F.xxhash64("id"), F.lit(1000)).alias("w"), F.col("id").alias("v")
    )


def totals(df):
    row = df.agg(F.count("*"), F.count("k"), F.sum("k"), F.sum("w"), F.sum("v")).first()
    return tuple(row)


def in_duckdb(sql, **frames):
    con = duckdb.connect()
    for name, df in frames.items():
        con.register(name, df.toArrow())
    return con.execute(sql).fetchone()


def test_dedupe(skewed):
    df = hot(skewed)
    wanted = in_duckdb(
        "SELECT count(*), count(k), sum(k), sum(w), sum(v) FROM (SELECT * FROM t "
        "QUALIFY row_number() OVER (PARTITION BY k ORDER BY w DESC, v DESC) = 1)", t=df,
    )
    assert totals(keep_latest(df, ["k"], ["w"])) == wanted


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_merge(skewed):
    target = hot(skewed)
    source = skewed.range(-1, ROWS * 2, 2, 8).select(F.col("id").alias("k"), F.lit(7).cast("bigint").alias("w"))
    done = merge(target, source, ["k"])
    wanted = in_duckdb(
        "SELECT count(*), count(k), sum(k), sum(w), sum(v) FROM ("
        "SELECT t.k, coalesce(s.w, t.w) AS w, t.v FROM t LEFT JOIN s ON t.k = s.k "
        "UNION ALL SELECT s.k, s.w, NULL FROM s WHERE s.k NOT IN (SELECT k FROM t WHERE k IS NOT NULL))",
        t=target, s=source,
    )
    assert totals(done) == wanted
    assert "skew=true" in final_plan(done)


def test_reference_check(skewed):
    df = hot(skewed)
    parents = skewed.range(0, ROWS, 1).filter("id % 2 = 0")
    found = check_reference(df, "T", "k", parents, "id")
    wanted = in_duckdb(
        "SELECT count(DISTINCT k), count(*) FROM t WHERE k IS NOT NULL AND k NOT IN (SELECT id FROM p)",
        t=df, p=parents,
    )
    assert tuple(found.agg(F.count("*"), F.sum("row_count")).first()) == wanted


@pytest.mark.parametrize("hot_key", [False, True])
def test_large_merges_are_dealt_out_by_rows(spark, monkeypatch, hot_key):
    from feedloom.operators import merge as merge_module

    monkeypatch.setattr(merge_module, "SMALL_ROWS", 100)
    monkeypatch.setattr(merge_module, "TASK_ROWS", 2_000)
    key = F.when(F.col("id") % 500 == 0, F.lit(None)).when((F.col("id") % 3 == 0) & F.lit(hot_key), F.lit(-2)).otherwise(F.col("id") * 2)
    # All rows are a few KB of shuffle: Spark by itself makes one task of them.
    target = spark.range(0, 30_000, 1, 4).select(key.alias("k"), F.lit(5).cast("bigint").alias("w"), F.lit(1).cast("bigint").alias("v"))
    source = spark.range(0, 30_000, 1, 4).select(
        F.when(F.col("id") % 700 != 0, F.col("id") * 3).when(F.col("id") == 0, F.lit(-2)).alias("k"), F.lit(7).cast("bigint").alias("w")
    )
    done = merge(target, source, ["k"], "o")
    most = done.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert (most <= 2 * 2_000) is not hot_key
    wanted = in_duckdb(
        "SELECT count(*), count(k), sum(k), sum(w), sum(v) FROM ("
        "SELECT t.k, coalesce(s.w, t.w) AS w, t.v FROM t LEFT JOIN s ON t.k = s.k "
        "UNION ALL SELECT s.k, s.w, NULL FROM s WHERE s.k IS NULL OR s.k NOT IN (SELECT k FROM t WHERE k IS NOT NULL))",
        t=target, s=source,
    )
    assert totals(done) == wanted
    if not hot_key:
        assert final_plan(done).split("Initial Plan")[0].count("Exchange hashpartitioning") == 4


def test_keys_are_counted_by_rows(spark, monkeypatch):
    from feedloom.operators import merge as merge_module

    monkeypatch.setattr(merge_module, "TASK_ROWS", 1_000)
    df = spark.range(0, 9_000, 1, 2).select(F.when(F.col("id") == 7, 8).when(F.col("id") > 8_990, F.lit(None)).otherwise(F.col("id")).alias("k"))
    found = merge_module.repeated_keys(df, ["k"], 9_000)
    assert [tuple(r) for r in found.collect()] == [(8, 2)]
    assert "REPARTITION_BY_NUM" in found._jdf.queryExecution().executedPlan().toString()
