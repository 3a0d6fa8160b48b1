"""The shape of the physical plans."""

import re

import pytest
from pyspark.sql import functions as F

from feedloom.operators.merge import SMALL_ROWS, is_large, merge
from feedloom.operators.rules import apply_rules
from feedloom.plans.feed import mark_goes_first
from feedloom.queries import QUERIES
from feedloom.specs import ColumnMapping, FeedSpec, LoadSpec, Rule, SourceSpec

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def reads(text):
    """The columns each scan reads."""
    return re.findall(r"FileScan parquet \[([^\]]*)\]", text)


def test_dedupe_limits_before_the_shuffle(spark):
    text = plan(QUERIES["ingest_lineitem"](spark, SF))
    partial, final = text.index("Partial"), text.index("Final")
    assert text.count("WindowGroupLimit") == 2 and text.count("Exchange") == 1
    assert final < text.index("Exchange") < partial
    assert len(reads(text)[0].split(",")) == 7 and "l_partkey" not in reads(text)[0]


def test_rules_make_one_projection(spark):
    df = spark.read.parquet(f"{SF}/lineitem.parquet")
    rules = [Rule.parse("sum", "l_quantity,l_tax", f"t{i}", seq=i) for i in range(40)]
    rules += [Rule.parse("round:1", f"t{i}", seq=100 + i) for i in range(40)]
    text = plan(apply_rules(df, rules))
    assert text.count("Project") == 1 and "Exchange" not in text


def test_large_dictionary_does_not_shuffle_the_rows(spark):
    text = plan(QUERIES["rule_map"](spark, SF))
    assert "BroadcastHashJoin" in text and "LocalTableScan" in text and "Exchange hashpartitioning" not in text


def test_scan_reads_what_is_used(spark):
    text = plan(QUERIES["parquet_scan"](spark, SF))
    assert "GreaterThan(p_size,10)" in text
    assert "p_brand" not in reads(text)[0]


def test_mark_is_pushed_down(spark):
    text = plan(QUERIES["append_watermark_only_new"](spark, SF))
    assert "GreaterThan(ts," in text and "Exchange" not in text


def test_small_source_leaves_the_target_in_place(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    source = orders.filter("o_orderkey < 10")
    text = plan(merge(orders, source, ["o_orderkey"]))
    assert "SortMergeJoin" not in text and "Cartesian" not in text and "NestedLoop" not in text
    # The only shuffle is of keys found in both.
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1


@pytest.mark.parametrize("broadcast", ["-1", "10MB"])
def test_large_merge_uses_joins_that_skew_handling_splits(spark, broadcast):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        text = plan(QUERIES["merge_orders"](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "FullOuter" not in text and "Cartesian" not in text and "NestedLoop" not in text


def test_a_source_of_many_rows_is_not_broadcast_however_small_its_files(spark, tmp_path):
    def source(count):
        path = str(tmp_path / str(count))
        spark.range(0, 2 * count, 2, 1).selectExpr("id AS k", "0 AS v").write.parquet(path)
        return spark.read.parquet(path)

    small, many = source(SMALL_ROWS), source(SMALL_ROWS + 1)
    assert is_large(many) and not is_large(small)
    target = spark.range(0, SMALL_ROWS, 1, 2).selectExpr("CAST(id DIV 2 AS BIGINT) AS k", "1 AS v", "id AS w")
    assert "Broadcast" in plan(merge(target, small, ["k"]))
    done = merge(target, many, ["k"])
    assert "Broadcast" not in plan(done) and "SortMergeJoin" in plan(done)
    met = SMALL_ROWS // 4
    got = done.groupBy("v", F.col("w").isNull().alias("new")).count().collect()
    assert {(r["v"], r["new"]): r["count"] for r in got} == {(0, False): 2 * met, (1, False): 2 * met, (0, True): SMALL_ROWS + 1 - met}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_single_task(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text
    # A single partition may only hold an aggregate without keys.
    for found in re.finditer(r"Exchange SinglePartition", text):
        assert "partial_" in text[found.end(): found.end() + 400]


def feed(watermark="w", rules=(), query=None):
    return FeedSpec(
        "1", "n", SourceSpec("parquet"), (ColumnMapping("a", "w"),),
        LoadSpec("append", "t", ("k",), watermark, query), tuple(rules),
    )


@pytest.mark.parametrize(
    "spec, early",
    [
        (feed(), True),
        (feed(rules=[Rule("upper", ("v",))]), True),
        (feed(rules=[Rule("upper", ("W",))]), False),
        (feed(rules=[Rule("sql_update", query="SELECT * FROM src")]), False),
        (feed(rules=[Rule("drop_duplicates", ("v",))]), False),
        (feed(watermark=None), False),
        (feed(watermark="other"), False),
        (feed(query="SELECT 1"), False),
    ],
)
def test_when_the_mark_may_go_first(spec, early):
    assert mark_goes_first(spec) is early


def test_early_mark_gives_the_rows_of_a_late_one(spark, rows):
    from feedloom.operators.watermark import after_mark
    from feedloom.plans.feed import shape

    df = spark.createDataFrame(
        [("a", 1), ("a", 9), ("b", 4), ("b", None), ("c", None), ("d", 5)], "k string, w int"
    )
    spec, mark = feed(), F.lit(4)
    assert rows(shape(df, spec, mark)) == rows(after_mark(shape(df, spec), "w", mark)) == [("a", 9), ("d", 5)]
