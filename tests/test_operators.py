from datetime import datetime

import pytest
from pyspark.sql import functions as F

from feedloom.operators.dedupe import keep_latest
from feedloom.operators.merge import merge, merge_counts, repeated_keys
from feedloom.operators.nested import explode_first, flatten_structs, join_arrays, normalize
from feedloom.operators.watermark import after_mark, high_water_mark


def test_keep_latest(spark, rows):
    day = [datetime(2024, 1, d) for d in (1, 2, 3)]
    data = [(1, day[0], "a"), (1, day[1], "b"), (2, day[2], "x"), (2, day[2], "y"),
            (3, None, "n"), (3, day[0], "m"), (None, day[0], "p"), (None, day[1], "q"),
            (4, None, "w"), (4, None, "w")]
    df = spark.createDataFrame(data, "k int, wm timestamp_ntz, v string")
    assert rows(keep_latest(df, ["K"], ["WM"]).select("k", "v")) == [
        (None, "q"), (1, "b"), (2, "y"), (3, "m"), (4, "w"),
    ]
    assert keep_latest(df, []).count() == 9


def test_keep_latest_with_nested_columns(spark):
    df = spark.sql("SELECT 1 AS k, map('a', i) AS m, array(i) AS r, named_struct('x', i) AS s FROM range(3) t(i)")
    assert keep_latest(df, ["k"]).first()["r"] == [2]


def test_flatten_names(spark):
    df = spark.sql(
        "SELECT 1 AS a, named_struct('a', 2, 'A', 3, 'x.y', 4) AS s, 5 AS b, named_struct('b', 6, 'a_1', 7) AS t"
    )
    flat = flatten_structs(df)
    assert flat.columns == ["a", "a_1", "A_2", "x.y", "b", "b_1", "a_1_1"]
    assert tuple(flat.first()) == (1, 2, 3, 4, 5, 6, 7)


def test_normalize_document(spark, rows):
    text = '[{"a":1,"b":{"a":2,"c":[{"d":1},{"d":2}]},"e":[]},{"a":3}]'
    kind = "array<struct<a:int,b:struct<a:int,c:array<struct<d:int>>>,e:array<int>>>"
    df = spark.createDataFrame([(text,)], "t string").select(F.inline(F.from_json("t", kind)))
    flat = normalize(df)
    assert flat.columns == ["a", "a_1", "d", "e"]
    assert rows(flat) == [(1, 2, 1, []), (1, 2, 2, []), (3, None, None, None)]


def test_sibling_arrays_pair_up(spark):
    df = spark.sql(
        "SELECT 1 AS k, array(named_struct('p',1),named_struct('p',2)) AS x, "
        "array(named_struct('q',1),named_struct('q',2)) AS y"
    )
    assert normalize(df).count() == 4
    assert normalize(df, explode=False).columns == ["k", "x", "y"]
    assert explode_first(df).columns == ["k", "x", "y"]


def test_explode_keeps_parents(spark):
    df = spark.sql(
        "SELECT 1 AS k, array(named_struct('p',1)) AS x UNION ALL SELECT 2, NULL "
        "UNION ALL SELECT 3, CAST(array() AS array<struct<p:int>>)"
    )
    assert sorted(r["k"] for r in normalize(df).collect()) == [1, 2, 3]


def test_join_arrays(spark):
    df = spark.sql(
        "SELECT array(1, NULL, 3) AS n, CAST(NULL AS array<string>) AS z, array(array(1,2), array(3)) AS d, "
        "array() AS e, array(named_struct('p', 1)) AS s"
    )
    row = join_arrays(df).first()
    assert (row["n"], row["z"], row["d"], row["e"]) == ("1|3", None, "[1,2]|[3]", "")
    assert row["s"][0]["p"] == 1


TARGET = [(1, "a", "t1"), (2, "b", "t2"), (None, "n", "tn")]
SOURCE = [(2, "B"), (3, "C"), (None, "N")]
MERGED = [(None, "N", None), (None, "n", "tn"), (1, "a", "t1"), (2, "B", "t2"), (3, "C", None)]


def frames(spark):
    target = spark.createDataFrame(TARGET, "k int, v string, only_target string")
    return target, spark.createDataFrame(SOURCE, "K int, v string")


def test_merge(any_mode, rows):
    target, source = frames(any_mode)
    done = merge(target, source, ["k"], "what")
    assert rows(done.drop("what")) == MERGED
    assert dict(rows(merge_counts(done, "what"))) == {"insert": 2, "unchanged": 2, "update": 1}
    assert done.schema["k"].dataType == target.schema["k"].dataType


def test_merge_updates_to_null(spark, rows):
    target, _ = frames(spark)
    source = spark.createDataFrame([(1, None)], "k int, v string")
    assert (1, None, "t1") in rows(merge(target, source, ["k"]))


def test_merge_without_insert(spark, rows):
    target, source = frames(spark)
    assert rows(merge(target, source, ["k"], insert=False)) == [(None, "n", "tn"), (1, "a", "t1"), (2, "B", "t2")]


def test_merge_on_all_columns_only_inserts(spark, rows):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    source = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    assert rows(merge(target, source, ["k", "v"])) == [(1, "a"), (1, "b")]


def test_merge_repeated_target_keys_and_typed_source(any_mode, rows):
    target = any_mode.createDataFrame([(1, 10), (1, 20), (2, 30)], "k int, v int")
    source = any_mode.createDataFrame([("1", "7.9", "extra"), ("9", "x", "extra")], "k string, v string, other string")
    assert rows(merge(target, source, ["k"])) == [(1, 7), (1, 7), (2, 30), (9, None)]


def test_merge_two_keys_with_a_null_part(spark, rows):
    target = spark.createDataFrame([(1, None, "a"), (1, 2, "b")], "k int, j int, v string")
    source = spark.createDataFrame([(1, None, "A"), (1, 2, "B")], "k int, j int, v string")
    assert rows(merge(target, source, ["k", "j"])) == [(1, None, "A"), (1, None, "a"), (1, 2, "B")]


def test_merge_needs_keys(spark):
    target, source = frames(spark)
    with pytest.raises(ValueError):
        merge(target, source, [])
    with pytest.raises(ValueError, match="lacks"):
        merge(target, source, ["only_target"])


def test_merge_with_shuffles(spark, rows):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows(merge(*frames(spark), ["k"])) == MERGED
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_repeated_keys(spark, rows):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    assert rows(repeated_keys(df, ["k"])) == [(1, 2)]


@pytest.mark.parametrize(
    "kind, low, high",
    [
        ("int", "1", "2"), ("string", "'a'", "'b'"), ("double", "0.1", "0.30000000000000004"),
        ("decimal(20,5)", "1.00001", "1.00002"), ("date", "'2024-01-01'", "'2024-01-02'"),
        ("timestamp", "'2024-01-01 00:00:00.000001'", "'2024-01-01 00:00:00.000002'"),
        ("timestamp_ntz", "'2024-01-01 00:00:00.000001'", "'2024-01-01 00:00:00.000002'"),
    ],
)
def test_marks_of_all_types(spark, kind, low, high):
    df = spark.sql(f"SELECT CAST(x AS {kind}) AS w FROM VALUES ({low}), ({high}), (NULL) t(x)")
    mark = high_water_mark(df.filter(F.col("w") == F.expr(f"CAST({low} AS {kind})")), "W")
    assert after_mark(df, "w", mark).count() == 1
    assert after_mark(df, "w", high_water_mark(df, "w")).count() == 0


def test_no_mark_keeps_everything(spark):
    df = spark.sql("SELECT CAST(x AS int) AS w FROM VALUES (1), (NULL) t(x)")
    mark = high_water_mark(df.filter("w IS NULL"), "w")
    assert mark is None and after_mark(df, "w", mark).count() == 2
