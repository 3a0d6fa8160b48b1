from datetime import datetime

import pytest

from feedloom.operators import rules as catalogue
from feedloom.operators.rules import apply_rules
from feedloom.specs import Rule, parse_dictionary


def run(df, *rows, strict=True):
    return apply_rules(df, [Rule.parse(*row, seq=i) for i, row in enumerate(rows)], strict)


def one(df, *rows, column="out"):
    return [r[column] for r in run(df, *rows).collect()]


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v string")


@pytest.mark.parametrize(
    "rule, given, wanted",
    [
        ("to_bool", ["t", " FALSE ", "on", None], [True, False, None, None]),
        ("to_int", ["1.5", "-1.5", "x", None], [1, -1, None, None]),
        ("to_float", ["1.5", "x", None], [1.5, None, None]),
        ("to_varchar", ["a", None], ["a", None]),
        ("to_time", ["2024-03-05 01:02:03", "x", None], ["01:02:03", None, None]),
        ("year", ["2024-03-05", "x", None], [2024, None, None]),
        ("month_name", ["2024-03-05", "x", None], ["March", None, None]),
        ("day_name", ["2024-03-05", "x", None], ["Tuesday", None, None]),
        ("upper", ["aB", None], ["AB", None]),
        ("lower", ["aB", None], ["ab", None]),
        ("trim", ["  a ", "\ta", None], ["a", "\ta", None]),
        ("strip", ["  a ", None], ["a", None]),
        ("fillna:Unknown", ["a", "", None], ["a", "", "Unknown"]),
        ("regexp_replace:[A-Z]+,<$0>", ["aBCd", None], ["a<BC>d", None]),
        (r"regexp_replace:\D,", ["a1b2", None], ["12", None]),
        ("regexp_replace:a,b,c", ["a"], ["b,c"]),
        ("concat", ["a", None], ["a", ""]),
        ("split:first", ["one two", "one", "", " lead", None], ["one", "one", "", "", None]),
        ("substring:1,2", ["abcd", "a", None], ["bc", "", None]),
        ("copy", ["a", None], ["a", None]),
        ("mask:*,2", ["abcd", "a", "", None], ["ab**", "a", "", None]),
        ("mask:',0", ["ab"], ["''"]),
        ("map:{'a': 'A', 'b': 1}", ["a", "b", "c", None], ["A", "1", None, None]),
        ('map:{"a": 1}', ["a", "x"], [1, None]),
        ("UPPER", ["a"], ["A"]),
    ],
)
def test_text_rules(any_mode, rule, given, wanted):
    assert one(texts(any_mode, *given), (rule, "v", "out")) == wanted


def test_to_datetime(any_mode):
    df = run(texts(any_mode, "2024-03-05 01:02:03", "x"), ("to_datetime", "v", "out"))
    assert dict(df.dtypes)["out"] == "timestamp"
    values = [r[0] for r in df.selectExpr("CAST(out AS timestamp_ntz)").collect()]
    assert values == [datetime(2024, 3, 5, 1, 2, 3), None]


@pytest.mark.parametrize(
    "rule, wanted",
    [("sum", 7.5), ("multiply", 9.0), ("subtract", 4.5), ("divide", 4.0)],
)
def test_math_over_mixed_types(any_mode, rule, wanted):
    df = any_mode.createDataFrame([(6, "1.5")], "a int, b string")
    assert one(df, (rule, "a,b", "out")) == [wanted]


def test_math_with_null_and_zero(any_mode):
    df = any_mode.createDataFrame([(6, 0, None)], "a int, b int, c int")
    out = run(df, ("divide", "a,b", "zero"), ("divide", "a,c", "unknown"), ("sum", "a,c", "total"),
              ("divide", "b,a", "whole")).first()
    assert (out["zero"], out["unknown"], out["total"], out["whole"]) == (None, None, None, 0.0)


def test_overflow_is_null(any_mode):
    df = any_mode.createDataFrame([(2147483647, 1)], "a int, b int")
    assert one(df, ("sum", "a,b", "out")) == [None]


def test_round_half_up(any_mode):
    df = any_mode.sql("SELECT 2.5D AS a, CAST(-1.255 AS decimal(10,3)) AS b, '2.345' AS c")
    out = run(df, ("round:0", "a"), ("round:2", "b"), ("round:1", "c")).first()
    assert (out["a"], str(out["b"]), out["c"]) == (3.0, "-1.26", 2.3)


def test_fillna_by_type(any_mode):
    df = any_mode.createDataFrame([(None, None, None)], "a int, b int, c double")
    out = run(df, ("fillna:7", "a"), ("fillna:n/a", "b"), ("fillna:1.5", "c"))
    assert tuple(out.first()) == (7, "n/a", 1.5)
    assert dict(out.dtypes) == {"a": "int", "b": "string", "c": "double"}


def test_fillna_fraction_on_whole_column(any_mode):
    df = any_mode.createDataFrame([(None,), (3,)], "a int")
    assert one(df, ("fillna:1.5", "a"), column="a") == ["1.5", "3"]


def test_map_with_number_keys(any_mode):
    df = any_mode.createDataFrame([(1,), (5,)], "a bigint")
    assert one(df, ("map:{1: 'one', 2: 'two'}", "a", "out")) == ["one", None]


def test_map_is_never_evaluated():
    with pytest.raises(ValueError):
        parse_dictionary("__import__('os').getcwd()")
    with pytest.raises(ValueError):
        parse_dictionary("[1, 2]")


def test_large_map_equals_small(any_mode, monkeypatch):
    df = texts(any_mode, "a", "b", "c", None)
    rule = ("map:{'a': 'x', 'b': 'y'}", "v", "out")
    small = one(df, rule)
    monkeypatch.setattr(catalogue, "MAP_LITERAL_LIMIT", 1)
    assert sorted(one(df, rule), key=str) == sorted(small, key=str)


def test_delete_ignores_absent(any_mode):
    df = any_mode.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert run(df, ("delete", "B,nothing,a")).columns == ["c"]


def test_target_defaults_to_first_input(any_mode):
    df = any_mode.createDataFrame([("a", "b")], "x string, y string")
    assert tuple(run(df, ("concat", "x,y")).first()) == ("ab", "b")
    assert tuple(run(df, ("concat", "x,y", "")).first()) == ("ab", "b")


def test_rules_see_earlier_results(any_mode):
    df = texts(any_mode, " a ")
    assert one(df, ("trim", "v"), ("upper", "v"), ("concat", "v,v", "out")) == ["AA"]


def test_rules_run_by_seq(any_mode):
    rules = [Rule.parse("upper", "v", seq=2), Rule.parse("fillna:b", "v", seq=1)]
    assert apply_rules(texts(any_mode, None), rules).first()[0] == "B"


def test_drop_duplicates_is_repeatable(any_mode, rows):
    df = any_mode.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (2, "c")], "k int, v string")
    assert rows(run(df, ("drop_duplicates", "k"))) == [(1, "b"), (2, "c")]
    assert rows(run(df, ("drop_duplicates", ""))) == [(1, "a"), (1, "b"), (2, "c")]


@pytest.mark.parametrize("name", ["src", "{src}"])
def test_sql_update(any_mode, name):
    df = any_mode.createDataFrame([(1,), (2,)], "a int")
    out = run(df, ("sql_update", None, None, f"SELECT sum(a) AS total FROM {name}"))
    assert out.first()["total"] == 3
    assert not any_mode.catalog.tableExists("src")


def test_sql_update_keeps_a_view_named_src(any_mode):
    any_mode.createDataFrame([(9,)], "mine int").createOrReplaceTempView("src")
    try:
        run(any_mode.createDataFrame([(1,)], "a int"), ("sql_update", None, None, "SELECT a FROM src"))
        assert any_mode.table("src").columns == ["mine"]
    finally:
        any_mode.catalog.dropTempView("src")


def test_unknown_rule(spark):
    df = texts(spark, "a")
    with pytest.raises(ValueError, match="unknown rule"):
        run(df, ("shout", "v"))
    assert run(df, ("shout", "v"), strict=False).collect() == df.collect()


@pytest.mark.parametrize(
    "row, error",
    [
        (("split:last", "v", "out"), "first"),
        (("upper", "nothing", "out"), "not among"),
        (("upper", "", ""), "no column"),
        (("sql_update", None, None, None), "query"),
        (("multiply", "", "out"), "at least one"),
    ],
)
def test_wrong_rules_raise(spark, row, error):
    with pytest.raises(ValueError, match=error):
        run(texts(spark, "a"), row)


def test_the_size_of_a_dictionary_changes_nothing(spark):
    """64 entries are a literal, 65 a join: the same type and the same rows, also for equal keys."""
    df = spark.createDataFrame([("1",), ("5",), ("x",)], "k string")
    for size in (64, 65):
        mapping = {**{i: i * 10 for i in range(1, size)}, "1": 7}
        out = apply_rules(df, [Rule("map", ("k",), (mapping,), "v")])
        assert dict(out.dtypes)["v"] == "int"
        assert {tuple(r) for r in out.collect()} == {("1", 7), ("5", 50), ("x", None)}
