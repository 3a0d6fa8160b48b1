from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.casts import lenient_cast, target_type
from feedloom.operators.project import project, pruned_query, target_schema
from feedloom.specs import ColumnMapping

TEXTS = ["1.5", "-1.5", " 7 ", "abc", "", "3000000000", None]


def cast_all(spark, texts, spark_type):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")
    out = df.select("i", lenient_cast(F.col("v"), T.StringType(), spark_type).alias("v"))
    return [r["v"] for r in out.orderBy("i").collect()]


@pytest.mark.parametrize(
    "spark_type, wanted",
    [
        ("int", [1, -1, 7, None, None, None, None]),
        ("bigint", [1, -1, 7, None, None, 3000000000, None]),
        ("double", [1.5, -1.5, 7.0, None, None, 3e9, None]),
        ("string", TEXTS),
        ("decimal(12,2)", [Decimal("1.50"), Decimal("-1.50"), Decimal("7.00"), None, None, Decimal("3000000000.00"), None]),
    ],
)
def test_text_to_number(any_mode, spark_type, wanted):
    assert cast_all(any_mode, TEXTS, spark_type) == wanted


def test_text_to_boolean(any_mode):
    texts = ["t", "Y", "1", "0", "no", "on", " true ", "f", None]
    assert cast_all(any_mode, texts, "boolean") == [True, True, True, False, False, None, True, False, None]


def test_text_to_moment(any_mode):
    texts = ["2024-03-05", "2024-03-05 01:02:03", "not a date", None]
    assert cast_all(any_mode, texts, "date") == [date(2024, 3, 5), date(2024, 3, 5), None, None]
    assert cast_all(any_mode, texts, "timestamp_ntz") == [
        datetime(2024, 3, 5), datetime(2024, 3, 5, 1, 2, 3), None, None,
    ]
    assert cast_all(any_mode, texts, "time") == ["00:00:00", "01:02:03", None, None]


def test_wide_numbers_do_not_wrap(any_mode):
    df = any_mode.createDataFrame([(3000000000, 1.9, True)], "a bigint, b double, c boolean")
    kinds = {f.name: f.dataType for f in df.schema.fields}
    row = df.select(*[lenient_cast(F.col(c), kinds[c], "int").alias(c) for c in "abc"]).first()
    assert tuple(row) == (None, 1, 1)


def test_ends_of_the_ranges(any_mode):
    texts = ["2147483647.9", "2147483648", "-2147483648.9", "-2147483649", "1e3", "+5", ".5", "5.", "1 2", "٣",
             "9223372036854775807", "9223372036854775808", "-9223372036854775808.5", "1_0", "0x1", "12d", "- 1"]
    assert cast_all(any_mode, texts, "int") == [
        2147483647, None, -2147483648, None, 1000, 5, 0, 5, None, None, None, None, None, None, None, None, None,
    ]
    assert cast_all(any_mode, texts, "bigint")[10:13] == [9223372036854775807, None, -9223372036854775808]
    assert cast_all(any_mode, ["1.5d", "Infinity", "-inf", "\t2\n", "1e400", "x"], "double") == [
        1.5, float("inf"), float("-inf"), 2.0, float("inf"), None,
    ]
    assert cast_all(any_mode, ["\tTRUE\n", "tr ue", "11"], "boolean") == [True, None, None]


@pytest.mark.parametrize(
    "kind, values, ints, bigints",
    [
        ("double", [2147483647.9, 2147483648.0, -2147483648.9, -2147483649.0, float("nan"), float("inf"), None],
         [2147483647, None, -2147483648, None, None, None, None],
         [2147483647, 2147483648, -2147483648, -2147483649, None, None, None]),
        ("double", [9.3e18, -9223372036854775808.0, -9.3e18], [None, None, None], [None, -9223372036854775808, None]),
        ("bigint", [2147483648, -2147483648, 7], [None, -2147483648, 7], [2147483648, -2147483648, 7]),
        ("decimal(30,1)", [Decimal("2147483647.9"), Decimal("-2147483648.9"), Decimal("1e20")],
         [2147483647, -2147483648, None], [2147483647, -2147483648, None]),
    ],
)
def test_numbers_to_whole_numbers(any_mode, kind, values, ints, bigints):
    df = any_mode.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    for target, wanted in (("int", ints), ("bigint", bigints)):
        out = df.select("i", lenient_cast(F.col("v"), df.schema["v"].dataType, target).alias("v"))
        assert [r["v"] for r in out.orderBy("i").collect()] == wanted


def test_dates_to_numbers_are_null(any_mode):
    df = any_mode.sql("SELECT DATE'2024-01-02' AS d, TIMESTAMP_NTZ'2024-01-02 03:04:05' AS t")
    row = df.select(
        lenient_cast(F.col("d"), T.DateType(), "int"),
        lenient_cast(F.col("d"), T.DateType(), "double"),
        lenient_cast(F.col("t"), T.TimestampNTZType(), "boolean"),
        lenient_cast(F.col("t"), T.TimestampNTZType(), "date"),
    ).first()
    assert tuple(row) == (None, None, None, date(2024, 1, 2))


@pytest.mark.parametrize(
    "text, wanted, legacy",
    [
        ("INT", "int", "int"),
        ("bigint", "bigint", "int"),
        ("NUMBER(10,2)", "decimal(10,2)", "string"),
        ("Decimal(12, 4)", "decimal(12,4)", "double"),
        ("NUMBER", "decimal(38,0)", "string"),
        ("FLOAT", "double", "double"),
        ("DOUBLE PRECISION", "double", "double"),
        ("BOOLEAN", "boolean", "boolean"),
        ("BOOL", "boolean", "string"),
        ("DATE", "date", "timestamp"),
        ("DATETIME", "timestamp", "timestamp"),
        ("TIMESTAMP_NTZ(9)", "timestamp_ntz", "timestamp"),
        ("TIME", "time", "string"),
        ("VARCHAR(20)", "string", "string"),
        ("VARIANT", "string", "string"),
        ("INTERVAL", "string", "int"),
        (None, "string", "string"),
        ("", "string", "string"),
    ],
)
def test_type_names(text, wanted, legacy):
    assert target_type(text) == wanted
    assert target_type(text, legacy=True) == legacy


def test_project(any_mode):
    df = any_mode.createDataFrame([(1, "x", "2.7", [1, None, 3])], "Id int, `a.b` string, n string, arr array<int>")
    out = project(
        df,
        [
            ColumnMapping("N", "number", "INT", 2),
            ColumnMapping(" id ", "key", "VARCHAR", 1),
            ColumnMapping("A.B", "dotted", None, 3),
            ColumnMapping("gone", "gone", "BIGINT", 4),
            ColumnMapping("arr", "arr", "VARCHAR", 5),
            ColumnMapping("later", "clock", "TIME", 6),
        ],
    )
    assert out.columns == ["key", "number", "dotted", "gone", "arr", "clock"]
    assert tuple(out.first()) == ("1", 2, "x", None, "[1, null, 3]", None)
    assert dict(out.dtypes)["gone"] == "bigint"


def test_sequence_orders_and_defaults_to_zero():
    schema = target_schema([ColumnMapping("a", "a", "INT", 5), ColumnMapping("b", "b", "DATE")])
    assert schema.simpleString() == "struct<b:date,a:int>"


def test_pruned_query():
    assert pruned_query("Account", ["Name", "Id", " Name ", ""]) == "SELECT Id, Name FROM Account"
    assert pruned_query("Account", []) == "SELECT Id FROM Account"
    assert pruned_query(" select 1", ["x"]) == "select 1"
