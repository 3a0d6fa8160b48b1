"""The catalogue of transformation rules."""

from __future__ import annotations

import logging
import threading
import uuid
from collections.abc import Callable, Sequence
from functools import reduce
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.casts import as_number, lenient_cast, to_timestamp
from feedloom.operators.dedupe import drop_duplicates
from feedloom.operators.project import quoted
from feedloom.specs import Rule

log = logging.getLogger(__name__)

_SRC = threading.Lock()

# A dictionary up to this size is a map literal; a larger one is joined, because a
# literal map is searched entry by entry for every row. Rows and types are the same.
MAP_LITERAL_LIMIT = 64

Input = tuple[Column, T.DataType]
ColumnRule = Callable[[list[Input], tuple[Any, ...]], Column]


def _cast_to(spark_type: str) -> ColumnRule:
    return lambda inputs, args: lenient_cast(*inputs[0], spark_type)


def _text(function: Callable[[Column], Column]) -> ColumnRule:
    return lambda inputs, args: function(inputs[0][0].cast("string"))


def _moment(function: Callable[[Column], Column]) -> ColumnRule:
    return lambda inputs, args: function(to_timestamp(*inputs[0]))


def _fold(function: Callable[[Column, Column], Column]) -> ColumnRule:
    def build(inputs: list[Input], args: tuple[Any, ...]) -> Column:
        if not inputs:
            raise ValueError("a math rule needs at least one column")
        return reduce(function, [as_number(*item) for item in inputs])

    return build


def _divide(inputs: list[Input], args: tuple[Any, ...]) -> Column:
    numbers = [as_number(*item) for item in inputs]
    return reduce(F.try_divide, numbers)


def _round(inputs: list[Input], args: tuple[Any, ...]) -> Column:
    return F.round(as_number(*inputs[0]), args[0])


def _fillna(inputs: list[Input], args: tuple[Any, ...]) -> Column:
    """Fill NULLs; the column keeps its type when the default can be read as it."""
    col, kind = inputs[0]
    default = F.lit(str(args[0]))
    if isinstance(kind, (T.StringType, T.ArrayType, T.MapType, T.StructType, T.BinaryType)):
        return F.coalesce(col.cast("string"), default)
    typed = lenient_cast(default, T.StringType(), kind.simpleString())
    if _readable(str(args[0]), kind):
        return F.coalesce(col, typed)
    return F.coalesce(col.cast("string"), default)


def _readable(text: str, kind: T.DataType) -> bool:
    """Whether a default text is a value of the column's type."""
    probe = lenient_cast(F.lit(text), T.StringType(), kind.simpleString())
    exact = probe.isNotNull()
    if isinstance(kind, T.IntegralType):
        exact = exact & (F.lit(text).try_cast("decimal(38,10)") == probe)
    return bool(SparkSession.active().sql("SELECT 1").select(exact).first()[0])


def _regexp_replace(inputs: list[Input], args: tuple[Any, ...]) -> Column:
    pattern, replacement = args
    return F.regexp_replace(inputs[0][0].cast("string"), pattern, replacement)


def _concat(inputs: list[Input], args: tuple[Any, ...]) -> Column:
    return F.concat_ws("", *[col.cast("string") for col, _ in inputs])


def _split(inputs: list[Input], args: tuple[Any, ...]) -> Column:
    if args != ("first",):
        raise ValueError(f"rule 'split' knows only the position 'first', not {args}")
    return F.substring_index(inputs[0][0].cast("string"), " ", 1)


def _substring(inputs: list[Input], args: tuple[Any, ...]) -> Column:
    start, length = args
    return F.substring(inputs[0][0].cast("string"), start + 1, length)


def _mask(inputs: list[Input], args: tuple[Any, ...]) -> Column:
    char, keep = args
    text = inputs[0][0].cast("string")
    hidden = F.greatest(F.length(text) - F.lit(keep), F.lit(0))
    return F.concat(F.substring(text, 1, keep), F.repeat(F.lit(char), hidden))


def _map_literal(inputs: list[Input], args: tuple[Any, ...]) -> Column:
    (mapping,) = args
    col, kind = inputs[0]
    entries, key_type, value_type = _uniform_entries(mapping, kind)
    if not entries:
        return F.lit(None).cast(value_type)
    literal = F.create_map(
        *[item for k, v in entries for item in (F.lit(k).cast(key_type), F.lit(v).cast(value_type))]
    )
    return F.try_element_at(literal, _key_column(col, kind, mapping))


def _uniform_entries(mapping: dict[Any, Any], kind: T.DataType) -> tuple[list[tuple[Any, Any]], str, str]:
    """Entries with keys of one type and values of one type, and those types.

    Mixed values become text. Of keys that are equal once typed the last holds.
    """
    texts = _text_keys(mapping, kind)
    whole = all(isinstance(k, int) for k in mapping)
    key_type = "string" if texts else "bigint" if whole else "double"
    values = [v for v in mapping.values() if v is not None]
    kinds = {type(v) for v in values}
    plain = {bool: "boolean", float: "double"}
    value_type = plain.get(next(iter(kinds)), "string") if len(kinds) == 1 else "string"
    if kinds == {int}:
        value_type = "int" if all(-(2**31) <= v < 2**31 for v in values) else "bigint"
    entries: dict[Any, Any] = {}
    for key, value in mapping.items():
        key = str(key) if texts else int(key) if whole else float(key)
        entries.pop(key, None)
        entries[key] = str(value) if value is not None and value_type == "string" else value
    return list(entries.items()), key_type, value_type


def _text_keys(mapping: dict[Any, Any], kind: T.DataType) -> bool:
    numeric = all(isinstance(k, (int, float)) and not isinstance(k, bool) for k in mapping)
    return not (numeric and isinstance(kind, T.NumericType))


def _key_column(col: Column, kind: T.DataType, mapping: dict[Any, Any]) -> Column:
    if _text_keys(mapping, kind):
        return col.cast("string")
    return col.try_cast("bigint" if all(isinstance(k, int) for k in mapping) else "double")


COLUMN_RULES: dict[str, ColumnRule] = {
    "to_bool": _cast_to("boolean"),
    "to_int": _cast_to("int"),
    "to_float": _cast_to("double"),
    "to_datetime": lambda inputs, args: to_timestamp(*inputs[0]),
    "to_varchar": _cast_to("string"),
    "to_time": _cast_to("time"),
    "year": _moment(F.year),
    "month_name": _moment(lambda c: F.date_format(c, "MMMM")),
    "day_name": _moment(lambda c: F.date_format(c, "EEEE")),
    "upper": _text(F.upper),
    "lower": _text(F.lower),
    "trim": _text(F.trim),
    "strip": _text(F.trim),
    "fillna": _fillna,
    "regexp_replace": _regexp_replace,
    "concat": _concat,
    "split": _split,
    "substring": _substring,
    "sum": _fold(F.try_add),
    "multiply": _fold(F.try_multiply),
    "subtract": _fold(F.try_subtract),
    "divide": _divide,
    "round": _round,
    "map": _map_literal,
    "copy": lambda inputs, args: inputs[0][0],
    "mask": _mask,
}


def _delete(df: DataFrame, rule: Rule) -> DataFrame:
    present = {c.lower() for c in df.columns}
    return df.drop(*[quoted(c) if "." in c else c for c in rule.columns if c.lower() in present])


def _sql(df: DataFrame, rule: Rule) -> DataFrame:
    """Run the rule's query over the rows as ``src`` (or ``{src}``)."""
    if not rule.query:
        raise ValueError("rule 'sql_update' needs a query")
    spark = df.sparkSession
    if "{src}" in rule.query:
        return spark.sql(rule.query, src=df)
    with _SRC:  # feeds that run side by side share the session's view names
        return _over_view(spark, df, rule.query)


def _over_view(spark: SparkSession, df: DataFrame, query: str) -> DataFrame:
    known = spark.table("src") if spark.catalog.tableExists("src") else None
    df.createOrReplaceTempView("src")
    try:
        return spark.sql(query)
    finally:
        spark.catalog.dropTempView("src")
        if known is not None and not spark.catalog.tableExists("src"):
            known.createOrReplaceTempView("src")


def _map_join(df: DataFrame, rule: Rule) -> DataFrame:
    """A large dictionary as a left join with a local relation.

    Spark knows the size of that relation, and broadcasts it if the size allows.
    """
    (mapping,) = rule.args
    kind = _field(df, rule.columns[0]).dataType
    key, value = f"__key_{uuid.uuid4().hex}", f"__value_{uuid.uuid4().hex}"
    entries, key_type, value_type = _uniform_entries(mapping, kind)
    keys, values = zip(*entries, strict=True)
    table = df.sparkSession.createDataFrame(pa.table({key: list(keys), value: list(values)}))
    table = table.select(F.col(key).cast(key_type).alias(key), F.col(value).cast(value_type).alias(value))
    wanted = _key_column(F.col(quoted(rule.columns[0])), kind, mapping)
    joined = df.join(table, wanted == F.col(key), "left")
    return joined.withColumn(rule.output, F.col(value)).drop(key, value)


FRAME_RULES: dict[str, Callable[[DataFrame, Rule], DataFrame]] = {
    "drop_duplicates": lambda df, rule: drop_duplicates(df, rule.columns),
    "delete": _delete,
    "sql_update": _sql,
}


def apply_rules(df: DataFrame, rules: Sequence[Rule], strict: bool = False) -> DataFrame:
    """Apply rules in ``seq`` order, each seeing the result of those before it.

    Neighbouring column rules that do not depend on each other share one
    projection, which keeps the plan shallow however many rules there are. An
    unknown rule raises when ``strict``, else it is reported and skipped.
    """
    pending: dict[str, Column] = {}
    fields: dict[str, T.StructField] = {}
    for rule in sorted(rules, key=lambda r: r.seq):
        frame_rule = FRAME_RULES.get(rule.op)
        if rule.op == "map" and len(rule.args[0]) > MAP_LITERAL_LIMIT:
            frame_rule = _map_join
        if frame_rule is not None:
            df, pending, fields = frame_rule(_flush(df, pending), rule), {}, {}
            continue
        build = COLUMN_RULES.get(rule.op)
        if build is None:
            if strict:
                raise ValueError(f"unknown rule '{rule.op}'")
            log.warning("unknown rule skipped: %s", rule.op)
            continue
        touched = {c.lower() for c in rule.columns} | {rule.output.lower()}
        if touched & {name.lower() for name in pending}:
            df, pending, fields = _flush(df, pending), {}, {}
        fields = fields or {f.name.lower(): f for f in df.schema.fields}
        inputs = [_input(fields, name) for name in rule.columns]
        target = fields[rule.output.lower()].name if rule.output.lower() in fields else rule.output
        pending[target] = build(inputs, rule.args)
    return _flush(df, pending)


def _flush(df: DataFrame, pending: dict[str, Column]) -> DataFrame:
    return df.withColumns(pending) if pending else df


def _input(fields: dict[str, T.StructField], name: str) -> Input:
    field = fields.get(name.lower())
    if field is None:
        raise ValueError(f"rule column '{name}' is not among {sorted(fields)}")
    return F.col(quoted(field.name)), field.dataType


def _field(df: DataFrame, name: str) -> T.StructField:
    return next(f for f in df.schema.fields if f.name.lower() == name.lower())
