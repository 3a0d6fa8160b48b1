"""Normalisation of nested rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.operators.nested import flatten_structs, join_arrays, normalize
from feedloom.queries import register, table


@register(
    """
    SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, value AS value,
           event_type AS kind, value + 1 AS value_1
    FROM events
    """
)
def flatten_events_props(spark, sf_dir):
    """A struct read from JSON; the name that repeats gets a suffix."""
    events = table(spark, sf_dir, "events")
    nested = events.select(
        "event_id",
        F.struct(
            F.from_json("props", "k int")["k"].alias("k"), "value", F.col("event_type").alias("kind")
        ).alias("detail"),
        (F.col("value") + 1).alias("value"),
    )
    return flatten_structs(nested)


@register(
    """
    WITH split AS (
      SELECT conv_id, turn, string_split(text, chr(10)) AS parts FROM conversations
      WHERE turn % 5 < 3),
    numbered AS (
      SELECT conv_id, turn, parts, unnest(generate_series(1, len(parts))) AS i FROM split)
    SELECT conv_id, turn, CAST(i - 1 AS INTEGER) AS line_no, parts[i] AS line FROM numbered
    UNION ALL
    SELECT conv_id, turn, NULL, NULL FROM conversations WHERE turn % 5 >= 3
    """
)
def explode_conversations(spark, sf_dir):
    """The lines of each turn as an array of structs; NULL and empty arrays keep their row."""
    lines = F.transform(
        F.split("text", "\n"), lambda line, i: F.struct(i.cast("int").alias("line_no"), line.alias("line"))
    )
    rest = F.col("turn") % 5
    kept = F.when(rest < 3, lines).when(rest == 3, F.filter(lines, lambda _: F.lit(False)))
    return normalize(table(spark, sf_dir, "conversations").select("conv_id", "turn", kept.alias("lines")))


@register(
    """
    SELECT o_orderkey, o_custkey AS id, o_orderstatus AS code, o_orderpriority AS text,
           x.word AS word, y.code_1 AS code_1
    FROM orders,
         LATERAL (SELECT unnest(string_split(o_orderpriority, '-')) AS word) x,
         LATERAL (SELECT unnest([o_orderstatus || '1', o_orderstatus || '2']) AS code_1) y
    WHERE o_custkey % 3 <> 0
    UNION ALL
    SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, NULL, y.code_1
    FROM orders, LATERAL (SELECT unnest([o_orderstatus || '1', o_orderstatus || '2']) AS code_1) y
    WHERE o_custkey % 3 = 0
    """
)
def normalize_nested_orders(spark, sf_dir):
    """Structs within structs, and two arrays side by side, until the rows are flat."""
    words = F.transform(F.split("o_orderpriority", "-"), lambda w: F.struct(w.alias("word")))
    codes = F.transform(
        F.array(F.lit("1"), F.lit("2")),
        lambda n: F.struct(F.concat("o_orderstatus", n).alias("code")),
    )
    priority = F.struct(F.col("o_orderstatus").alias("code"), F.col("o_orderpriority").alias("text"))
    nested = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.struct(F.col("o_custkey").alias("id"), priority.alias("priority")).alias("buyer"),
        F.when(F.col("o_custkey") % 3 != 0, words).alias("words"),
        codes.alias("codes"),
    )
    return normalize(nested)


@register(
    """
    SELECT p_partkey, CASE WHEN p_partkey % 4 <> 0 THEN replace(p_name, ' ', '|') END AS words,
           p_size || '|' || p_partkey AS numbers
    FROM part
    """
)
def join_primitive_array(spark, sf_dir):
    """Arrays of plain values as text; a NULL array stays NULL, NULL elements are skipped."""
    arrays = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(F.col("p_partkey") % 4 != 0, F.split("p_name", " ")).alias("words"),
        F.array(F.col("p_size").cast("bigint"), F.lit(None).cast("bigint"), "p_partkey").alias("numbers"),
    )
    return join_arrays(arrays)
