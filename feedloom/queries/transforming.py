"""Transformation rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.operators.metadata import transform_rules
from feedloom.operators.rules import apply_rules
from feedloom.queries import register, table
from feedloom.specs import Rule


def rules(*rows: tuple) -> list[Rule]:
    """Rules from (text, columns, target[, query]) tuples, in order."""
    return [Rule.parse(*row, seq=i) for i, row in enumerate(rows)]


@register(
    """
    SELECT * FROM orders QUALIFY row_number() OVER (
      PARTITION BY o_custkey, o_orderstatus
      ORDER BY o_orderkey DESC, o_totalprice DESC, o_orderdate DESC, o_orderpriority DESC) = 1
    """
)
def rule_drop_duplicates(spark, sf_dir):
    """One row per key; which one is settled by all other columns."""
    return apply_rules(table(spark, sf_dir, "orders"), rules(("drop_duplicates", "o_custkey,o_orderstatus")))


@register(
    """
    SELECT p_partkey, upper(p_name) AS up, lower(p_brand) AS low,
           p_name AS trimmed, p_name AS stripped,
           concat_ws('', p_brand, p_type) AS joined,
           split_part(p_name, ' ', 1) AS first_word,
           substring(p_brand, 3, 4) AS middle, p_type AS copied
    FROM part
    """
)
def rule_strings(spark, sf_dir):
    padded = table(spark, sf_dir, "part").withColumn("padded", F.concat(F.lit("  "), "p_name", F.lit(" ")))
    done = apply_rules(
        padded,
        rules(
            ("upper", "p_name", "up"),
            ("lower", "p_brand", "low"),
            ("trim", "padded", "trimmed"),
            ("strip", "padded", "stripped"),
            ("concat", "p_brand, p_type", "joined"),
            ("split:first", "p_name", "first_word"),
            ("substring:2,4", "p_brand", "middle"),
            ("copy", "p_type", "copied"),
        ),
    )
    return done.select(
        "p_partkey", "up", "low", "trimmed", "stripped", "joined", "first_word", "middle", "copied"
    )


@register(
    """
    SELECT c_custkey, o_orderkey, coalesce(o_orderstatus, 'None Yet') AS o_orderstatus,
           coalesce(o_totalprice, 0) AS o_totalprice,
           coalesce(CAST(o_custkey AS VARCHAR), 'no order') AS buyer
    FROM customer LEFT JOIN orders ON c_custkey = o_custkey
    """
)
def rule_fillna(spark, sf_dir):
    """Text keeps its case; a default that is no number turns the column into text."""
    customer, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    joined = customer.join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    done = apply_rules(
        joined,
        rules(
            ("fillna:None Yet", "o_orderstatus"),
            ("fillna:0", "o_totalprice"),
            ("fillna:no order", "o_custkey", "buyer"),
        ),
    )
    return done.select("c_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", "buyer")


@register(
    r"""
    SELECT c_custkey, regexp_replace(c_name, '[A-Za-z]+#0*', 'C', 'g') AS short_name,
           regexp_replace(c_mktsegment, '([AEIOU])', '<\1>', 'g') AS marked
    FROM customer
    """
)
def rule_regexp(spark, sf_dir):
    done = apply_rules(
        table(spark, sf_dir, "customer"),
        rules(
            ("regexp_replace:[A-Za-z]+#0*,C", "c_name", "short_name"),
            ("regexp_replace:([AEIOU]),<$1>", "c_mktsegment", "marked"),
        ),
    )
    return done.select("c_custkey", "short_name", "marked")


@register(
    """
    SELECT event_id, ts AS moment, strftime(ts, '%H:%M:%S') AS clock,
           CAST(year(ts) AS INTEGER) AS yr, monthname(ts) AS month_text, dayname(ts) AS day_text
    FROM events
    """
)
def rule_dates(spark, sf_dir):
    """Date rules on text, as a file source would give it."""
    texts = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("string").alias("ts"))
    done = apply_rules(
        texts,
        rules(
            ("to_datetime", "ts", "moment"),
            ("to_time", "moment", "clock"),
            ("year", "moment", "yr"),
            ("month_name", "moment", "month_text"),
            ("day_name", "moment", "day_text"),
            ("delete", "ts,absent"),
        ),
    )
    return done.withColumn("moment", F.col("moment").cast("timestamp_ntz"))


@register(
    """
    SELECT l_orderkey, l_linenumber, l_quantity + l_linenumber + l_tax AS added,
           l_extendedprice * l_discount AS discounted,
           l_extendedprice - l_quantity - l_tax AS reduced,
           l_extendedprice / nullif(l_discount, 0) AS ratio,
           round(l_extendedprice) AS rounded,
           l_partkey / nullif(l_linenumber - 1, 0) AS whole_ratio
    FROM lineitem
    """
)
def rule_math(spark, sf_dir):
    """Division is fractional, and NULL for a zero divisor."""
    lines = table(spark, sf_dir, "lineitem").withColumn("less", F.col("l_linenumber") - 1)
    done = apply_rules(
        lines,
        rules(
            ("sum", "l_quantity,l_linenumber,l_tax", "added"),
            ("multiply", "l_extendedprice,l_discount", "discounted"),
            ("subtract", "l_extendedprice,l_quantity,l_tax", "reduced"),
            ("divide", "l_extendedprice,l_discount", "ratio"),
            ("round:0", "l_extendedprice", "rounded"),
            ("divide", "l_partkey,less", "whole_ratio"),
        ),
    )
    return done.select(
        "l_orderkey", "l_linenumber", "added", "discounted", "reduced", "ratio", "rounded", "whole_ratio"
    )


@register(
    """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Filled' END AS status_text,
           CASE WHEN o_custkey BETWEEN 0 AND 99 THEN 'group ' || (o_custkey % 10) END AS buyer_group
    FROM orders
    """
)
def rule_map(spark, sf_dir):
    """A small dictionary is a literal, a large one a join; a missing key gives NULL."""
    groups = {str(key): f"group {key % 10}" for key in range(100)}
    done = apply_rules(
        table(spark, sf_dir, "orders"),
        [
            Rule.parse("map:{'O': 'Open', 'F': 'Filled'}", "o_orderstatus", "status_text", seq=1),
            Rule("map", ("o_custkey",), (groups,), "buyer_group", seq=2),
        ],
    )
    return done.select("o_orderkey", "status_text", "buyer_group")


@register(
    """
    SELECT c_custkey, substring(c_name, 1, 8) || repeat('*', greatest(length(c_name) - 8, 0)) AS c_name,
           substring(c_mktsegment, 1, 9) || repeat('''', greatest(length(c_mktsegment) - 9, 0)) AS segment
    FROM customer
    """
)
def rule_mask(spark, sf_dir):
    """The first characters stay; text shorter than that is unchanged."""
    done = apply_rules(
        table(spark, sf_dir, "customer"),
        rules(("mask:*,8", "c_name"), ("mask:',9", "c_mktsegment", "segment")),
    )
    return done.select("c_custkey", "c_name", "segment")


@register("SELECT s_suppkey, s_name AS label, s_acctbal FROM supplier")
def rule_delete_copy(spark, sf_dir):
    return apply_rules(
        table(spark, sf_dir, "supplier"),
        rules(("copy", "s_name", "label"), ("delete", "s_name,s_nationkey,no_such_column")),
    )


@register(
    """
    SELECT user_id, event_type, count(*) AS event_count, max(value) AS top_value
    FROM events WHERE event_type <> 'error' GROUP BY user_id, event_type
    """
)
def rule_sql_update(spark, sf_dir):
    query = (
        "SELECT user_id, event_type, count(*) AS event_count, max(value) AS top_value "
        "FROM src WHERE event_type <> 'error' GROUP BY user_id, event_type"
    )
    return apply_rules(table(spark, sf_dir, "events"), rules(("sql_update", None, None, query)))


@register(
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS ordered_on,
           CAST(o_custkey % 7 AS VARCHAR) AS remainder, CAST(o_totalprice > 100000 AS VARCHAR) AS large
    FROM orders
    """
)
def rule_to_varchar(spark, sf_dir):
    typed = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.to_date("o_orderdate").alias("ordered_on"),
        (F.col("o_custkey") % 7).cast("int").alias("remainder"),
        (F.col("o_totalprice") > 100000).alias("large"),
    )
    return apply_rules(typed, rules(*[("to_varchar", name) for name in typed.columns]))


@register(
    """
    WITH texts AS (
      SELECT l_orderkey, l_linenumber, l_shipdate, l_quantity,
             CASE l_linenumber % 4 WHEN 0 THEN 'Y' WHEN 1 THEN ' no ' WHEN 2 THEN 'on' ELSE '1' END AS flag
      FROM lineitem)
    SELECT l_orderkey, l_linenumber, flag AS flag_text,
           CASE WHEN flag IN ('Y', '1') THEN TRUE WHEN flag = ' no ' THEN FALSE END AS flag,
           CAST(trunc(l_quantity + 0.5) AS INTEGER) AS quantity_int,
           l_quantity + 0.5 AS quantity_float
    FROM texts
    """
)
def rule_casts(spark, sf_dir):
    """Cast rules on text; a fraction is cut off, unknown flags are NULL."""
    part = F.col("l_linenumber") % 4
    flag = F.when(part == 0, "Y").when(part == 1, " no ").when(part == 2, "on").otherwise("1")
    texts = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        flag.alias("flag_text"),
        (F.col("l_quantity") + 0.5).cast("string").alias("quantity"),
    )
    done = apply_rules(
        texts,
        rules(
            ("to_bool", "flag_text", "flag"),
            ("to_int", "quantity", "quantity_int"),
            ("to_float", "quantity", "quantity_float"),
            ("delete", "quantity"),
        ),
    )
    return done


@register(
    """
    SELECT o_orderkey AS seq, o_custkey AS "PIPELINEID", 'fillna:' || o_orderpriority AS "TRANSFORMATIONRULES"
    FROM orders
    WHERE o_orderstatus = 'O' AND o_orderpriority IN ('1-URGENT', '2-HIGH')
    """
)
def rule_selection(spark, sf_dir):
    """Rules that are active and of the transforming kind, here with orders as rule rows."""
    kind = F.when(F.col("o_orderstatus") == "O", "transform").otherwise("validate")
    active = F.when(F.col("o_orderpriority") == "1-URGENT", "Y").when(
        F.col("o_orderpriority") == "2-HIGH", " true "
    ).when(F.col("o_orderpriority") == "5-LOW", "N")
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("seq"),
        F.col("o_custkey").alias("PIPELINEID"),
        kind.alias("OPERATIONTYPE"),
        active.alias("ACTIVE"),
        F.concat(F.lit("fillna:"), "o_orderpriority").alias("TRANSFORMATIONRULES"),
    )
    return transform_rules(rows).drop("OPERATIONTYPE", "ACTIVE")
