"""URL verdicts: listed rules first, then association rules between URL tokens and verdicts.

The URLs that a listed rule judges are the labelled ones. Spark's FP-growth mines the combinations
of URL tokens that go with a verdict; rules below the support or confidence are pruned, and so are
those that a shorter rule with the same verdict and at least their confidence implies. Tokens that
occur in the very same labelled URLs are mined as one. The rules are put into an inverted index under
their rarest token; a URL meets the rules under its tokens, and the one with the highest confidence,
then support, whose tokens it has all decides.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import checkpointed

# Fixed values: (host, path, verdict) of the listed rules.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
MIN_SUPPORT, MIN_CONFIDENCE = 0.002, 0.6
DEFAULT = "allow"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What is between the first ``://`` and the next ``/``, ``?``, ``#`` or the end; empty without."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def listed(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null if none does."""
    rule = verdict = F.lit(None).cast("string")
    for name, start, says in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        rule, verdict = F.when(fits, name + start).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def tokens_of(url: Column) -> Column:
    """Distinct tokens: the end of the host, its words, directories, file kind, query names, fragment."""
    host, path = host_of(url), path_of(url)
    labels = F.split(host, r"\.")
    parts = F.filter(F.split(F.regexp_replace(path, r"\.[^./]*$", ""), "/"), lambda x: x != "")
    shape = lambda x: F.regexp_replace(x, r"[0-9]+", "0")
    names = F.filter(F.split(F.regexp_extract(url, r"\?([^#]*)", 1), "&"), lambda x: x != "")
    kind = F.regexp_extract(path, r"\.([^./]*)$", 1)
    found = F.concat(
        F.array(F.concat(F.lit("end:"), F.element_at(labels, -1))),
        F.transform(F.filter(F.split(host, r"[.\-]"), lambda x: x != ""), lambda x: F.concat(F.lit("host:"), shape(x))),
        F.transform(parts, lambda x, i: F.concat(F.lit("dir"), F.least(i, F.lit(3)).cast("string"), F.lit(":"), shape(x))),
        F.transform(names, lambda x: F.concat(F.lit("query:"), F.substring_index(x, "=", 1))),
        F.when(kind != "", F.array(F.concat(F.lit("kind:"), kind))).otherwise(F.array()),
        F.when(F.instr(url, "#") > 0, F.array(F.lit("fragment:"))).otherwise(F.array()),
    )
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(found))


def token_classes(labelled: DataFrame, least: int) -> DataFrame:
    """(x, item, n, says): of each token in ``least`` rows or more its class, its rows, and the verdict if all have one.

    Tokens that occur in the very same rows are one class, named by the first: what holds for one of
    them holds for all, alone and together. Rows are (row, tokens, verdict).
    """
    each = labelled.select("row", "verdict", F.explode("tokens").alias("x"))
    same = [F.bit_xor(F.xxhash64("row", F.lit(k))).alias(f"h{k}") for k in (0, 1)]
    found = each.groupBy("x").agg(F.count("*").alias("n"), F.min("verdict").alias("low"), F.max("verdict").alias("high"), *same)
    found = found.where(F.col("n") >= least)
    by = ["n", "low", "high", "h0", "h1"]
    groups = found.groupBy(*by).agg(F.min("x").alias("item"))
    return found.join(groups, by).select("x", "item", "n", F.when(F.col("low") == F.col("high"), F.col("low")).alias("says"))


def mined_rules(labelled: DataFrame, classes: DataFrame, rows: int) -> DataFrame:
    """(tokens, says, confidence, support, anchor) over the classes of tokens, from ``rows`` rows (row, tokens, verdict).

    A class that only goes with one verdict is a rule alone, of full confidence, and every longer
    rule with it is implied; so it takes no part in the mining of combinations. Without this and
    without classes, n tokens that come together would be 2^n combinations.
    """
    lone = classes.where("says is not null").select("item", "says", "n").distinct()
    lone = lone.select(F.array("item").alias("tokens"), "says", F.lit(1.0).alias("confidence"), (F.col("n") / rows).alias("support"), F.col("item").alias("anchor"))
    mixed = classes.where("says is null")
    if mixed.isEmpty():
        return lone
    each = labelled.select("row", F.explode("tokens").alias("x")).join(mixed.select("x", "item"), "x")
    items = each.groupBy("row").agg(F.collect_set("item").alias("found"))
    verdict = F.array(F.concat(F.lit("verdict:"), F.col("verdict")))
    baskets = labelled.join(items, "row", "left").select(F.concat(F.coalesce("found", F.array().cast("array<string>")), verdict).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=MIN_SUPPORT, minConfidence=MIN_CONFIDENCE).fit(checkpointed(baskets))
    rules = checkpointed(
        model.associationRules.where(F.col("consequent")[0].startswith("verdict:"))
        .where(~F.exists("antecedent", lambda x: x.startswith("verdict:")))
        .select(F.sort_array("antecedent").alias("tokens"), F.expr("substring(consequent[0], 9)").alias("says"), "confidence", "support")
    )
    # A rule goes if one of the rules with one token less is as sure of the same verdict: they share all
    # but one token, so each rule meets its shorter ones by their exact token lists.
    shorter = rules.select(F.col("tokens").alias("t"), F.col("says").alias("s"), F.col("confidence").alias("c"))
    less = rules.where("size(tokens) > 1").select("tokens", "says", "confidence", F.explode("tokens").alias("x"))
    less = less.withColumn("t", F.array_remove("tokens", F.col("x")))
    implied = less.join(shorter, (less["t"] == shorter["t"]) & (F.col("says") == F.col("s")) & (F.col("c") >= F.col("confidence")), "left_semi")
    rules = rules.join(implied.select("tokens", "says").distinct(), ["tokens", "says"], "left_anti")
    often = mixed.select(F.col("item").alias("x"), "n").distinct()
    anchor = rules.select("tokens", "says", "confidence", "support", F.explode("tokens").alias("x")).join(often, "x")
    anchor = anchor.groupBy("tokens", "says", "confidence", "support").agg(F.min(F.struct("n", "x"))["x"].alias("anchor"))
    return anchor.unionByName(lone)


def url_verdicts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """For every row of ``pages``: page_id, host, path, rule, verdict.

    A null URL, or one without ``://``, has an empty host and path and no tokens; where no rule
    decides the verdict is ``allow``. Rows that repeat an identifier are judged each by its URL. An
    empty table gives no rows; other columns have no part.
    """
    url = F.col(url_col).cast("string")
    rule, verdict = listed(F.col("host"), F.col("path"))
    judged = pages.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"), tokens_of(F.coalesce(url, F.lit(""))).alias("tokens"))
    judged = checkpointed(judged.withColumn("rule", rule).withColumn("verdict", verdict))
    result = judged.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(DEFAULT)).alias("verdict"))
    labelled = judged.where("verdict is not null and size(tokens) > 0").select("row", "tokens", "verdict")
    rows = labelled.count()
    if not rows:
        return result
    classes = checkpointed(token_classes(labelled, math.ceil(MIN_SUPPORT * rows)))
    rules = checkpointed(mined_rules(labelled, classes, rows))
    # A row has a rule's combination if it has a token of each of its classes.
    open_rows = judged.where("verdict is null").select("row", F.explode("tokens").alias("x")).join(classes.select("x", "item"), "x")
    open_rows = open_rows.groupBy("row").agg(F.collect_set("item").alias("items"))
    index = rules.withColumnRenamed("tokens", "needs")
    met = open_rows.select("row", "items", F.explode("items").alias("anchor")).join(index, "anchor")
    met = met.where(F.size(F.array_except("needs", "items")) == 0)
    best = met.groupBy("row").agg(F.max(F.struct("confidence", "support", "needs", "says"))["says"].alias("mined"))
    return judged.join(best, "row", "left").select("page_id", "host", "path", "rule", F.coalesce("verdict", "mined", F.lit(DEFAULT)).alias("verdict"))
