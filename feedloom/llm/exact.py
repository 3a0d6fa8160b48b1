"""Exact duplicates by a tree merge of digest runs; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import checkpointed, staged

FAN_IN = 16
SALTS = 16


def _digest(text: Column) -> list[Column]:
    """What stands for a text: SHA-256, and its length and a second hash that verify it."""
    whole = F.coalesce(text, F.lit(""))
    return [
        F.unhex(F.sha2(whole.cast("binary"), 256)).alias("__sha"),
        F.octet_length(whole).alias("__bytes"),
        F.xxhash64(whole).alias("__check"),
    ]


KEY = ["__sha", "__bytes", "__check"]


def merged_runs(digests: DataFrame, runs: int, largest: bool = False, fan_in: int = FAN_IN) -> DataFrame:
    """One row per digest: the identifier that stays, and the number of rows.

    Every partition's digests are one run. In each round the runs of ``fan_in`` neighbours meet in
    one: the map side of the aggregate leaves a row per digest and run, the exchange sends the rows
    of a digest of those runs to one task, which keeps the best identifier among rows whose length
    and second hash agree too. So a task gets ``fan_in`` rows of a digest at most, however many
    copies there are. The rounds end when one run is left.
    """
    best = F.max if largest else F.min
    runs = max(1, runs)
    tree = digests.select(*KEY, F.col("__run"), F.struct("__id", "__row").alias("__best"), F.lit(1).cast("long").alias("__n"))
    while True:
        tree = (
            tree.withColumn("__run", F.floor(F.col("__run") / fan_in).cast("int"))
            .groupBy("__run", *KEY)
            .agg(best("__best").alias("__best"), F.sum("__n").alias("__n"))
        )
        runs = -(-runs // fan_in)
        if runs == 1:
            return tree.drop("__run")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", largest: bool = False) -> DataFrame:
    """For every row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are compared as they are; a null text counts as empty. Of equal texts the row with the
    smallest (or ``largest``) identifier stays; a null identifier counts as the smallest. Of
    repeated rows with the same identifier and text one stays. An empty table gives no rows; other
    columns of ``docs`` may have any name.
    """
    digests = checkpointed(
        docs.select(
            F.col(id_col).alias("__id"),
            *_digest(F.col(text_col)),
            F.spark_partition_id().alias("__run"),
            F.monotonically_increasing_id().alias("__row"),
        )
    )
    runs = (digests.agg(F.max("__run")).first()[0] or 0) + 1
    groups = merged_runs(digests, runs, largest).where("__n > 1").select(*KEY, "__best", "__n")
    # A group may hold a third of all rows: its rows are salted by run, and the group's row repeated.
    groups = groups.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    found = digests.withColumn("__salt", F.pmod("__run", F.lit(SALTS))).join(groups, [*KEY, "__salt"], "left")
    return found.select(
        F.col("__id").alias("doc_id"),
        F.when(F.col("__n").isNull(), F.col("__id")).otherwise(F.col("__best")["__id"]).alias("keep_id"),
        F.coalesce("__n", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("__best")["__row"] == F.col("__row"), F.lit(True)).alias("kept"),
        F.lower(F.hex("__sha")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", largest: bool = False) -> DataFrame:
    """The rows of ``docs`` that ``exact_groups`` keeps, with all their columns."""
    groups = exact_groups(docs, id_col, text_col, largest)
    dropped = staged(
        groups.where("not kept").select(
            F.col("doc_id").alias("__id"), F.unhex("text_sha256").alias("__sha"), (F.col("keep_id").eqNullSafe(F.col("doc_id"))).alias("__same")
        ).distinct(),
        "dropped",
    )
    names = docs.columns
    with_key = docs.withColumn("__sha", _digest(F.col(text_col))[0])
    on = lambda other: (with_key["__sha"] == other["__sha"]) & with_key[id_col].eqNullSafe(other["__id"])
    others = dropped.where("not __same")
    kept = with_key.join(others, on(others), "left_anti")
    repeated = dropped.where("__same")
    if not repeated.isEmpty():
        # Rows that repeat the identifier and the text of the row that stays: one of them stays.
        once = kept.join(repeated, (kept["__sha"] == repeated["__sha"]) & kept[id_col].eqNullSafe(repeated["__id"]), "left_semi")
        rest = kept.join(repeated, (kept["__sha"] == repeated["__sha"]) & kept[id_col].eqNullSafe(repeated["__id"]), "left_anti")
        kept = rest.unionByName(once.dropDuplicates([id_col, "__sha"]))
    return kept.select(*names)
