"""Keyed upsert as joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.casts import lenient_cast
from feedloom.functions.predicates import any_null
from feedloom.operators.dedupe import keep_latest
from feedloom.operators.project import quoted

#: Rows of a source that Spark may broadcast, if it takes the source for small. What it goes by is the size of
#: files, and well compressed ones of a few MB hold millions of rows.
SMALL_ROWS = 100_000

#: Rows that a task of a large merge takes, and sorts. Spark goes by bytes of shuffle, and 64 MB of rows that
#: compress well are many millions of them.
TASK_ROWS = 1_000_000

# Values of the outcome column.
INSERT, UPDATE, UNCHANGED = "insert", "update", "unchanged"


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    outcome: str | None = None,
    insert: bool = True,
) -> DataFrame:
    """Update target rows that match a source row on every key; insert the rest.

    The result has the target's columns. Columns only the target has keep their
    value on update and are NULL on insert. A NULL key matches nothing, so such
    source rows are inserted. Source keys must be unique (see ``repeated_keys``).
    With ``outcome`` a column of that name says what happened to each row.

    Shape: target left join source, plus source anti join the target's keys. When
    the source is small Spark broadcasts it and the target is not shuffled at all;
    otherwise only outer, semi and anti joins occur whose big side AQE can split.
    The target's keys are made distinct first, so a key that fills the target
    meets the join as one row per task. Whether the source has more than ``SMALL_ROWS``
    rows is found out here, by a job that counts no more of them in a task; such a source is sorted and
    merged, never broadcast. Rows are then dealt out by number, ``TASK_ROWS`` to a task, unless a key
    is so hot that AQE has to split it (see ``dealt``).
    """
    if not keys:
        raise ValueError("a merge needs key columns")
    key_names = {k.lower() for k in keys}
    given = {f.name.lower(): f for f in source.schema.fields}
    absent = key_names - given.keys()
    if absent:
        raise ValueError(f"the source lacks the key columns {sorted(absent)}")

    new = {f.name: f"__new_{i}" for i, f in enumerate(target.schema.fields) if f.name.lower() in given}
    incoming = source.select(
        *[
            typed(given[f.name.lower()], f).alias(new[f.name])
            for f in target.schema.fields
            if f.name in new
        ]
    )
    key_cols = [f.name for f in target.schema.fields if f.name.lower() in key_names]
    new_keys = [new[k] for k in key_cols]
    large = is_large(source)
    parts = dealt(target, key_cols, incoming, new_keys) if large else 0

    def gathered(rows: DataFrame, by: Sequence[str]) -> DataFrame:
        return rows.repartition(parts, *[F.col(quoted(k)) for k in by]) if parts else rows

    def sorted_join(rows: DataFrame) -> DataFrame:
        return rows.hint("merge") if large else rows

    def same_key() -> Column:
        condition = F.lit(True)
        for k in key_cols:
            condition = condition & (F.col(quoted(k)) == F.col(new[k]))
        return condition

    def row(pick, label: Column) -> list[Column]:
        columns = [pick(f.name).cast(f.dataType).alias(f.name) for f in target.schema.fields]
        return columns + ([label.alias(outcome)] if outcome else [])

    matched = F.col("__matched").isNotNull()

    def merged_value(name: str) -> Column:
        old = F.col(quoted(name))
        if name not in new or name in key_cols:
            return old
        return F.when(matched, F.col(new[name])).otherwise(old)

    # A NULL key equals nothing: the outer join leaves its target row alone, the anti join keeps its
    # source row.
    update = gathered(incoming.withColumn("__matched", F.lit(True)), new_keys)
    joined = gathered(target, key_cols).join(sorted_join(update), same_key(), "left")
    result = joined.select(*row(merged_value, F.when(matched, UPDATE).otherwise(UNCHANGED)))
    if not insert:
        return result

    known = target.select(*[F.col(quoted(k)) for k in key_cols])
    if parts:
        # The source's rows follow: Spark would put an anti join below a repartition of theirs.
        known = gathered(known, key_cols).hint("merge")
    elif large:
        # What is left of a task's keys comes sorted, as the join wants it.
        known = keep_latest(known, key_cols).hint("merge")
    else:
        known = known.distinct().join(incoming.select(*new_keys), same_key(), "left_semi")
    added = sorted_join(incoming).join(known, same_key(), "left_anti")
    inserted = added.select(
        *row(lambda n: F.col(new[n]) if n in new else F.lit(None), F.lit(INSERT))
    )
    return result.unionByName(inserted)


def is_large(source: DataFrame) -> bool:
    """Whether a source has more than ``SMALL_ROWS`` rows, of which no more are counted in a task."""
    return source.select(F.lit(1)).limit(SMALL_ROWS + 1).count() > SMALL_ROWS


def dealt(target: DataFrame, keys: Sequence[str], source: DataFrame, new_keys: Sequence[str]) -> int:
    """Into how many partitions by key the rows of a large merge go; 0 leaves it to AQE.

    It is left so with few rows, and with a hot key: when a partition would get more than twice its
    share, as only AQE splits it between tasks. Two passes over the keys.
    """
    parts = -(-(target.count() + source.count()) // TASK_ROWS)
    if parts < 2:
        return 0
    places = [
        rows.select(F.pmod(F.hash(*[F.col(quoted(k)) for k in by]), F.lit(parts)).alias("place"))
        for rows, by in ((target, keys), (source, new_keys))
    ]
    most = places[0].unionAll(places[1]).groupBy("place").count().agg(F.max("count")).first()[0]
    return parts if most <= 2 * TASK_ROWS else 0


def typed(source_field, target_field) -> Column:
    """A source column with the type of the target's."""
    col = F.col(quoted(source_field.name))
    if source_field.dataType == target_field.dataType:
        return col
    return lenient_cast(col, source_field.dataType, target_field.dataType.simpleString())


def merge_counts(merged: DataFrame, outcome: str) -> DataFrame:
    """Number of rows inserted, updated and left alone."""
    return merged.groupBy(outcome).agg(F.count(F.lit(1)).alias("row_count"))


def repeated_keys(source: DataFrame, keys: Sequence[str], rows: int = 0) -> DataFrame:
    """Keys without NULL that occur more than once, with their count.

    Nearly all keys occur once, so counting them in the tasks that read them saves nothing there but
    takes memory for every row. With ``rows``, how many there are, ``TASK_ROWS`` of them are counted in a task.
    """
    columns = [F.col(quoted(k)) for k in keys]
    named = source.filter(~any_null(columns)).select(*columns)
    if rows > TASK_ROWS:
        named = named.repartition(-(-rows // TASK_ROWS), *columns)
    counted = named.groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.filter(F.col("row_count") > 1)
