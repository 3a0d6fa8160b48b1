"""Validation findings as rows (table_name, row_key, column_name, message).

The checks work on any table. Wherever a finding depends only on a value, equal
values are collapsed before the join, so a value shared by very many rows costs
one row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.predicates import is_active, is_blank
from feedloom.operators.project import quoted

# Message texts, the required fields of each configuration table, and
# the load types, layers and source kinds that are known.
REQUIRED_MESSAGE = "{column} in {table} table is mandatory; empty values are not permitted."
INACTIVE_MESSAGE = "The values in the ACTIVE column of the {table} table are not set to active."
REQUIRED_FIELDS = {
    "PIPELINE": ("PIPELINENAME", "SOURCEID", "DESTINATIONID", "LOADTYPEID"),
    "SOURCE": ("SOURCENAME", "SOURCEPATH", "SOURCETYPEID", "FORMATTYPEID", "SECRETID"),
    "DESTINATION": ("DESTINATIONNAME", "DESTINATIONPATH", "DESTINATIONTYPEID", "FORMATTYPEID"),
    "LOOKUP": ("LOOKUPID", "LOOKUPNAME", "LOOKUPVALUE"),
    "SECRET": ("SECRETNAME", "SECRETKEY"),
    "COLUMNMAPPING": ("SOURCECOLUMNID", "DESTINATIONCOLUMNID"),
    "SOURCECOLUMN": ("SOURCECOLUMNNAME", "SOURCECOLUMNSEQUENCE", "SOURCECOLUMNDATATYPE"),
    "DESTINATIONCOLUMN": (
        "DESTINATIONCOLUMNNAME", "DESTINATIONCOLUMNSEQUENCE", "DESTINATIONCOLUMNDATATYPE",
    ),
}
MESSAGE_NAMES = {"SECRET": "Secret"}
ENDPOINTS = (("SOURCE", "SOURCEID"), ("DESTINATION", "DESTINATIONID"))
LOAD_TYPES = ("full", "bulk", "append", "incremental")
LAYERS = ("bronze", "silver")


def required_message(table: str, column: str) -> str:
    return REQUIRED_MESSAGE.format(column=column, table=MESSAGE_NAMES.get(table, table))


def inactive_message(table: str) -> str:
    return INACTIVE_MESSAGE.format(table=MESSAGE_NAMES.get(table, table))


def _findings(df: DataFrame, table: str, key: str, found: Sequence[tuple[Column, str, str]]) -> DataFrame:
    """One row per hit among (condition, column, message) triples."""
    hits = F.array_compact(
        F.array(
            *[
                F.when(
                    condition,
                    F.struct(F.lit(column).alias("column_name"), F.lit(message).alias("message")),
                )
                for condition, column, message in found
            ]
        )
    )
    return df.select(
        F.lit(table).alias("table_name"),
        F.col(quoted(key)).cast("string").alias("row_key"),
        F.inline(hits),
    )


def _blank_fields(df: DataFrame, table: str, columns: Sequence[str]) -> list[tuple[Column, str, str]]:
    present = {c.lower(): c for c in df.columns}
    found = []
    for name in columns:
        actual = present.get(name.lower())
        blank = F.lit(True) if actual is None else is_blank(F.col(quoted(actual)))
        found.append((blank, name, required_message(table, name)))
    return found


def _not_active(df: DataFrame, table: str, column: str) -> tuple[Column, str, str]:
    actual = {c.lower(): c for c in df.columns}.get(column.lower())
    inactive = F.lit(True) if actual is None else ~is_active(F.col(quoted(actual)))
    return inactive, column, inactive_message(table)


def check_required(df: DataFrame, table: str, key: str, columns: Sequence[str]) -> DataFrame:
    """A finding for every blank required field; an absent column is blank in all rows."""
    return _findings(df, table, key, _blank_fields(df, table, columns))


def check_active(df: DataFrame, table: str, key: str, column: str = "ACTIVE") -> DataFrame:
    """A finding for every row that is not active; without the column none is."""
    return _findings(df, table, key, [_not_active(df, table, column)])


def check_domain(df: DataFrame, table: str, key: str, column: str, allowed: Sequence[str]) -> DataFrame:
    """A finding for every value outside the allowed ones; letter case and outer spaces ignored."""
    value = F.lower(F.trim(F.col(quoted(column)).cast("string")))
    outside = ~F.coalesce(value.isin(*[a.lower() for a in allowed]), F.lit(False))
    return _findings(df, table, key, [(outside, column, f"Unsupported {column} in {table}.")])


def check_reference(
    df: DataFrame, table: str, column: str, parent: DataFrame, parent_key: str
) -> DataFrame:
    """Distinct ids that no parent row has, with the number of rows that use them."""
    child = F.col(quoted(column))
    used = df.filter(child.isNotNull()).groupBy(child.alias("__id")).agg(
        F.count(F.lit(1)).alias("row_count")
    )
    known = parent.select(F.col(quoted(parent_key)).alias("__known")).distinct()
    dangling = used.join(known, F.col("__id") == F.col("__known"), "left_anti")
    return dangling.select(
        F.lit(table).alias("table_name"),
        F.col("__id").cast("string").alias("row_key"),
        F.lit(column).alias("column_name"),
        F.concat(F.lit(f"Invalid {column}="), F.col("__id").cast("string")).alias("message"),
        "row_count",
    )


def referenced_rows(df: DataFrame, key: str, users: DataFrame, column: str) -> DataFrame:
    """The rows of ``df`` whose key some row of ``users`` refers to."""
    ids = users.select(F.col(quoted(column)).alias("__id")).distinct()
    return df.join(ids, F.col(quoted(key)) == F.col("__id"), "left_semi")


def distinct_messages(findings: DataFrame) -> DataFrame:
    """Each message once per table."""
    return findings.select("table_name", "message").distinct()


def validate_config(config: Mapping[str, DataFrame], requested: DataFrame | None = None) -> DataFrame:
    """All findings of all pipelines at once: distinct (pipeline_id, message).

    ``config`` maps table names to frames. ``requested`` holds a PIPELINEID column;
    ids without a pipeline row are reported, and only requested ones are checked.

    There are few messages, so what is wrong with a row is one number with a bit for each of them.
    These numbers pass along references, from a row to whatever refers to it, up to the
    pipelines: one join and one grouping a level, a row for every reference.
    """
    rows = {t: _noted(config[t], t, *LINKS[t]) for t in LINKS}
    leaves = _or_of(rows["LOOKUP"].unionByName(rows["SECRET"]).unionByName(rows["SOURCECOLUMN"]))
    columns = _told(rows["DESTINATIONCOLUMN"], _told(rows["COLUMNMAPPING"], leaves))
    ends = _told(rows["SOURCE"].unionByName(rows["DESTINATION"]), leaves)
    ends = _or_of(ends.unionByName(columns))
    found = _told(rows["PIPELINE"], leaves.unionByName(ends)).select(F.col("id").alias("pipeline_id"), "bits")
    if requested is not None:
        asked = requested.select(_id("PIPELINEID").alias("pipeline_id")).distinct()
        absent = F.lit(1 << BITS["PIPELINE", "PIPELINEID"])
        found = asked.join(found, "pipeline_id", "left").select("pipeline_id", F.coalesce("bits", absent).alias("bits"))
    texts = [F.when(F.col("bits").bitwiseAND(F.lit(1 << k)) != 0, F.lit(_text(name))) for name, k in BITS.items()]
    return found.select("pipeline_id", F.explode(F.array_compact(F.array(*texts))).alias("message"))


# Of each configuration table: what its rows say things about, the column of that, and what they refer to.
# A column mapping is about its destination column, and that is about its destination.
LINKS: dict[str, tuple[str, str, tuple[tuple[str, str], ...]]] = {
    "PIPELINE": ("PIPELINE", "PIPELINEID", (("LOOKUP", "LOADTYPEID"), ("LOOKUP", "LAYERID"), *ENDPOINTS)),
    "SOURCE": ("SOURCE", "SOURCEID", (("LOOKUP", "SOURCETYPEID"), ("LOOKUP", "FORMATTYPEID"), ("SECRET", "SECRETID"))),
    "DESTINATION": ("DESTINATION", "DESTINATIONID", (("LOOKUP", "FORMATTYPEID"), ("SECRET", "SECRETID"))),
    "LOOKUP": ("LOOKUP", "LOOKUPID", ()),
    "SECRET": ("SECRET", "SECRETID", ()),
    "SOURCECOLUMN": ("SOURCECOLUMN", "SOURCECOLUMNID", ()),
    "DESTINATIONCOLUMN": ("DESTINATION", "DESTINATIONID", (("DESTINATIONCOLUMN", "DESTINATIONCOLUMNID"),)),
    "COLUMNMAPPING": ("DESTINATIONCOLUMN", "DESTINATIONCOLUMNID", (("SOURCECOLUMN", "SOURCECOLUMNID"),)),
}
# The bit of each message, named by table and column; a missing end of a pipeline has one of its own.
BITS: dict[tuple[str, str], int] = {
    name: k
    for k, name in enumerate(
        [(t, c) for t in LINKS for c in (*REQUIRED_FIELDS[t], *(() if t == "PIPELINE" else ("ACTIVE",)))]
        + [*ENDPOINTS, ("PIPELINE", "PIPELINEID")]
    )
}


def _text(name: tuple[str, str]) -> str:
    return inactive_message(name[0]) if name[1] == "ACTIVE" else required_message(*name)


def _noted(df: DataFrame, table: str, about: str, key: str, links: Sequence[tuple[str, str]]) -> DataFrame:
    """From one pass: (table, id, bits, is_row, refs), refs with the bit that is set if nothing is there."""
    checks = _blank_fields(df, table, REQUIRED_FIELDS[table])
    if table != "PIPELINE":
        checks.append(_not_active(df, table, "ACTIVE"))
    bits = reduce(Column.bitwiseOR, [F.when(hit, F.lit(1 << BITS[table, c])).otherwise(F.lit(0)).cast("long") for hit, c, _ in checks])
    refs = [
        F.struct(F.lit(to).alias("table"), _id(c).alias("id"), F.lit(1 << BITS[to, c] if table == "PIPELINE" and (to, c) in ENDPOINTS else 0).cast("long").alias("lost"))
        for to, c in links
        if c in df.columns
    ]
    given = F.filter(F.array(*refs), lambda r: r["id"].isNotNull()) if refs else F.lit(None).cast("array<struct<table:string,id:string,lost:bigint>>")
    # Rows of these two are about others, which have rows of their own or none.
    is_row = table not in ("DESTINATIONCOLUMN", "COLUMNMAPPING")
    return df.select(F.lit(about).alias("table"), _id(key).alias("id"), bits.alias("bits"), F.lit(is_row).alias("is_row"), given.alias("refs"))


def _or_of(rows: DataFrame) -> DataFrame:
    return rows.groupBy("table", "id").agg(F.bit_or("bits").alias("bits"), F.bool_or("is_row").alias("is_row"))


def _told(rows: DataFrame, known: DataFrame) -> DataFrame:
    """(table, id, bits, is_row): the rows' own bits and those of what they refer to."""
    flat = rows.select("table", "id", "bits", "is_row", F.explode_outer("refs").alias("ref"))
    known = known.select(F.col("table").alias("to"), F.col("id").alias("to_id"), F.col("bits").alias("said"), F.col("is_row").alias("there"))
    met = flat.join(known, (F.col("ref.table") == F.col("to")) & (F.col("ref.id") == F.col("to_id")), "left")
    lost = F.when(F.coalesce("there", F.lit(False)), F.lit(0)).otherwise(F.coalesce("ref.lost", F.lit(0)))
    bits = F.col("bits").bitwiseOR(F.coalesce("said", F.lit(0))).bitwiseOR(lost)
    return _or_of(met.select("table", "id", bits.alias("bits"), "is_row"))


def _id(column: str) -> Column:
    return F.col(quoted(column)).cast("string")
