"""Feed descriptions from configuration tables."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.operators.layout import parse_layout
from feedloom.operators.metadata import (
    resolve_mappings,
    resolve_pipelines,
    resolve_properties,
    transform_rules,
)
from feedloom.specs import (
    ColumnMapping,
    FeedSpec,
    LoadSpec,
    ReadOptions,
    Rule,
    SourceSpec,
    split_keys,
)

log = logging.getLogger(__name__)

# The file settings whose absence is reported.
EXPECTED_PROPERTIES = ("compression", "skipheader", "delimiter", "quotechar", "escape", "lineseparator")

# The references every pipeline must have, with the text each resolves to.
RESOLVED = (
    ("LOADTYPEID", "LOAD_TYPE"),
    ("LAYERID", "LAYER"),
    ("SOURCEID", "SOURCE_TYPE"),
    ("SOURCEID", "FORMAT_TYPE"),
    ("SOURCEID", "SOURCE_SECRET_KEY"),
    ("DESTINATIONID", "DESTINATIONPATH"),
)


def feed_from_config(
    config: Mapping[str, DataFrame],
    pipeline_id: Any,
    connections: Mapping[str, Mapping[str, Any]] | None = None,
) -> FeedSpec:
    """The description of one pipeline; raises what is wrong with it."""
    found = feeds_from_config(config, [pipeline_id], connections)[str(pipeline_id)]
    if isinstance(found, Exception):
        raise found
    return found


def feeds_from_config(
    config: Mapping[str, DataFrame],
    pipeline_ids: Sequence[Any],
    connections: Mapping[str, Mapping[str, Any]] | None = None,
) -> dict[str, FeedSpec | Exception]:
    """The descriptions of pipelines by id, or what is wrong with one.

    Four joined queries for all of them, whatever their number: pipelines, columns,
    properties, rules. Only the configuration of these pipelines comes to the
    driver. ``connections`` holds connection settings by secret key.
    """
    ids = [str(i) for i in pipeline_ids]
    mine = F.col("PIPELINEID").cast("string").isin(ids)
    chosen = resolve_pipelines({**config, "PIPELINE": config["PIPELINE"].filter(mine)})
    pipelines = {str(row["PIPELINEID"]): row.asDict() for row in chosen.collect()}
    targets = list({row["DESTINATIONID"] for row in pipelines.values()} - {None})
    columns = config["DESTINATIONCOLUMN"].filter(F.col("DESTINATIONID").isin(targets))
    mappings: dict[Any, list[ColumnMapping]] = {}
    for m in resolve_mappings(columns, config["COLUMNMAPPING"], config["SOURCECOLUMN"]).collect():
        mapping = ColumnMapping(
            m["SOURCECOLUMNNAME"], m["DESTINATIONCOLUMNNAME"], m["DESTINATIONCOLUMNDATATYPE"],
            int(m["DESTINATIONCOLUMNSEQUENCE"] or 0),
        )
        mappings.setdefault(m["DESTINATIONID"], []).append(mapping)
    options: dict[str, dict[str, str]] = {}
    for p in resolve_properties(config["PIPELINEPROPERTIES"].filter(mine), config["PROPERTIES"]).collect():
        options.setdefault(str(p["PIPELINEID"]), {})[p["property_key"]] = p["property_value"]
    rules: dict[str, list[dict[str, Any]]] = {}
    if "VALIDATION" in config:
        for r in _in_order(transform_rules(config["VALIDATION"]).filter(mine)):
            rules.setdefault(str(r["PIPELINEID"]), []).append(r.asDict())
    out: dict[str, FeedSpec | Exception] = {}
    for key in ids:
        try:
            if key not in pipelines:
                raise ValueError(f"no pipeline has the id {key}")
            row = pipelines[key]
            out[key] = _feed(
                key, row, mappings.get(row["DESTINATIONID"], []), options.get(key, {}), rules.get(key, []), connections or {}
            )
        except Exception as error:
            out[key] = error
    return out


def _feed(
    pipeline_id: str,
    row: dict[str, Any],
    mappings: list[ColumnMapping],
    options: dict[str, str],
    rules: list[dict[str, Any]],
    connections: Mapping[str, Mapping[str, Any]],
) -> FeedSpec:
    for key, text in RESOLVED:
        if row[text] is None:
            raise ValueError(f"{key} {row.get(key)} leads to no {text}")
    absent = [key for key in EXPECTED_PROPERTIES if key not in options]
    if absent:
        log.warning("pipeline %s: file settings not given, defaults apply: %s", pipeline_id, ", ".join(absent))
    return FeedSpec(
        feed_id=pipeline_id,
        name=row.get("PIPELINENAME") or "",
        source=SourceSpec(
            row["SOURCE_TYPE"],
            row["SOURCEPATH"] or "",
            ReadOptions.from_properties(options),
            connections.get(row["SOURCE_SECRET_KEY"], {}),
            options.get("schema"),
        ),
        mappings=tuple(mappings),
        load=LoadSpec(
            row["LOAD_TYPE"],
            row["DESTINATIONPATH"],
            split_keys(row.get("UNIQUEKEYCOLUMNS")),
            row.get("WATERMARKCOLUMN") or row.get("WATERMARK_COLUMN"),
            row.get("CUSTOMQUERY"),
            split_keys(options.get("partition_by")),
            tuple(str(b) for b in parse_layout(options.get("layout"))),
        ),
        rules=tuple(_rule(r, i) for i, r in enumerate(rules)),
        layer=row["LAYER"].strip().lower(),
        archive_path=row.get("DATARETENTIONARCHIVEPATH") if row.get("ISARCHIVEAFTERDATARETENTION") else None,
    )


def _in_order(rules: DataFrame) -> list:
    """Rule rows by SEQ; rows without one come in order of all their text."""
    order = ["SEQ"] if "SEQ" in rules.columns else []
    return rules.orderBy(*order, *[c for c in rules.columns if c not in order]).collect()


def _rule(row: dict[str, Any], position: int) -> Rule:
    return Rule.parse(
        row["TRANSFORMATIONRULES"], row["OPERATIONCOLUMNS"], row["OPERATIONTARGET"], row.get("QUERY"), position
    )
