"""What a feed is: plain immutable descriptions, no Spark objects."""

from __future__ import annotations

import ast
import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

# The cell texts taken as missing, the defaults that the pandas
# documentation of read_csv lists.
MISSING_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# The words that mean "no custom query".
NO_QUERY_WORDS = ("", "NULL", "NONE")


@dataclass(frozen=True)
class ColumnMapping:
    """One destination column: where it comes from, its name, type and position."""

    source: str
    target: str
    type_text: str | None = "VARCHAR"
    sequence: int = 0


@dataclass(frozen=True)
class ReadOptions:
    """File reading options, as found in a feed's key/value properties.

    ``multiline`` says whether a record may span lines; when it is None the scan
    finds out from the data. ``compression`` is kept as given: Spark knows how to
    unpack a file by the ending of its name.
    """

    delimiter: str = ","
    header: bool = True
    quote: str = '"'
    escape: str = '"'
    multiline: bool | None = None
    line_separator: str | None = None
    compression: str | None = None
    sheet: str | None = None
    pattern: str | None = None
    missing_words: tuple[str, ...] = MISSING_WORDS

    @classmethod
    def from_properties(cls, properties: Mapping[str, str | None], **defaults: Any) -> ReadOptions:
        """Build from key/value text; keys in any letter case, blanks ignored."""
        given = {k.lower(): v for k, v in properties.items() if v not in (None, "")}
        chosen = dict(defaults)
        texts = {
            "delimiter": "delimiter",
            "quotechar": "quote",
            "escape": "escape",
            "lineseparator": "line_separator",
            "compression": "compression",
            "sheetname": "sheet",
            "pattern": "pattern",
        }
        for key, name in texts.items():
            if key in given:
                chosen[name] = given[key]
        for key, name in {"skipheader": "header", "multiline": "multiline"}.items():
            if key in given:
                chosen[name] = int(given[key]) > 0
        return cls(**chosen)

    def to_spark(self) -> dict[str, str]:
        """Options for Spark's delimited-text reader."""
        options = {
            "sep": self.delimiter,
            "header": str(self.header).lower(),
            "quote": self.quote,
            "escape": self.escape,
            "multiLine": str(self.multiline is not False).lower(),
        }
        if self.line_separator:
            options["lineSep"] = self.line_separator
        return options


@dataclass(frozen=True)
class Rule:
    """One transformation: an operation on input columns, written to a target."""

    op: str
    columns: tuple[str, ...] = ()
    args: tuple[Any, ...] = ()
    target: str | None = None
    query: str | None = None
    seq: int = 0

    @property
    def output(self) -> str:
        if self.target:
            return self.target
        if not self.columns:
            raise ValueError(f"rule '{self.op}' names no column")
        return self.columns[0]

    @classmethod
    def parse(
        cls,
        text: str | None,
        columns: str | None = None,
        target: str | None = None,
        query: str | None = None,
        seq: int = 0,
    ) -> Rule:
        """Read rule text such as ``fillna:Unknown``.

        Only the operation name ignores letter case; arguments stay as written.
        """
        name, colon, rest = (text or "").partition(":")
        op = name.strip().lower()
        names = tuple(c.strip() for c in (columns or "").split(",") if c.strip())
        return cls(op, names, _parse_args(op, rest) if colon else (), target or None, query, seq)


def _parse_args(op: str, rest: str) -> tuple[Any, ...]:
    if op == "map":
        return (parse_dictionary(rest),)
    if op in ("regexp_replace", "mask"):
        left, comma, right = rest.partition(",") if op == "regexp_replace" else rest.rpartition(",")
        if not comma:
            raise ValueError(f"rule '{op}' needs two arguments")
        return (left, right) if op == "regexp_replace" else (left, int(right))
    if op == "substring":
        return tuple(int(part) for part in rest.split(","))
    if op == "round":
        return (int(rest),)
    if op == "split":
        return (rest.strip().lower(),)
    return (rest,)


def parse_dictionary(text: str) -> dict[Any, Any]:
    """A JSON object or a dictionary literal; read as data, never evaluated."""
    try:
        value = json.loads(text)
    except ValueError:
        value = ast.literal_eval(text.strip())
    if not isinstance(value, dict):
        raise ValueError("the argument of rule 'map' must be a dictionary")
    return value


@dataclass(frozen=True)
class SourceSpec:
    """Where rows come from: a kind of source, a path or name, and its options."""

    kind: str
    path: str = ""
    options: ReadOptions = field(default_factory=ReadOptions)
    connection: Mapping[str, Any] = field(default_factory=dict)
    schema: str | None = None


@dataclass(frozen=True)
class LoadSpec:
    """How rows reach the target table."""

    mode: str
    target: str
    keys: tuple[str, ...] = ()
    watermark: str | None = None
    query: str | None = None
    partition_by: tuple[str, ...] = ()
    layout: tuple[str, ...] = ()  # such as bucket(64, id) or truncate(100000, id)

    def custom_query(self) -> str | None:
        text = (self.query or "").strip()
        return None if text.upper() in NO_QUERY_WORDS else text


@dataclass(frozen=True)
class FeedSpec:
    """A whole feed: source, mapping, key, rules and load."""

    feed_id: str
    name: str
    source: SourceSpec
    mappings: tuple[ColumnMapping, ...]
    load: LoadSpec
    rules: tuple[Rule, ...] = ()
    layer: str = "bronze"
    strict_rules: bool = False
    legacy_types: bool = False
    archive_path: str | None = None

    @property
    def keys(self) -> tuple[str, ...]:
        return self.load.keys


def split_keys(text: str | None) -> tuple[str, ...]:
    """A comma list of key columns; NULL or blank text means no key."""
    return tuple(part.strip() for part in (text or "").split(",") if part.strip())


def in_sequence(mappings: Sequence[ColumnMapping]) -> list[ColumnMapping]:
    """Mappings in destination order; a missing sequence counts as 0."""
    return sorted(mappings, key=lambda m: int(m.sequence or 0))
