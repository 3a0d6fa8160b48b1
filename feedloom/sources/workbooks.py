"""Spreadsheet workbooks (.xlsx), read in tasks, one workbook at a time."""

from __future__ import annotations

import fnmatch
import io
import re
import sys
import zipfile
from collections.abc import Iterator, Sequence
from datetime import datetime, timedelta
from xml.etree import ElementTree

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.project import quoted
from feedloom.sources.files import blank_out
from feedloom.specs import ReadOptions

# Number formats of the file format that show dates or times.
DATE_FORMATS = frozenset((*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)))
_QUOTED_FORMAT = re.compile(r'"[^"]*"|\\.|\[[^\]]*\]')
ROWS_PER_BATCH = 4096

# The functions below travel with the tasks, so workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def scan_workbooks(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    options: ReadOptions | None = None,
) -> DataFrame:
    """The given columns of all matching workbooks, by name, as text.

    ``path`` is a workbook or a folder; the pattern of the options is held against
    paths below the folder, and ``*`` in it matches slashes too. A column that a
    workbook lacks is NULL there. Memory per task is bounded by the largest
    workbook, not by their number.
    """
    options = options or ReadOptions()
    files = workbook_files(spark, path, options.pattern or "*")
    if files.select("path").isEmpty():
        raise ValueError(f"no workbook in '{path}' matches '{options.pattern}'")
    return workbook_rows(files, columns, options)


def workbook_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """The files below a folder whose path from there matches the pattern."""
    reader = spark.read.format("binaryFile")
    if path.lower().endswith((".xlsx", ".xls")):
        return reader.load(path)
    # File names are narrowed down first, by what follows the last star.
    tail = pattern.rpartition("*")[2].rpartition("/")[2]
    narrowed = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{tail}")
    base = re.sub(r"^[A-Za-z][\w+.-]*:", "", path).strip("/")
    absolute = path.startswith("/") or ":" in path
    start = r"^(?:[A-Za-z][\w+.-]*:)?/*" if absolute else "^(?:.*/)?"
    whole = f"{start}{re.escape(base)}/{fnmatch.translate(pattern)}"
    return narrowed.load(path).filter(F.col("path").rlike(whole))


def workbook_rows(files: DataFrame, columns: Sequence[str], options: ReadOptions) -> DataFrame:
    """Rows of the workbooks in the binary column ``content``."""
    sheet, header, wanted = options.sheet, options.header, [c.lower() for c in columns]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                rows = sheet_rows(content, sheet)
                names = header_names(next(rows, [])) if header else None
                chunk: list[list[str | None]] = []
                for row in rows:
                    keys = names if names is not None else [str(i) for i in range(len(row))]
                    cells = dict(zip((k.lower() for k in keys), row, strict=False))
                    chunk.append([cells.get(name) for name in wanted])
                    if len(chunk) == ROWS_PER_BATCH:
                        yield pd.DataFrame(chunk, columns=list(columns), dtype=object)
                        chunk = []
                if chunk:
                    yield pd.DataFrame(chunk, columns=list(columns), dtype=object)

    schema = ", ".join(f"{quoted(c)} string" for c in columns)
    return blank_out(files.select("content").mapInPandas(read, schema), options.missing_words)


def workbook_columns(files: DataFrame, options: ReadOptions) -> list[str]:
    """All header names of the workbooks; only distinct names reach the driver."""
    sheet = options.sheet

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                names = header_names(next(sheet_rows(content, sheet), []))
                yield pd.DataFrame({"name": names, "position": range(len(names))})

    found = files.select("content").mapInPandas(read, "name string, position int")
    ordered = found.groupBy("name").agg(F.min("position").alias("position")).orderBy("position", "name")
    return [row["name"] for row in ordered.collect()]


def header_names(cells: Sequence[str | None]) -> list[str]:
    """Column names of a header row; blanks and repeats are numbered."""
    names: list[str] = []
    for position, cell in enumerate(cells):
        name = cell or f"Unnamed: {position}"
        repeats = sum(1 for known in cells[:position] if known == cell)
        names.append(f"{name}.{repeats}" if cell and repeats else name)
    return names


def sheet_rows(content: bytes, sheet: str | None = None) -> Iterator[list[str | None]]:
    """Rows of one sheet (the first when unnamed) as text, gaps filled with NULL."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        path, base = _sheet_path(book, sheet)
        strings, dated = _shared_strings(book), _date_styles(book)
        done = 0
        with book.open(path) as stream:
            parents: list[ElementTree.Element] = []
            for event, node in ElementTree.iterparse(stream, ("start", "end")):
                if event == "start":
                    parents.append(node)
                    continue
                parents.pop()
                if not node.tag.endswith("}row"):
                    continue
                number = int(node.get("r", done + 1))
                yield from ([] for _ in range(number - done - 1))
                done = number
                yield _row(node, strings, dated, base)
                if parents:
                    parents[-1].remove(node)  # rows that were read are let go


def _row(node, strings: list[str], dated: set[int], base: datetime) -> list[str | None]:
    cells: list[str | None] = []
    for cell in node:
        letters = re.match(r"[A-Z]+", cell.get("r", ""))
        position = _column_number(letters.group()) if letters else len(cells)
        cells.extend([None] * (position - len(cells)))
        cells.append(_cell_text(cell, strings, dated, base))
    return cells


def _column_number(letters: str) -> int:
    number = 0
    for letter in letters:
        number = number * 26 + ord(letter) - ord("A") + 1
    return number - 1


def _cell_text(cell, strings: list[str], dated: set[int], base: datetime) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in cell.iter() if t.tag.endswith("}t"))
    value = next((n.text for n in cell if n.tag.endswith("}v")), None)
    if value is None:
        return None
    if kind == "s":
        return strings[int(value)]
    if kind == "b":
        return "true" if value == "1" else "false"
    if kind != "n":
        return value
    if int(cell.get("s", "0")) in dated:
        return _moment_text(float(value), base)
    if re.fullmatch(r"[+-]?[0-9]+", value):
        return str(int(value))
    number = float(value)
    return str(int(number)) if number.is_integer() else value


def _moment_text(number: float, base: datetime) -> str:
    moment = base + timedelta(days=int(number), milliseconds=round((number % 1) * 86_400_000))
    return moment.strftime("%H:%M:%S" if number < 1 else "%Y-%m-%d %H:%M:%S")


def _sheet_path(book: zipfile.ZipFile, sheet: str | None) -> tuple[str, datetime]:
    root = ElementTree.fromstring(book.read("xl/workbook.xml"))
    sheets = [n for n in root.iter() if n.tag.endswith("}sheet")]
    chosen = next((n for n in sheets if sheet is None or n.get("name") == sheet), None)
    if chosen is None:
        raise ValueError(f"no sheet named '{sheet}' in the workbook")
    link = next(v for k, v in chosen.attrib.items() if k.endswith("}id"))
    links = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    target = next(n.get("Target") for n in links if n.get("Id") == link)
    old = any(n.get("date1904") in ("1", "true") for n in root.iter() if n.tag.endswith("}workbookPr"))
    base = datetime(1904, 1, 1) if old else datetime(1899, 12, 30)
    return (target.lstrip("/") if target.startswith("/") else f"xl/{target}"), base


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    root = ElementTree.fromstring(book.read("xl/sharedStrings.xml"))
    return [_plain_text(item) for item in root]


def _plain_text(item) -> str:
    direct = [n for n in item if n.tag.endswith("}t")]
    runs = [t for n in item if n.tag.endswith("}r") for t in n if t.tag.endswith("}t")]
    return "".join(n.text or "" for n in (*direct, *runs))


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    custom = {
        int(n.get("numFmtId")): _QUOTED_FORMAT.sub("", n.get("formatCode", "")).lower()
        for n in root.iter()
        if n.tag.endswith("}numFmt")
    }
    dates = DATE_FORMATS | {i for i, text in custom.items() if re.search(r"[ymdhs]", text)}
    formats = next((n for n in root if n.tag.endswith("}cellXfs")), ())
    return {i for i, n in enumerate(formats) if int(n.get("numFmtId", "0")) in dates}
