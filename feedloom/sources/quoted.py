"""Separated text whose quoted cells hold line breaks, read in parts by many tasks.

Where a part of a file begins, nothing says whether it is inside a quoted cell. So a first pass works out
for each part, from its lines alone, how it ends if it begins outside quotes and how if it begins
inside; put one after another from the start of the file, these say how each part really begins. A
second pass over the same parts then cuts them into records. Only records that run from one part
into another meet in a shuffle, of two rows a part at most. The driver holds one value for each part,
as it does for the list of parts itself.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator, Sequence
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedloom.operators.project import quoted
from feedloom.specs import ReadOptions

# Functions travel with their tasks, so workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BREAK = "\n"


class Quotes:
    """How the options' quote, escape and delimiter open and close cells."""

    def __init__(self, options: ReadOptions) -> None:
        self.delimiter, self.quote = options.delimiter, options.quote
        quote, escape = re.escape(options.quote), re.escape(options.escape or options.quote)
        inner = f"[^{quote}]++|{quote}{quote}" if quote == escape else f"[^{quote}{escape}]++|{escape}.|{escape}\\Z"
        self.closing = re.compile(f"(?:{inner})*+{quote}", re.S)

    def open_after(self, line: str, inside: bool) -> bool:
        """Whether a quoted cell is still open behind a line that begins inside one, or not.

        A quote opens a cell only as its first character; what follows a closing quote up to the
        delimiter belongs to the cell.
        """
        at = 0
        while True:
            if not inside and line.startswith(self.quote, at):
                inside, at = True, at + len(self.quote)
            if inside:
                closed = self.closing.match(line, at)
                if not closed:
                    return True
                inside, at = False, closed.end()
            at = line.find(self.delimiter, at)
            if at < 0:
                return False
            at += len(self.delimiter)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.Array]]:
    """The lines of each part in turn, in slices: ((file, begin), lines)."""
    for batch in batches:
        file, at = batch.column(0), batch.column(1)
        if not len(batch):
            continue
        number = file.dictionary_encode()
        codes = number.indices.to_numpy()
        begins = at.to_numpy()
        cuts = np.flatnonzero((codes[1:] != codes[:-1]) | (begins[1:] != begins[:-1])) + 1
        for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(batch)], strict=True):
            yield (file[int(a)].as_py(), int(begins[a])), batch.column(2).slice(int(a), int(b - a))


def _lines(spark: SparkSession, files: list[str], options: ReadOptions) -> DataFrame:
    text = spark.read.option("lineSep", options.line_separator or BREAK).text(files)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), "value")


def part_states(spark: SparkSession, files: list[str], options: ReadOptions) -> dict[tuple[str, int], tuple[bool, bool, bool]]:
    """For each part (file, begin): whether it begins and whether it ends inside quotes, and whether lines end in CR LF."""
    quotes = Quotes(options)

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, first = None, (False, True), False

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"file": now[0], "at": now[1], "outside": state[0], "inside": state[1], "crlf": first}])

        for part, lines in _parts(batches):
            if part != now:
                if now:
                    yield told()
                now, state, first = part, (False, True), (lines[0].as_py() or "").endswith("\r")
            for line in lines.filter(pc.match_substring(lines, quotes.quote)).to_pylist():
                outside = quotes.open_after(line, state[0])
                state = (outside, outside if state[0] == state[1] else quotes.open_after(line, state[1]))
        if now:
            yield told()

    found = _lines(spark, files, options).mapInArrow(ends, "file string, at long, outside boolean, inside boolean, crlf boolean")
    out: dict[tuple[str, int], tuple[bool, bool, bool]] = {}
    last, inside, crlf = None, False, False
    for row in sorted(found.collect(), key=lambda r: (r["file"], r["at"])):
        if row["file"] != last:
            last, inside, crlf = row["file"], False, row["crlf"]
        ended = row["inside"] if inside else row["outside"]
        out[row["file"], row["at"]] = (inside, ended, crlf)
        inside = ended
    return out


def records(spark: SparkSession, files: list[str], options: ReadOptions) -> DataFrame:
    """(file, first, record): every record of the files as text, and whether it is the first of its file.

    Empty lines between records are left out, as is the line break behind a record, and that at the
    end of a file whose last cell is never closed. Where the first line of a file ends in CR LF, every
    CR LF of it becomes LF, as Spark's reader has it.
    """
    states = part_states(spark, files, options)
    quotes, separator = Quotes(options), options.line_separator or BREAK
    begin_of: dict[str, int] = {}
    for file, at in states:
        begin_of[file] = min(at, begin_of.get(file, at))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(part: tuple[str, int], values: pa.Array | list, begins: bool = True, ends: bool = True, first: bool = False) -> pa.RecordBatch:
            column = values if isinstance(values, pa.Array) else pa.array(values, pa.string())
            n = len(column)
            flags = [pa.array([flag] * n, pa.bool_()) for flag in (begins, ends, first)]
            names = ["file", "at", "begins", "ends", "first", "record"]
            return pa.RecordBatch.from_arrays([pa.array([part[0]] * n, pa.string()), pa.array([part[1]] * n, pa.int64()), *flags, column], names=names)

        # Of the record at hand: its lines so far, and whether its beginning is in this part.
        now, held, begun = None, [], True
        inside = crlf = fresh = False  # fresh: no record of the file was seen yet
        for part, lines in _parts(batches):
            if part != now:
                if held:
                    yield told(now, [separator.join(held)], begun, False, fresh and begun)
                now, held = part, []
                inside, _, crlf = states[part]
                begun, fresh = not inside, begin_of[part[0]] == part[1]
            after = np.zeros(len(lines), dtype=bool)  # whether a cell is open behind each line
            k = 0
            for i in np.flatnonzero(pc.match_substring(lines, quotes.quote).to_numpy(zero_copy_only=False)):
                after[k:i] = inside
                inside = after[i] = quotes.open_after(lines[int(i)].as_py(), inside)
                k = i + 1
            after[k:] = inside
            # A line with nothing open before and behind it is a record of its own.
            alone = ~after
            alone[1:] &= ~after[:-1]
            alone[0] &= begun and not held
            if fresh:
                blank = pc.is_in(lines, value_set=pa.array(["", "\r"] if crlf else [""])).to_numpy(zero_copy_only=False)
                alone[np.flatnonzero(~blank)[:1]] = False  # told apart below, as the first
            singles = lines.filter(pa.array(alone))
            if crlf:
                singles = pc.replace_substring_regex(singles, r"\r\z", "")
            singles = singles.filter(pc.not_equal(singles, ""))
            others = np.flatnonzero(~alone)
            for i, text in zip(others, lines.take(pa.array(others)).to_pylist(), strict=True):
                held.append(text.removesuffix("\r") if crlf else text)
                if not after[i]:
                    yield told(part, [separator.join(held)], begun, True, fresh and begun)
                    held, begun, fresh = [], True, False
            yield told(part, singles)
        if held:
            yield told(now, [separator.join(held)], begun, False, fresh and begun)

    found = _lines(spark, files, options).mapInArrow(cut, "file string, at long, begins boolean, ends boolean, first boolean, record string")
    whole = found.where("begins and ends").select("file", "first", "record")
    if not any(begin or end for begin, end, _ in states.values()):
        return whole
    order = Window.partitionBy("file").orderBy("at", "begins")
    pieces = found.where("not (begins and ends)").withColumn("number", F.sum(F.col("begins").cast("int")).over(order))
    texts = F.transform(F.sort_array(F.collect_list(F.struct("at", "begins", "record"))), lambda x: x["record"])
    joined = pieces.groupBy("file", "number").agg(F.bool_or("first").alias("first"), F.array_join(texts, separator).alias("record"))
    return whole.unionByName(joined.drop("number"))


def scan_quoted(spark: SparkSession, files: list[str], options: ReadOptions, columns: Sequence[str] = ()) -> DataFrame:
    """The rows of files of one layout, as text columns; the same rows as those of Spark's reader over whole files.

    With ``columns`` these are the names, and a file whose header has others is an error.
    """
    whole = replace(options, multiline=True)
    names = list(columns) or spark.read.options(**whole.to_spark()).csv(files[0]).columns
    kinds = ", ".join(f"{quoted(c)} string" for c in names)
    row = F.from_csv("record", kinds, {k: v for k, v in whole.to_spark().items() if k not in ("header", "multiLine", "lineSep")})
    found = records(spark, files, options).select("first", row.alias("row"), "record")
    if options.header:
        same = F.lit(True)
        for name in columns:
            same &= F.lower(F.col(f"row.{quoted(name)}")).eqNullSafe(F.lit(name.lower()))
        error = F.raise_error(F.concat(F.lit(f"a file's header is not {', '.join(columns)}: "), "record")).cast("boolean")
        found = found.where(F.when(F.col("first") & ~same, error).otherwise(~F.col("first")))
    return found.select("row.*")
