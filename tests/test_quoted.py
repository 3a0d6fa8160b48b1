"""Records over several lines, cut by many tasks, against Spark's own reader in one."""

import random
from dataclasses import replace

import pytest

from feedloom.sources.files import scan_delimited
from feedloom.sources.quoted import Quotes, part_states, records, scan_quoted
from feedloom.specs import ReadOptions


@pytest.fixture
def small_parts(spark):
    """Files are split every hundred bytes or so."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, "100")
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def whole(spark, path, options):
    """What the reader gives that takes a file as one."""
    names = [str(path)] if not isinstance(path, list) else path
    return spark.read.options(**replace(options, multiline=True).to_spark()).csv(names)


CELLS = ["a", "", "plain text", '"q"', '"a ""b"" c"', '"two\nlines"', '"x\n\n\ny,z"', '"' + "long\n" * 40 + '"', 'pipe 5" wide', '"end"""', "é ü", '"\n"', '""']


def made(seed, cells=CELLS, delimiter=",", ending="\n"):
    rng = random.Random(seed)
    lines = ["k" + delimiter + "v" + delimiter + "w"]
    for i in range(120):
        lines.append(delimiter.join([str(i), rng.choice(cells), rng.choice(cells)]))
        if rng.random() < 0.05:
            lines.append("")
    return ending.join(c.replace("\n", ending) for c in lines) + (ending if seed % 2 else "")


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("ending", ["\n", "\r\n"], ids=["lf", "crlf"])
def test_rows_are_those_of_the_whole_reader(spark, tmp_path, rows, small_parts, seed, ending):
    options = ReadOptions(missing_words=())
    path = tmp_path / "a.csv"
    path.write_bytes(made(seed, ending=ending).encode())
    got = scan_quoted(spark, [str(path)], options)
    assert got.rdd.getNumPartitions() > 8
    want = whole(spark, path, options)
    assert got.columns == want.columns
    assert rows(got) == rows(want)


@pytest.mark.parametrize("escape", ["\\", "^"])
def test_another_escape_and_delimiter(spark, tmp_path, rows, small_parts, escape):
    options = ReadOptions(delimiter="||", quote="'", escape=escape, missing_words=())
    cells = ["a", "'b'", f"'c {escape}' d\nnext'", f"'{escape}'\n{escape}''", "'x||y\n'", "plain's"]
    path = tmp_path / "a.csv"
    path.write_text(made(3, cells, "||"), encoding="utf-8")
    assert rows(scan_quoted(spark, [str(path)], options)) == rows(whole(spark, path, options))


def test_a_cell_over_many_parts_and_one_that_never_ends(spark, tmp_path, rows, small_parts):
    options = ReadOptions(missing_words=())
    path = tmp_path / "a.csv"
    path.write_text('k,v\n1,"' + "middle of a cell\n" * 100 + '"\n2,b\n3,"open\nto the end', encoding="utf-8")
    assert rows(scan_quoted(spark, [str(path)], options)) == rows(whole(spark, path, options))
    states = part_states(spark, [str(path)], options)
    assert sum(begins for begins, _, _ in states.values()) > 5


def test_no_header_and_a_broken_header(spark, tmp_path, rows, small_parts):
    path = tmp_path / "a.csv"
    path.write_text('"k\nk",v\n1,"a\nb"\n2,c\n', encoding="utf-8")
    for header in (True, False):
        options = ReadOptions(header=header, missing_words=())
        got, want = scan_quoted(spark, [str(path)], options), whole(spark, path, options)
        assert got.columns == want.columns and rows(got) == rows(want)


def test_files_of_several_layouts(spark, tmp_path, rows, small_parts):
    (tmp_path / "a.csv").write_text('k,v\n1,"a\nb"\n', encoding="utf-8")
    (tmp_path / "b.csv").write_text('v,k\n"c\n\nd",2\n' + 'plain,3\n' * 40, encoding="utf-8")
    (tmp_path / "c.csv").write_text("k,v\n4,e\n", encoding="utf-8")
    got = scan_delimited(spark, str(tmp_path), ReadOptions())
    assert rows(got.select("k", "v")) == sorted([("1", "a\nb"), ("2", "c\n\nd"), ("4", "e"), *[("3", "plain")] * 40])


@pytest.mark.parametrize(
    "line, outside, inside",
    [("a,b", False, True), ('a,"b', True, False), ('"a""', True, False), ('x"y,z', False, False), ('"a"b,"c', True, True), ('"', True, False), ('",""', True, False)],
)
def test_open_after(line, outside, inside):
    quotes = Quotes(ReadOptions())
    assert (quotes.open_after(line, False), quotes.open_after(line, True)) == (outside, inside)


def test_only_records_over_parts_are_shuffled(spark, tmp_path, small_parts):
    path = tmp_path / "a.csv"
    path.write_text("k,v\n" + '1,"a"\n' * 200, encoding="utf-8")
    plan = records(spark, [str(path)], ReadOptions())._jdf.queryExecution().toString()
    assert "Exchange" not in plan


def test_given_columns_are_checked(spark, tmp_path, rows, small_parts):
    (tmp_path / "a.csv").write_text('k,v\n1,"a\nb"\n', encoding="utf-8")
    assert rows(scan_delimited(spark, str(tmp_path), ReadOptions(), ["K", "v"])) == [("1", "a\nb")]
    with pytest.raises(Exception, match="header is not"):
        scan_delimited(spark, str(tmp_path), ReadOptions(), ["v", "k"]).collect()
    bare = ReadOptions(header=False)
    assert rows(scan_delimited(spark, str(tmp_path), bare, ["x", "y"])) == [("1", "a\nb"), ("k", "v")]
