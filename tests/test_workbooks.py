import io
import zipfile
from pathlib import Path

import pytest

from feedloom.sources.scan import scan
from feedloom.sources.workbooks import (
    header_names,
    scan_workbooks,
    sheet_rows,
    workbook_columns,
    workbook_files,
)
from feedloom.specs import ColumnMapping, ReadOptions, SourceSpec

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def book(sheets, strings=(), formats=(), old_dates=False):
    """A workbook from sheet XML by name, shared strings, and cell number formats."""
    names = "".join(f'<sheet name="{n}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(sheets))
    links = "".join(f'<Relationship Id="r{i}" Target="worksheets/s{i}.xml"/>' for i in range(len(sheets)))
    custom = "".join(f'<numFmt numFmtId="{200 + i}" formatCode="{f}"/>' for i, f in enumerate(formats))
    styles = "".join(f'<xf numFmtId="{200 + i}"/>' for i in range(len(formats)))
    parts = {
        "xl/workbook.xml": f'<workbook xmlns="{MAIN}" xmlns:r="{OFFICE}">'
        f'<workbookPr date1904="{int(old_dates)}"/><sheets>{names}</sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="x">{links}</Relationships>',
        "xl/sharedStrings.xml": f'<sst xmlns="{MAIN}">{"".join(strings)}</sst>',
        "xl/styles.xml": f'<styleSheet xmlns="{MAIN}"><numFmts>{custom}</numFmts>'
        f'<cellXfs><xf numFmtId="0"/><xf numFmtId="14"/>{styles}</cellXfs></styleSheet>',
    }
    for i, xml in enumerate(sheets.values()):
        parts[f"xl/worksheets/s{i}.xml"] = f'<worksheet xmlns="{MAIN}"><sheetData>{xml}</sheetData></worksheet>'
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        for name, text in parts.items():
            archive.writestr(name, text)
    return buffer.getvalue()


def text_row(*values):
    return "<row>" + "".join(f'<c t="inlineStr"><is><t>{v}</t></is></c>' for v in values) + "</row>"


def test_cell_kinds():
    xml = (
        '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="b"><v>1</v></c><c r="D1"><v>12</v></c>'
        '<c r="E1"><v>1.50</v></c><c r="F1" s="1"><v>45356</v></c><c r="G1" s="2"><v>45356.5</v></c>'
        '<c r="H1" s="3"><v>7</v></c><c r="I1" t="str"><f>A1</f><v>made</v></c><c r="J1"/>'
        '<c r="K1" t="e"><v>#N/A</v></c><c r="AA1"><v>3.0</v></c></row><row r="4"><c r="A4" t="s"><v>1</v></c></row>'
    )
    strings = ["<si><t>plain</t></si>", "<si><r><t>in </t></r><r><t>runs</t></r><rPh><t>no</t></rPh></si>"]
    rows = list(sheet_rows(book({"s": xml}, strings, ["yyyy\\-mm hh:mm", "0.00&quot;day&quot;"])))
    first = ["plain", None, "true", "12", "1.50", "2024-03-05 00:00:00", "2024-03-05 12:00:00", "7", "made", None, "#N/A"]
    assert rows[0][:11] == first and rows[0][26] == "3"
    assert rows[1:] == [[], [], ["in runs"]]


def test_times_and_old_dates():
    xml = '<row><c s="1"><v>0.25</v></c><c s="1"><v>1</v></c></row>'
    assert list(sheet_rows(book({"s": xml}, old_dates=True))) == [["06:00:00", "1904-01-02 00:00:00"]]


def test_header_names():
    assert header_names(["a", None, "a", "b", "a"]) == ["a", "Unnamed: 1", "a.1", "b", "a.2"]


@pytest.fixture
def folder(tmp_path):
    one = book({"first": text_row("id", "name") + text_row("1", "x"), "second": text_row("id") + text_row("9")})
    two = book({"first": text_row("Name", "extra") + text_row("y", "NA") + text_row("z", "e")})
    (tmp_path / "a1.xlsx").write_bytes(one)
    (tmp_path / "a2.xlsx").write_bytes(two)
    (tmp_path / "b.xlsx").write_bytes(book({"first": text_row("id") + text_row("no")}))
    return str(tmp_path)


def test_union_of_matching_workbooks(spark, folder, rows):
    out = scan_workbooks(spark, folder, ["id", "NAME", "extra"], ReadOptions(pattern="a*.xlsx"))
    assert rows(out) == [(None, "y", None), (None, "z", "e"), ("1", "x", None)]


def test_named_sheet_and_no_header(spark, folder, rows):
    named = ReadOptions(pattern="a1.xlsx", sheet="second")
    assert rows(scan_workbooks(spark, folder, ["id"], named)) == [("9",)]
    plain = ReadOptions(pattern="b.xlsx", header=False)
    assert rows(scan_workbooks(spark, folder, ["0", "1"], plain)) == [("id", None), ("no", None)]
    with pytest.raises(Exception, match="no sheet named"):
        scan_workbooks(spark, folder, ["id"], ReadOptions(pattern="b.xlsx", sheet="gone")).collect()


@pytest.mark.parametrize(
    "pattern, found",
    [
        ("a*.xlsx", ["a1", "a2"]),
        ("*.xlsx", ["a1", "a2", "a3", "b"]),
        ("sub/*", ["a3"]),
        ("s*3.xlsx", ["a3"]),
        ("a?.xlsx", ["a1", "a2"]),
        ("[ab].xlsx", ["b"]),
        ("a1.xlsx", ["a1"]),
    ],
)
def test_patterns_hold_for_the_path_below_the_folder(spark, folder, pattern, found):
    below = Path(folder) / "sub"
    below.mkdir()
    (below / "a3.xlsx").write_bytes(book({"first": text_row("id")}))
    (below / "notes.txt").write_text("no")
    names = workbook_files(spark, folder, pattern).select("path").collect()
    assert sorted(Path(r["path"]).stem for r in names if r["path"].endswith("xlsx")) == found


def test_one_file_or_none(spark, folder, rows):
    assert rows(scan_workbooks(spark, folder + "/b.xlsx", ["id"])) == [("no",)]
    with pytest.raises(ValueError, match="matches"):
        scan_workbooks(spark, folder, ["id"], ReadOptions(pattern="z*.xlsx"))


def test_columns_and_kind(spark, folder, rows):
    files = spark.read.format("binaryFile").load(folder)
    assert set(workbook_columns(files, ReadOptions())) == {"id", "name", "Name", "extra"}
    source = SourceSpec("azureblob", folder, ReadOptions(pattern="b*"))
    assert rows(scan(spark, source, [ColumnMapping("ID", "k")])) == [("no",)]


def test_long_sheets_come_in_batches(spark, tmp_path):
    (tmp_path / "long.xlsx").write_bytes(book({"s": text_row("k") + "".join(text_row(i) for i in range(9000))}))
    out = scan_workbooks(spark, str(tmp_path), ["k"])
    assert out.count() == 9000 and out.distinct().count() == 9000
