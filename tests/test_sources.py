from dataclasses import replace

import pytest

from feedloom.sources import jdbc
from feedloom.sources.documents import body_rows, scan_bodies, scan_json, scan_pages
from feedloom.sources.files import has_quoted_breaks, scan_delimited, scan_parquet, union_by_name
from feedloom.sources.scan import scan
from feedloom.specs import ColumnMapping, ReadOptions, SourceSpec, split_keys


def write(folder, **files):
    for name, text in files.items():
        (folder / name.replace("__", ".")).write_text(text, encoding="utf-8")
    return str(folder)


def test_csv(spark, tmp_path, rows):
    path = write(tmp_path, a__csv='id,text,note\n1,"a, ""b""\nc",\n2,NA,x\\y\n3,"","  z "\n')
    out = scan_delimited(spark, path)
    assert out.columns == ["id", "text", "note"]
    assert rows(out) == [("1", 'a, "b"\nc', None), ("2", None, "x\\y"), ("3", None, "  z ")]
    kept = scan_delimited(spark, path, ReadOptions(missing_words=()))
    assert kept.filter("id = 2").first()["text"] == "NA"


@pytest.mark.parametrize(
    "text, options, broken",
    [
        ('a,b\n"x ""y""",z\n', {}, False),
        ('a,b\n"x\ny",z\n', {}, True),
        ('a,b\n5" pipe,z\n', {}, True),
        ('a,b\n"x \\" y",z\n', {"escape": "\\"}, False),
        ("a,b\n'x\ny',\"\n", {"quote": "'"}, True),
        ("a,b\nx,\"\n", {"quote": "'"}, False),
    ],
)
def test_quoted_breaks_are_found(spark, tmp_path, text, options, broken):
    path = write(tmp_path, a__csv=text)
    given = ReadOptions(**options)
    assert has_quoted_breaks(spark, path, given) is broken
    plain = scan_delimited(spark, path, given)
    whole = scan_delimited(spark, path, replace(given, multiline=True))
    assert plain.collect() == whole.collect()


def test_psv_without_header(spark, tmp_path, rows):
    path = write(tmp_path, a__psv="1|'x|y'\n2|z\n")
    options = ReadOptions.from_properties({"delimiter": "|", "SKIPHEADER": "0", "quotechar": "'"})
    assert rows(scan_delimited(spark, path, options, ["k", "v"])) == [("1", "x|y"), ("2", "z")]


def test_other_column_order_fails(spark, tmp_path):
    path = write(tmp_path, a__csv="a,b\n1,2\n", b__csv="b,a\n2,1\n")
    with pytest.raises(Exception, match="header"):
        scan_delimited(spark, path, columns=["a", "b"]).collect()


def test_read_options():
    options = ReadOptions.from_properties(
        {"Delimiter": ";", "skipheader": "0", "quotechar": "'", "escape": "\\", "lineseparator": "\n",
         "compression": "gzip", "multiline": "0", "sheetname": None, "page_size": "100"}
    )
    assert options.to_spark() == {
        "sep": ";", "header": "false", "quote": "'", "escape": "\\", "multiLine": "false",
        "lineSep": "\n",
    }
    assert ReadOptions().to_spark()["multiLine"] == "true"


def test_pattern_selects_files_at_any_depth(spark, tmp_path, rows):
    (tmp_path / "deep").mkdir()
    write(tmp_path, a1__csv="k\n1\n", b1__csv="k\n2\n")
    write(tmp_path / "deep", a2__csv="k\n3\n")
    assert rows(scan_delimited(spark, str(tmp_path), ReadOptions(pattern="a*.csv"))) == [("1",), ("3",)]


@pytest.mark.parametrize(
    "text",
    [
        '[{"a": 1, "b": {"c": "x"}},\n {"a": 2}]',
        '{"a": 1, "b": {"c": "x"}}\n{"a": 2}\n',
        '\n[{"a": 1, "b": {"c": "x"}}, {"a": 2}]',
    ],
)
@pytest.mark.parametrize("schema", [None, "a bigint, b struct<c: string>"])
def test_json_layouts(spark, tmp_path, rows, text, schema):
    path = write(tmp_path, a__json=text)
    flat = scan(spark, SourceSpec("sftp", path + "/a.json", schema=schema))
    assert rows(flat) == [(1, "x"), (2, None)]


def test_broken_json_is_an_error(spark, tmp_path):
    path = write(tmp_path, a__json='{"a": 1}\n{"a": \n')
    with pytest.raises(Exception, match="MALFORMED|Malformed|malformed"):
        scan_json(spark, path, "a int").collect()


def test_layouts_are_found_for_each_file(spark, tmp_path, rows):
    """A pretty-printed file beside a file of lines: every record of both is read."""
    many = "".join(f'{{"a": {i}}}\n' for i in range(100))
    path = write(tmp_path, a__json='{\n "a": -1,\n "b": "x"\n}\n', b__json=many)
    for schema in (None, "a bigint, b string"):
        assert scan_json(spark, path, schema).count() == 101
    flat = scan_json(spark, path, "a bigint, b string")
    assert flat.where("a = -1").first()["b"] == "x"


def test_files_of_differing_columns_are_paired_by_name(spark, tmp_path, rows):
    path = write(tmp_path, a__csv="id,name\n1,x\n", b__csv='name,id,more\n"y\nz",2,m\n', c__csv="id,name\n3,w\n")
    found = scan(spark, SourceSpec("sftp", path + "/*.csv"))
    assert rows(found.select("id", "name", "more")) == [("1", "x", None), ("2", "y\nz", "m"), ("3", "w", None)]


def test_a_compressed_file(spark, tmp_path, rows):
    import gzip

    (tmp_path / "a.csv.gz").write_bytes(gzip.compress(b"id\n7\n"))
    assert rows(scan(spark, SourceSpec("sftp", str(tmp_path / "a.csv.gz")))) == [("7",)]


def test_dotted_field(spark, tmp_path):
    path = write(tmp_path, a__json='{"p": {"x.y": 1}}')
    flat = scan(spark, SourceSpec("sftp", path + "/a.json"))
    assert flat.columns == ["x.y"] and flat.first()[0] == 1


def test_bodies(spark, tmp_path, rows):
    path = write(
        tmp_path, one='{"a": 1}', two='[{"a": 2},\n {"a": 3}]', three="service unavailable", four="5", five="",
        six='{"a": 1,',
    )
    assert rows(scan_bodies(spark, path, "a int")) == [(1,), (2,), (3,)]
    source = SourceSpec("restapi", path, schema="a int")
    assert rows(scan(spark, source)) == [(1,), (2,), (3,)]
    found = scan(spark, SourceSpec("api", path))
    assert rows(found.where("a IS NOT NULL")) == [(1,), (2,), (3,)]


def test_body_rows_flatten(spark, rows):
    bodies = spark.createDataFrame([('{"a": {"b": 1}}',), (None,)], "body string")
    assert rows(body_rows(bodies, "body", "a struct<b: int>").select("a.b")) == [(1,)]


def test_pages(spark, tmp_path, rows):
    path = write(
        tmp_path,
        p1__json='{"results": [{"id": "1", "properties": {"email": "a@x.example", "firstname": null}}],\n'
        ' "paging": {"next": {"after": "2"}}}',
        p2__json='{"results": [{"id": 2}, {"id": "3", "properties": null}]}',
        p3__json='{"results": []}',
    )
    out = scan_pages(spark, path, ["RecordID", "Email", "FirstName", "hs_object_id"], multiline=True)
    assert rows(out) == [("1", "a@x.example", None, "1"), ("2", None, None, "2"), ("3", None, None, "3")]
    assert {kind for _, kind in out.dtypes} == {"string"}


def test_no_pages(spark, tmp_path):
    out = scan_pages(spark, str(tmp_path), ["id", "x"])
    assert out.columns == ["id", "x"] and out.count() == 0


def test_scan_kinds(spark, tmp_path, rows):
    path = str(tmp_path / "t.parquet")
    spark.range(3).withColumnRenamed("id", "Id").write.parquet(path)
    spark.read.parquet(path).selectExpr("Id", "Id * 2 AS twice", "1 AS unused").createOrReplaceTempView("thing")
    try:
        mapped = [ColumnMapping("twice", "t")]
        assert scan(spark, SourceSpec("SFDC", "thing"), mapped).columns == ["Id", "twice"]
        assert scan(spark, SourceSpec("sf", "SELECT twice FROM thing"), mapped).columns == ["twice"]
        assert scan(spark, SourceSpec("table", "thing")).count() == 3
        assert scan(spark, SourceSpec("sftp", path)).count() == 3
        assert scan_parquet(spark, [path, path]).count() == 6
    finally:
        spark.catalog.dropTempView("thing")


@pytest.mark.parametrize(
    "source, error", [(SourceSpec("ftp", "x"), "Unsupported source type"), (SourceSpec("sftp", "a.xml"), "extension")]
)
def test_unknown_sources(spark, source, error):
    with pytest.raises(ValueError, match=error):
        scan(spark, source)


def test_union_by_name(spark, rows):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([("y", 2)], "w string, k int")
    assert rows(union_by_name([a, b])) == [(1, "x", None), (2, None, "y")]
    with pytest.raises(ValueError):
        union_by_name([])


def test_split_keys():
    assert split_keys(" a , b,,") == ("a", "b")
    assert split_keys("") == split_keys(None) == ()


LOGIN = {"host": "h", "port": 1, "username": "u", "password": "p"}


@pytest.mark.parametrize(
    "dialect, extra, url",
    [
        ("sqlserver", {}, "jdbc:sqlserver://h:1"),
        (
            "sqlserver", {"database": "d"},
            "jdbc:sqlserver://h:1;database=d;encrypt=true;trustServerCertificate=false;loginTimeout=30;",
        ),
        (
            "mssql", {"database": "d"},
            "jdbc:sqlserver://h:1;database=d;encrypt=true;trustServerCertificate=false;loginTimeout=30;",
        ),
        ("postgresql", {}, "jdbc:postgresql://h:1/postgres"),
        ("PostgreSQL", {"dbname": "d"}, "jdbc:postgresql://h:1/d"),
        ("mysql", {"database": "d"}, "jdbc:mysql://h:1"),
        ("oracle", {"SERVICE": "s", "sid": "x"}, "jdbc:oracle:thin:@//h:1/s"),
        ("oracle", {"SID": "x", "ezconnect": "e"}, "jdbc:oracle:thin:@h:1:x"),
        ("oracle", {"ezconnect": "e", "connect_descriptor": "c"}, "jdbc:oracle:thin:@//e"),
        ("oracle", {"connect_descriptor": "(D)"}, "jdbc:oracle:thin:@(D)"),
        ("redshift", {}, "jdbc:redshift://h:1"),
        ("redshift", {"database": "d", "jdbc_params": {"ssl": "on", "a": 1}}, "jdbc:redshift://h:1/d?ssl=on&a=1"),
        ("saphana", {}, "jdbc:sap://h:1"),
        ("saphana", {"currentschema": "S", "jdbc_params": {"encrypt": True}},
         "jdbc:sap://h:1/?encrypt=true&currentSchema=S"),
        ("saphana", {"url": "jdbc:sap://x/?a=1", "jdbc_params": {"b": 2}}, "jdbc:sap://x/?a=1&b=2"),
    ],
)
def test_jdbc_urls(dialect, extra, url):
    options = jdbc.connection_options(dialect, {**LOGIN, **extra})
    assert options["url"] == url and "." in options["driver"]


@pytest.mark.parametrize("dialect, error", [("jdbc", "url"), ("oracle", "Oracle"), ("azuresql", "database")])
def test_jdbc_errors(dialect, error):
    with pytest.raises(ValueError, match=error):
        jdbc.connection_options(dialect, LOGIN)


def test_jdbc_read_options():
    options = jdbc.read_options("postgresql", LOGIN, table="t")
    assert (options["dbtable"], options["user"], options["fetchsize"]) == ("t", "u", "10000")
    assert jdbc.read_options("mysql", LOGIN, query="SELECT 1")["query"] == "SELECT 1"
    assert jdbc.split_options("k", 1, 9, 4) == {
        "partitionColumn": "k", "lowerBound": "1", "upperBound": "9", "numPartitions": "4",
    }
    with pytest.raises(ValueError):
        jdbc.read_options("mysql", LOGIN)
