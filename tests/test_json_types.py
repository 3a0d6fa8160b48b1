"""JSON that is parsed once: the same rows and types as by Spark's own inference over the files."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from feedloom.sources.documents import parsed_once, scan_bodies, scan_json

DOCS = [
    '{"a":1,"b":1.5,"c":"x","d":null,"e":[1,2.5],"f":{"g":1,"h":[{"i":1},{"j":"z"}]},"k":true,"l":1,"m":[],"n":{},"v":1}',
    '[{"a":2,"b":3,"c":"y","l":"s","r":5,"s":[1],"v":1.25,"w":{"x":null},"z":[[]]}, {"o":12345678901234567890,"p":1e3,"q":[1,"a"],"r":{"z":1},"s":1}]',
    '{"t":[null],"u":"2024-01-01","x.y":{"a b":[{"c`d":1.5},{}]},"nn":[{}],"e":[3]}', "[]", "  ",
]


def own(spark, path):
    return spark.read.option("mode", "FAILFAST").json(str(path))


def shown(df):
    return sorted(json.dumps(r.asDict(recursive=True), default=str, sort_keys=True) for r in df.collect())


def test_rows_and_types_of_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text("\n".join(DOCS), encoding="utf-8")
    got, want = scan_json(spark, str(tmp_path)), own(spark, tmp_path)
    assert got.schema == want.schema
    assert shown(got) == shown(want)


def test_the_input_is_scanned_once(spark, tmp_path, monkeypatch):
    (tmp_path / "a.json").write_text('{"a": 1}\n{"a": 2.5}\n', encoding="utf-8")
    found = scan_json(spark, str(tmp_path))
    assert "FileScan" not in found._jdf.queryExecution().toString() and found.schema.simpleString() == "struct<a:double>"
    (tmp_path / "a.json").write_text("gone", encoding="utf-8")
    assert sorted(r["a"] for r in found.collect()) == [1.0, 2.5]


@pytest.mark.parametrize("text", ['{"a": 1, "a": 2}', "5", '{"a": 1}\nnull', '{\n "a": 1\n}', "[1, 2]", "", "{}"])
def test_what_is_left_to_sparks_inference(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text, encoding="utf-8")
    lines = spark.read.text(str(tmp_path)).where("trim(value) <> ''")
    assert parsed_once(lines) is None


values = st.recursive(
    st.one_of(st.none(), st.booleans(), st.integers(-(2**63), 2**63 - 1), st.sampled_from([0.5, -2.25, 1e20, 100.125]), st.text("ab é\"\\", min_size=1, max_size=3)),
    lambda inner: st.one_of(st.lists(inner, max_size=2), st.dictionaries(st.sampled_from("pqr"), inner, max_size=2)), max_leaves=4,
)
rows_of = st.lists(st.dictionaries(st.sampled_from("xyz"), values, min_size=1, max_size=3), min_size=1, max_size=4)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows_of)
def test_any_objects_have_the_types_of_sparks_inference(spark, tmp_path, found):
    (tmp_path / "a.json").write_text("\n".join(json.dumps(r) for r in found), encoding="utf-8")
    got = scan_json(spark, str(tmp_path / "a.json"))
    assert got.schema == own(spark, tmp_path / "a.json").schema
    assert got.count() == len(found)


def test_bodies_without_a_schema(spark, tmp_path, rows):
    for i, text in enumerate(['{"a": 1}', '[{"a": 2},\n {"a": 3}]', "service unavailable", "", '{"a": 1,']):
        (tmp_path / f"{i}.txt").write_text(text, encoding="utf-8")
    found = scan_bodies(spark, str(tmp_path))
    assert rows(found) == [(1,), (2,), (3,)] and found.schema.simpleString() == "struct<a:bigint>"
    (tmp_path / "6.txt").write_text('{"a": 7, "a": 8}', encoding="utf-8")
    with pytest.raises(Exception, match="COLUMN_ALREADY_EXISTS"):
        scan_bodies(spark, str(tmp_path))
