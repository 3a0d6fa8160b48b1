"""Tables laid out by buckets of their key: what a merge opens and rewrites."""

import datetime
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.operators.layout import Bucketing, parse_layout
from feedloom.plans import load as load_module
from feedloom.plans.load import load, table_layout, table_rows
from feedloom.specs import LoadSpec


@pytest.fixture
def table(spark):
    name = f"t_{uuid.uuid4().hex}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def files(spark, table):
    folder = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").first()["data_type"]
    return {p.relative_to(folder.removeprefix("file:")).as_posix(): p.stat().st_mtime_ns for p in Path(folder.removeprefix("file:")).rglob("*.parquet")}


@pytest.mark.parametrize("layout", ["truncate(100, k)", "bucket(10, k)"])
def test_only_touched_buckets_are_read_and_written(spark, tmp_path, rows, monkeypatch, table, layout):
    step = {"target": table, "keys": ("k",), "layout": (layout,)}
    old = spark.range(1000).selectExpr("id AS k", "id % 7 AS v")
    load(spark, LoadSpec("incremental", **step), old, str(tmp_path))
    before = files(spark, table)
    assert {p.split("/")[0] for p in before} == {f"__{parse_layout(layout)[0].name[2:]}={b}" for b in (range(0, 1000, 100) if "truncate" in layout else range(10))}
    opened = []

    def seen(target, *args, real=load_module.merge, **kwargs):
        opened.extend(r[0].split("/")[-2] for r in target.select(F.input_file_name()).distinct().collect())
        return real(target, *args, **kwargs)

    monkeypatch.setattr(load_module, "merge", seen)
    # The source's keys are text: they count as the numbers the table holds.
    fresh = spark.createDataFrame([("0205", 70), ("299", 71), ("5000", 72)], "k string, v long")
    result = load(spark, LoadSpec("incremental", table, ("k",)), fresh, str(tmp_path))
    assert (result.inserted, result.updated) == (1, 2)
    bucket = parse_layout(layout)[0]
    kind = T.LongType()
    mine = {f"{bucket.name}={r[0]}" for r in spark.createDataFrame([(205,), (299,), (5000,)], "k long").select(bucket.of(F.col("k"), kind)).collect()}
    after = files(spark, table)
    assert set(opened) <= mine and len(mine) < 4
    unchanged = {p: t for p, t in before.items() if p.split("/")[0] not in mine}
    assert len(unchanged) >= 7 and unchanged.items() <= after.items()
    want = {r["k"]: r["v"] for r in old.collect()} | {205: 70, 299: 71, 5000: 72}
    assert rows(table_rows(spark, table)) == sorted(want.items(), key=str)


def test_every_mode_keeps_the_layout(spark, tmp_path, rows, table):
    spec = {"target": table, "keys": ("k",)}
    data = spark.createDataFrame([(1, "a"), (150, "b"), (None, "n")], "k int, v string")
    load(spark, LoadSpec("full", layout=("truncate(100, k)",), **spec), data, str(tmp_path))
    load(spark, LoadSpec("append", target=table), spark.createDataFrame([(-1, "c")], "k int, v string"), str(tmp_path), batch="x")
    load(spark, LoadSpec("incremental", **spec), spark.createDataFrame([(150, "B"), (None, "m")], "k int, v string"), str(tmp_path))
    assert rows(table_rows(spark, table)) == [(None, "m"), (None, "n"), (-1, "c"), (1, "a"), (150, "B")]
    assert sorted(r[0] or 0 for r in spark.table(table).select("__truncate_k").distinct().collect()) == [-100, 0, 0, 100]
    assert [str(b) for b in table_layout(spark, table)] == ["truncate(100, k)"]
    load(spark, LoadSpec("full", **spec), data.limit(1), str(tmp_path))
    assert rows(table_rows(spark, table)) == [(1, "a")]
    with pytest.raises(ValueError, match="laid out"):
        load(spark, LoadSpec("full", layout=("bucket(3, k)",), **spec), data, str(tmp_path))


def test_a_layout_on_another_column_rewrites_the_table(spark, tmp_path, rows, table):
    spec = {"target": table, "keys": ("k",)}
    load(spark, LoadSpec("full", layout=("bucket(4, v)",), **spec), spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), str(tmp_path))
    load(spark, LoadSpec("incremental", **spec), spark.createDataFrame([(1, "z"), (3, "c")], "k int, v string"), str(tmp_path))
    assert rows(table_rows(spark, table)) == [(1, "z"), (2, "b"), (3, "c")]


def test_buckets_of_values(spark):
    day = datetime.date
    data = [(-1, "abc", day(1969, 12, 31)), (-(2**63), "é", day(2024, 2, 29)), (2**63 - 1, "", day(1970, 1, 1)), (None, None, None)]
    df = spark.createDataFrame(data, "n long, s string, d date")
    cut = lambda w, c: Bucketing("truncate", w, c).of(F.col(c), df.schema[c].dataType)
    got = df.select(cut(10, "n"), cut(2, "s"), cut(7, "d")).collect()
    assert [r[0] for r in got] == [-10, -(2**63) + 10, 2**63 - 8, None]
    assert [r[1] for r in got] == ["ab", "é", "", None]
    assert all(0 <= (a[2] - r[2]).days < 7 and (r[2] - day(1970, 1, 1)).days % 7 == 0 for a, r in zip(data[:3], got, strict=False))
    for wrong in ("buckets(3, a)", "bucket(0, a)", "truncate(a)"):
        with pytest.raises(ValueError, match="layout"):
            parse_layout(wrong)


@pytest.mark.parametrize("small", [0, 100])
def test_large_sources_merge_into_buckets_without_a_broadcast(spark, tmp_path, rows, monkeypatch, table, small):
    from feedloom.operators import merge as merge_module

    monkeypatch.setattr(merge_module, "SMALL_ROWS", small)
    old = spark.createDataFrame([(i, "old") for i in range(40)] + [(None, "old")], "k int, v string")
    fresh = spark.createDataFrame([(i, "new") for i in range(35, 45)] + [(None, "new")], "k int, v string")
    load(spark, LoadSpec("full", table, ("k",), layout=("truncate(10, k)",)), old, str(tmp_path))
    seen = []

    def shown(*args, real=load_module.merge, **kwargs):
        seen.append(real(*args, **kwargs))
        return seen[0]

    monkeypatch.setattr(load_module, "merge", shown)
    result = load(spark, LoadSpec("incremental", table, ("k",)), fresh, str(tmp_path))
    assert (result.inserted, result.updated) == (6, 5)
    want = [(None, "new"), (None, "old")] + [(i, "old") for i in range(35)] + [(i, "new") for i in range(35, 45)]
    assert rows(table_rows(spark, table)) == sorted(want, key=lambda r: [(v is not None, str(v)) for v in r])
    assert ("Broadcast" in seen[0]._jdf.queryExecution().sparkPlan().toString()) is bool(small)
