import uuid

import pytest

from feedloom.plans import load as load_module
from feedloom.plans.load import load
from feedloom.specs import ColumnMapping, FeedSpec, LoadSpec, ReadOptions, SourceSpec
from feedloom.streaming import landing as landing_module
from feedloom.streaming.landing import load_landed


def test_landed_files_load_once_and_are_archived(spark, tmp_path, rows):
    landing, archive = tmp_path / "landing", tmp_path / "archive"
    landing.mkdir()
    table = f"t_{uuid.uuid4().hex}"
    spec = FeedSpec(
        "1", "landed",
        SourceSpec("sftp", str(landing), ReadOptions(pattern="*.csv")),
        (ColumnMapping("k", "k", "INT", 1), ColumnMapping("v", "v", "VARCHAR", 2)),
        LoadSpec("incremental", table, ("k",)),
        archive_path=str(archive),
    )

    def run():
        load_landed(spark, spec, str(tmp_path / "tables"), str(tmp_path / "checkpoint")).awaitTermination()
        return rows(spark.table(table))

    try:
        (landing / "a.csv").write_text("k,v\n1,a\n2,NA\n", encoding="utf-8")
        assert run() == [(1, "a"), (2, None)]
        assert run() == [(1, "a"), (2, None)]
        (landing / "b.csv").write_text('k,v\n2,"b\nb"\n3,c\n3,d\n', encoding="utf-8")
        assert run() == [(1, "a"), (2, "b\nb"), (3, "d")]
        (landing / "c.csv").write_text("k,v\n4,e\n", encoding="utf-8")
        assert len(run()) == 4
        left = {p.name for p in landing.glob("*.csv")}
        moved = {p.name for p in archive.rglob("*.csv")}
        assert "a.csv" in moved and not left & moved
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_a_batch_that_comes_again_is_loaded_once(spark, tmp_path, rows):
    """The run broke off between the load and the commit of its batch; marks see earlier runs."""
    landing, table = tmp_path / "landing", f"t_{uuid.uuid4().hex}"
    landing.mkdir()
    checkpoint = tmp_path / "checkpoint"

    def run(**load):
        spec = FeedSpec(
            "1", "landed", SourceSpec("sftp", str(landing), ReadOptions(pattern="*.csv")),
            (ColumnMapping("id", "id", "INT", 1),), LoadSpec("append", table, (), **load),
        )
        load_landed(spark, spec, str(tmp_path / "tables"), str(checkpoint)).awaitTermination()
        return rows(spark.table(table))

    try:
        (landing / "a.csv").write_text("id\n1\n2\n", encoding="utf-8")
        assert run(watermark="id") == [(1,), (2,)]
        for commit in (checkpoint / "commits").glob("*0*"):
            commit.unlink()
        assert run() == [(1,), (2,)]
        (landing / "b.csv").write_text("id\n2\n3\n", encoding="utf-8")
        assert run(watermark="id") == [(1,), (2,), (3,)]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_a_break_before_the_load_and_an_append_in_between_lose_no_rows(spark, tmp_path, rows, monkeypatch):
    """Another writer changes the number of rows between the break and the next run."""
    landing, table = tmp_path / "landing", f"t_{uuid.uuid4().hex}"
    landing.mkdir()
    spec = FeedSpec(
        "1", "landed", SourceSpec("sftp", str(landing), ReadOptions(pattern="*.csv")),
        (ColumnMapping("id", "id", "INT", 1),), LoadSpec("append", table, ()),
    )

    def run():
        load_landed(spark, spec, str(tmp_path / "tables"), str(tmp_path / "checkpoint")).awaitTermination()
        return rows(spark.table(table))

    try:
        (landing / "a.csv").write_text("id\n1\n2\n", encoding="utf-8")
        assert run() == [(1,), (2,)]
        (landing / "b.csv").write_text("id\n3\n", encoding="utf-8")
        with monkeypatch.context() as broken:
            broken.setattr(landing_module, "load", lambda *a, **k: 1 / 0)
            with pytest.raises(Exception, match="division by zero"):
                run()
        spark.sql(f"INSERT INTO {table} VALUES (50), (51)")
        assert run() == [(1,), (2,), (3,), (50,), (51,)]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


@pytest.mark.parametrize("by", [(), ("part",)], ids=["plain", "partitioned"])
@pytest.mark.parametrize("broken", ["move", "touch", "remove"])
def test_an_append_that_breaks_off_is_gone_on_with(spark, tmp_path, rows, monkeypatch, by, broken):
    table, root = f"t_{uuid.uuid4().hex}", str(tmp_path)
    spec = LoadSpec("append", table, partition_by=by)
    data = spark.range(20).selectExpr("id", "id % 3 AS part").repartition(3)
    try:
        load(spark, spec, data, root, batch="first")
        calls = []

        def once(self, *args, real=getattr(load_module._Folder, broken)):
            calls.append(args)
            if len(calls) == 1 + (broken == "move"):
                raise OSError("broken off")
            return real(self, *args)

        with monkeypatch.context() as patched:
            patched.setattr(load_module._Folder, broken, once)
            with pytest.raises(OSError, match="broken off"):
                load(spark, spec, data, root, batch="second")
        spark.sql(f"INSERT INTO {table} VALUES (100, 1)")
        load(spark, spec, data, root, batch="second")
        load(spark, spec, data, root, batch="second")
        assert spark.table(table).where("id < 100").groupBy("id").count().select("count").distinct().collect() == [(2,)]
        assert spark.table(table).count() == 41
        load(spark, LoadSpec("full", table), data, root)
        assert load(spark, spec, data, root, batch="second").inserted == 0
        assert load(spark, spec, data, root, batch="third").inserted == 20
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_a_merge_or_replacement_of_one_name_is_done_once(spark, tmp_path, rows):
    table, root = f"t_{uuid.uuid4().hex}", str(tmp_path)
    try:
        load(spark, LoadSpec("full", table), spark.createDataFrame([(1, "a")], "k int, v string"), root, batch="a")
        fresh = spark.createDataFrame([(1, "b"), (None, "n")], "k int, v string")
        for _ in range(2):
            load(spark, LoadSpec("incremental", table, ("k",)), fresh, root, batch="b")
        assert rows(spark.table(table)) == [(None, "n"), (1, "b")]
        load(spark, LoadSpec("full", table), fresh, root, batch="a")
        assert rows(spark.table(table)) == [(None, "n"), (1, "b")]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
