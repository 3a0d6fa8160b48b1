import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from feedloom.llm.exact import drop_exact_duplicates, exact_groups, merged_runs


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep if len(ids) > 1 else i, len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


def test_groups_against_brute_force(documents):
    rows = [(i, ["same", "É\n", f"own {i}", None, ""][i % 5], "s") for i in range(200)]
    got = exact_groups(documents(rows, 7), largest=True)
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got.collect()), key=str) == brute([r[:2] for r in rows])
    kept = [r["doc_id"] for r in got.where("kept").collect()]
    assert len(kept) == len(set(kept)) == 43


def test_odd_rows(odd, clashing):
    got = exact_groups(clashing(odd))
    assert got.count() == odd.count()
    assert [tuple(r) for r in got.where("kept and text_sha256 = sha2('a b c d e f g h', 256)").select("doc_id", "keep_id", "group_size").collect()] == [(1, 1, 3)]
    by_text = got.groupBy("text_sha256").agg(F.sum(F.col("kept").cast("int")).alias("k")).collect()
    assert {r["k"] for r in by_text} == {1}
    assert exact_groups(odd.limit(0)).count() == 0


def test_dropping(odd, clashing):
    kept = drop_exact_duplicates(clashing(odd), largest=True)
    assert kept.columns == clashing(odd).columns
    assert sorted(r["text"] or "" for r in kept.collect()) == sorted({r["text"] or "" for r in odd.collect()})


@pytest.mark.parametrize("runs, fan_in", [(1, 2), (9, 2), (40, 3), (16, 16)])
def test_every_tree_gives_the_same(spark, runs, fan_in):
    rows = spark.range(500).selectExpr(
        f"CAST(id % {runs} AS INT) AS __run", "CAST(CAST(id % 7 AS STRING) AS BINARY) AS __sha", "1 AS __bytes", "id % 2 AS __check", "id AS __id", "id AS __row"
    )
    got = merged_runs(rows, runs, False, fan_in)
    assert got.agg(F.sum("__n")).first()[0] == 500 and got.count() == 14
    assert sorted(r["__best"]["__id"] for r in got.collect()) == list(range(14))


def test_the_main_path_is_native(documents):
    plan = exact_groups(documents([(1, "a", "s")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
