"""Properties that hold for any rows."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from feedloom.operators.dedupe import keep_latest
from feedloom.operators.merge import merge
from feedloom.operators.nested import normalize
from feedloom.operators.watermark import after_mark, high_water_mark

FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
KEYS = st.one_of(st.none(), st.integers(0, 4))
ROWS = st.lists(st.tuples(KEYS, st.one_of(st.none(), st.integers(0, 3)), st.sampled_from("abc")), max_size=14)
SCHEMA = "k int, w int, v string"


def bag(df):
    return Counter(tuple(r) for r in df.collect())


@FEW
@given(data=ROWS)
def test_dedupe(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    once = bag(keep_latest(df, ["k"], ["w"]))
    wanted = {}
    for row in data:
        rank = (row[1] is not None, row[1] or 0, row[2])
        if row[0] not in wanted or rank > wanted[row[0]][0]:
            wanted[row[0]] = (rank, row)
    assert once == Counter(row for _, row in wanted.values())
    again = keep_latest(spark.createDataFrame(list(once.elements()), SCHEMA), ["k"], ["w"])
    assert bag(again) == once


@FEW
@given(target=ROWS, source=ROWS)
def test_merge(spark, target, source):
    unique = list({row[0]: row for row in source if row[0] is not None}.values())
    keyless = [row for row in source if row[0] is None]
    old = spark.createDataFrame(target, SCHEMA)
    new = spark.createDataFrame(unique + keyless, SCHEMA)
    found = {row[0]: row for row in unique}
    wanted = Counter(found.get(row[0], row) if row[0] is not None else row for row in target)
    present = {row[0] for row in target}
    wanted += Counter(row for row in unique if row[0] not in present) + Counter(keyless)
    once = merge(old, new, ["k"])
    assert bag(once) == wanted
    assert bag(merge(once, spark.createDataFrame(unique, SCHEMA), ["k"])) == wanted


@FEW
@given(target=ROWS, source=ROWS)
def test_append(spark, target, source):
    old, new = spark.createDataFrame(target, SCHEMA), spark.createDataFrame(source, SCHEMA)
    after = old.unionByName(after_mark(new, "w", high_water_mark(old, "w")))
    if any(row[1] is not None for row in target + source):
        assert after_mark(new, "w", high_water_mark(after, "w")).count() == 0


@FEW
@given(lists=st.lists(st.one_of(st.none(), st.lists(st.integers(0, 9), max_size=3)), max_size=6))
def test_explode_keeps_every_parent(spark, lists):
    data = [(i, None if items is None else [(x,) for x in items]) for i, items in enumerate(lists)]
    df = spark.createDataFrame(data, "k int, xs array<struct<x:int>>")
    wanted = Counter((i, x) for i, items in enumerate(lists) for x in (items or [None]))
    assert bag(normalize(df)) == wanted
