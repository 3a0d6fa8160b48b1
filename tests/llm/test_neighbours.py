import numpy as np
import pytest

from feedloom.llm import neighbours
from feedloom.llm.neighbours import bounds, decoded, encode, nearest, rotation


def brute(rows, every, top):
    out = []
    ok = [(i, np.array(v, dtype=float)) for i, v in rows]
    for a, (i, v) in enumerate(ok):
        if i % every == 0:
            score = [(-(w * v).sum() / (np.sqrt((w * w).sum()) * np.sqrt((v * v).sum())), j) for b, (j, w) in enumerate(ok) if a != b]
            out += [(i, k, j) for k, (_, j) in enumerate(sorted(score)[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize("seed, dim", [(1, 64), (2, 16), (3, 3)])
def test_against_brute_force(spark, clashing, seed, dim, monkeypatch):
    monkeypatch.setattr(neighbours, "ROWS", 100)
    monkeypatch.setattr(neighbours, "QUERIES", 7)
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((8, dim))
    rows = [(i, [float(x) for x in centres[i % 8] + 0.3 * rng.standard_normal(dim)]) for i in range(400)]
    rows += [(400 + i, rows[50][1]) for i in range(150)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = nearest(clashing(df), every=50).collect()
    want = brute(rows, 50, 5)
    assert len({(r["query_id"], r["vec_id"]) for r in got} & {(q, v) for q, _, v in want}) >= 0.99 * len(want)
    assert len(got) == len(want)
    vectors = dict(rows)
    for r in got:
        a, b = np.array(vectors[r["query_id"]]), np.array(vectors[r["vec_id"]])
        assert r["score"] == pytest.approx((a * b).sum() / np.sqrt((a * a).sum() * (b * b).sum()), abs=1e-14)


def test_odd_vectors(spark):
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, [None, 1.0]),
        (7, [1.0]), (None, [1.0, 0.0]), (8, [1e200, 0.0]), (8, [1e200, 0.0]), (50, []),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r)[:3] for r in nearest(df).orderBy("rank").collect()]
    assert got == [(0, 1, 8), (0, 2, 8), (0, 3, 1)]
    assert nearest(df.limit(0)).count() == 0
    assert nearest(df.where("vec_id = 0")).count() == 0


def test_errors_are_within_their_bounds():
    rng = np.random.default_rng(4)
    unit = rng.standard_normal((500, 64))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    turn = rotation(64)
    assert np.allclose(turn @ turn.T, np.eye(64))
    codes, scalars = encode(unit, turn)
    assert codes.shape == (500, neighbours.CODES, 8)
    error = bounds(scalars, 64)
    assert np.median(error) < 0.06 and error.max() < 0.15
    off = decoded(codes, scalars, 64) @ (unit[:40] @ turn).T - unit @ unit[:40].T
    assert (np.abs(off) <= error[:, None] + 1e-4).mean() > 0.99 and abs(off.mean()) < 0.01


@pytest.mark.parametrize("dim", [1, 9, 64, 100, 130])
def test_codes_and_scalars_give_their_sum(dim):
    rng = np.random.default_rng(dim)
    unit = rng.standard_normal((50, dim))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    turn = rotation(dim)
    codes, scalars = encode(unit, turn)
    signs = np.where(np.unpackbits(codes, axis=2, count=dim) == 1, 1.0, -1.0)
    known = (signs * scalars[:, : neighbours.CODES, None]).sum(axis=1)
    assert np.allclose(decoded(codes, scalars, dim) * scalars[:, -2:-1], known, atol=1e-6)
    assert np.allclose((known * (unit @ turn)).sum(axis=1), scalars[:, -2])
    assert codes.shape[1] * codes.shape[2] + 4 * scalars.shape[1] < 4 * dim or dim < 64


def test_codes_are_shipped_and_not_vectors(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(i, [float(x) for x in rng.standard_normal(64)]) for i in range(60)], "vec_id long, embedding array<double>")
    plan = nearest(df)._jdf.queryExecution().optimizedPlan().toString()
    grouped = [line for line in plan.splitlines() if "FlatMapCoGroupsInPandas" in line]
    assert len(grouped) == 1 and "array" not in grouped[0]


def test_a_hot_vector_is_a_few_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [1.0, 2.0, 3.0] if i % 3 else [float(x) for x in rng.standard_normal(3)]) for i in range(3000)]
    got = nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=100).collect()
    for q in range(100, 3000, 300):
        assert [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] == [1, 2, 4, 5, 7]
