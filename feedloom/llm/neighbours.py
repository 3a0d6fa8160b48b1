"""Nearest neighbours by cosine with randomly rotated one-bit codes.

Every vector is scaled to length one and rotated by one random orthogonal matrix; its code is the
sign of each coordinate, packed to bits. With few dimensions one such code leaves large errors, so what
a code leaves over is coded in the same way, some times. Each code has its length as a scalar, and their sum has
as correction scalar its inner product with the vector. Codes are made once, as packed bits; blocks of codes and of
queries meet, and no vector goes along. The inner product of a rotated query with the sum of a row's
codes, divided by the correction, estimates the inner product of the vectors, with an error
below ``EPSILON / sqrt(d - 1)`` times what of the codes' sum is not along the vector, with high probability.

A first scan of the codes finds each query's best estimates, over all blocks. Their vectors are joined and
measured exactly, which gives the query a bar. A second scan lets through the rows whose
estimate plus error bound reaches the bar, and only their vectors are joined and measured, in double
precision as they are. No row is left unseen. Of equal vectors only as many as can be
among the nearest take part, those with the smallest identifiers, so a hot vector is a few rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import checkpointed

ROWS, QUERIES = 32768, 1024  # of a block
CODES = 5  # of a vector
FIRST = 4  # how many times the neighbours wanted are measured to find the bar
EPSILON = 3.0


def rotation(dim: int, seed: int = 5) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def encode(unit: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed sign bits of unit vectors (vectors by codes by bytes), and scalars: lengths, correction, what is across."""
    turned = unit @ turn
    rest, codes, lengths = turned.copy(), [], []
    for _ in range(CODES):
        sign = rest >= 0
        length = np.abs(rest).mean(axis=1)
        codes.append(np.packbits(sign, axis=1))
        lengths.append(length)
        rest -= np.where(sign, length[:, None], -length[:, None])
    known = turned - rest
    along = (known * turned).sum(axis=1)
    across = np.sqrt(np.maximum((known * known).sum(axis=1) - along * along, 0))
    return np.stack(codes, axis=1), np.stack([*lengths, along, across], axis=1)


def bounds(scalars: np.ndarray, dim: int) -> np.ndarray:
    """How far estimates may be off, by row."""
    return EPSILON * scalars[:, -1] / (scalars[:, -2] * np.sqrt(max(1, dim - 1)))


def decoded(codes: np.ndarray, scalars: np.ndarray, dim: int) -> np.ndarray:
    """The sums of the codes of a block's rows, divided by the corrections, in single precision."""
    known = np.zeros((len(codes), dim), dtype=np.float32)
    for k in range(codes.shape[1]):
        length = (scalars[:, k] / scalars[:, -2]).astype(np.float32)[:, None]
        known += np.where(np.unpackbits(codes[:, k], axis=1, count=dim), length, -length)
    return known


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(row, vec_id, v): vectors that take part, as doubles."""
    v = F.col(vector_col).cast("array<double>")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.coalesce(good, F.lit(False))
    )


def _measured(pairs: DataFrame, asked: DataFrame, data: DataFrame) -> DataFrame:
    """(query, query_id, row, vec_id, score) of pairs (query, row), from their vectors."""

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = np.empty(len(pdf))
            for a in range(0, len(pdf), 1024):
                # By a power of two, which changes no digit of a cosine and keeps squares within bounds.
                q, v = (np.array(pdf[c].iloc[a : a + 1024].tolist(), dtype=np.float64) for c in ("q", "v"))
                q, v = (np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1]) for x in (q, v))
                norms = np.sqrt((q * q).sum(axis=1)), np.sqrt((v * v).sum(axis=1))
                found[a : a + 1024] = (v * q).sum(axis=1) / (norms[1] * norms[0])
            yield pdf[["query", "query_id", "row", "vec_id"]].assign(score=found)

    queries = asked.select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
    met = pairs.join(data.select("row", "vec_id", "v"), "row").join(queries, "query")
    return met.select("query", "query_id", "row", "vec_id", "q", "v").mapInPandas(score, "query long, query_id long, row long, vec_id long, score double")


def nearest(vectors: DataFrame, every: int = 50, top: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """For every row whose identifier is divisible by ``every``: query_id, rank, vec_id, score of its ``top`` nearest.

    Nearest first by cosine, ties by the smaller identifier; fewer rows if there are fewer
    candidates, none for an empty table. Vectors that are null, zero, or hold null or non-finite
    components, rows without an identifier, and vectors of another length than most have no part. A
    row that repeats another's identifier is a candidate of its own. Other columns have no part.
    """
    rows = checkpointed(usable(vectors, id_col, vector_col))
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    result = "query_id long, rank int, vec_id long, score double"
    if sizes is None:
        return vectors.sparkSession.createDataFrame([], result)
    dim = sizes["d"]
    rows = rows.where(F.size("v") == dim)
    asked = rows.where(F.col("vec_id") % every == 0)
    # Of equal vectors those with the smallest identifiers come first, and one may be the query itself.
    place = F.row_number().over(Window.partitionBy("v").orderBy("vec_id", "row"))
    data = checkpointed(rows.withColumn("place", place).where(F.col("place") <= top + 1).drop("place"))
    turn = rotation(dim)

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            v = np.array(pdf["v"].tolist(), dtype=np.float64).reshape(-1, dim)
            v = np.ldexp(v, -np.frexp(np.abs(v).max(axis=1, keepdims=True))[1])
            codes, scalars = encode(v / np.sqrt((v * v).sum(axis=1, keepdims=True)), turn)
            yield pd.DataFrame({"row": pdf["row"].to_numpy(), "code": [c.tobytes() for c in codes], "scalars": [x.astype(np.float32).tobytes() for x in scalars]})

    def turned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            v = np.array(pdf["v"].tolist(), dtype=np.float64).reshape(-1, dim)
            v = np.ldexp(v, -np.frexp(np.abs(v).max(axis=1, keepdims=True))[1])
            unit = (v / np.sqrt((v * v).sum(axis=1, keepdims=True))) @ turn
            yield pd.DataFrame({"row": pdf["row"].to_numpy(), "code": [u.astype(np.float32).tobytes() for u in unit]})

    codes = checkpointed(data.select("row", "v").mapInPandas(coded, "row long, code binary, scalars binary"))
    queries = checkpointed(asked.select("row", "v").mapInPandas(turned, "row long, code binary"))
    data_blocks, query_blocks = max(1, -(-codes.count() // ROWS)), max(1, -(-queries.count() // QUERIES))
    number = lambda k: F.pmod(F.xxhash64("row"), F.lit(k)).cast("int")
    others = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    held = codes.select(number(data_blocks).alias("d"), others(query_blocks).alias("b"), "row", "code", "scalars")

    def scan(bars: DataFrame | None) -> DataFrame:
        """Pairs (query, row, estimate): the best of each block, or all that may reach the query's bar."""
        asks = queries if bars is None else queries.join(bars, queries["row"] == bars["query"], "left").drop("query")
        barred = bars is not None
        bar = F.lit(0.0) if bars is None else F.coalesce("bar", F.lit(-2.0))
        asks = asks.select(others(data_blocks).alias("d"), number(query_blocks).alias("b"), "row", "code", bar.alias("bar"))

        def search(mine: pd.DataFrame, those: pd.DataFrame) -> pd.DataFrame:
            codes = np.frombuffer(b"".join(those["code"]), dtype=np.uint8).reshape(len(those), CODES, -1)
            scalars = np.frombuffer(b"".join(those["scalars"]), dtype=np.float32).reshape(len(those), -1)
            known, error, row = decoded(codes, scalars, dim), bounds(scalars, dim), those["row"].to_numpy()
            asked_for = np.frombuffer(b"".join(mine["code"]), dtype=np.float32).reshape(len(mine), dim)
            queries_at, bars_at, out = mine["row"].to_numpy(), mine["bar"].to_numpy(), []
            for a in range(0, len(mine), 64):
                for i, guess in enumerate(asked_for[a : a + 64] @ known.T, a):
                    guess[row == queries_at[i]] = -np.inf
                    if barred:
                        # Single precision moves an estimate by far less than 1e-4.
                        chosen = np.flatnonzero(guess + error + 1e-4 >= bars_at[i])
                    else:
                        k = min(FIRST * top, len(row))
                        chosen = np.argpartition(-guess, k - 1)[:k]
                    chosen = chosen[np.isfinite(guess[chosen])]
                    out.append(pd.DataFrame({"query": queries_at[i], "row": row[chosen], "estimate": guess[chosen]}))
            return pd.concat(out) if out else pd.DataFrame({"query": [], "row": [], "estimate": []})

        both = asks.groupBy("d", "b").cogroup(held.groupBy("d", "b"))

        def met(mine: pd.DataFrame, those: pd.DataFrame) -> pd.DataFrame:
            if not len(mine) or not len(those):
                return pd.DataFrame({"query": [], "row": [], "estimate": []})
            return search(mine, those)

        return both.applyInPandas(met, "query long, row long, estimate double")

    by_guess = Window.partitionBy("query").orderBy(F.desc("estimate"), "row")
    first = scan(None).withColumn("k", F.row_number().over(by_guess)).where(F.col("k") <= FIRST * top).select("query", "row")
    measured = checkpointed(_measured(first, asked, data))
    by_score = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    bars = measured.withColumn("k", F.row_number().over(by_score)).where(F.col("k") == top).select("query", F.col("score").alias("bar"))
    rest = scan(bars).select("query", "row").join(measured.select("query", "row"), ["query", "row"], "left_anti")
    found = measured.unionByName(_measured(rest, asked, data))
    return found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
