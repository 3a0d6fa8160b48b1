"""Document quality by hierarchical empirical Bayes.

A logistic regression of simple properties of the whole text gives the evidence of a document. Its
site adds a prior: of the labelled documents of a host (the source) and of a path below it (the
language), grouped counts give posteriors, a path's shrunk towards its host's, a host's towards the
global share. How far is estimated from the counts themselves (a beta-binomial moment estimate): the
less hosts differ, and the fewer labels one has, the closer it stays to the global prior.

The regression is fitted on a bounded sample (``MAX_LABELLED`` rows, the smallest hashes of doc_id);
the site counts cover all labelled rows that are not held out.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import smallest_hashes
from feedloom.llm.toxicity import held_out
from feedloom.llm.words import text_chunks, word_hashes

MAX_LABELLED = 8_000
MIN_STRENGTH, MAX_STRENGTH = 2.0, 1e6  # how many labels a prior counts for
#: Bounds of each property's classes; a property is one 0/1 column for each bound it reaches.
BOUNDS = {
    "words": (3, 10, 20, 40, 80, 160, 320, 640, 1280, 2560),
    "word_length": (3, 4, 5, 6, 7, 8, 10),
    "distinct_words": (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9),
    "line_words": (1, 2, 4, 8, 16, 32, 64, 128),
    "distinct_lines": (0.1, 0.25, 0.5, 0.75, 0.9, 0.999),
    "letters": (0.3, 0.5, 0.6, 0.7, 0.75, 0.8, 0.85),
    "capitals": (0.01, 0.02, 0.05, 0.1, 0.3, 0.6),
    "digits": (0.001, 0.005, 0.01, 0.03, 0.1, 0.3),
    "signs": (0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.3),
    "shouts": (0.001, 0.01, 0.05),
    "bars": (0.001, 0.01, 0.05),
}
_CLASS = np.zeros(256, dtype=np.uint8)  # 0: none of the classes below
for _i, _c in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "#$%&*+<=>@\\^_`{}~", "!?", "|")):
    _CLASS[[ord(x) for x in _c]] = _i + 1
_CLASS[0xC0:] = 1  # the first byte of any character beyond ASCII counts as a letter


def properties(column: pa.Array) -> np.ndarray:
    """The properties of every whole text, in the order of BOUNDS; a null text is empty."""
    out = np.zeros((len(column), len(BOUNDS)))
    for row, end, data, bounds in text_chunks(column):
        words, at = word_hashes(data, bounds)
        kind = _CLASS[data]
        breaks = np.flatnonzero(data == 10)
        for i in range(end - row):
            a, b = bounds[i], bounds[i + 1]
            own = words[at[i] : at[i + 1]]
            if not len(own):
                continue
            low, up, digit, sign, shout, bar = np.bincount(kind[a:b], minlength=7)[1:]
            lines = [x for x in data[a:b].tobytes().split(b"\n") if x] if np.searchsorted(breaks, a) < np.searchsorted(breaks, b) else [b""]
            n, size = len(own), int(b - a)
            out[row + i] = (
                n, size / n, len(np.unique(own)) / n, n / len(lines), len(set(lines)) / len(lines), (low + up) / size,
                up / max(1, low + up), digit / size, sign / size, shout / size, bar / size,
            )
    return out


def coded(values: np.ndarray) -> np.ndarray:
    return np.hstack([values[:, [j]] >= np.array(b) for j, b in enumerate(BOUNDS.values())]).astype(float)


def _strength(groups: DataFrame) -> float:
    """The moment estimate from grouped (k, n, prior), as sums over all groups."""
    chance = F.greatest(F.col("prior") * (1 - F.col("prior")), F.lit(1e-6))
    m, spread, free = groups.where("n > 1").agg(
        F.count("*"), F.sum((F.col("k") / F.col("n") - F.col("prior")) ** 2 * F.col("n") / chance), F.sum(F.col("n") - 1)
    ).first()
    if m < 2:
        return MAX_STRENGTH
    rho = (spread - m) / free
    return float(min(max(1 / rho - 1, MIN_STRENGTH), MAX_STRENGTH)) if rho > 0 else MAX_STRENGTH


def site_priors(labelled: DataFrame) -> tuple[DataFrame, float]:
    """(host, path, prior) of labelled rows (host, path, y), and the global share.

    Counts are aggregates with a map side; a host or path of any size is one row.
    """
    n, k = labelled.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    share = (k + 0.5) / (n + 1)
    count = lambda *by: labelled.groupBy(*by).agg(F.count("*").alias("n"), F.sum("y").alias("k"))
    hosts = count("host").withColumn("prior", F.lit(share))
    s = _strength(hosts)
    hosts = hosts.select(F.col("host").alias("h"), ((F.col("k") + s * F.col("prior")) / (F.col("n") + s)).alias("prior"))
    paths = count("host", "path").join(hosts, F.col("host").eqNullSafe(F.col("h")))
    s = _strength(paths)
    found = paths.select("host", "path", ((F.col("k") + s * F.col("prior")) / (F.col("n") + s)).alias("prior"))
    # Paths without labels have their host's posterior.
    return found.unionByName(hosts.select(F.col("h").alias("host"), F.lit("\0any").alias("path"), "prior")), share


def _regression(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    from feedloom.llm.toxicity import _regression as fit

    return fit(x, y, penalty=1.0)


def quality_scores(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    host_col: str = "source", path_col: str = "lang", label_col: str = "quality",
) -> DataFrame:
    """For every row of ``docs``: doc_id, held_out, evidence, prior, score, predicted, keep.

    ``evidence`` is the share the text alone gives, ``prior`` that of its site, ``score`` both
    combined; rows of score one half and more are kept. A null text counts as empty; a null host or
    path is a site of its own. Labels that are null or not 0 or 1 are left out; of several of a
    document the largest holds. Without two classes the evidence is the global share. Rows that
    repeat an identifier are scored each by its own text. An empty table gives no rows.
    """
    marked = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & ~held_out(id_col))
        .groupBy(F.col(id_col).alias("__id")).agg(F.max(label_col).cast("int").alias("y"))
    )
    small = docs.select(F.col(id_col).alias("__id"), F.col(host_col).cast("string").alias("host"), F.col(path_col).cast("string").alias("path"))
    priors, share = site_priors(small.join(marked, "__id"))

    def measured(texts: pd.Series) -> pd.Series:
        return pd.Series(list(properties(pa.array(texts, pa.large_string(), from_pandas=True))))

    measure = F.pandas_udf(measured, "array<double>")
    sample = smallest_hashes(marked, ["__id"], MAX_LABELLED)
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("t")).join(F.broadcast(sample), "__id")
    rows = rows.select("y", measure("t").alias("p")).collect()  # at most a row for each sampled label
    y = np.array([r["y"] for r in rows], dtype=float)
    two = len(set(y.tolist())) == 2
    weights, intercept = _regression(coded(np.array([r["p"] for r in rows])), y) if two else (None, float(np.log(share / (1 - share))))
    base = float(np.log(y.mean() / (1 - y.mean()))) if two else intercept

    def judged(texts: pd.Series) -> pd.Series:
        x = coded(properties(pa.array(texts, pa.large_string(), from_pandas=True)))
        return pd.Series(np.clip(x @ weights + intercept, -30, 30) if two else np.full(len(x), intercept))

    logit = lambda c: F.log(c / (1 - c))
    back = lambda c: 1 / (1 + F.exp(-c))
    found = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(held_out(id_col), F.lit(False)).alias("held_out"), F.col(host_col).cast("string").alias("host"),
        F.col(path_col).cast("string").alias("path"), F.pandas_udf(judged, "double")(F.col(text_col).cast("string")).alias("e"),
    )
    own = priors.where("path is null or path <> '\0any'").select(F.col("host").alias("h1"), F.col("path").alias("p1"), F.col("prior").alias("of_path"))
    whole = priors.where("path = '\0any'").select(F.col("host").alias("h2"), F.col("prior").alias("of_host"))
    found = found.join(own, F.col("host").eqNullSafe(F.col("h1")) & F.col("path").eqNullSafe(F.col("p1")), "left")
    found = found.join(whole, F.col("host").eqNullSafe(F.col("h2")), "left").withColumn("prior", F.coalesce("of_path", "of_host", F.lit(share)))
    found = found.withColumn("score", back(F.col("e") - base + logit(F.col("prior"))))
    return found.select(
        "doc_id", "held_out", back(F.col("e")).alias("evidence"), "prior", "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), (F.col("score") >= 0.5).alias("keep"),
    )
