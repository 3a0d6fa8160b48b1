"""Toxicity of whole texts, scored after undoing disguised spellings.

A noisy channel turned intended words into what is written: letters into look-alike signs, one
letter into a run of it, a word into single letters with separators. Words that show such traces are
decoded: the readings of every sign, letter run and separator form a lattice, and Viterbi search
finds the most likely spelling under a character trigram model. Signs at a word's edge may also be
none of it. All other words have one reading, themselves. The trigram model is counted over all
documents, as built-in sums of one count vector per task.

The restored words, with the written ones, are the features of a logistic regression. It is fitted
on a bounded sample of labelled rows (``MAX_LABELLED``, the smallest hashes of doc_id), over at most
``MAX_FEATURES`` words and word beginnings that tell the classes apart.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import checkpointed, giving_back, small_batches, smallest_hashes
from feedloom.llm.words import text_chunks

MAX_LABELLED = 8_000
MAX_FEATURES = 500
MIN_DOCS = 4  # labelled documents that must have a feature

# Which letters a sign may stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t",
}
# Negative log probabilities of the channel: a sign, a run of a letter, an added sign.
_SIGN_COST, _RUN_COST, _DROP_COST = 1.5, 0.7, 2.0
_END_COSTS = (0.0, 1.5, 3.0, 5.0)  # tried for a word end at a separator: the model alone favours short words

_SYMBOLS = 28  # 0 word edge, 1-26 a-z, 27 any other letter
_SYMBOL = np.zeros(256, dtype=np.int32)
_SYMBOL[97:123] = _SYMBOL[65:91] = np.arange(1, 27)
_SYMBOL[128:] = 27
_SIGN = np.zeros(256, dtype=bool)
_SIGN[[ord(c) for c in LOOKALIKES]] = True
_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[ord(c) for c in " .-_*"]] = True

_WORD = re.compile(r"[^\W\d_]+")
_RUNS = re.compile(r"(.)\1*", re.S)
_DOUBLE = re.compile(r"([a-z])\1")
# A run of letters, digits and signs that has a letter beside a sign.
_SIGNED = re.compile(r"(?<![^\W_])(?<![@$!|+])(?:[^\W\d_]++[0-9@$!|+]|[0-9@$!|+]++[^\W\d_])(?:[^\W_]|[@$!|+])*+")
_LEADING, _TRAILING = re.compile(r"[\d@$!|+]+"), re.compile(r"[\d@$!|+]++\Z")
_GAP = re.compile(r"[ ._*-]+")
_SPACED = re.compile(r"(?<!\w)(?:[a-z0-9@$!|+][ ._*-]+){2,}[a-z0-9@$!|+](?!\w)")


def trigram_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """How often each three symbols follow each other, over all texts: a table of fixed size."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_SYMBOLS**3, dtype=np.int64)
        for batch in batches:
            for _, _, data, _ in text_chunks(batch.column(0)):
                s = np.concatenate([[0], _SYMBOL[data], [0]])
                if len(s) > 2:
                    total += np.bincount((s[:-2] * _SYMBOLS + s[1:-1]) * _SYMBOLS + s[2:], minlength=_SYMBOLS**3)
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(total[own])], names=["gram", "n"])

    rows = docs.select(F.col(text_col).cast("string")).mapInArrow(giving_back(counted), "gram long, n long")
    out = np.zeros(_SYMBOLS**3)
    for gram, n in rows.groupBy("gram").agg(F.sum("n")).collect():  # at most _SYMBOLS ** 3 rows
        out[gram] = n
    return out


def costs(counts: np.ndarray) -> np.ndarray:
    """Negative log probabilities of the third symbol, interpolated with those of two and of one."""
    cube = counts.reshape(_SYMBOLS, _SYMBOLS, _SYMBOLS)
    one = (cube.sum((0, 1)) + 1) / (cube.sum() + _SYMBOLS)
    pair = cube.sum(0)
    two = (pair + 20 * one) / (pair.sum(1, keepdims=True) + 20)
    return -np.log((cube + 20 * two[None]) / (cube.sum(2, keepdims=True) + 20))


def _symbol(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else 0 if c == " " else 27


def _readings(c: str, run: int, ends: bool, double: bool) -> list[tuple[str, float]]:
    """What a run of one character may stand for, with its price."""
    signs, gaps = LOOKALIKES.get(c), ("", " ") if ends else ("",)
    if signs and run > 1:  # a sign's run is as many letters
        return [(x + gap + y, 2 * _SIGN_COST) for x in signs for gap in gaps for y in signs]
    if signs:
        return [(x, _SIGN_COST) for x in signs]
    if run == 1 or not c.isalpha():
        return [(c * min(run, 2), 0.0)]
    if run == 2 and not double:
        return [(c + gap + c, 0.0) for gap in gaps]
    # A letter's run is one letter or two.
    return [(c, _RUN_COST), *((c + gap + c, _RUN_COST if run > 2 else 0.0) for gap in gaps)]


def decode(
    written: str, cost: np.ndarray | list[float], end: float | None = None, lead: int = 0, trail: int = 0, double: bool = True
) -> str:
    """The most likely intended word for a written one without separators: Viterbi over its lattice.

    With a price ``end``, words may end (a space) between any two characters. Signs in the first
    ``lead`` and the last ``trail`` characters may be none of the word. Without ``double``, a letter
    written twice is meant twice. Time is linear in the length.
    """
    flat = cost if isinstance(cost, list) else cost.ravel().tolist()
    steps: list[list[tuple[str, float]]] = []
    for m in _RUNS.finditer(written):
        if end is not None and steps:
            steps.append([("", 0.0), (" ", end)])
        readings = _readings(m[1], m.end() - m.start(), end is not None, double)
        if m.end() <= lead or m.start() >= len(written) - trail:
            readings = [*readings, ("", _DROP_COST)]
        if steps and len(readings) == len(steps[-1]) == 1 and readings[0][1] == steps[-1][0][1] == 0:
            (before, _), (more, _) = steps.pop()[0], readings[0]
            readings = [(before + more, 0.0)]
        steps.append(readings)
    best: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}
    for step in [*steps, [(" ", 0.0)]]:
        options = [(reading, tuple(map(_symbol, reading)), price) for reading, price in step]
        new: dict[int, tuple[float, tuple | None]] = {}
        for state, (total, back) in best.items():
            for reading, symbols, price in options:
                at, sum_ = state, total + price
                for z in symbols:
                    gram = at * _SYMBOLS + z
                    sum_ += flat[gram]
                    at = gram % (_SYMBOLS * _SYMBOLS)
                if at not in new or sum_ < new[at][0]:
                    new[at] = (sum_, (back, reading))
        best = new
    least = min(total for total, _ in best.values())
    texts = []
    for total, back in best.values():
        if total == least:
            parts = []
            while back:
                back, reading = back
                parts.append(reading)
            texts.append("".join(reversed(parts))[:-1])
    return min(texts)


def _wider(spaced: str, least: int) -> list[str]:
    """The parts of a spaced run between the gaps that are wider than its least."""
    parts, at = [], 0
    for m in _GAP.finditer(spaced):
        if m.end() - m.start() > least:
            parts.append(spaced[at : m.start()])
            at = m.end()
    return [*parts, spaced[at:]]


def _disguised(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Which texts may have letters beside signs, and single characters between separators: a quick look at all bytes."""
    signed, spaced = np.zeros(len(column), dtype=bool), np.zeros(len(column), dtype=bool)
    for row, _, data, bounds in text_chunks(column):
        if len(data) < 2:
            continue
        letter, sign, part = _SYMBOL[data] > 0, _SIGN[data], _SEPARATOR[data]
        for out, trace in ((signed, sign[:-1] & letter[1:] | letter[:-1] & sign[1:]), (spaced, part[:-2] & ~part[1:-1] & part[2:])):
            at = np.searchsorted(bounds, np.flatnonzero(trace), "right") - 1
            out[row + np.unique(at)] = True
    return signed, spaced


class Restorer:
    """Restored words of a text, remembering decoded spellings."""

    def __init__(self, cost: np.ndarray) -> None:
        self.cost, self.known = cost.ravel().tolist(), {}

    def _kept(self, kind: str, written: str, found) -> tuple[str, ...]:
        key = kind + written
        if key in self.known:
            return self.known[key]
        words = tuple({w for text in found(written) for w in _WORD.findall(text)})
        if len(written) <= 64:
            if len(self.known) > 100_000:
                self.known.clear()
            self.known[key] = words
        return words

    def _plain(self, written: str) -> list[str]:
        return [decode(written, self.cost)]

    def _signed(self, written: str) -> list[str]:
        """Of the signs at an edge, the model chooses which are letters; and those beside the word's letters taken as letters."""
        lead, trail = _LEADING.match(written), _TRAILING.search(written)
        leads, trails = {0}, {0}
        if lead:
            run = lead[0]
            leads = {len(run), len(run.rstrip(run[-1]))}
        if trail:
            run = trail[0]
            trails = {len(run), len(run.lstrip(run[0]))}
        doubles = {False, _DOUBLE.search(written) is not None}
        return [decode(written, self.cost, lead=a, trail=b, double=d) for a in leads for b in trails for d in doubles]

    def _spaced(self, written: str) -> list[str]:
        """Separators end words or do not, as the model has it at each price; and all characters, or those after the first, as one word."""
        doubles = {False, _DOUBLE.search(written) is not None}
        found = [decode(written, self.cost, end=e, double=d) for e in (*_END_COSTS, None) for d in doubles]
        return found + [decode(written[1:], self.cost, double=d) for d in doubles]

    def words(self, low: str, own: set[str], signed: bool = True, spaced: bool = True) -> set[str]:
        """Intended words behind the disguised ones of a lower-case text with the words ``own``."""
        found = set()
        if spaced:
            for m in _SPACED.finditer(low):
                gaps = {len(gap) for gap in _GAP.findall(m.group())}
                parts = [m.group()] if len(gaps) == 1 else [m.group(), *_wider(m.group(), min(gaps))]
                for part in parts:
                    found.update(self._kept(" ", _GAP.sub("", part), self._spaced))
        if signed:
            for m in _SIGNED.finditer(low):
                found.update(self._kept("!", m.group(), self._signed))
        for word in own:
            if _DOUBLE.search(word):
                found.update(self._kept("", word, self._plain))
        return found


def features(words: set[str]) -> set[str]:
    """Words, and beginnings of four and five letters, marked."""
    return words | {w[:4] + "~" for w in words if len(w) > 4} | {w[:5] + "~" for w in words if len(w) > 5}


def text_features(texts: pd.Series, restorer: Restorer) -> Iterator[set[str]]:
    """The feature set of every whole text; a null text has none."""
    flags = _disguised(pa.array(texts, pa.large_string(), from_pandas=True))
    for text, signed, spaced in zip(texts, *flags, strict=True):
        if not isinstance(text, str):
            yield set()
            continue
        low = text.lower()
        words = set(_WORD.findall(low))
        yield features(words | restorer.words(low, words, signed, spaced))


class Model:
    """Restores and scores texts: character costs, feature weights, intercept."""

    def __init__(self, cost: np.ndarray, weights: dict[str, float], intercept: float) -> None:
        self.cost, self.weights, self.intercept = cost, weights, intercept

    def score(self, text: Column) -> Column:
        cost, weights, intercept = self.cost, self.weights, self.intercept
        known = frozenset(weights)

        def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            restorer = Restorer(cost)
            for texts in batches:
                sums = [intercept + sum(weights[f] for f in sorted(own & known)) for own in text_features(texts, restorer)]
                yield pd.Series(1 / (1 + np.exp(-np.clip(np.array(sums, dtype=float), -30, 30))))

        scored.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
        return F.pandas_udf(giving_back(scored), "double")(text.cast("string"))


def held_out(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def _regression(x: np.ndarray, y: np.ndarray, penalty: float = 0.3) -> tuple[np.ndarray, float]:
    """Logistic regression of 0/1 features by Newton steps; the intercept is not penalised."""
    x = np.hstack([x, np.ones((len(x), 1), dtype=x.dtype)])
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-6
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * np.maximum(p * (1 - p), 1e-4)) @ x + np.diag(ridge), x.T @ (p - y) + ridge * w)
        w -= step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-3:
            break
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """The model: character statistics of all ``docs``, and weights from labelled rows that are not held out.

    Labels that are null or not 0 or 1, and those of no document, are left out; of several labels of
    a document the largest holds. Without two classes every score is the share of toxic rows, one
    half without any label.
    """
    small_batches(docs.sparkSession)
    cost = costs(trigram_counts(docs, text_col))
    marked = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & ~held_out(id_col))
        .groupBy(F.col(id_col).alias("__id")).agg(F.max(label_col).cast("int").alias("__y"))
    )
    sample = smallest_hashes(marked, ["__id"], MAX_LABELLED)

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        restorer = Restorer(cost)
        for pdf in batches:
            yield pd.DataFrame({"y": pdf["__y"], "f": [sorted(x) for x in text_features(pdf["__t"], restorer)]})

    # The sample is at most MAX_LABELLED rows of two numbers.
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__t")).join(F.broadcast(sample), "__id")
    rows = checkpointed(rows.select("__y", "__t").mapInPandas(giving_back(listed), "y int, f array<string>"))
    n, toxic = rows.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    if not 0 < toxic < n:
        share = (toxic + 0.5) / (n + 1)
        return Model(cost, {}, float(np.log(share / (1 - share))))
    seen = rows.select("y", F.explode("f").alias("f")).groupBy("f").agg(F.sum("y").alias("t"), F.count("*").alias("c")).where(f"c >= {MIN_DOCS}")
    # How far the toxic rows that have a feature are above what its count leads to expect.
    expected = F.col("c") * (toxic / n)
    tells = (F.col("t") - expected) / F.sqrt(expected * (1 - toxic / n) + 0.5)
    best = seen.withColumn("v", tells).orderBy(F.desc("v"), "f").limit(MAX_FEATURES)
    chosen = sorted(r["f"] for r in best.collect())
    index = {f: i for i, f in enumerate(chosen)}
    kept = rows.select("y", F.array_intersect("f", F.lit(chosen)).alias("f")).collect()
    x, y = np.zeros((len(kept), len(chosen))), np.zeros(len(kept))
    for i, r in enumerate(kept):
        y[i] = r["y"]
        x[i, [index[f] for f in r["f"]]] = 1
    weights, intercept = _regression(x, y)
    return Model(cost, {f: float(w) for f, w in zip(chosen, weights, strict=True)}, intercept)


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every row of ``docs``: doc_id, held_out, score, predicted.

    A null text counts as empty and gets the score of a text without features. Rows that repeat an
    identifier are scored by their own texts; a null identifier is not held out. An empty table
    gives no rows; other columns have no part in the score.
    """
    model = fit(docs, labels, id_col, text_col)
    score = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(held_out(id_col), F.lit(False)).alias("held_out"), model.score(F.col(text_col)).alias("score"))
    return score.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below one half."""
    model = fit(docs, labels, id_col, text_col)
    return docs.withColumn("__score", model.score(F.col(text_col))).where("__score < 0.5").drop("__score")
