"""Personal data: patterns, and a skip-chain conditional random field that adds spans.

The patterns find the base spans. The field labels the tokens of a document: those with a digit or
an ``@``, and their neighbours (a token of letters alone far from both is no personal data by
definition, which cuts the chain there). Its potentials are features of a token, transitions
between neighbours, and a skip potential between equal or alike tokens anywhere in the document,
which share their evidence through loopy message passing: what is labelled in one place is labelled
the same in another. The base spans are fixed labels of the decoding. Runs of tokens that the marginals give one
label beyond ``MIN_MARGINAL`` and that touch no base span are added.

The field is fitted on a bounded sample (``MAX_SAMPLE`` documents with base spans, the smallest
hashes of doc_id) whose labels are the base spans.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import checkpointed, smallest_hashes

KINDS = ("email", "ip", "card", "phone")
LABELS = (None, *KINDS)
MAX_SAMPLE = 400
MIN_MARGINAL = 0.97
ROUNDS = 4  # of message passing
WINDOW = 2  # tokens beside one with a digit or an @

_EMAIL_END = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: Runs that hold every digit pattern whole: each of them is made of these characters only.
_ZONE = re.compile(r"[+0-9][0-9 ().+-]*")
_IP = re.compile(r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[^0-9]")
_IP_START = re.compile(r"(?<![0-9])[0-9]")

Span = tuple[int, int, int]  # start, number of the kind, end


def _luhn(digits: str) -> bool:
    doubled = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _EMAIL_END.match(text, at + 1) if start < at else None
        if m:
            yield start, 0, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def _ips(text: str, start: int, end: int) -> Iterator[Span]:
    at = start
    while m := _IP_START.search(text, at, end):
        if found := _IP.match(text, m.start(), end):
            if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in found.group().split(".")):
                yield found.start(), 1, found.end()
            at = found.end()
        else:
            at = m.end()


def base_spans(text: str) -> list[Span]:
    """Base spans by start, then kind. Every pattern takes time in proportion to the text."""
    out = list(_emails(text)) if "@" in text else []
    for zone in _ZONE.finditer(text):
        a, b = zone.span()
        if b - a < 7:
            continue
        out.extend(_ips(text, a, b))
        for m in _CARD.finditer(text, a, b):
            digits = _DIGITS.sub("", m.group())
            if 14 <= len(digits) <= 19 and _luhn(digits):
                out.append((m.start(), 2, m.end()))
        for m in _PHONE.finditer(text, a, b):
            if 10 <= len(_DIGITS.sub("", m.group())) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


_TOKEN = re.compile(r"\S+")
_CORE = " .,;:!?\"'<>[]{}"
MIN_DIGITS = 7  # of a number that is known in any layout
_NAME = r"[^\s@:;,<>()\[\]\"'=]"  # of an address, before its @
_AT = re.compile(rf"(?<={_NAME})@[\w-]+(?:\.[\w-]+)*")
_BACK = re.compile(rf"{_NAME}+")
_LABEL = re.compile(r"^[a-z]+[:=]")
_HINT = re.compile(r"[0-9@]")


def _tokens(text: str) -> list[list[tuple[int, int]]]:
    """Runs of neighbouring token spans around each token with a digit or an @."""
    runs: list[list[tuple[int, int]]] = []
    window: list[tuple[int, int]] = []  # the last tokens, not yet in a run
    left = at = 0
    while True:
        if not left:  # nothing to do before the next hint: go there
            hint = _HINT.search(text, at)
            if not hint:
                return runs
            begin = hint.start()
            while begin > at and not text[begin - 1].isspace():
                begin -= 1
            back, before = begin, []
            while len(before) < WINDOW and back > at:
                end = back
                while end > at and text[end - 1].isspace():
                    end -= 1
                back = end
                while back > at and not text[back - 1].isspace():
                    back -= 1
                if back < end:
                    before.append((back, end))
            window = before[::-1]
            if runs and window and begin and window[0][0] <= at:
                runs[-1].extend(window)
            else:
                runs.append(window)
            at, left = begin, 1
        m = _TOKEN.search(text, at)
        if not m:
            return runs
        left = WINDOW + 1 if _HINT.search(m.group()) else left
        runs[-1].append(m.span())
        left -= 1
        at = m.end()


def _form(core: str, groups: list[int]) -> str:
    """A normal form that equal tokens, and numbers and addresses in other layouts, have in common."""
    at = _AT.search(core)
    if at:
        return _BACK.match(core[: at.start()][::-1])[0][::-1] + at[0]
    bare = _LABEL.sub("", core)
    digits = "".join(c for c in bare if c.isdigit())
    # Not fractions and dotted quads, where the places of the marks tell numbers apart.
    placed = "." in bare and (len(groups) == 2 or (len(groups) == 4 and max(groups) <= 3))
    return core if len(digits) < MIN_DIGITS or placed or any(c.isalpha() for c in bare) else digits


def _features(token: str) -> tuple[list[int], str]:
    """Active features of a token, and what alike tokens have in common."""
    core = token.strip(_CORE)
    digits = sum(c.isdigit() for c in core)
    groups = [len(g) for g in re.findall(r"[0-9]+", core)]
    marks = [
        True, digits == 0, 0 < digits == len(core), digits > 0 and any(c.isalpha() for c in core), "@" in core,
        "." in core, core.count(".") == 3, core.startswith("+"), core.startswith("(") or core.endswith(")"), "-" in core,
        "=" in core or "_" in core, len(core) > 20, digits >= 14, 10 <= digits < 14, 5 <= digits < 10, digits in (1, 2),
        digits in (3, 4), len(groups) == 4 and max(groups) <= 3, len(groups) == 2 and groups == [3, 4], core[:1].isupper(),
    ]
    return [i for i, m in enumerate(marks) if m], _form(core.lower(), groups)


N_FEATURES = 20


def _labels(runs: list[list[tuple[int, int]]], spans: list[Span]) -> list[np.ndarray]:
    """The label of each token: that of the base span that covers its first letter or digit, or most of it."""
    out, k = [], 0
    for run in runs:
        own = np.zeros(len(run), dtype=np.int64)
        for i, (a, b) in enumerate(run):
            while k and spans[k - 1][2] > a:
                k -= 1
            while k < len(spans) and spans[k][2] <= a:
                k += 1
            j = k
            while j < len(spans) and spans[j][0] < b:
                if min(b, spans[j][2]) - max(a, spans[j][0]) > (b - a) // 2:
                    own[i] = spans[j][1] + 1
                j += 1
        out.append(own)
    return out


def _scores(run: list[list[int]], nodes: np.ndarray) -> np.ndarray:
    return np.array([nodes[f].sum(axis=0) for f in run])


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)


def _chain(score: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward log messages of a chain."""
    forward, backward = np.zeros_like(score), np.zeros_like(score)
    for i in range(1, len(score)):
        forward[i] = _log_sum((forward[i - 1] + score[i - 1])[:, None] + steps, 0)
    for i in range(len(score) - 2, -1, -1):
        backward[i] = _log_sum(steps + (backward[i + 1] + score[i + 1])[None], 1)
    return forward, backward


class Field:
    """Weights of the field: features by label, transitions, and the skip potential."""

    def __init__(self, nodes: np.ndarray, steps: np.ndarray, skip: float) -> None:
        self.nodes, self.steps, self.skip = nodes, steps, skip

    def marginals(self, runs: list[list[list[int]]], alike: list[str], fixed: np.ndarray) -> np.ndarray:
        """Label marginals of all tokens of a document; ``fixed`` labels above 0 are evidence.

        Chains are solved exactly in each round. Tokens that are alike are joined through one hub
        that adds up the messages of its group and gives back to each what the others say, so a
        group of n tokens costs n messages, not n * n.
        """
        at = np.cumsum([0, *map(len, runs)])
        score = np.concatenate([_scores(r, self.nodes) for r in runs])
        evidence = np.zeros_like(score)
        evidence[fixed > 0] = -50.0
        evidence[fixed > 0, fixed[fixed > 0]] = 0.0
        score = score + evidence
        numbers: dict[str, int] = {}
        groups = np.array([numbers.setdefault(form, len(numbers)) for form in alike])
        skips = np.zeros_like(score)
        shared = np.bincount(groups)[groups] > 1
        for _ in range(ROUNDS if shared.any() else 1):
            belief = np.empty_like(score)
            for a, b in zip(at, at[1:], strict=False):
                own = score[a:b] + skips[a:b]
                forward, backward = _chain(own, self.steps)
                belief[a:b] = own + forward + backward
            if not shared.any():
                break
            # What a token says to those alike: its belief without what they said, through the skip potential.
            cavity = belief - skips
            p = np.exp(cavity - _log_sum(cavity, 1)[:, None])
            message = np.log1p(p * np.expm1(self.skip))
            total = np.zeros((groups.max() + 1, score.shape[1]))
            np.add.at(total, groups, message)
            skips = np.where(shared[:, None], np.clip(total[groups] - message, 0, 20), 0.0)
        return np.exp(belief - _log_sum(belief, 1)[:, None])


def fit_field(texts: list[str]) -> Field:
    """Feature and transition weights by the chains' likelihood, the skip potential from alike tokens' agreement."""
    data, together, apart = [], 1.0, 1.0
    for text in texts:
        runs = _tokens(text)
        labels = _labels(runs, base_spans(text))
        seen: dict[str, int] = {}
        for run, own in zip(runs, labels, strict=True):
            found = [_features(text[a:b]) for a, b in run]
            data.append(([f for f, _ in found], own))
            for (_, core), label in zip(found, own, strict=True):
                if core in seen and (label or seen[core]):
                    together, apart = together + (seen[core] == label), apart + (seen[core] != label)
                seen[core] = int(label)
    n = len(LABELS)
    nodes, steps = np.zeros((N_FEATURES, n)), np.zeros((n, n))
    pace_n, pace_s = np.full_like(nodes, 1e-6), np.full_like(steps, 1e-6)
    for _ in range(12):
        for a in range(0, len(data), 50):
            grad_n, grad_s = -0.02 * nodes, -0.02 * steps
            for run, own in data[a : a + 50]:
                if not run:
                    continue
                score = _scores(run, nodes)
                forward, backward = _chain(score, steps)
                belief = score + forward + backward
                p = np.exp(belief - _log_sum(belief, 1)[:, None])
                for i, f in enumerate(run):
                    grad_n[f] -= p[i]
                    grad_n[f, own[i]] += 1
                for i in range(len(run) - 1):
                    pair = (forward[i] + score[i])[:, None] + steps + (score[i + 1] + backward[i + 1])[None]
                    pair = np.exp(pair - pair.max())
                    grad_s -= pair / pair.sum()
                    grad_s[own[i], own[i + 1]] += 1
            pace_n, pace_s = pace_n + grad_n**2, pace_s + grad_s**2
            nodes, steps = nodes + 0.5 * grad_n / np.sqrt(pace_n), steps + 0.5 * grad_s / np.sqrt(pace_s)
    return Field(nodes, steps, float(np.log(together / apart)) if together > apart else 0.0)


def all_spans(text: str, base: list[Span], field: Field) -> list[Span]:
    """The base spans and those that the field adds."""
    if not _HINT.search(text):
        return base
    runs = _tokens(text)
    flat = [s for run in runs for s in run]
    if not flat:
        return base
    found = [_features(text[a:b]) for a, b in flat]
    at = np.cumsum([0, *map(len, runs)])
    features = [[f for f, _ in found[a:b]] for a, b in zip(at, at[1:], strict=False) if b > a]
    fixed = np.concatenate([x for x in _labels(runs, base)])
    p = field.marginals(features, [c for _, c in found], fixed)
    label = np.where(p.max(1) >= MIN_MARGINAL, p.argmax(1), 0)
    label[[not _HINT.search(text[a:b]) for a, b in flat]] = 0
    ends = set(np.cumsum([len(r) for r in runs]))
    out, i = list(base), 0
    starts = np.array([s for s, _, _ in base], dtype=np.int64)
    stops = np.maximum.accumulate(np.array([e for _, _, e in base], dtype=np.int64)) if base else starts
    while i < len(flat):
        if not label[i]:
            i += 1
            continue
        j = i + 1
        while j < len(flat) and label[j] == label[i] and j not in ends:
            j += 1
        a, b = flat[i][0], flat[j - 1][1]
        word = text[a:b]
        a, b = a + len(word) - len(word.lstrip(_CORE)), b - len(word) + len(word.rstrip(_CORE))
        k = int(np.searchsorted(starts, b, "left"))
        if a < b and not (k and stops[k - 1] > a):
            out.append((a, int(label[i]) - 1, b))
        i = j
    return sorted(out)


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def sample_texts(docs: DataFrame, id_col: str, text_col: str, size: int = MAX_SAMPLE) -> list[str]:
    """Texts with base spans, those with the smallest hashes of the rows: a bounded sample for fitting.

    Of large tables a bounded number of rows is looked at, a hundred for each text wanted; texts
    of more than 20,000 characters are left out of the sample, though not of the decoding.
    """

    def having(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: bool(base_spans(t)))

    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).cast("string").alias("t"))
    some = smallest_hashes(rows.select("i"), ["i"], 100 * size).distinct()
    likely = rows.join(F.broadcast(some), "i").where(F.length("t") <= 20_000).where("t rlike '[0-9]{2}|@'")
    likely = likely.where(F.pandas_udf(having, "boolean")("t")).orderBy(F.xxhash64("i"), "i", "t").limit(size)
    return [r["t"] for r in checkpointed(likely).collect()]


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", replace: bool = False) -> DataFrame:
    """For every row of ``docs``: doc_id, spans (kind, start, end, base) in whole texts, sorted by start and kind.

    Positions count code points, ends are exclusive. A null text is empty and has no spans. Rows
    that repeat an identifier are read each for itself; an empty table gives no rows; other columns
    have no part. With ``replace`` a column ``clean`` holds the text with every span as ``[KIND]``.
    """
    field = fit_field(sample_texts(docs, id_col, text_col))
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, clean = [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                base = base_spans(text)
                found = all_spans(text, base, field)
                own = set(base)
                out.append([{"kind": KINDS[k], "start": a, "end": b, "base": (a, k, b) in own} for a, k, b in found])
                if replace:
                    parts, at = [], 0
                    for a, k, b in found:
                        if a >= at:
                            parts += [text[at:a], f"[{KINDS[k].upper()}]"]
                        at = max(at, b)
                    clean.append("".join(parts) + text[at:])
            columns = [batch.column(0), pa.array(out, pa.list_(kind))] + ([pa.array(clean, pa.string())] if replace else [])
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "spans", "clean"][: len(columns)])

    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {id_type}, spans array<struct<kind:string,start:bigint,end:bigint,base:boolean>>" + (", clean string" if replace else "")
    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(rows, schema)


def personal_data_digest(found: DataFrame) -> DataFrame:
    """doc_id, the numbers of base spans by kind, their SHA-256, and all spans as text."""
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, KINDS), F.sha2(text(base).cast("binary"), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))
