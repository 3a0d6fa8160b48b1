"""Main text of web pages by the maximum-scoring run of words and tags.

Tags score below zero, and words by where they stand: in what kind of block, how long that block is,
in a link or not, and, on a page that has an ``article`` or ``main`` of some words, inside or outside of it.
The scores are log odds inside the content against outside, learnt from the labelled pages: those whose
markup names the content with an ``article`` or ``main`` element, with all words of their menus, footers,
adverts and so on as words outside. Elements that are no content (menus, forms, scripts, ...) count
as one token each, the element, and give no text, unless they hold an ``article`` or ``main``, or,
on a page without these, most words of the page. Words of class, id or role that hint at
something else are tokens of their own. One scan finds the best contiguous run; its words are the text.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_MARK = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<more>(?>[^>\"']+|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|<[/a-zA-Z!?][^>]*(?:>|\Z)",
    re.S,
)
_HINT = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

# Fixed values of HTML: elements whose content is not parsed, those that end a block, those without an end.
RAW = frozenset("script style title textarea noscript iframe template svg xmp noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot"
    " th thead tr ul option caption".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# No content, by element, and by whole names of class, id or role; as parts of names they are tokens.
DROPPED = RAW | frozenset("nav footer aside form head button select menu dialog object canvas audio video map".split())
HINTS = frozenset(
    "ad ads adv advert adverts advertisement banner breadcrumb breadcrumbs comment comments cookie cookies disqus footer"
    " menu modal nav navbar navigation newsletter notice notices popup promo promotion related reply replies search share"
    " sharing sidebar social sponsor sponsored subscribe toolbar widget header masthead consent alert complementary"
    " contentinfo".split()
)


HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LENGTHS = (5, 15)  # words from which a block is of middle length, and long
SCOPE_WORDS = 25  # words from which an article or main is taken for the content
#: Words inside and outside that each place is taken to have been seen with before any page.
PLACES = {
    "inside": (50, 0), "outside": (0, 50), "linked": (1, 10), "unlinked": (10, 5), "short": (1, 5), "middle": (5, 5), "long": (20, 2),
    "p": (20, 2), "heading": (5, 2), "list": (5, 5), "other": (5, 5),
}


def _hints(name: str, more: str) -> tuple[bool, list[str]]:
    """Whether a whole name of class, id or role is a hint, and all hints that names hold as words."""
    if name in ("html", "body", "article", "main") or not more:
        return False, []
    values = [(m[1] or m[2] or m[3] or "").lower() for m in _HINT.finditer(more)]
    words = [w for v in values for w in re.split(r"[^a-z]+", v) if w in HINTS]
    return bool(words) and any(w in HINTS for v in values for w in v.split()), words


def _spans(page: str, marks: list[re.Match]) -> tuple[dict[int, int], list[int], list[int]]:
    """The end of each closed element, and running numbers of words and of articles before each mark."""
    ends: dict[int, int] = {}
    begun: dict[str, list[int]] = {}
    words, articles = [0], [0]
    at = 0
    for i, m in enumerate(marks):
        name = (m["name"] or "").lower()
        text = len(page[at : m.start()].split()) if m.start() > at else 0
        words.append(words[-1] + text)
        articles.append(articles[-1] + (m.start() >= at and not m["end"] and name in ("article", "main")))
        if m["end"]:
            if begun.get(name):
                ends[begun[name].pop()] = i
        elif name:
            begun.setdefault(name, []).append(i)
        if m.start() >= at:
            at = _raw_end(page, m.end(), name) if not m["end"] and _is_raw(m, name) else m.end()
    words.append(words[-1] + len(page[at:].split()))
    return ends, words, articles


def _is_raw(mark: re.Match, name: str) -> bool:
    """Whether what follows a start tag is not parsed; pictures may close themselves."""
    return name in RAW and not (name == "svg" and mark["more"].rstrip().endswith("/"))


def _raw_end(page: str, at: int, name: str) -> int:
    end = re.compile(rf"</{name}[\s/>]", re.I).search(page, at)
    return page.find(">", end.end() - 1) + 1 or len(page) if end else len(page)


def tokens(page: str, whole: bool = False) -> list[tuple[str, str]]:
    """(kind, value) in page order: ``text`` runs, ``tag`` names, ``hint`` words and ``skip`` for elements left out.

    With ``whole`` only elements whose content is not parsed are left out.
    """
    out: list[tuple[str, str]] = []
    at = inside = 0
    marks = list(_MARK.finditer(page))
    ends, words, articles = _spans(page, marks)
    i = 0
    while i < len(marks):
        m = marks[i]
        i += 1
        if m.start() < at:
            continue
        if m.start() > at:
            out.append(("text", page[at : m.start()]))
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        if m["end"]:
            inside -= name in ("article", "main") and inside > 0
            out.append(("tag", "/" + name))
            continue
        if _is_raw(m, name):
            at = _raw_end(page, at, name)
            out.append(("skip", name))
            continue
        hinted, hints = _hints(name, m["more"])
        if not whole and name not in VOID and not m["more"].endswith("/") and (hinted or name in DROPPED or (name == "header" and not inside)):
            # To the element's own end, elements of its name inside it counted; unclosed ones go on alone.
            j = ends.get(i - 1)
            if j is None:
                out.append(("skip", name))
                continue
            # Most words of a page are more than two thirds of them.
            holds = articles[j + 1] > articles[i] or (not articles[-1] and 3 * (words[j + 1] - words[i]) > 2 * words[-1])
            if not holds:
                i, at = j + 1, marks[j].end()
                out.append(("skip", name))
                continue
        inside += name in ("article", "main")
        out.extend(("hint", w) for w in hints)
        out.append(("tag", name))
    if at < len(page):
        out.append(("text", page[at:]))
    return out


def places(found: list[tuple[str, str]]) -> list[tuple[str, ...]]:
    """For each token the places of its words, without the side; empty for tokens that are no text."""
    out: list[tuple[str, ...]] = [()] * len(found)
    run: list[tuple[int, int, bool]] = []  # of the block at hand: token, words, in a link
    opened: list[str] = []
    links = 0

    def told() -> None:
        size = sum(n for _, n, _ in run)
        length = "short" if size < LENGTHS[0] else "middle" if size < LENGTHS[1] else "long"
        tag = next((t for t in reversed(opened)), "")
        kind = "p" if tag == "p" else "heading" if tag in HEADINGS else "list" if tag in ("li", "dd", "dt", "td", "th") else "other"
        for i, _, linked in run:
            out[i] = ("linked" if linked else "unlinked", length, kind)
        run.clear()

    for i, (kind, value) in enumerate(found):
        if kind == "text":
            run.append((i, len(value.split()), links > 0))
            continue
        name = value.lstrip("/")
        if kind != "tag" or (name not in BLOCKS and name != "a"):
            continue
        if name == "a":
            links = max(0, links + (-1 if value[0] == "/" else 1))
            continue
        told()
        if value[0] != "/":
            if opened and opened[-1] == name == "p":  # a paragraph ends where the next begins
                opened.pop()
            if name != "hr":
                opened.append(name)
        elif name in opened[-64:]:
            while opened.pop() != name:
                pass
    told()
    return out


def inside_of(found: list[tuple[str, str]]) -> list[bool]:
    """Whether each token is inside an article, or, on a page whose articles hold less than half of main's words, inside main."""
    sides, words = {}, {}
    for scope in ("article", "main"):
        depth, side = 0, []
        for kind, value in found:
            if kind == "tag" and value.lstrip("/") == scope:
                depth = max(0, depth + (-1 if value[0] == "/" else 1))
                side.append(False)
            else:
                side.append(depth > 0)
        sides[scope] = side
        words[scope] = sum(len(v.split()) for (k, v), inner in zip(found, side, strict=True) if inner and k == "text")
    return sides["article"] if 2 * words["article"] >= words["main"] else sides["main"]


def token_counts(pages: DataFrame, html_col: str = "html") -> dict[tuple[str, bool], int]:
    """How often each kind of token is inside and outside the content of the labelled pages."""
    known = BLOCKS | VOID | DROPPED | HINTS | frozenset("a b i u em strong span code small sub sup font img label q cite".split())

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        for pdf in batches:
            for page in pdf["h"]:
                found = tokens(page) if isinstance(page, str) else []
                if ("tag", "article") not in found and ("tag", "main") not in found:
                    continue
                every = tokens(page, whole=True)
                for (kind, value), place, side in zip(every, places(every), inside_of(every), strict=True):
                    if kind == "text" and (n := len(value.split())):
                        for name in ("word", *(f"word:{x}" for x in (*place, "inside" if side else "outside"))):
                            total[name, side] += n
                inside = 0
                for kind, value in found:
                    if kind == "text":
                        continue
                    own = value.lstrip("/") in ("article", "main")
                    inside += own and value[0] != "/"
                    name = f"{kind}:{value.lstrip('/')}" if value.lstrip("/") in known else f"{kind}:other"
                    total[name, inside > 0 and not own] += 1
                    inside -= own and value[0] == "/" and inside > 0
        rows = [(k, i, n) for (k, i), n in total.items()]
        yield pd.DataFrame(rows, columns=["token", "inside", "n"])

    rows = pages.select(F.col(html_col).cast("string").alias("h")).mapInPandas(counted, "token string, inside boolean, n long")
    rows = rows.groupBy("token", "inside").agg(F.sum("n").alias("n"))
    return {(r["token"], r["inside"]): r["n"] for r in rows.collect()}  # two rows for each known name at most


def scores(counts: dict[tuple[str, bool], int]) -> dict[str, float]:
    """Log odds: of words by their places, above or below zero; of other tokens, below zero."""
    seen = lambda t, side: counts.get((t, side), 0)
    total = {side: sum(n for (t, s), n in counts.items() if s == side and t[:4] != "word") for side in (True, False)}
    odds = lambda t: np.log((seen(t, True) + 0.5) / (total[True] + 1)) - np.log((seen(t, False) + 0.5) / (total[False] + 1))
    least = {"tag": -1.5, "hint": -4.0, "skip": -8.0}
    out = {t: float(np.clip(odds(t), least[t.partition(":")[0]], -0.05)) for t, _ in counts if t[:4] != "word"}
    words = {side: seen("word", side) + 100 for side in (True, False)}
    out["word"] = float(np.clip(np.log(words[True] / words[False]), 0.5, 1.5))
    for place, (inner, outer) in PLACES.items():
        gain = np.log((seen(f"word:{place}", True) + inner + 0.5) / words[True]) - np.log((seen(f"word:{place}", False) + outer + 0.5) / words[False])
        most = 6.0 if place in ("inside", "outside") else 2.5 if place in ("short", "middle", "long") else 1.5
        out[f"word:{place}"] = float(np.clip(gain, -most, most))
    return out


def _blocks(found: list[tuple[str, str]]) -> list[str]:
    out, run = [], []
    for kind, value in [*found, ("tag", "p")]:
        if kind == "text":
            run.append(value)
        elif kind == "hint":
            continue
        elif value.lstrip("/") in BLOCKS:
            text = " ".join(html.unescape("".join(run)).split())
            if text:
                out.append(text)
            run = []
        elif value == "br":
            run.append(" ")
    return out


def best_run(gains: list[float]) -> tuple[int, int]:
    """The contiguous run of the largest sum, as (begin, end); an empty one if no sum is above zero."""
    best, best_at, total, begin = 0.0, (0, 0), 0.0, 0
    for i, gain in enumerate(gains):
        total += gain
        if total <= 0:
            total, begin = 0.0, i + 1
        elif total > best:
            best, best_at = total, (begin, i + 1)
    return best_at


def token_gains(found: list[tuple[str, str]], score: dict[str, float]) -> list[float]:
    """What each token adds to a run."""
    sides = inside_of(found)
    scoped = sum(len(v.split()) for (k, v), side in zip(found, sides, strict=True) if side and k == "text") >= SCOPE_WORDS
    out, inside = [], 0
    for (kind, value), place, side in zip(found, places(found), sides, strict=True):
        if kind == "tag" and value.lstrip("/") in ("article", "main"):
            inside = max(0, inside + (-1 if value[0] == "/" else 1))
        if kind == "text":
            gain = score["word"] + sum(score.get(f"word:{x}", 0.0) for x in place)
            if scoped:  # the markup says more than any block does
                gain = max(gain, 0.5) + score.get("word:inside", 0.0) if side else min(gain, 0.0) + score.get("word:outside", score["word"])
            out.append(gain * len(value.split()))
        elif kind in ("skip", "hint") and inside:
            out.append(-0.05)  # what is left out of the content, or hints at something else in it, does not end it
        else:
            name = value.lstrip("/")
            out.append(score.get(f"{kind}:{name}", score.get(f"{kind}:other", -1.0 if kind == "tag" else -8.0)))
    return out


def main_text(page: str | None, score: dict[str, float]) -> str:
    """The words of the best run of tokens of a whole page, a line to each block."""
    found = tokens(page or "")
    return "\n".join(_blocks(found[slice(*best_run(token_gains(found, score)))]))


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """For every row of ``pages``: page_id, url, text, n_chars.

    A null or empty page has an empty text. Rows that repeat an identifier are read each for itself;
    an empty table gives no rows; other columns have no part.
    """
    score = scores(token_counts(pages, html_col))

    def texts(batch: pd.Series) -> pd.Series:
        return batch.map(lambda page: main_text(page, score), na_action=None)

    text = F.pandas_udf(texts, "string")(F.coalesce(F.col(html_col).cast("string"), F.lit("")))
    out = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), text.alias("text"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
