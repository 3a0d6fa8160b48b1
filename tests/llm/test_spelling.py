import random
import zlib
from collections import Counter

import numpy as np
import pytest

from feedloom.llm import spelling
from feedloom.llm.spelling import blocked, near_words, roots, shared, spelling_variants, word_counts


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute_near(words: dict[str, int]) -> dict[str, list[str]]:
    return {w: [v for v in words if one_edit(w, v)] for w in words}


def make_words(seed: int, letters: str = "abé") -> dict[str, int]:
    rng = random.Random(seed)
    out: dict[str, int] = {}
    while len(out) < 250:
        w = "".join(rng.choice(letters) for _ in range(rng.randrange(7, 12)))
        out[w] = rng.choice([2, 3, 30, 31, 400])
    out |= {"x" * 40: 2, "x" * 41: 50, "x" * 20 + "y" + "x" * 19: 3, "ÿ" * 7: 2, "aaaaaaa": 5}
    return out


@pytest.mark.parametrize("seed, letters, tile", [(1, "abé", 1024), (2, "ab", 4), (3, "abcdÿ", 16)])
def test_near_words_against_all_pairs(spark, monkeypatch, seed, letters, tile):
    monkeypatch.setattr(spelling, "TILE", tile)
    monkeypatch.setattr(spelling, "CELLS", 64)
    words = make_words(seed, letters)
    got = {r["word"]: (r["n_near"], r["near"], r["near_n"]) for r in near_words(spark.createDataFrame(list(words.items()), "word string, n long")).collect()}
    want = {}
    for w, near in brute_near(words).items():
        if near:
            best = min(near, key=lambda v: (-words[v], v))
            want[w] = (len(near), best, words[best])
    assert got == want


def test_shared_lengths():
    left = np.frombuffer(b"abcdabddxbcd", np.uint8).reshape(3, 4)
    prefix, suffix = shared(left, left, np.array([[0]]), np.array([[0, 1, 2]]))
    assert prefix.tolist() == [[[4, 2, 0]]] and suffix.tolist() == [[[4, 1, 3]]]


def test_every_pair_meets_in_a_block(spark):
    words = {w: 2 for w in list(make_words(4))[:80]}
    rows = blocked(spark.createDataFrame(list(words.items()), "word string, n long")).collect()
    blocks = {}
    for r in rows:
        blocks.setdefault(r["block"], set()).add(r["word"])
    met = {(a, b) for ws in blocks.values() for a in ws for b in ws if a < b}
    assert {(a, b) for a in words for b in words if a < b and one_edit(a, b)} <= met


def test_counts_follow_the_rule(documents, rows):
    texts = [(i, "Überall hausbau Häuserbau ×××××××÷ short HAUSBAU1hausbauten abcdefg" * (1 + i % 2), "s") for i in range(60)] + [(99, None, "s")]
    want = Counter()
    for i, t, _ in texts:
        run = ""
        for c in (t or "") + " ":
            if c.isascii() and c.isalpha() or 0xC0 <= ord(c) <= 0xFF:
                run += c.lower() if c.isascii() else c
                continue
            if run:
                h = zlib.crc32(f"{i}:{run}".encode())
                want[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
            run = ""
    assert dict(rows(word_counts(documents(texts)))) == {w: n for w, n in want.items() if len(w) >= 7 and n >= 2}


def test_roots(spark, rows):
    forms = [(f"w{i}", f"w{i + 1}") for i in range(13)] + [("v", "w5")]
    got = dict(rows(roots(spark.createDataFrame(forms, "word string, form string"))))
    assert got == {w: "w13" for w, _ in forms}
    assert roots(spark.createDataFrame([], "word string, form string")).count() == 0


def test_chains_and_odd_rows(documents, odd, clashing):
    texts = [(1000 + i, t, "s") for i, t in enumerate(["wordform"] * 2 + ["wordforms"] * 25 + ["wordformss"] * 600)]
    got = {r["word"]: r for r in spelling_variants(documents(texts)).collect()}
    if got["wordform"]["n"] * 10 <= got["wordforms"]["n"]:
        assert got["wordform"]["form"] == "wordforms" and got["wordform"]["root"] == "wordformss"
    assert got["wordforms"]["root"] == got["wordforms"]["form"] == "wordformss"
    assert got["wordformss"]["form"] is None and got["wordformss"]["root"] == "wordformss" and got["wordformss"]["form_n"] is None
    assert spelling_variants(clashing(odd)).columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert spelling_variants(odd.limit(0)).count() == 0


def test_long_words(documents):
    long = "ab" * 20_000
    got = {len(r["word"]): r for r in spelling_variants(documents([(i, f"{long} {long}x", "s") for i in range(8)])).collect()}
    assert got[40_000]["n_near"] >= 1 and got[40_001]["n_near"] >= 1
