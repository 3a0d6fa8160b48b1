import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from feedloom.llm import common, jaccard
from feedloom.llm.common import components
from feedloom.llm.jaccard import drop_similar, prefix_size, similar_documents, trie_links
from feedloom.llm.words import shingle_sets

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)} if words else set()


def brute(rows, k, percent):
    sets = [grams(t, k) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                up[find(a)] = find(b)
    least = defaultdict(list)
    for i in range(len(rows)):
        least[find(i)].append(rows[i][0])
    return sorted(((rows[i][0], len(sets[i]), min((x for x in least[find(i)] if x is not None), default=None)) for i in range(len(rows))), key=str)


def family(seed):
    """Copies, near copies of a few texts, chains, and texts that share a passage."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    shared = [word() for _ in range(40)]
    rows = []
    for base in range(6):
        text = [word() for _ in range(rng.choice([3, 12, 60, 150]))]
        for _ in range(rng.choice([2, 9, 25])):
            own = list(text)
            for _ in range(rng.randrange(4)):
                own[rng.randrange(len(own))] = word()
            rows.append(" ".join(own + (shared if rng.random() < 0.3 else [])))
            text = own if base % 2 else text
    rows += [" ".join([word() for _ in range(rng.randrange(30))] + shared) for _ in range(20)]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed, k, percent", [(1, 3, 90), (2, 5, 80), (3, 1, 50)])
def test_components_against_brute_force(documents, seed, k, percent, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    monkeypatch.setattr(jaccard, "DENSE", 4)
    monkeypatch.setattr(jaccard, "MAX_FAMILY", (64, 12, 2)[seed - 1])
    rows = family(seed)
    got = similar_documents(documents([(i, t, "s") for i, t in rows]), k=k, percent=percent)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, k, percent)


@pytest.mark.parametrize("percent, most, block", [(90, 9, 16), (80, 16, 1000)])
def test_variants_of_one_text_against_brute_force(documents, monkeypatch, percent, most, block):
    monkeypatch.setattr(jaccard, "DENSE", 3)
    monkeypatch.setattr(jaccard, "MAX_FAMILY", block)
    rng = random.Random(percent)
    word = lambda: f"w{rng.randrange(40)}"
    text, rows = [word() for _ in range(120)], []
    for i in range(150):
        own = list(text)
        for _ in range(rng.randrange(most)):
            at = rng.randrange(len(own))
            own[at : at + rng.randrange(2)] = [word()] * rng.randrange(1, 3)
        rows.append((i, " ".join(own)))
    want = brute(rows, 3, percent)
    assert 3 < len({c for *_, c in want}) < 140
    got = similar_documents(documents([(i, t, "s") for i, t in rows]), k=3, percent=percent)
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_texts_that_share_a_line_are_not_compared_with_each_other(documents, monkeypatch):
    handed, links = [], jaccard.verified_links

    def counted(groups, sets, percent):
        handed.append(groups.count())
        return links(groups, sets, percent)

    monkeypatch.setattr(jaccard, "verified_links", counted)
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    rng = random.Random(4)
    line = " ".join(f"line{i}" for i in range(12))
    rows = [(i, line + " " + " ".join(f"w{rng.randrange(50000)}" for _ in range(18))) for i in range(400)]
    got = similar_documents(documents([(i, t, "s") for i, t in rows]), k=3, percent=90)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(((i, 28, i) for i, _ in rows), key=str)
    assert sum(handed) < 4 * len(rows)


def test_parities_differ_in_no_more_bits_than_sets():
    rng = np.random.default_rng(8)
    for n, m, common in [(1, 1, 0), (10, 11, 9), (60, 70, 55), (500, 520, 480), (5000, 4000, 3900)]:
        grams = rng.integers(0, 1 << 63, n + m - common).astype(np.uint64)
        a, b = (np.frombuffer(jaccard._parities(x), np.uint64) for x in (grams[:n], grams[n - common :]))
        width = min(len(a), len(b))
        apart = int(np.bitwise_count(jaccard._folded(a, width) ^ jaccard._folded(b, width)).sum())
        assert (n + m - 2 * common) // 2 <= apart <= n + m - 2 * common


def test_odd_rows(odd, clashing):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = similar_documents(clashing(odd), k=3, percent=90)
    assert sorted(map(tuple, got.collect()), key=str) == [
        (i, n, i if n == 0 else c) for i, n, c in brute(rows, 3, 90)
    ]
    assert similar_documents(odd.limit(0)).count() == 0
    assert drop_similar(clashing(odd)).columns == clashing(odd).columns


def test_shingles_are_those_of_the_words():
    texts = ["A b\tc  d", "a B c", "a b", "", None, "é É \x0b x y z é É x", "\x1c q"]
    for k in (1, 2, 3):
        got = [len(s) for s in shingle_sets(pa.array(texts), k)]
        assert got == [len(grams(t, k)) for t in texts]
    first, second = list(shingle_sets(pa.array(["A b c d", "a b c"]), 3))
    assert set(second) < set(first)


def test_the_trie_finds_what_sets_say():
    rng = np.random.default_rng(3)
    sets = []
    for i in range(60):
        own = rng.choice(400, rng.integers(1, 60), replace=False) if i % 3 else rng.permutation(np.arange(30 + i % 4))[: 28 + i % 3]
        sets.append((bytes([i]) * 16, bytes([i]) * 16, np.unique(own.astype(np.uint64))))
    for percent in (50, 80, 90):
        links = {(a, b) for q in sets for a, b in trie_links(sets, [q], percent)}
        want = {
            (a, b) for a, _, x in sets for b, _, y in sets
            if a != b and 100 * len(np.intersect1d(x, y)) >= percent * len(np.union1d(x, y))
        }
        assert links == want


def test_prefixes_hold_what_similar_sets_share():
    for n in range(1, 200):
        for percent in (50, 80, 90, 100):
            assert prefix_size(n, percent) == n - -(-n * percent // 100) + 1 >= 1


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (4, 5), (9, 8), (7, 9), (20, 21)] + [(100 + i, 101 + i) for i in range(40)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 6)}, 7: 7, 8: 7, 9: 7, 20: 20, 21: 20, **{100 + i: 100 for i in range(41)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_few_links_take_few_jobs(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(400)], "a long, b long")
    spark.sparkContext.setJobGroup("few links", "components of a chain")
    try:
        got = {tuple(r) for r in components(chain).collect()}
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert got == {(i, 0) for i in range(401)}
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("few links")) < 20


@pytest.mark.parametrize("forest", [16, 1 << 17])
def test_trees_of_tasks_are_joined(spark, monkeypatch, forest):
    monkeypatch.setattr(common, "FOREST", forest)
    rng = random.Random(3)
    pairs = [(f"n{rng.randrange(120):03}".encode(), f"n{rng.randrange(120):03}".encode()) for _ in range(90)]
    up = {x: x for pair in pairs for x in pair}
    for _ in up:
        for a, b in pairs:
            up[a] = up[b] = min(up[a], up[b])
    alone = {a for a, b in pairs if a == b} - {x for a, b in pairs if a != b for x in (a, b)}
    links = spark.createDataFrame([*pairs, (None, b"n000"), (b"n001", None)], "a binary, b binary").repartition(5)
    got = [(bytes(r["node"]), bytes(r["root"])) for r in components(links).collect()]
    assert len(got) == len(set(got))
    assert dict(got) == {x: root for x, root in up.items() if x not in alone}


def test_rows_are_dropped_by_their_own_texts(documents):
    x, y, z, q = (" ".join(f"{c}{i}" for i in range(40)) for c in "xyzq")
    rows = [(3, x, "a"), (5, x, "b"), (5, y, "c"), (None, z, "d"), (None, z, "e"), (7, q, "f"), (7, q, "g"), (7, q + " more", "h"), (None, q, "i"), (8, "", "j"), (8, "", "k")]
    got = [(r["doc_id"], r["text"]) for r in drop_similar(documents(rows)).collect()]
    assert sorted(got[i] for i in range(len(got)) if got[i][0] in (3, 5, 8)) == sorted([(3, x), (5, y), (8, ""), (8, "")])
    assert [t for i, t in got if i is None] == [z]
    assert len([t for i, t in got if i == 7]) == 1


def test_a_null_identifier_among_unique_ones_goes(documents):
    x = " ".join(f"x{i}" for i in range(40))
    assert [r["doc_id"] for r in drop_similar(documents([(None, x, "a"), (4, x, "b"), (9, x, "c")])).collect()] == [4]
