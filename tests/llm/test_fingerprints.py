import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedloom.llm import fingerprints as fp

RANK = fp.rank_of(np.random.default_rng(3).integers(0, 1000, fp.CLASSES))


def prose(rng, words):
    return " ".join("".join(rng.choice("abcdeéfghimnorst") for _ in range(rng.randrange(2, 10))) for _ in range(words))


def brute_features(text: bytes) -> list[bytes]:
    """The chosen windows of one text, window by window."""
    n = max(1, len(text) - fp.WINDOW + 1) if text else 0
    windows = [text[i : i + fp.WINDOW].ljust(fp.WINDOW, b"\0") for i in range(n)]
    hashes = fp.window_hashes(np.frombuffer(b"".join(windows) + bytes(1), np.uint8), fp.WINDOW)[:: fp.WINDOW] if n else []
    order = [(int(RANK[sum(int(fp._WEIGHT[c]) for c in Counter(w).values())]), int(h) >> 43, i) for i, (w, h) in enumerate(zip(windows, hashes, strict=True))]
    votes = Counter(min(order[i : i + fp.RUN])[2] for i in range(n))
    chosen = [windows[i] for i in sorted(votes) if votes[i] >= min(fp.VOTES, -(-n // fp.VOTES))]
    return list(dict.fromkeys(chosen))


def test_features_against_brute_force():
    rng = random.Random(1)
    texts = [b"", b"a", b"abc" * 5, b"x" * 300, *[prose(rng, rng.randrange(1, 200)).encode() for _ in range(12)]]
    text, hashes = fp.features(texts, RANK)
    for k, t in enumerate(texts):
        want = brute_features(t)
        data = np.frombuffer(b"".join(want) + bytes(1), np.uint8)
        assert hashes[text == k].tolist() == (fp.window_hashes(data, fp.WINDOW)[:: fp.WINDOW].tolist() if want else [])


def test_entropy_of_every_window():
    data = np.random.default_rng(1).integers(0, 5, 500).astype(np.uint8)
    want = [sum(int(fp._WEIGHT[c]) for c in Counter(data[i : i + fp.WINDOW].tolist()).values()) for i in range(len(data) - fp.WINDOW + 1)]
    assert fp.entropy_classes(data).tolist() == want


def test_a_text_alone_and_among_others_is_the_same():
    rng = random.Random(2)
    texts = [prose(rng, rng.randrange(0, 900)).encode() for _ in range(20)]
    together = [fp.shown(p) for p in fp.prints(texts, RANK)]
    assert together == [fp.shown(fp.prints([t], RANK)[0]) for t in texts]


def test_likeness():
    rng = random.Random(4)
    for words in (12, 60, 400, 5000):
        text, other = prose(rng, words), prose(rng, words)
        cut = len(text) // 3
        same, edited, strange = (fp.prints([t.encode()], RANK)[0] for t in (text, text[:-cut] + other[:cut], other))
        assert fp.likeness(same, same) == pytest.approx(1)
        assert 0.4 < fp.likeness(same, edited) < 0.95
        assert fp.likeness(same, strange) < 0.25
        assert fp.likeness(same, edited) == pytest.approx(fp.likeness(edited, same), abs=0.05)
    empty = fp.prints([b""], RANK)[0]
    assert fp.likeness(empty, empty) == 1 and fp.likeness(empty, same) == 0


def test_a_fingerprint_as_text_is_read_back():
    chain = fp.prints([prose(random.Random(5), 800).encode()], RANK)[0]
    read = fp.parsed(fp.shown(chain))
    assert (read.bits == chain[0].bits).all() and read.counts.tolist() == chain[0].counts.tolist()
    assert len(fp.parsed("").bits) == 0 and len(fp.parsed(fp.shown(chain), short=True).bits) == 0


def expected(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for (i, t, *_), (_, after, *_) in zip(order, order[1:] + order[:1], strict=True):
        t, after = t or "", after or ""
        cut = len(t) // 3
        out.append((i, len(t), hashlib.sha256((t[: len(t) - cut] + after[:cut]).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("part", [1 << 25, 4000, 500])
def test_every_row_meets_the_next(documents, monkeypatch, part):
    monkeypatch.setattr(fp, "PART_BYTES", part)
    monkeypatch.setattr(fp, "CHUNK_BYTES", 3000)
    rng = random.Random(6)
    rows = [(i * 7 - 90, prose(rng, rng.randrange(0, 120)) + "🙂é" * (i % 3), "s") for i in range(80)] + [(3, None, "s"), (None, "no id", "t")]
    got = fp.fingerprints(documents(rows, 5)).collect()
    assert sorted([tuple(r)[:3] for r in got], key=str) == expected(rows)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)


def test_equal_texts_have_equal_fingerprints(documents):
    rng = random.Random(7)
    texts = [prose(rng, 300) for _ in range(5)]
    got = fp.fingerprints(documents([(i, texts[i % 5], "s") for i in range(30)]))
    assert got.select("fingerprint").distinct().count() == 5
    assert got.agg(F.min("near_edited")).first()[0] > 0.4 and got.agg(F.max("near_next")).first()[0] < 0.3


def test_odd_rows(odd, clashing):
    got = fp.fingerprints(clashing(odd))
    assert got.count() == odd.count()
    assert [tuple(r) for r in got.where("n_chars = 0").select("fingerprint").distinct().collect()] == [("",)]
    assert got.where("fingerprint is null or near_edited is null or near_next is null").isEmpty()
    assert fp.fingerprints(odd.limit(0)).count() == 0
    one = fp.fingerprints(odd.where("doc_id = 7")).first()
    assert one["n_chars"] == 3 and one["near_next"] == 1.0 and one["edited_sha256"] == hashlib.sha256(b"ono").hexdigest()
