import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from feedloom.llm import merkle
from feedloom.llm.merkle import Appender, document_manifest, folded, grown, height_of, manifest


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def levels(leaves: list[str]) -> list[list[str]]:
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def siblings(tree: list[list[str]], at: int) -> list[tuple[int, list[str]]]:
    out = []
    for level in tree[:-1]:
        run = level[at // 8 * 8 : at // 8 * 8 + 8]
        out.append((at % 8, run[: at % 8] + run[at % 8 + 1 :]))
        at //= 8
    return out


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 57, 64, 65, 513, 600])
def test_appends_grow_the_whole_tree(n):
    leaves = [sha(str(i)) for i in range(n)]
    tree, want = grown(leaves, height_of(n)), levels(leaves)
    assert tree.root == want[-1][0]
    for i in range(n):
        assert tree.steps[i] == siblings(want, i)
        assert folded(leaves[i], tree.steps[i])[-1] == tree.root


def test_witnesses_are_extended_by_later_siblings():
    tree = Appender(2)
    leaves = [sha(str(i)) for i in range(11)]
    tree.append(leaves[0])
    assert tree.steps[0] == [(0, [])]
    tree.append(leaves[1])
    assert tree.steps[0] == [(0, [leaves[1]])] and tree.steps[1] == [(1, [leaves[0]])]
    for leaf in leaves[2:8]:
        tree.append(leaf)
    assert tree.steps[0] == [(0, leaves[1:8]), (0, [])] and tree.root is None
    for leaf in leaves[8:]:
        tree.append(leaf)
    tree.finish()
    assert tree.steps[0][1] == (0, [sha("".join(leaves[8:]))])


def brute(rows):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda i, t, lang, s, n: sha("".join(map(field, (i, s, lang, n, t))))
    groups: dict = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees[g] = levels([leaf(*r) for r in groups[g]])
    top = levels([trees[g][-1][0] for g in order])
    out = []
    for k, g in enumerate(order):
        for at, r in enumerate(groups[g]):
            steps = siblings(trees[g], at) + siblings(top, k)
            own = leaf(*r)
            hit = r[0] is not None and r[1] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            end = folded(leaf(r[0], r[1].encode().lower().decode(), *r[2:]) if hit else own, steps)[-1]
            out.append((r[0], own, trees[g][-1][0], top[-1][0], sha("".join(d for _, o in steps for d in o)), end, end == top[-1][0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("height", [1, 2, 4])
def test_manifest_against_brute_force(spark, monkeypatch, height):
    monkeypatch.setattr(merkle, "HEIGHT", height)
    langs = ["en", "en", "de", None, "", "ü", "z1", "z2", "z3", "z4", "z5"]
    rows = [(i * 3 - 100, None if i % 9 == 0 else f"Text ÄB {i}", langs[i % 11 if i % 2 else 0], None if i % 7 == 0 else "S", i) for i in range(400)]
    rows.append((5, "Alone", "zz", "s", None))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(6)
    assert sorted([tuple(r) for r in document_manifest(docs).collect()], key=str) == brute(rows)


def test_odd_rows(odd, clashing):
    want = brute([tuple(r) for r in odd.select("doc_id", "text", "lang", "source", "n_chars").collect()])
    assert sorted([tuple(r) for r in document_manifest(clashing(odd)).collect()], key=str) == want
    assert document_manifest(odd.limit(0)).count() == 0


def test_any_rows_and_their_proofs(spark):
    rows = spark.range(100).select("id", (F.col("id") % 3).alias("part"), F.sha2(F.col("id").cast("string"), 256).alias("leaf"))
    got = manifest(rows, "part", ["id"], "leaf").collect()
    assert all(r["verified"] for r in got)
    for r in got:
        assert sha("".join(r["proof"])) == r["proof_sha256"]
        assert 6 <= len(r["proof"]) <= 13
    assert {r["part"]: r["subroot"] for r in got} == {p: levels([sha(str(i)) for i in range(p, 100, 3)])[-1][0] for p in range(3)}
