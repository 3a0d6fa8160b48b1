import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedloom.llm.common import running
from feedloom.llm import mixing
from feedloom.llm.mixing import Source, mix_counts, mixed_documents, permuted, sized, slots, source_plan, with_targets
from feedloom.llm.packing import bin_patterns, default_tokenizer, fullest, pack


def corpus(seed, n=120):
    rng = random.Random(seed)
    return [(i, " ".join(f"v{rng.randrange(99)}" for _ in range(rng.choice([0, 1, 5, 40, 900]))), rng.choice(["a", "a", "b", "c", None])) for i in range(n)]


def targets(sizes, weights, cap=3.0):
    """Shares by weight, none above ``cap`` times its own size, the excess shared anew."""
    sizes, weights = np.asarray(sizes, dtype=float), np.asarray(weights, dtype=float)
    out, free, left = np.zeros(len(sizes)), np.ones(len(sizes), dtype=bool), float(sizes.sum())
    while free.any():
        share = left * weights[free] / weights[free].sum()
        over = share > cap * sizes[free]
        if not over.any():
            out[free] = share
            break
        at = np.flatnonzero(free)[over]
        out[at] = cap * sizes[at]
        free[at] = False
        left = float(sizes.sum()) - out[~free].sum()
    return out


def test_targets_reshare_what_is_above_the_cap(spark):
    assert targets([100, 100, 100], [5, 2, 1]) == pytest.approx([187.5, 75, 37.5])
    rng = random.Random(9)
    for sizes in ([100, 100, 100], [10, 1000, 1000], [0, 0], [0, 7], [int(rng.lognormvariate(4, 3)) for _ in range(400)], [2**k for k in range(40)]):
        weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
        table = spark.createDataFrame([(i, n, w) for i, (n, w) in enumerate(zip(sizes, weights, strict=True))], "i int, size long, weight int")
        got = [r["target"] for r in with_targets(table, 3).orderBy("i").collect()]
        assert got == list(targets(sizes, weights))


@pytest.mark.parametrize("size", [1, 2, 3, 17, 64, 1000])
def test_permutations(size):
    got = permuted(np.arange(size), size, 9)
    assert sorted(got) == list(range(size))
    assert list(permuted(got, size, 9, back=True)) == list(range(size))


@pytest.mark.parametrize("seed", [1, 2])
def test_taken_words(documents, seed):
    rows = corpus(seed)
    got = mix_counts(documents(rows)).collect()
    sizes = {i: len((t or "").split()) for i, t, _ in rows}
    source = {i: s for i, _, s in rows}
    assert {r["doc_id"]: r["size"] for r in got} == sizes
    for name in set(source.values()):
        own = [r for r in got if source[r["doc_id"]] == name]
        assert {r["source_size"] for r in own} == {sum(sizes[r["doc_id"]] for r in own)}
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 1
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    again = mix_counts(documents(rows, 8)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


@pytest.mark.parametrize("parts", [(4096, 8192, 4096), (2, 3, 5)], ids=["whole", "cut"])
def test_slots_fill_shards(documents, monkeypatch, parts):
    for name, value in zip(("RANGE", "CHUNK", "UNITS"), parts, strict=True):
        monkeypatch.setattr(mixing, name, value)
    plan = source_plan(sized(documents(corpus(3)), "doc_id", "text", "source"), block=64)
    found = slots(plan, shard_slots=16).cache()
    sources = {r["source_no"]: r for r in plan.collect()}
    assert found.count() == sum(r["slots"] for r in sources.values())
    sizes = [r["count"] for r in found.groupBy("shard").count().orderBy("shard").collect()]
    assert set(sizes[:-1]) == {16}
    # Every slot of each source is dealt once: its words are its target.
    for r in found.groupBy("source_no").agg(F.sum("words").alias("words"), F.count("*").alias("n"), F.countDistinct("pass", "block").alias("d")).collect():
        own = sources[r["source_no"]]
        assert r["words"] == round(own["target"]) and r["n"] == r["d"] == own["slots"]


def test_draws_follow_the_targets(spark):
    plan = spark.createDataFrame([(i, (i % 7 + 1) * 40) for i in range(50)], "source_no long, slots long")
    total = plan.agg(F.sum("slots")).first()[0]
    got = mixing._drawn(plan, total, 64, 3)
    assert got.groupBy("shard").agg(F.sum("count").alias("n")).where("n = 64").count() == total // 64
    counts = {r["source_no"]: r["n"] for r in got.groupBy("source_no").agg(F.sum("count").alias("n")).collect()}
    assert all(abs(counts[i] - (i % 7 + 1) * 40) < 5 * np.sqrt((i % 7 + 1) * 40) for i in range(50))


def test_many_sources(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE", 512)
    docs = spark.range(9_000).selectExpr("id AS doc_id", "concat('host', id % 6000, '.org') AS source", "repeat('word ', CAST(1 + id % 40 AS INT)) AS text")
    sums = mix_counts(docs).join(docs, "doc_id").groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max("source_size").alias("size"))
    rows = sorted(sums.collect(), key=lambda r: r["source"])
    want = targets([r["size"] for r in rows], [(5, 2, 1)[i % 3] for i in range(len(rows))])
    assert [r["target"] for r in rows] == list(want)
    assert all(r["taken"] == min(round(r["target"]), 3 * r["size"]) for r in rows) and len(rows) == 6000


def test_short_blocks_are_cut_right():
    for size in (1, 63, 64, 65, 130, 1000):
        for weight in (1, 2, 5):
            goal = targets([size, 500], [weight, 3])
            for s, n in enumerate((size, 500)):
                plan = Source.planned(s, n, goal[s], 64, 3)
                _, _, words = plan.taken(np.arange(plan.slots))
                assert words.sum() == min(round(goal[s]), 3 * n) and (words > 0).all()


def test_mixed_documents_hold_the_words(documents, odd, clashing):
    rows = corpus(4)
    texts = {i: t for i, t, _ in rows}
    counts = {r["doc_id"]: r["taken"] for r in mix_counts(documents(rows)).collect()}
    found = mixed_documents(documents(rows)).collect()
    taken = {i: 0 for i in counts}
    for r in found:
        words = re.findall(r"[^\x20\x09-\x0D]+", r["text"])
        taken[r["doc_id"]] += len(words)
        assert len(words) <= len(texts[r["doc_id"]].split()) and r["n_chars"] == len(r["text"])
        assert all(w in texts[r["doc_id"]] for w in words)
    assert taken == counts
    assert mix_counts(clashing(odd)).count() == odd.count()
    assert mixed_documents(clashing(odd)).columns == clashing(odd).columns
    assert mix_counts(odd.limit(0)).count() == mixed_documents(odd.limit(0)).count() == 0


def test_slots_are_not_broadcast(documents):
    rows = sized(documents(corpus(3)), "doc_id", "text", "source")
    plan = mixing.takes(rows, source_plan(rows))._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("MapInPandas")]
    assert "SortMergeJoin" in above and "BroadcastExchange" not in above.split("SortMergeJoin")[0]


def test_running_sums(spark):
    df = spark.range(3000).selectExpr("id % 3 AS k", "id", "id % 5 AS v")
    got = running(df, ["k"], "v", ["id"], 40_000_000, "before").collect()
    for key in range(3):
        own = sorted((r["before"], r["v"]) for r in got if r["k"] == key)
        total = 0
        spans = sorted(own, key=lambda x: (x[0], x[1] > 0))
        for before, v in spans:
            assert before == total or v == 0
            total += v


def test_fullest_combination():
    counts = {7: 1, 5: 2, 3: 3, 2: 1}
    got = fullest(counts, 13)
    assert got[7] == 1 and sum(k * v for k, v in got.items()) == 13
    assert fullest({9: 1, 4: 5}, 20) == {9: 1, 4: 2}


@pytest.mark.parametrize("seed", range(6))
def test_patterns_use_every_piece_and_beat_first_fit(seed):
    rng = random.Random(seed)
    lengths = [min(100, int(rng.lognormvariate(3, 1)) + 1) for _ in range(700)]
    counts = {k: lengths.count(k) for k in set(lengths)}
    patterns = bin_patterns(counts, 100)
    used = {}
    for pattern, times in patterns:
        assert sum(k * v for k, v in pattern.items()) <= 100 and times > 0
        for k, v in pattern.items():
            used[k] = used.get(k, 0) + v * times
    assert used == counts
    first_fit: list[int] = []
    for x in sorted(lengths, reverse=True):
        i = next((i for i, room in enumerate(first_fit) if room >= x), None)
        if i is None:
            first_fit.append(100 - x)
        else:
            first_fit[i] -= x
    assert -(-sum(lengths) // 100) <= sum(t for _, t in patterns) <= len(first_fit)


def test_pieces_are_the_tokens(documents, odd, clashing):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(default_tokenizer())
    rows = [*corpus(5, 40), (900, "a  b \n\n c <|endoftext|> d e \x1c f  ", "a"), (901, " lead", "a"), (902, None, "a")]
    found = pack(documents(rows), capacity=256).collect()
    for i, text, _ in rows:
        ids = [*model.encode(text or "", add_special_tokens=False).ids, 0]
        own = sorted((r for r in found if r["doc_id"] == i), key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own))) and sum(r["length"] for r in own) == len(ids)
        assert all(r["length"] == 256 for r in own[1:])
        for r in own:
            piece = np.array(ids[r["start"] : r["start"] + r["length"]], dtype="<u4").tobytes()
            assert r["ids_crc32"] == zlib.crc32(piece)
    at: dict[int, int] = {}
    for r in sorted(found, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == at.get(r["sequence_id"], 0)
        at[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(at.values()) <= 256
    assert pack(clashing(odd)).where("piece = 0").count() == odd.count()
    assert pack(odd.limit(0)).count() == 0


def test_quick_ids_are_the_tokenizers(monkeypatch):
    from hypothesis import given, settings
    from hypothesis import strategies as st
    from tokenizers import Tokenizer

    from feedloom.llm import packing

    model, quick = Tokenizer.from_file(default_tokenizer()), packing._Ids(default_tokenizer())
    assert quick.quick is not None
    monkeypatch.setattr(packing, "SLICE", 7)
    own = lambda t: np.frombuffer(quick.of(t), "<u4").tolist()
    odd = st.text(st.sampled_from("aZé 9\n\t'.,-<|>\u00a0\u3000\u200b漢🙂\x00\x1cİß's"), max_size=60)

    @settings(max_examples=400, deadline=None)
    @given(st.one_of(odd, st.text(max_size=40)))
    def same(text):
        assert own(text) == model.encode(text, add_special_tokens=False).ids

    same()
    for text in ("<|endoftext|> a", " " * 30_000, "\n" * 30_000 + "x", "a" * 30_000, "x y " * 9_000, "'s" * 500):
        assert own(text) == model.encode(text, add_special_tokens=False).ids


def test_other_models_are_read_by_the_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    from feedloom.llm import packing

    path = public_tokenizers.path("word_bpe_49k.json")
    ids = packing._Ids(path)
    assert ids.quick is None
    assert np.frombuffer(ids.of("Some Words, more."), "<u4").tolist() == Tokenizer.from_file(path).encode("Some Words, more.", add_special_tokens=False).ids


def test_steps_of_the_mix_are_stored(documents):
    # As one plan they filled the driver's memory with plans.
    rows = sized(documents(corpus(5)), "doc_id", "text", "source")
    found = mixing.takes(rows, source_plan(rows))
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange") <= 3


def test_whole_texts_of_the_mix_stay_out_of_python(documents):
    found = mixed_documents(documents(corpus(5)))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    given = re.search(r"cut\((CASE WHEN )?", plan)
    assert given and given[1]
    assert found.where("text is null").count() == 0


def test_the_tokenizer_is_read_when_a_text_needs_it():
    from feedloom.llm import packing

    ids = packing._Ids(default_tokenizer())
    ids.of("plain text")
    assert "model" not in vars(ids)
    ids.of("<|endoftext|>")
    assert "model" in vars(ids)


def test_workers_give_back_what_they_freed():
    import os

    from feedloom.llm.common import giving_back

    def held() -> float:
        with open("/proc/self/statm", encoding="ascii") as file:
            return int(file.read().split()[1]) * os.sysconf("SC_PAGE_SIZE") / 1e6

    kept = []

    def task(batches):
        for _ in batches:
            large = [bytes(2000) for _ in range(100_000)]
            kept.append(bytes(2000))  # lies above, so that what is below is not given back by itself
            yield len(large)
            del large

    before = held()
    assert list(giving_back(task)(iter("ab"))) == [100_000, 100_000]
    assert held() - before < 60
