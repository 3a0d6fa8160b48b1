import random

import corpus_pipeline
from feedloom.llm.queries import QUERIES


def test_stages_take_effect(spark, tmp_path):
    rng = random.Random(2)
    word = lambda: f"w{rng.randrange(4000)}"
    texts = [" ".join(word() for _ in range(rng.randrange(20, 120))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, texts[i]) for i in range(10)]
    near = texts[20].split()
    near[-1] = "changed"
    rows += [(200, " ".join(near))] + [(300 + i, f"you {['idiot', 'clown'][i % 2]} {texts[i]} x{i}") for i in range(30)]
    full = [(i, t, "en", f"src{i % 3}", len(t)) for i, t in rows]
    spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, int(i >= 300)) for i, _ in rows]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:3]:
        after = stage(spark, docs, str(tmp_path))
        assert after.columns == docs.columns
        after.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert kept["toxicity"] == {i for i, _ in rows if i < 300}
    assert kept["exact_dedup"] == set(range(60)) | {200}
    assert kept["ngram_jaccard"] == set(range(60))
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} <= set(range(60))
    assert packed.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").count() == 0


def test_one_query_for_each_operator():
    assert [sum(n.startswith(f"op{i}_") for n in QUERIES) for i in range(1, 14)] == [1] * 13
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "ngram_jaccard", "mixing", "packing"]
