"""What Python workers get and hold at once."""

from __future__ import annotations

import itertools
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from feedloom.llm import words
from feedloom.llm.common import BATCH, BATCH_BYTES, small_batches
from feedloom.llm.jaccard import drop_similar
from feedloom.llm.mixing import mixed_documents
from feedloom.llm.packing import pack
from feedloom.llm.toxicity import drop_toxic


@pytest.fixture
def unset(spark):
    spark.conf.unset(BATCH)
    yield spark
    spark.conf.unset(BATCH)


def largest_batch(spark) -> int:
    """Bytes of the largest batch that a worker gets of 24 MB of texts in one task."""

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["bytes"])

    texts = spark.range(6000).select(F.repeat(F.lit("abcd"), 1000).alias("text")).coalesce(1)
    return texts.mapInArrow(sizes, "bytes long").agg(F.max("bytes")).first()[0]


@pytest.mark.parametrize("stage", ["toxicity", "ngram_jaccard", "mixing", "packing"])
def test_batches_of_texts_are_bounded_by_bytes(unset, documents, stage):
    assert largest_batch(unset) > 20 << 20
    docs = documents([(i, f"text {i} of some words", f"s{i % 2}") for i in range(20)])
    if stage == "toxicity":
        drop_toxic(docs, unset.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, toxic int"))
    else:
        {"ngram_jaccard": drop_similar, "mixing": mixed_documents, "packing": pack}[stage](docs)
    assert largest_batch(unset) < BATCH_BYTES + (64 << 10)


def test_a_bound_of_the_session_stays(unset):
    unset.conf.set(BATCH, 1 << 20)
    small_batches(unset)
    assert largest_batch(unset) < (1 << 20) + (64 << 10)


def test_shingles_hold_little_at_once(monkeypatch):
    rng = np.random.default_rng(7)
    texts = pa.array([" ".join(f"w{i}" for i in rng.integers(0, 5000, 600)) for _ in range(600)])
    monkeypatch.setattr(words, "_powers", [])
    tracemalloc.start()
    small = [s.tolist() for s in itertools.islice(words.shingle_sets(texts, 5), 50)]
    held = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert held < 20 << 20
    monkeypatch.setattr(words, "CHUNK_BYTES", 1 << 20)
    assert [s.tolist() for s in itertools.islice(words.shingle_sets(texts, 5), 50)] == small
