"""Spelling variants: words one edit apart, found by dense prefix-suffix tiles.

Two words are one edit apart when the code points they share at the front and at the back reach the
longer one's length less one. The words of a block lie in padded matrices of code points, aligned to
the left and to the right, and all pairs of the block are compared at once, position by position.

Blocks are words that can meet: for an edit at place ``e`` of a longer word of length ``m``, both
words have the first ``e`` and the last ``m - 1 - e`` code points in common. The places are cut into
windows of a few, and a word goes, for each window, to the block of what lies before and behind the
window. So blocks stay small at any number of words, and no pair is lost. A pair counts in the
window of its shared prefix's end alone, hence once. Blocks of very many words are cut into tiles,
and each pair of tiles is compared by a task of its own.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import checkpointed

# Fixed values of the words that count: letters, shortest length, least occurrences, deletion, ratio.
LETTERS = r"[A-Za-zÀ-ÿ]"
MIN_LENGTH, MIN_COUNT, EVERY, RATIO = 7, 2, 31, 10
WINDOW, MAX_WINDOWS = 3, 8  # places of an edit in a window, and windows of a long word
TILE = 1024  # words of a tile; a block of more is compared in pairs of tiles
CELLS = 1 << 19  # pairs compared at once
HELD = 200_000  # words counted in a task before they are passed on


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): the words of all texts, and how often each occurs."""
    run = re.compile(f"{LETTERS}{{{MIN_LENGTH},}}")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def passed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"])
            total.clear()
            return out

        for batch in batches:
            for name, text in zip(batch.column(0), batch.column(1), strict=True):
                if not text.is_valid:
                    continue
                # Small letters in the bytes: A-Z alone change.
                found = Counter(run.findall(text.as_py().lower().decode()))
                begun = zlib.crc32((name.as_py() or "").encode() + b":")
                for word, n in found.items():
                    h = zlib.crc32(word.encode(), begun)
                    if h % EVERY == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < MIN_LENGTH:
                            continue
                    total[word] += n
                if len(total) > HELD:
                    yield passed()
        yield passed()

    rows = docs.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).cast("string").cast("binary").alias("t"))
    counts = rows.mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= MIN_COUNT)


def _windows(m: Column) -> tuple[Column, Column]:
    """How many places a window of words up to length ``m`` has, and how many windows there are."""
    width = F.greatest(F.lit(WINDOW), F.ceil(m / MAX_WINDOWS)).cast("int")
    return width, F.ceil(m / width).cast("int")


def blocked(words: DataFrame) -> DataFrame:
    """(block, m, window, first, width, word, n): each word in all blocks where it can meet another."""
    size = F.char_length("word")
    placed = words.select("word", "n", F.explode(F.array(size, size + 1)).alias("m"))
    width, many = _windows(F.col("m"))
    placed = placed.withColumn("width", width).withColumn("w", F.explode(F.sequence(F.lit(0), many - 1)))
    first = F.col("w") * F.col("width")
    behind = F.col("m") - F.least(first + F.col("width"), F.col("m"))
    before = F.substring("word", F.lit(1), first)
    after = F.when(behind > 0, F.substring("word", size - behind + 1, behind)).otherwise("")
    return placed.select(F.xxhash64("m", "w", before, after).alias("block"), "m", first.alias("first"), "width", "word", "n")


def shared(left: np.ndarray, right: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of the common prefix and suffix of rows ``a`` and ``b``, all pairs of their last axes.

    ``left`` and ``right`` hold the code points of words aligned to either side; ``a`` (..., x) and
    ``b`` (..., y) are row numbers, the results (..., x, y).
    """
    out = []
    width = left.shape[1]
    for points, places in ((left, range(width)), (right, range(width - 1, -1, -1))):
        alive = np.ones((*a.shape, b.shape[-1]), dtype=bool)
        length = np.zeros(alive.shape, dtype=np.int32 if width > 250 else np.uint8)
        for k in places:
            column = points[:, k]
            alive &= column[a][..., :, None] == column[b][..., None, :]
            length += alive
            if not alive.any():
                break
        out.append(length)
    return out[0], out[1]


def _matrices(words: list[bytes], m: int) -> tuple[np.ndarray, np.ndarray]:
    """Words of at most ``m`` code points (one byte each) aligned to the left and to the right; pads differ from letters."""
    left = np.frombuffer(b"".join(w.ljust(m, b"\0") for w in words), dtype=np.uint8).reshape(len(words), m)
    right = np.frombuffer(b"".join(w.rjust(m, b"\0") for w in words), dtype=np.uint8).reshape(len(words), m)
    return left, right


def _pairs(left, right, long, m, first, end, a, b, same):
    """Rows (i, j) of pairs one edit apart whose shared prefix ends in the window, of tiles ``a`` and ``b``."""
    prefix, suffix = shared(left, right, np.maximum(a, 0), np.maximum(b, 0))
    prefix = prefix.astype(np.int64)
    at = lambda x, rows: x[np.maximum(rows, 0)]
    near = prefix + suffix >= m - 1
    near &= (prefix >= first[..., None, None]) & (prefix < end[..., None, None])
    near &= at(long, a)[..., :, None] | at(long, b)[..., None, :]
    near &= (a >= 0)[..., :, None] & (b >= 0)[..., None, :]
    if same:
        near &= np.triu(np.ones((a.shape[-1], a.shape[-1]), dtype=bool), 1)
    found = np.nonzero(near)
    return a[(*found[:-2], found[-2])], b[(*found[:-2], found[-1])]


def compared(block: np.ndarray, side: np.ndarray, m: np.ndarray, first: np.ndarray, width: np.ndarray, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i, j) one edit apart, of rows sorted by ``block``; each pair once.

    Side 0 holds rows that are compared with each other, 1 and 2 two tiles that are compared with one another.
    """
    begins = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
    sizes = np.diff(np.r_[begins, len(block)])
    out: list[tuple[np.ndarray, np.ndarray]] = []
    of_length = np.array([len(w) for w in words])
    for length in np.unique(m[begins[sizes > 1]]):
        mine = np.flatnonzero((m[begins] == length) & (sizes > 1))
        rows = np.concatenate([np.arange(begins[k], begins[k] + sizes[k]) for k in mine])
        place = np.full(len(block), -1)
        place[rows] = np.arange(len(rows))
        left, right = _matrices([words[r] for r in rows], int(length))
        long = of_length[rows] == length
        # Blocks of like size are compared together, in matrices padded to the next power of two.
        exact = side[begins[mine]] > 0
        shape = 1 << np.ceil(np.log2(sizes[mine])).astype(int)
        for size in np.unique(shape[~exact]):
            some = mine[~exact & (shape == size)]
            step = max(1, CELLS // int(size * size))
            for k in range(0, len(some), step):
                part = some[k : k + step]
                at = begins[part][:, None] + np.arange(size)
                tile = np.where(np.arange(size) < sizes[part][:, None], place[np.minimum(at, len(block) - 1)], -1)
                f = first[begins[part]]
                i, j = _pairs(left, right, long, length, f, np.minimum(f + width[begins[part]], length), tile, tile, True)
                out.append((rows[i], rows[j]))
        for k in mine[exact]:
            span = np.arange(begins[k], begins[k] + sizes[k])
            one, two = place[span[side[span] == 1]], place[span[side[span] == 2]]
            if not len(two):
                continue
            f = first[begins[k] : begins[k] + 1]
            end = np.minimum(f + width[begins[k]], length)
            step = max(1, CELLS // len(two))
            for x in range(0, len(one), step):
                i, j = _pairs(left, right, long, length, f, end, one[None, x : x + step], two[None], False)
                out.append((rows[i], rows[j]))
    if not out:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return np.concatenate([i for i, _ in out]), np.concatenate([j for _, j in out])


def _tiled(rows: DataFrame) -> DataFrame:
    """Rows by (block, side): blocks of more than two tiles are cut into tiles, and every pair of tiles is a block."""
    large = rows.groupBy("block").agg(F.count("*").alias("size")).where(F.col("size") > 2 * TILE)
    large = large.select("block", F.ceil(F.col("size") / TILE).cast("int").alias("tiles"))
    rows = rows.join(large, "block", "left")
    own = F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int")
    other = F.sequence(F.lit(0), F.col("tiles") - 1)
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.when(F.col("tiles").isNull(), F.array(F.lit(-1))).otherwise(other)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    side = F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2)
    block = F.when(F.col("other") < 0, F.col("block")).otherwise(F.xxhash64("block", low, high))
    return rows.select(block.alias("block"), F.when(F.col("other") < 0, 0).otherwise(side).cast("int").alias("side"), "m", "first", "width", "word", "n")


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, near, near_n): how many words are one edit away, and the most frequent of them.

    Of those equally frequent it is the first in code-point order. Words without any are left out.
    """

    def best(pdf: pd.DataFrame) -> pd.DataFrame:
        words = [w.encode("latin-1") for w in pdf["word"]]
        columns = [pdf[c].to_numpy() for c in ("block", "side", "m", "first", "width")]
        i, j = compared(*columns, words)
        n = pdf["n"].to_numpy()
        i, j = np.r_[i, j], np.r_[j, i]
        place = {w: k for k, w in enumerate(sorted(set(words)))}
        rank = np.array([place[w] for w in words], dtype=np.int64)
        # Rows of one word come together over blocks; the most frequent near word first.
        order = np.lexsort((rank[j], -n[j], rank[i]))
        i, j = i[order], j[order]
        begins = np.flatnonzero(np.diff(rank[i], prepend=-1))
        word = pdf["word"].to_numpy()
        return pd.DataFrame({"word": word[i[begins]], "n_near": np.diff(np.r_[begins, len(i)]), "near": word[j[begins]], "near_n": n[j[begins]]})

    def all_best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Rows come sorted by block: whole blocks are compared, those begun wait for their rest.
        held = []
        size = 0
        for pdf in batches:
            held.append(pdf)
            size += len(pdf)
            last = pdf["block"].iloc[-1] if len(pdf) else None
            if size < 65536 or (held[0]["block"].iloc[0] == last):
                continue
            whole = pd.concat(held, ignore_index=True)
            cut = int(whole["block"].searchsorted(last))
            yield best(whole.iloc[:cut])
            held, size = [whole.iloc[cut:]], len(whole) - cut
        if size:
            yield best(pd.concat(held, ignore_index=True))

    rows = _tiled(checkpointed(blocked(words))).repartition("block").sortWithinPartitions("block")
    found = rows.mapInPandas(all_best, "word string, n_near long, near string, near_n long")
    first = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("w"))).alias("b")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first).select("word", "n_near", F.col("b.w").alias("near"), (-F.col("b.n")).alias("near_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the last of the forms that follow one another, by doubling steps.

    A form is at least ten times as frequent as its word, so chains are short and have an end.
    """
    steps = checkpointed(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        on = checkpointed(steps.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        steps = on.select("word", "root")
        if on.where("moved").isEmpty():
            return steps


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every word: word, form, root, n, n_near, form_n.

    Runs of letters of whole texts, A-Z in small, one code point deleted where 31 divides the crc32 of
    identifier and run; words of at least 7 code points and 2 occurrences. A null text has no words, a
    null identifier counts as empty; rows that repeat an identifier count each. An empty table gives
    no rows; other columns have no part, whatever their names.
    """
    words = checkpointed(word_counts(docs, id_col, text_col))
    near = checkpointed(near_words(words))
    often = F.col("near_n") >= RATIO * F.col("n")
    found = words.join(near, "word", "left")
    found = found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(often, F.col("near")).alias("form"), F.when(often, F.col("near_n")).alias("form_n"))
    last = roots(found.where("form is not null").select("word", "form"))
    return found.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
