"""Fingerprints of documents from improbable features, kept in chained Bloom filters.

A feature is a window of bytes. Windows are ranked by how rare their entropy is among the windows of
all documents, the rarest first, equal ranks by a hash of the window. Every run of neighbouring
windows votes for its first in rank, and a window with enough votes is a feature: what is
chosen depends on the text nearby alone, so an edit changes the features near it and no others. The
features go, in text order, into Bloom filters of fixed size, a new one when one is full. Short texts
carry a second chain, of all their windows of a few bytes.

Two fingerprints are compared filter by filter: the share of bits that both have set, less what
chance gives for filters as full as these, is 0 for unrelated filters and 1 for equal ones. Each
filter of the shorter chain takes the best of the other chain, weighted by its features.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


WINDOW, RUN, VOTES = 16, 16, 4  # bytes of a feature, windows of a run, votes needed
SHORT, SHORT_TEXT = 4, 256  # windows of the second chain, and the bytes below which a text has it
BITS, FULL, HASHES, FEW = 2048, 160, 5, 16  # bits and features of a filter, bits of a feature, features of a filter worth comparing
GAP = WINDOW + RUN
CHUNK_BYTES, PART_BYTES = 1 << 20, 32 << 20  # bytes read at once, and of a partition
SCALE = 16  # units of entropy: sums of 16 c log2(c), rounded

_U = np.uint64
_COUNT = np.arange(WINDOW + 1)
_WEIGHT = np.rint(SCALE * _COUNT * np.log2(np.maximum(_COUNT, 1))).astype(np.int32)
_STEP = np.diff(_WEIGHT)
CLASSES = int(_WEIGHT[-1]) + 1
_NEVER = _U(0xFFFFFFFFFFFFFFFF)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of texts with gaps behind them, and where each begins and ends."""
    gap = bytes(GAP)
    data = np.frombuffer(gap.join(texts) + gap, dtype=np.uint8)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    ends = np.cumsum(sizes + GAP) - GAP
    return data, ends - sizes, ends


def entropy_classes(data: np.ndarray) -> np.ndarray:
    """For each window its sum of c log c over the counts c of its bytes: the higher, the less entropy."""
    back, fore = np.zeros(len(data), dtype=np.uint8), np.zeros(len(data), dtype=np.uint8)
    for j in range(1, WINDOW):
        same = (data[j:] == data[:-j]).view(np.uint8)
        back[j:] += same
        fore[:-j] += same
    first = int(_WEIGHT[np.bincount(data[:WINDOW])].sum())
    # The next window gains the byte behind and loses its first; their numbers in between are known.
    moves = _STEP[back[WINDOW:]] - _STEP[fore[: len(data) - WINDOW]]
    return np.cumsum(np.r_[first, moves], dtype=np.int32)


def window_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each window of ``size`` bytes, a power of two up to 16."""
    word, width = data.astype(_U), 1
    while width < min(size, 8):
        word = word[: len(word) - width] | (word[width:] << _U(8 * width))
        width *= 2
    if size > 8:
        word = _mixed(word[:-8] * _U(0x9E3779B97F4A7C15) + word[8:])
    return _mixed(word + _U(size))


def _starts(begins: np.ndarray, ends: np.ndarray, size: int, n: int) -> np.ndarray:
    """Where windows begin: one for a text of fewer bytes than ``size``, none for an empty one."""
    marks = np.zeros(n + 1, dtype=np.int32)
    some = ends > begins
    np.add.at(marks, begins[some], 1)
    np.add.at(marks, np.maximum(ends[some] - size, begins[some]) + 1, -1)
    return np.flatnonzero(np.cumsum(marks[:-1]))


def rank_of(counts: np.ndarray) -> np.ndarray:
    """The rank of each entropy class, the rarest first."""
    order = np.argsort(counts, kind="stable")
    rank = np.empty(CLASSES, dtype=_U)
    rank[order] = np.arange(CLASSES, dtype=_U)
    return rank


def features(texts: list[bytes], rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of the chosen windows, in text order; equal windows of a text count once."""
    data, begins, ends = joined(texts)
    starts = _starts(begins, ends, WINDOW, len(data) - WINDOW + 1)
    if not len(starts):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=_U)
    hashes = window_hashes(data, WINDOW)
    key = np.full(len(hashes) + RUN, _NEVER)
    key[starts] = (rank[entropy_classes(data)[starts]] << _U(53)) | (hashes[starts] >> _U(43) << _U(32)) | starts.astype(_U)
    least, width = key, 1
    while width < RUN:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    votes = np.bincount((least[starts] & _U(0xFFFFFFFF)).astype(np.int64), minlength=len(data))
    text = np.searchsorted(begins, starts, "right") - 1
    many = np.bincount(text, minlength=len(texts))
    at = votes[starts] >= np.minimum(VOTES, -(-many // VOTES))[text]
    return _once(text[at], hashes[starts[at]])


def short_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    data, begins, ends = joined(texts)
    starts = _starts(begins, ends, SHORT, len(data) - WINDOW + 1)
    return _once(np.searchsorted(begins, starts, "right") - 1, window_hashes(data, SHORT)[starts])


def _once(text: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((hashes, text))
    t, h = text[order], hashes[order]
    new = np.ones(len(t), dtype=bool)
    new[1:] = (t[1:] != t[:-1]) | (h[1:] != h[:-1])
    keep = np.sort(order[new])  # the sort is stable, so the first of equals stays
    return text[keep], hashes[keep]


class Chain:
    """The filters of one fingerprint: packed bits, and the features in each."""

    def __init__(self, bits: np.ndarray, counts: np.ndarray) -> None:
        self.bits, self.counts = bits, counts
        self.set = np.bitwise_count(bits).sum(axis=1, dtype=np.int64)

    def __str__(self) -> str:
        return ",".join(map(str, self.counts)) + ":" + base64.b64encode(self.bits.tobytes()).decode()


def chains(text: np.ndarray, hashes: np.ndarray, texts: int) -> list[Chain]:
    """One chain of filters for each text number below ``texts``."""
    counts = np.bincount(text, minlength=texts)
    filters = -(-counts // FULL)
    first = np.cumsum(filters) - filters
    number = np.arange(len(text)) - (np.cumsum(counts) - counts)[text]
    row = first[text] + number // FULL
    bits = np.zeros((int(filters.sum()), BITS), dtype=bool)
    for k in range(HASHES):
        bits[row, ((hashes >> _U(11 * k)) & _U(BITS - 1)).astype(np.int64)] = True
    packed = np.packbits(bits, axis=1)
    held = np.bincount(row, minlength=len(bits))
    return [Chain(packed[a : a + n], held[a : a + n]) for a, n in zip(first, filters, strict=True)]


def prints(texts: list[bytes], rank: np.ndarray) -> list[tuple[Chain, Chain | None]]:
    """The chain of each text, and the second one of a short text."""
    main = chains(*features(texts, rank), len(texts))
    small = [i for i, t in enumerate(texts) if len(t) < SHORT_TEXT]
    found = dict(zip(small, chains(*short_features([texts[i] for i in small]), len(small)), strict=True)) if small else {}
    return [(chain, found.get(i)) for i, chain in enumerate(main)]


def shown(one: tuple[Chain, Chain | None]) -> str:
    return ";".join(str(c) for c in one if c is not None and len(c.bits))


def parsed(fingerprint: str, short: bool = False) -> Chain:
    """A chain of a fingerprint as text, the first or the second."""
    part = ([*fingerprint.split(";"), ""])[int(short)]
    counts, _, bits = part.partition(":")
    return Chain(np.frombuffer(base64.b64decode(bits), dtype=np.uint8).reshape(-1, BITS // 8), np.array([int(c) for c in counts.split(",") if c], dtype=np.int64))


def _alike(a: Chain, b: Chain) -> float:
    if (len(a.bits), int(a.counts.sum())) > (len(b.bits), int(b.counts.sum())):
        a, b = b, a
    if not len(a.bits):
        return 0.0
    worth = b.counts >= FEW
    other, filled = (b.bits[worth], b.set[worth]) if worth.any() else (b.bits, b.set)
    total = 0.0
    for bits, full, count in zip(a.bits, a.set, a.counts, strict=True):
        best = 0.0
        for k in range(0, len(other), 4096):  # a long chain in blocks
            both = np.bitwise_count(other[k : k + 4096] & bits).sum(axis=1, dtype=np.int64)
            chance = filled[k : k + 4096] * full / BITS
            most = np.minimum(filled[k : k + 4096], full)
            best = max(best, float(((both - chance) / np.maximum(most - chance, 1e-9)).max()))
        total += float(count) * min(1.0, best)
    return total / float(a.counts.sum())


def likeness(a: tuple[Chain, Chain | None], b: tuple[Chain, Chain | None]) -> float:
    """0 to 1; of texts that are both short by their second chains. Of two empty texts it is 1."""
    if not len(a[0].bits) and not len(b[0].bits):
        return 1.0
    if a[1] is not None and b[1] is not None:
        return _alike(a[1], b[1])
    return _alike(a[0], b[0])


def _pieces(texts: Iterator[bytes]) -> Iterator[list[bytes]]:
    """Lists of texts of about CHUNK_BYTES."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text) + GAP
        if size >= CHUNK_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def entropy_ranks(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """The rank of each entropy class by its frequency in the windows of all texts."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES, dtype=np.int64)
        for texts in _pieces(x.as_py() for batch in batches for x in batch.column(0)):
            data, begins, ends = joined(texts)
            starts = _starts(begins, ends, WINDOW, len(data) - WINDOW + 1)
            total += np.bincount(entropy_classes(data)[starts], minlength=CLASSES)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen])], names=["class", "n"])

    texts = docs.select(F.col(text_col).cast("binary").alias("t")).where("octet_length(t) > 0")
    found = texts.mapInArrow(counted, "class int, n long").groupBy("class").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(CLASSES, dtype=np.int64)
    for r in found:  # a row for each class
        counts[r["class"]] = r["n"]
    return rank_of(counts)


def _neighbourhoods(docs: DataFrame, parts: int) -> DataFrame:
    """Rows (block, halo, ..., doc_id, t) in the order of descending identifiers, cut into blocks.

    The first row of a block is also the last of the block before, as halo, and the very first the
    last of the last block, so that each row meets the one after it in its own block. Rows equal in
    identifier and text stay together.
    """
    rows = docs.select("doc_id", "t", F.col("doc_id").isNull().alias("none"), F.coalesce(F.bitwise_not("doc_id"), F.lit(0)).alias("o"),
                       F.xxhash64("t").alias("h"))
    key = ["none", "o", "h"]
    least = rows.select(*key).repartitionByRange(parts, *key).groupBy(F.spark_partition_id()).agg(F.min(F.struct(*key)).alias("k"))
    heads = sorted(tuple(r["k"]) for r in least.collect())  # one for each partition
    if not heads:
        return None
    columns = [np.array(c, dtype=np.int64) for c in zip(*heads, strict=True)]
    blocks = len(heads)

    def placed(none: pd.Series, o: pd.Series, h: pd.Series) -> pd.Series:
        own = [x.to_numpy().astype(np.int64) for x in (none, o, h)]
        both = [np.r_[a, b] for a, b in zip(columns, own, strict=True)]
        later = np.r_[np.zeros(blocks, dtype=np.int64), np.ones(len(h), dtype=np.int64)]
        order = np.lexsort((later, *both[::-1]))
        block = np.empty(len(order), dtype=np.int64)
        block[order] = np.cumsum(order < blocks) - 1
        block = block[blocks:]
        head = np.ones(len(h), dtype=bool)
        for c, x in zip(columns, own, strict=True):
            head &= c[block] == x
        return pd.Series([[b, blocks + (b - 1) % blocks] if at else [b] for b, at in zip(block, head, strict=True)])

    place = F.pandas_udf(placed, "array<long>")(*key)
    dealt = rows.withColumn("place", F.explode(place)).withColumn("block", (F.col("place") % blocks).cast("int")).withColumn("halo", F.col("place") >= blocks)
    # No two blocks share a task: they were cut to be of a size.
    return dealt.drop("place").repartitionById(blocks, "block").sortWithinPartitions("block", "halo", *key).select("doc_id", "t", "halo")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rank: np.ndarray | None = None) -> DataFrame:
    """For every row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next row is that of the next smaller integer identifier, rows of one identifier by a hash of
    the text, rows without one last; after the last comes the first. A null text is empty and has the
    fingerprint ``''``; two empty texts are alike by 1. ``rank``, if given, ranks entropy classes
    instead of the texts' own, so that fingerprints of several tables can be compared. An empty
    table gives no rows; other columns have no part, whatever their names.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("t"))
    rank = entropy_ranks(docs, text_col) if rank is None else rank
    size = texts.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    kind = docs.schema[id_col].dataType
    schema = f"doc_id {kind.simpleString()}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    sorted_rows = _neighbourhoods(texts, int(size // PART_BYTES) + 1)
    if sorted_rows is None:
        return docs.sparkSession.createDataFrame([], schema)

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def chunks() -> Iterator[list[tuple]]:
            held, size = [], 0
            for batch in batches:
                for doc, text, halo in zip(*batch.columns, strict=True):
                    held.append((doc.as_py(), text.as_py(), halo.as_py()))
                    size += len(held[-1][1])
                    if size >= CHUNK_BYTES:
                        yield held
                        held, size = [], 0
            if held:
                yield held

        last = None
        for rows in chunks():
            own = [(row, found) for row, found in zip(rows, prints([t for _, t, _ in rows], rank), strict=True)]
            rows = ([last] if last else []) + own
            last = rows[-1]
            pairs = [(a, b) for a, b in zip(rows[:-1], rows[1:], strict=True) if not a[0][2]]
            out = [[] for _ in range(7)]
            edits, sizes = [], []
            for ((_, text, _), _), ((_, after, _), _) in pairs:
                text = text.decode()
                cut = len(text) // 3
                sizes.append(len(text))
                edits.append((text[: len(text) - cut] + after[: 4 * cut].decode(errors="ignore")[:cut]).encode())
            edited = [x for piece in _pieces(iter(edits)) for x in prints(piece, rank)]
            for (((doc, _, _), own_print), (_, next_print)), n, edit, other in zip(pairs, sizes, edits, edited, strict=True):
                row = (doc, n, hashlib.sha256(edit).hexdigest(), shown(own_print), shown(other), likeness(own_print, other), likeness(own_print, next_print))
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            types = (id_type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=names)

    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(kind)
    return sorted_rows.mapInArrow(compared, schema)
