"""Best-fit packing of tokenised documents into sequences by minimum bin slack.

How pieces are packed depends on their lengths only, and there are at most ``capacity`` different
ones, so the plan is made from the number of pieces of each length, a table of bounded size. Per bin, the
longest piece left is put in, and a bitset subset-sum over the lengths still available finds the
fullest combination beside it; the combination is used as often as the counts allow, and removed.
The plan, at most some thousand combinations, then says which piece of a length goes where: pieces
are numbered within their length in parallel and looked up.
"""

from __future__ import annotations

import functools
import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import checkpointed, give_back, giving_back, running, small_batches

CAPACITY = 2048
#: A single space between two other characters: pre-tokenising never joins what is on both sides.
_BREAK = re.compile(r"(?<=\S) (?=\S)")
SLICE = 1 << 18  # characters encoded at once; a longer text is cut at such a space
_LONG_GAP = re.compile(r"\s{1000}")  # more than the quick way takes
#: How byte-level models cut a text before merging (fixed value of the format).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_ranks(model: dict) -> dict[bytes, int] | None:
    """The tokens of a tokenizer file as bytes, with their ids, if merging them in order of ids gives its ids.

    That is so for a byte-level BPE without normalisation whose merges make tokens of rising ids.
    """
    bpe, cut = model.get("model") or {}, model.get("pre_tokenizer") or {}
    plain = model.get("normalizer") is None and model.get("post_processor") is None and bpe.get("type") == "BPE"
    plain = plain and cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True)
    if not plain or any(bpe.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
        return None
    vocab = bpe["vocab"]
    merges = [vocab.get("".join(m if isinstance(m, list) else m.split(" ")), -1) for m in bpe["merges"]]
    if any(b <= a for a, b in zip(merges, merges[1:], strict=False)) or len(vocab) != 256 + len(merges) or (merges and merges[0] < 256):
        return None
    # Bytes that are no printable character of Latin-1 stand as the characters from 256 on, in order.
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    return {bytes(byte[c] for c in token): i for token, i in vocab.items()}


class _Ids:
    """Token ids of whole texts, as little-endian 32-bit bytes.

    A byte-level model's own vocabulary is given to the quick encoder, whose ids are the same; texts
    that hold one of the model's added tokens or very long white space, and other models, are
    encoded by the tokenizer itself, which is read when the first such text comes. Nothing of a text is kept.
    """

    def __init__(self, path: str) -> None:
        self.path = path
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        self.added = [t["content"] for t in described.get("added_tokens") or []]
        ranks = _byte_ranks(described)
        self.quick = None
        if ranks is not None:
            import tiktoken

            self.quick = tiktoken.Encoding("model", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        # The file's text and tables are several times what is kept of them.
        del described, ranks
        give_back()

    @functools.cached_property
    def model(self):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def of(self, text: str) -> bytes:
        if self.quick is None or any(t in text for t in self.added) or _LONG_GAP.search(text):
            return np.array(self.model.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if len(text) <= SLICE:
            return np.array(self.quick.encode_ordinary(text), dtype="<u4").tobytes()
        out, at = [], 0
        while at < len(text):
            cut = _BREAK.search(text, at + SLICE)
            end = cut.start() if cut else len(text)
            out.append(np.array(self.quick.encode_ordinary(text[at:end]), dtype="<u4").tobytes())
            at = end
        return b"".join(out)


def pieces(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, capacity: int, end_id: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every row's tokens and the end id."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _Ids(tokenizer)
        stop = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                tokens = ids.of(text.as_py() or "") + stop
                n, start, piece = len(tokens) // 4, 0, 0
                size = (n - 1) % capacity + 1
                while start < n:
                    out.append((doc, piece, start, size, zlib.crc32(tokens[4 * start : 4 * (start + size)])))
                    start, piece, size = start + size, piece + 1, capacity
            columns = list(zip(*out, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (batch.column(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(giving_back(rows), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def fullest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The longest length there is, and the fullest combination of the others beside it."""
    longest = max(counts)
    room = capacity - longest
    mask, reach, layers = (1 << (room + 1)) - 1, 1, []
    for length in sorted(counts, reverse=True):
        copies = min(counts[length] - (length == longest), room // length)
        step = 1
        while copies > 0 and not reach >> room & 1:  # 1, 2, 4, ... copies reach any number of them
            step = min(step, copies)
            layers.append((length, step, reach))
            reach |= (reach << (length * step)) & mask
            copies -= step
            step *= 2
        if reach >> room & 1:
            break
    out, left = {longest: 1}, reach.bit_length() - 1
    for length, step, before in reversed(layers):
        if not before >> left & 1:
            out[length] = out.get(length, 0) + step
            left -= length * step
    return out


def bin_patterns(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Combinations of lengths and how many bins use each, until no piece is left."""
    counts, out = {k: v for k, v in counts.items() if v}, []
    while counts:
        pattern = fullest(counts, capacity)
        times = min(counts[k] // v for k, v in pattern.items())
        out.append((pattern, times))
        for k, v in pattern.items():
            counts[k] -= v * times
            if not counts[k]:
                del counts[k]
    return out


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null text is empty, and is packed as its end id alone; only a document longer than
    ``capacity`` is cut. Rows that repeat an identifier, or have none, are packed each for itself.
    An empty table gives no rows; other columns have no part.
    """
    cut = checkpointed(pieces(docs, id_col, text_col, tokenizer or default_tokenizer(), capacity).withColumn("row", F.monotonically_increasing_id()))
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    # For each length, runs of its pieces: (first number, pieces to a bin, first bin, offset in the bin).
    runs: dict[int, list[list[int]]] = {}
    done, bins = dict.fromkeys(counts, 0), 0
    for pattern, times in bin_patterns(counts, capacity):
        offset = 0
        for length in sorted(pattern, reverse=True):
            runs.setdefault(length, []).append([done[length], pattern[length], bins, offset])
            done[length] += pattern[length] * times
            offset += length * pattern[length]
        bins += times
    table = {k: np.array(v, dtype=np.int64).T for k, v in runs.items()}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, numbers = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            sequence, offset = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
            for length in np.unique(lengths):
                mine = lengths == length
                first, each, start, at = table[int(length)]
                i = np.searchsorted(first, numbers[mine], "right") - 1
                k = numbers[mine] - first[i]
                sequence[mine] = start[i] + k // each[i]
                offset[mine] = at[i] + k % each[i] * length
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)], names=[*batch.schema.names[:5], "sequence_id", "offset"]
            )

    numbered = running(cut.withColumn("__one", F.lit(1).cast("long")), ["length"], "__one", ["doc_id", "piece", "row"], sum(counts.values()), "number", ["doc_id", "piece"])
    numbered = numbered.select("doc_id", "piece", "start", "length", "ids_crc32", "number")
    kind = docs.schema[id_col].dataType.simpleString()
    return numbered.mapInArrow(giving_back(place), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
