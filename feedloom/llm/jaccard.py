"""n-gram Jaccard join: which documents are linked by similar word n-grams, and their groups.

Exact. The steps:

1. Every text becomes its set of distinct k-word n-grams (64-bit hashes). Equal sets are one class
   (a 128-bit digest of the sorted set); copies go no further.
2. The global order of the n-grams is: those of a fixed share of the hash space first, rarest
   first, then all others by hash. Two sets that are similar enough share an n-gram among the first
   ``n - ceil(t * n) + 1`` of each. A class whose first n-grams occur in no other class is done;
   that is nearly all of them, and counting needs the sampled share of the n-grams only.
3. What is left is posted under its first n-grams. Under each of them the classes are compared with
   the smallest one by the prefix-tree join, and linked components are formed. Only n-grams whose
   classes are then in several components are looked at further. Pairs whose component is already
   the same are left out everywhere: linked copies cost no pairs.
4. Classes that share n-grams with many others are given other first n-grams: all n-grams of their
   sets are counted among these classes, and the rarest go first. A text that shares a frequent
   line with many has rarer n-grams of its own before that, so most classes are done with this. The
   lists that are left are compared with the class that has the fewest rarer n-grams, and linked.
   Of a list that is still in several components the pairs are taken that the sizes, the place of
   the n-gram in the order and the parities of the sets, some bits for each n-gram, do not rule out.
5. Of the short lists the pairs are taken that the prefixes do not rule out, a tenth of the sets.
6. The prefix-tree join puts the ordered sets of a block into a trie and walks it once for each
   query set: overlaps of shared beginnings are counted once for all sets below, and a subtree is
   left as soon as the n-grams missed, or those remaining, rule out the threshold.

Nothing grows in one task: counting is dealt by n-gram hash with one row per task and n-gram,
buckets of frequent n-grams are split, postings are joined, and blocks have a fixed size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import checkpointed, components, giving_back, release, small_batches, staged
from feedloom.llm.words import mixed, shingle_sets

_U = np.uint64
BLOCK = 256  # classes of a block of the prefix-tree join
DENSE = 16  # classes of an n-gram from which theirs are ordered anew, by all n-grams
MAX_FAMILY = 16 * BLOCK  # classes of such an n-gram that are compared at once, of more in blocks
MAX_BITS = 1 << 13  # parities of a set
BUCKET = 1 << 20  # n-gram entries of a counting bucket
SLOT = 1024  # rows of small groups that a task takes together
CLASS_SCHEMA = "doc_id long, sig binary, n long, s long, ext binary"


def prefix_size(n: int, percent: int) -> int:
    """How many first n-grams of a set of n must hold one of any similar set."""
    return n - -(-percent * n // 100) + 1


def _is_sampled(grams: np.ndarray, percent: int) -> np.ndarray:
    """The share of the hash space that is counted: twice the share a prefix has."""
    return (mixed(grams) & _U(0xFFFF)) < _U(65536 * min(100, 2 * (100 - percent)) // 100)


def _signed(grams: np.ndarray) -> np.ndarray:
    return grams.view(np.int64)


def _signature(grams: np.ndarray) -> bytes:
    return blake2b(grams.tobytes(), digest_size=16).digest()


def classes(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """For every row: doc_id, the digest of its set, the set's size, how many of it are sampled.

    ``ext`` holds further n-grams, in hash order, where the sampled ones are fewer than the prefix.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sigs, sizes, sampled, more = [], [], [], []
            for grams in shingle_sets(batch.column(1), k):
                mine = _is_sampled(grams, percent)
                count, need = int(mine.sum()), prefix_size(len(grams), percent)
                sigs.append(_signature(grams))
                sizes.append(len(grams))
                sampled.append(count)
                more.append(grams[~mine][: need - count].tobytes() if count < need and len(grams) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(sigs, pa.binary()), pa.array(sizes, pa.int64()), pa.array(sampled, pa.int64()), pa.array(more, pa.binary())],
                names=["doc_id", "sig", "n", "s", "ext"],
            )

    return docs.mapInArrow(giving_back(rows), CLASS_SCHEMA)


def _runs(begins: np.ndarray, size: int):
    """(begin, end) of runs that begin at these places and fill ``size``."""
    return zip(begins, np.append(begins, size)[1:], strict=True)


def _of_texts(k: int) -> Callable[[pa.RecordBatch], Iterator[tuple[bytes, np.ndarray]]]:
    def sets(batch):
        for grams in shingle_sets(batch.column(0), k):
            yield _signature(grams), grams

    return sets


def _of_sets(batch: pa.RecordBatch) -> Iterator[tuple[bytes, np.ndarray]]:
    for sig, grams in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
        yield sig, np.frombuffer(grams, _U)


def _bucketed(batches: Iterator[pa.RecordBatch], sets: Callable, percent: int, buckets: int):
    """For each batch and bucket: the sampled n-grams, sorted, and the index of the class of each, and the classes."""
    for batch in batches:
        seen: dict[bytes, int] = {}
        parts, owners = [], []
        for sig, grams in sets(batch):
            if sig not in seen:
                mine = grams[_is_sampled(grams, percent)]
                parts.append(mine)
                owners.append(np.full(len(mine), len(seen), dtype=np.int64))
                seen[sig] = len(seen)
        if not parts:
            continue
        grams, owner = np.concatenate(parts), np.concatenate(owners)
        bucket = ((grams >> _U(16)) % _U(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        grams, owner, bucket = grams[order], owner[order], bucket[order]
        sigs = np.array(list(seen), dtype="S16")
        at = np.flatnonzero(np.diff(bucket, prepend=-1))
        for a, b in _runs(at, len(bucket)):
            yield int(bucket[a]), grams[a:b], owner[a:b], sigs


def frequencies(rows: DataFrame, sets: Callable, percent: int, buckets: int) -> DataFrame:
    """(bucket, grams, counts, entries) of the sampled n-grams that more than one class or task has.

    ``sets`` makes (digest, set) of the batches of ``rows``.
    """

    def counted(batches):
        for bucket, grams, _, _ in _bucketed(batches, sets, percent, buckets):
            own, counts = np.unique(grams, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([bucket], pa.int32()), pa.array([own.tobytes()], pa.binary()), pa.array([counts.astype(np.uint32).tobytes()], pa.binary())],
                names=["bucket", "grams", "counts"],
            )

    def summed(pdf: pd.DataFrame) -> pd.DataFrame:
        grams = np.concatenate([np.frombuffer(x, _U) for x in pdf["grams"]])
        counts = np.concatenate([np.frombuffer(x, np.uint32) for x in pdf["counts"]])
        own, at = np.unique(grams, return_inverse=True)
        total = np.bincount(at, weights=counts, minlength=len(own)).astype(np.int64)
        many = total > 1
        return pd.DataFrame({
            "bucket": [pdf["bucket"].iloc[0]], "df_grams": [own[many].tobytes()],
            "df_counts": [total[many].tobytes()], "entries": [int(counts.sum())],
        })

    parts = rows.mapInArrow(giving_back(counted), "bucket int, grams binary, counts binary")
    return parts.groupBy("bucket").applyInPandas(summed, "bucket int, df_grams binary, df_counts binary, entries long")


def shared_grams(source: DataFrame, found: DataFrame, sets: Callable, percent: int, buckets: int) -> DataFrame:
    """(sig, bucket, grams, counts): of every class, the sampled n-grams that are not its own alone.

    A bucket's counts come first in its task and its rows after them, a batch at a time; a bucket
    with a frequent n-gram, which has many more entries, is dealt to several tasks.
    """

    def listed(batches):
        for bucket, grams, owner, sigs in _bucketed(batches, sets, percent, buckets):
            held, runs = np.unique(owner, return_counts=True)
            names = b"".join(bytes(s).ljust(16, b"\0") for s in sigs[held])
            yield pa.RecordBatch.from_arrays(
                [pa.array([bucket], pa.int32()), pa.array([names], pa.binary()), pa.array([runs.astype(np.uint32).tobytes()], pa.binary()), pa.array([grams.tobytes()], pa.binary())],
                names=["bucket", "sigs", "runs", "grams"],
            )

    def answered(batches):
        known, times = np.empty(0, _U), np.empty(0, np.int64)
        for batch in batches:
            out_sig, out_bucket, out_grams, out_counts = [], [], [], []
            for i in range(batch.num_rows):
                bucket, sigs, runs, grams = (batch.column(j)[i].as_py() for j in range(4))
                if sigs is None:
                    known, times = np.frombuffer(grams, _U), np.frombuffer(runs, np.int64)
                    continue
                if not len(known):
                    continue
                grams, runs = np.frombuffer(grams, _U), np.frombuffer(runs, np.uint32)
                at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
                hit = known[at] == grams
                owner = np.repeat(np.arange(len(runs)), runs)[hit]
                grams, counts = grams[hit], times[at[hit]]
                edge = np.flatnonzero(np.diff(owner, prepend=-1))
                for a, b in _runs(edge, len(owner)):
                    x = int(owner[a])
                    out_sig.append(sigs[16 * x : 16 * x + 16])
                    out_bucket.append(bucket)
                    out_grams.append(grams[a:b].tobytes())
                    out_counts.append(counts[a:b].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(out_sig, pa.binary()), pa.array(out_bucket, pa.int32()), pa.array(out_grams, pa.binary()), pa.array(out_counts, pa.binary())],
                names=["sig", "bucket", "grams", "counts"],
            )

    parts = source.mapInArrow(giving_back(listed), "bucket int, sigs binary, runs binary, grams binary")
    split = found.withColumn("splits", F.ceil(F.col("entries") / (4 * BUCKET)).cast("int"))
    heads = split.select(
        "bucket", F.lit(None).cast("binary").alias("sigs"), F.col("df_counts").alias("runs"), F.col("df_grams").alias("grams"),
        F.explode(F.sequence(F.lit(0), F.greatest(F.lit(1), "splits") - 1)).alias("split"),
    )
    # Fewer than one row for each four BUCKETs of entries.
    hot = split.where("splits > 1").select("bucket", "splits")
    parts = parts.join(F.broadcast(hot), "bucket", "left")
    parts = parts.withColumn("split", F.pmod(F.xxhash64("sigs"), F.coalesce("splits", F.lit(1))).cast("int")).drop("splits")
    rows = heads.unionByName(parts).withColumn("body", F.col("sigs").isNotNull())
    rows = rows.repartition("bucket", "split").sortWithinPartitions("bucket", "split", "body")
    return rows.select("bucket", "sigs", "runs", "grams").mapInArrow(giving_back(answered), "sig binary, bucket int, grams binary, counts binary")


def prefixes(shared: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """(sig, n, alone, last_count, last_gram, grams): the prefix of every class that shares one of it.

    ``grams`` are those of the prefix that other classes may have, in the global order, of which the
    last is (last_count, last_gram); ``alone`` is how many more of the prefix are the class's own.
    """

    def ordered(batches):
        for batch in batches:
            out = []
            for sig, n, s, ext, grams, counts in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                need = prefix_size(n, percent)
                own = np.frombuffer(b"".join(grams or []), _U)
                times = np.frombuffer(b"".join(counts or []), np.int64)
                alone = s - len(own)
                order = np.lexsort((own, times))[: max(0, need - alone)]
                first, last = own[order], int(times[order[-1]]) if len(order) else 0
                if ext is not None:
                    first, last = np.concatenate([first, np.frombuffer(ext, _U)]), 1 << 62
                if len(first):
                    out.append((sig, n, min(alone, need), last, int(_signed(first)[-1] ^ np.int64(-(1 << 63))), first.tobytes()))
            columns = list(zip(*out, strict=True)) or [[]] * 6
            kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["sig", "n", "alone", "last_count", "last_gram", "grams"])

    # Copies give the same rows: one of each class and bucket is kept before anything is gathered.
    one = shared.groupBy("sig", "bucket").agg(F.min("grams").alias("grams"), F.min("counts").alias("counts"))
    gathered = one.groupBy("sig").agg(F.sort_array(F.collect_list(F.struct("bucket", "grams", "counts"))).alias("x"))
    return (
        reps.join(gathered, "sig", "left")
        .where("x is not null or ext is not null")
        .select("sig", "n", "s", "ext", "x.grams", "x.counts")
        .mapInArrow(giving_back(ordered), "sig binary, n long, alone long, last_count long, last_gram long, grams binary")
    )


def rarest_first(own: DataFrame, percent: int) -> DataFrame:
    """As ``prefixes``, of the sets (sig, grams) alone, in an order of all their n-grams: by how many of the sets have it."""
    reps = own.select("sig", (F.length("grams") / 8).cast("long").alias("n"))
    reps = reps.select("sig", "n", F.col("n").alias("s"), F.lit(None).cast("binary").alias("ext"))
    buckets = max(8, -(-(reps.agg(F.sum("n")).first()[0] or 0) // BUCKET))
    found = checkpointed(frequencies(own, _of_sets, 0, buckets))
    return checkpointed(prefixes(shared_grams(own, found, _of_sets, 0, buckets), reps, percent))


def postings(prefix: DataFrame, percent: int) -> DataFrame:
    """(gram, sig, n, upto) of the prefixes, for n-grams that two of them have.

    If the n-gram is the first in the order that a similar set has as well, it misses all before it,
    so that set has ``upto`` n-grams at most.
    """

    def rows(batches):
        for batch in batches:
            n, alone = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            grams = [np.frombuffer(x, _U) for x in batch.column(3).to_pylist()]
            if grams:
                names = np.repeat(np.arange(len(grams)), [len(x) for x in grams])
                place = alone[names] + np.concatenate([np.arange(len(x)) for x in grams])
                upto = (n[names] - place) * (100 + percent) // percent - n[names]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_signed(np.concatenate(grams))), batch.column(0).take(pa.array(names)), pa.array(n[names]), pa.array(upto)],
                    names=["gram", "sig", "n", "upto"],
                )

    posted = prefix.select("sig", "n", "alone", "grams").mapInArrow(giving_back(rows), "gram long, sig binary, n long, upto long")
    many = posted.groupBy("gram").agg(F.count("*").alias("__m")).where("__m > 1")
    return posted.join(many, "gram").select("gram", "sig", "n", "upto")


def gram_sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(sig, grams): the whole sets of the wanted (sig, doc_id) classes, from one text of each."""

    def rows(batches):
        for batch in batches:
            sigs, grams = [], []
            for own, sig in zip(shingle_sets(batch.column(0), k), batch.column(1).to_pylist(), strict=True):
                if _signature(own) == sig:
                    sigs.append(sig)
                    grams.append(own.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(sigs, pa.binary()), pa.array(grams, pa.binary())], names=["sig", "grams"])

    texts = docs.join(wanted.hint("shuffle_hash"), docs["doc_id"].eqNullSafe(wanted["rep"])).select("text", "sig")
    return texts.mapInArrow(giving_back(rows), "sig binary, grams binary").dropDuplicates(["sig"])


class _Forest:
    """Union-find over the components of one block."""

    def __init__(self) -> None:
        self.up: dict = {}

    def find(self, x):
        while (y := self.up.get(x, x)) != x:
            self.up[x] = x = self.up.get(y, y)
        return x

    def join(self, x, y) -> None:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)


def trie_links(members: list, queries: list, percent: int) -> list[tuple[bytes, bytes]]:
    """Links that join the components of ``queries`` and ``members``: (sig, component, sorted set) each.

    The members in lexicographic order, with the length that each shares with the one before, are
    the trie: a walk over them is a walk over its branches. Pairs in one component are left out.
    """
    members = sorted(members, key=lambda m: m[2].astype(">u8").tobytes())
    shared = [0]
    for (_, _, a), (_, _, b) in zip(members, members[1:], strict=False):
        k = min(len(a), len(b))
        differ = np.flatnonzero(a[:k] != b[:k])
        shared.append(int(differ[0]) if len(differ) else k)
    sizes = [len(m[2]) for m in members]
    forest, links = _Forest(), []
    for sig, comp, own in queries:
        nq = len(own)
        longest = nq * 100 // percent
        met = np.zeros(longest + 2, dtype=np.int64)  # met[i]: how many of the first i of the branch are in the query
        depth, dead = 0, None  # known so far; the depth at which the branch was given up
        for j, (other, group, grams) in enumerate(members):
            depth = min(depth, shared[j])
            if dead is not None and shared[j] >= dead:
                continue
            dead = None
            n = sizes[j]
            if 100 * n < percent * nq or n > longest or other == sig or forest.find(group) == forest.find(comp):
                continue
            need = -(-percent * (n + nq) // (100 + percent))
            while depth < n:
                end = min(n, depth + 128)
                tail = grams[depth:end]
                at = np.searchsorted(own, tail)
                hit = own[np.minimum(at, nq - 1)] == tail
                met[depth + 1 : end + 1] = met[depth] + np.cumsum(hit)
                # Misses that no set below this branch can afford, whatever its size.
                missed = np.arange(depth + 1, end + 1) - met[depth + 1 : end + 1]
                given = np.flatnonzero(missed > longest - -(-percent * longest // 100))
                depth = end
                if len(given):
                    dead = end - len(tail) + int(given[0]) + 1
                    depth = min(depth, dead)
                    break
                left = min(n - depth, nq - int(at[-1]))
                if met[depth] + left < need:
                    break
            if dead is None and depth == n and met[n] >= need:
                links.append((sig, other))
                forest.join(group, comp)
    return links


def _slotted(groups: DataFrame) -> DataFrame:
    """Groups (key, block, ...) with the slot whose groups are handed over together.

    Most groups are a few rows, and each would cost more to hand over than to compare. A slot has
    some SLOT rows, or one group of more.
    """
    groups = checkpointed(groups)
    return groups.withColumn("slot", F.pmod(F.xxhash64("key", "block"), F.lit(groups.count() // SLOT + 1)))


def _each(pdf: pd.DataFrame) -> Iterator[np.ndarray]:
    """Row numbers of each group of a slot."""
    group = pd.factorize(pdf["key"])[0] * np.int64(len(pdf) + 1) + pd.factorize(pdf["block"])[0]
    order = np.argsort(group, kind="stable")
    yield from np.split(order, np.flatnonzero(np.diff(group[order])) + 1)


def verified_links(groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): links found within the groups (key, block, sig, comp, asks, held) by the prefix-tree join."""

    def found(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = [(s, c, np.frombuffer(g, _U)) for s, c, g in zip(pdf["sig"], pdf["comp"], pdf["grams"], strict=True)]
        asks, held = pdf["asks"].to_numpy(dtype=bool), pdf["held"].to_numpy(dtype=bool)
        out: list = []
        for group in _each(pdf):
            out += trie_links([rows[i] for i in group if held[i]], [rows[i] for i in group if asks[i]], percent)
        return pd.DataFrame(out, columns=["a", "b"])

    links = checkpointed(_slotted(groups).join(sets, "sig").groupBy("slot").applyInPandas(found, "a binary, b binary").distinct())
    release(sets.sparkSession)
    return links


def _block_of(size: str, block: int):
    """The block of a class in a group of ``size``, in blocks of some ``block``."""
    return F.pmod(F.xxhash64("sig"), F.ceil(F.col(size) / block)).cast("int")


def _first_pairs(posted: DataFrame) -> DataFrame:
    """(a, b): under each n-gram, its smallest class and every other."""
    least = posted.groupBy("gram").agg(F.min("sig").alias("a"))
    return posted.join(least, "gram").where("sig <> a").select("a", F.col("sig").alias("b")).distinct()


def _centre_pairs(lists: DataFrame) -> DataFrame:
    """(a, b): under each n-gram, the class with the fewest rarer n-grams and those that it may be similar to."""
    top = lists.groupBy("gram").agg(F.max(F.struct("upto", "sig", "n", "comp")).alias("top"))
    pairs = lists.join(top, "gram").where("comp <> top.comp and n <= top.upto and top.n <= upto")
    return pairs.select(F.col("top.sig").alias("a"), F.col("sig").alias("b")).distinct()


def _undecided(posted: DataFrame, roots: DataFrame) -> DataFrame:
    """(gram, m, sig, n, upto, comp): the n-grams whose m classes are in several components.

    Of n-grams with the very same classes the first in the order is left.
    """
    known = posted.join(roots, posted["sig"] == roots["node"], "left").select("gram", "sig", "n", "upto", F.coalesce("root", "sig").alias("comp"))
    by_comp = known.groupBy("gram", "comp").agg(F.count("*").alias("c"), F.sum("upto").alias("u"), F.sum(F.xxhash64("sig").cast("decimal(38,0)")).alias("h"))
    several = by_comp.groupBy("gram").agg(F.count("*").alias("comps"), F.sum("c").alias("m"), F.sum("u").alias("u"), F.sum("h").alias("h"))
    lists = several.where("comps > 1").groupBy("m", "h").agg(F.max(F.struct("u", "gram"))["gram"].alias("gram"))
    return known.join(lists.select("gram", "m"), "gram")


def _block_groups(rows: DataFrame, block: int, *columns: str) -> DataFrame:
    """Groups of blocks from (key, sig, comp) and ``columns``: all but the largest component of a key ask all of it."""
    by_comp = rows.groupBy("key", "comp").agg(F.count("*").alias("c"))
    of = by_comp.groupBy("key").agg(F.sum("c").alias("m"), F.max(F.struct("c", "comp")).alias("top"))
    of = of.select("key", "m", (F.col("m") - F.col("top.c")).alias("k"), F.col("top.comp").alias("top")).where("k > 0")
    rows = rows.join(of, "key")
    every = lambda size: F.explode(F.sequence(F.lit(0), (F.ceil(F.col(size) / block) - 1).cast("int")))
    held = rows.select("key", _block_of("m", block).alias("h"), every("k").alias("q"), "sig", "comp", *columns, F.lit(False).alias("asks"), F.lit(True).alias("held"))
    asks = rows.where("comp <> top").select("key", every("m").alias("h"), _block_of("k", block).alias("q"), "sig", "comp", *columns, F.lit(True).alias("asks"), F.lit(False).alias("held"))
    number = F.col("h").cast("long") * (1 << 31) + F.col("q")
    return held.union(asks).select("key", number.alias("block"), "sig", "comp", *columns, "asks", "held")


def _parities(grams: np.ndarray) -> bytes:
    """How often each of some bits is hit, modulo 2: two sets differ in no fewer n-grams than bits.

    There are four to eight bits an n-gram, a power of 2. Both halves added up are those of half as many bits.
    """
    bits = min(MAX_BITS, 1 << max(6, (4 * len(grams) - 1).bit_length()))
    return np.packbits((np.bincount((grams & _U(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(bool)).tobytes()


def parities(own: DataFrame) -> DataFrame:
    """(sig, bits) of the sets (sig, grams)."""

    def rows(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([_parities(grams) for _, grams in _of_sets(batch)], pa.binary())], names=["sig", "bits"])

    return own.mapInArrow(giving_back(rows), "sig binary, bits binary")


def _folded(bits: np.ndarray, width: int) -> np.ndarray:
    while bits.shape[-1] > width:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


def close_pairs(groups: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b) of the groups (key, block, sig, comp, n, upto, asks, held), of different components, that may be similar.

    Sets are similar if they differ in few n-grams; they differ in no fewer than their parities do.
    """

    def found(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("n", kind="stable")
        n, upto, sigs = pdf["n"].to_numpy(), pdf["upto"].to_numpy(), pdf["sig"].to_numpy()
        holds, questions, comp = pdf["held"].to_numpy(dtype=bool), pdf["asks"].to_numpy(dtype=bool), pd.factorize(pdf["comp"])[0]
        own = [np.frombuffer(x, _U) for x in pdf["bits"]]
        out: list = []
        for group in _each(pdf):
            held, asks = group[holds[group]], group[questions[group]]
            if not len(held):
                continue
            size, most, parts = n[held], upto[held], comp[held]
            widths = np.array([len(own[i]) for i in held])  # these grow with the size
            runs = [(a, b, {int(widths[a]): np.stack([own[i] for i in held[a:b]])}) for a, b in _runs(np.flatnonzero(np.diff(widths, prepend=0)), len(held))]
            for x in asks:
                low, high = np.searchsorted(size, -(-percent * n[x] // 100)), np.searchsorted(size, upto[x], "right")
                may = low + np.flatnonzero((most[low:high] >= n[x]) & (parts[low:high] != comp[x]))
                for a, b, tables in runs:
                    these = may[np.searchsorted(may, a) : np.searchsorted(may, b)]
                    if not len(these):
                        continue
                    width = min(int(widths[a]), len(own[x]))
                    if width not in tables:
                        tables[width] = _folded(tables[int(widths[a])], width)
                    apart = np.bitwise_count(tables[width][these - a] ^ _folded(own[x], width)).sum(axis=1, dtype=np.int64)
                    both = n[x] + size[these]
                    for y in held[these[apart <= both - 2 * -(-percent * both // (100 + percent))]]:
                        out.append((min(sigs[x], sigs[y]), max(sigs[x], sigs[y])))
        return pd.DataFrame(out, columns=["a", "b"])

    return _slotted(groups).join(bits, "sig").groupBy("slot").applyInPandas(found, "a binary, b binary").distinct()


def near_pairs(groups: DataFrame, of: DataFrame, prefix: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b) of the groups, of different components, that the prefixes do not rule out.

    Of two prefixes, the one that ends first in the global order misses all it does not share. A
    pair is given by the first of the groups that both are in, and by none if both are ``dense``.
    """

    def found(pdf: pd.DataFrame) -> pd.DataFrame:
        grams = [np.frombuffer(g, _U) for g in pdf["grams"]]
        n, alone = pdf["n"].to_numpy(), pdf["alone"].to_numpy()
        size = alone + np.array([len(g) for g in grams])
        ends = np.lexsort((pdf["last_gram"], pdf["last_count"]))
        steps = (np.diff(pdf["last_gram"].to_numpy()[ends]) != 0) | (np.diff(pdf["last_count"].to_numpy()[ends]) != 0)
        rank = np.empty(len(ends), dtype=np.int64)
        rank[ends] = np.r_[0, np.cumsum(steps)]
        comp = pd.factorize(pdf["comp"])[0]
        holds, questions, sigs, key = pdf["held"].to_numpy(dtype=bool), pdf["asks"].to_numpy(dtype=bool), pdf["sig"].to_numpy(), pdf["key"].to_numpy()
        keys = [np.asarray(x, dtype=np.int64) for x in pdf["keys"]]
        dense = pdf["dense"].notna().to_numpy()
        out: list = []
        for group in _each(pdf):
            held, asks = group[holds[group]], group[questions[group]]
            if not len(held):
                continue
            flat = np.concatenate([grams[i] for i in held])
            owner = np.repeat(np.arange(len(held)), [len(grams[i]) for i in held])
            order = np.argsort(flat)
            flat, owner = flat[order], owner[order]
            before = [keys[i][: np.searchsorted(keys[i], key[i])] for i in held]
            first_flat = np.concatenate(before)
            first_owner = np.repeat(np.arange(len(held)), [len(x) for x in before])
            for x in asks:
                low, high = np.searchsorted(flat, grams[x], "left"), np.searchsorted(flat, grams[x], "right")
                counts = high - low
                at = np.repeat(low - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
                common = np.bincount(owner[at], minlength=len(held))
                need = -(-percent * (n[x] + n[held]) // (100 + percent))
                mine = np.where(rank[x] <= rank[held], size[x] - common, alone[x])
                theirs = np.where(rank[held] <= rank[x], size[held] - common, alone[held])
                good = (comp[held] != comp[x]) & (mine <= n[x] - need) & (theirs <= n[held] - need)
                own = keys[x][: np.searchsorted(keys[x], key[x])]
                if len(own) and good.any():
                    good[first_owner[np.isin(first_flat, own)]] = False
                if dense[x]:
                    good &= ~dense[held]
                out.extend((min(sigs[x], sigs[y]), max(sigs[x], sigs[y])) for y in held[good])
        return pd.DataFrame(out, columns=["a", "b"])

    return _slotted(groups).join(prefix, "sig").join(of, "sig", "left").groupBy("slot").applyInPandas(found, "a binary, b binary").distinct()


def _pair_groups(pairs: DataFrame, roots: DataFrame | None = None) -> DataFrame:
    """Groups that hold the partners of each class in ``pairs`` (a, b), and ask for it."""
    of = pairs.groupBy(F.col("a").alias("key")).agg(F.count("*").alias("m"))
    held = pairs.select(F.col("a").alias("key"), F.col("b").alias("sig")).join(of, "key").select("key", _block_of("m", BLOCK).alias("block"), "sig")
    asks = of.select("key", F.explode(F.sequence(F.lit(0), (F.ceil(F.col("m") / BLOCK) - 1).cast("int"))).alias("block"), F.col("key").alias("sig"))
    both = held.withColumn("asks", F.lit(False)).union(asks.withColumn("asks", F.lit(True)))
    both = both.withColumn("held", ~F.col("asks"))
    if roots is None:
        return both.withColumn("comp", F.col("sig"))
    return both.join(roots, both["sig"] == roots["node"], "left").withColumn("comp", F.coalesce("root", "sig")).drop("node", "root")


def _linked_rows(docs: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> DataFrame:
    """For every row: doc_id, sig, n, and of its component, if it has more rows: the smallest doc_id, and the first row."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    own = checkpointed(classes(docs, k, percent))
    total = own.agg(F.sum("s")).first()[0] or 0
    buckets = max(8, -(-total // BUCKET))
    reps = own.where("n > 0").groupBy("sig").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.max("s").alias("s"), F.max("ext").alias("ext"))
    texts = docs.select("text")
    found = checkpointed(frequencies(texts, _of_texts(k), percent, buckets))
    prefix = checkpointed(prefixes(shared_grams(texts, found, _of_texts(k), percent, buckets), reps, percent))
    posted = checkpointed(postings(prefix, percent))
    del found
    release(docs.sparkSession)
    wanted = posted.select("sig").distinct().join(reps.select("sig", "rep"), "sig")
    sets = staged(gram_sets(docs, wanted, k), "sets")
    release(docs.sparkSession)
    # First, under each n-gram, the smallest class against the others.
    links = verified_links(_pair_groups(_first_pairs(posted)), sets, percent)
    roots = components(links)
    # Then the classes of long lists, by the rarest of all their n-grams.
    lists = checkpointed(_undecided(posted, roots))
    dense = checkpointed(lists.where(F.col("m") >= DENSE).select("sig").distinct())
    pairs = None
    if not dense.isEmpty():
        chosen = staged(sets.join(dense, "sig"), "dense")
        rare = checkpointed(postings(rarest_first(chosen, percent), percent))
        release(docs.sparkSession)
        more = verified_links(_pair_groups(_centre_pairs(_undecided(rare, roots)), roots), chosen, percent)
        if not more.isEmpty():
            links = checkpointed(links.union(more))
            roots = components(links)
        left = _undecided(rare, roots).select(F.col("gram").alias("key"), "sig", "comp", "n", "upto")
        pairs = close_pairs(_block_groups(left, MAX_FAMILY, "n", "upto"), parities(chosen), percent)
    # Last, the short lists that are left; pairs of classes of long lists are known by now.
    lists = checkpointed(_undecided(posted, roots).where(F.col("m") < DENSE))
    of = lists.groupBy("sig").agg(F.sort_array(F.collect_list("gram")).alias("keys"))  # no more than its prefix
    of = of.join(dense.withColumn("dense", F.lit(True)), "sig", "left")
    groups = _block_groups(lists.select(F.col("gram").alias("key"), "sig", "comp"), BLOCK)
    near = near_pairs(groups, of, prefix, percent)
    pairs = checkpointed(near if pairs is None else pairs.union(near).distinct())
    more = verified_links(_pair_groups(pairs, roots), sets, percent)
    if not more.isEmpty():
        roots = components(links.union(more))
    marked = own.join(roots, own["sig"] == roots["node"], "left").select("doc_id", "sig", "n", F.coalesce("root", "sig").alias("root"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "sig"))
    by_root = marked.where("n > 0").groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("c"), first.alias("first")).where("c > 1")
    # A group may hold a third of all rows: its rows are salted.
    salts = 16
    by_root = by_root.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    marked = marked.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int"))
    return marked.join(by_root, ["root", "salt"], "left").select("doc_id", "sig", "n", "component_id", "first")


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """For every row of ``docs``: doc_id, n_shingles, component_id.

    Documents are linked when ``100 * |A & B| >= percent * |A | B|`` holds for their sets of
    distinct k-word n-grams; ``component_id`` is the smallest doc_id that links reach. A null or
    empty text has an empty set and is linked with nothing. Rows that repeat a doc_id are linked by
    their own texts; a null doc_id has part in links, and its component_id is null only if no other
    row of the component has an identifier. An empty table gives no rows.
    """
    linked = _linked_rows(docs, id_col, text_col, k, percent)
    return linked.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"))


def drop_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without those linked to a row that stays: one row of each component.

    That is the row with the smallest identifier, a null one only if there is no other; of several
    rows with this identifier the one with the smallest digest of its n-grams, and of those one.
    Rows that repeat an identifier go or stay by their own texts.
    """
    linked = _linked_rows(docs, id_col, text_col, k, percent).where("n > 0 and first is not null")
    stays = F.col("doc_id").eqNullSafe(F.col("first")["doc_id"]) & (F.col("sig") == F.col("first")["sig"])
    rows = linked.groupBy(F.col("doc_id").alias("__id"), F.col("sig").alias("__sig")).agg(F.max(stays).alias("__stays"), F.count("*").alias("__c"))
    # Stored first, so that Spark knows its size, and need not shuffle the texts if it is small.
    found = staged(rows.where("not __stays or __c > 1"), "dropped")
    own = F.col(id_col).cast("long")
    often = docs.groupBy(own.alias("__own")).count().where("count > 1")
    if often.join(found, often["__own"].eqNullSafe(found["__id"]), "left_semi").isEmpty():
        # No identifier of a row that goes is that of another row.
        return docs.join(found, own.eqNullSafe(found["__id"]), "left_anti")

    def signatures(texts: pd.Series) -> pd.Series:
        return pd.Series([_signature(grams) for grams in shingle_sets(pa.array(texts, pa.string(), from_pandas=True), k)])

    marked = docs.withColumn("__sig", F.pandas_udf(signatures, "binary")(F.col(text_col).cast("string")))
    same = lambda other: own.eqNullSafe(other["__id"]) & (marked["__sig"] == other["__sig"])
    gone, repeated = found.where("not __stays"), found.where("__stays")
    kept = marked.join(gone, same(gone), "left_anti")
    if not repeated.isEmpty():
        once = kept.join(repeated, same(repeated), "left_semi").dropDuplicates([id_col, "__sig"])
        kept = kept.join(repeated, same(repeated), "left_anti").unionByName(once)
    return kept.select(*docs.columns)
