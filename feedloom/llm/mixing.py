"""Mixing sources to target weights by fixed-length blocks of words.

The words of a source, its documents one after another, are cut into blocks of a fixed number of
words. The mix is a sequence of slots, a fixed number to an output shard. Every shard draws how
many of its slots each source gets from a multinomial distribution with the target shares, by
generators seeded with the shard's number: first how many each range of sources gets, and then, range by
range, how many each source of it. Sources are rows of a table, as many as there are; what a task or
the driver holds is a number for each range. The slots of a source, counted through all shards, run
through its blocks in passes, each pass in the order of a pseudorandom permutation of the block
index that is computed, not stored; blocks are then joined by index.

Draws leave sources some slots above or below their target. The last slots of those above go to
those below, and a source's last slot is cut to the words still due, so that every source's words
are its target, rounded. A pass takes a word once, and a target is at most ``cap`` passes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import checkpointed, giving_back, numbered, release, running, small_batches, staged

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
BLOCK_WORDS = 512
SHARD_SLOTS = 1024
RANGE, CHUNK = 4096, 8192  # sources of a range, and shards that draw from a range together
UNITS = 4096  # slots that move from source to source, cut into pieces that meet


def _feistel(x: np.ndarray, size: int, seed: int, back: bool) -> np.ndarray:
    """Four Feistel rounds over the smallest even number of bits that holds ``size``, or their inverse."""
    half = np.uint64(max(1, (max(1, int(size) - 1).bit_length() + 1) // 2))
    low = (np.uint64(1) << half) - np.uint64(1)
    keys = np.random.default_rng([7, seed]).integers(1, 1 << 62, 4).astype(np.uint64)

    def part(b: np.ndarray, key: np.uint64) -> np.ndarray:
        f = (b + key) * np.uint64(0x9E3779B97F4A7C15)
        return (((f ^ (f >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(32)) & low

    a, b = x >> half, x & low
    for key in keys[::-1] if back else keys:
        a, b = (b ^ part(a, key), a) if back else (b, a ^ part(b, key))
    return (a << half) | b


def permuted(index: np.ndarray, size: int, seed: int, back: bool = False) -> np.ndarray:
    """A pseudorandom permutation of 0..size-1 at the given indices, or its inverse: walked until inside."""
    x = _feistel(np.atleast_1d(index).astype(np.uint64), size, seed, back)
    while (out := x >= np.uint64(size)).any():
        x[out] = _feistel(x[out], size, seed, back)
    return x.astype(np.int64)


@dataclass(frozen=True)
class Source:
    """One source's part of the plan: its words, blocks, whole passes, and the words of the last pass."""

    number: int
    size: int
    passes: int
    rest: int
    block: int
    short: int = 0

    @classmethod
    def planned(cls, number: int, size: int, target: float, block: int, cap: int) -> Source:
        due = min(round(target), cap * size)
        passes = due // size if size else 0
        own = cls(number, size, passes, due - passes * size, block)
        # Where the last pass meets the source's last, shorter block.
        at = permuted(np.array([own.blocks - 1]), own.blocks, own.seed(passes), back=True)[0] if own.rest else 0
        return replace(own, short=int(at))

    @property
    def blocks(self) -> int:
        return -(-self.size // self.block)

    @property
    def slots(self) -> int:
        if not self.rest:
            return self.passes * self.blocks
        plain = -(-self.rest // self.block)
        if plain > self.short:
            plain = -(-(self.rest + self.missing) // self.block)
        return self.passes * self.blocks + plain

    @property
    def missing(self) -> int:
        """Words that the last block lacks."""
        return self.block * self.blocks - self.size

    def seed(self, turn: int) -> int:
        return self.number * 8 + int(turn)

    def taken(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pass, block, words) of the slots with these numbers."""
        turn, k = index // self.blocks, index % self.blocks
        block = np.empty(len(index), dtype=np.int64)
        for t in np.unique(turn):
            mine = turn == t
            block[mine] = permuted(k[mine], self.blocks, self.seed(t))
        words = np.minimum(self.block, self.size - block * self.block)
        last = turn == self.passes
        if last.any():
            before = k[last] * self.block - np.where(k[last] > self.short, self.missing, 0)
            words[last] = np.clip(self.rest - before, 0, words[last])
        return turn, block, words


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(row, doc_id, source, size): the words of every row's whole text."""
    row = F.col("__row") if "__row" in docs.columns else F.monotonically_increasing_id()
    return checkpointed(
        docs.select(
            row.alias("row"), F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
            F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        )
    )


def with_targets(sources: DataFrame, cap: int) -> DataFrame:
    """Sources (size, weight) with ``target``: shares of the whole size by weight, none above ``cap`` times its own.

    What is above is shared anew by weight. A share for each unit of weight only rises from round to
    round, so a source that was above stays so, and a round is one sum over all sources.
    """
    full, known = F.lit(False), -1
    total = sources.agg(F.sum("size")).first()[0] or 0
    while True:
        sums = sources.agg(
            F.sum(F.when(full, F.col("size") * cap).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("weight"))), F.count_if(full)
        ).first()
        left, weight = float(total - (sums[0] or 0)), float(sums[1] or 0)
        share = F.lit(left) * F.col("weight") / F.lit(weight) if weight else F.lit(0.0)
        if sums[2] == known or not weight:
            return sources.withColumn("target", F.when(full, (F.col("size") * cap).cast("double")).otherwise(share))
        known, full = sums[2], full | (share > F.col("size") * cap)


def source_plan(rows: DataFrame, weights: tuple = WEIGHTS, block: int = BLOCK_WORDS, cap: int = 3) -> DataFrame:
    """One row of each source: (source, source_no, size, target, passes, rest, short, block, slots)."""
    found = rows.groupBy("source").agg(F.sum("size").alias("size")).withColumn("tree", F.lit("all"))
    # By code point, which is the order of UTF-8 bytes; null last.
    found = numbered(found, "tree", [F.col("source").asc_nulls_last()]).withColumnRenamed("number", "source_no")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("source_no") % len(weights) + 1).cast("int"))
    found = with_targets(checkpointed(found.select("source", "source_no", "size", weight.alias("weight"))), cap)

    def planned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            plans = [Source.planned(int(n), int(size), target, block, cap) for n, size, target in zip(pdf["source_no"], pdf["size"], pdf["target"], strict=True)]
            columns = {name: np.array([getattr(p, name) for p in plans], dtype=np.int64) for name in ("passes", "rest", "short", "block", "slots")}
            yield pdf.assign(**columns)

    schema = "source string, source_no long, size long, target double, passes long, rest long, short long, block long, slots long"
    plan = checkpointed(found.select("source", "source_no", "size", "target").mapInPandas(planned, schema))
    release(rows.sparkSession)
    return plan


def _drawn(plan: DataFrame, total: int, shard_slots: int, seed: int) -> DataFrame:
    """(shard, source_no, count): how many slots of each shard each source is drawn for."""
    shards = -(-total // shard_slots)
    ranged = plan.where("slots > 0").withColumn("range", F.expr(f"source_no div {RANGE}"))
    sums = ranged.groupBy("range").agg(F.sum("slots").alias("n")).orderBy("range").collect()
    names, ends = np.array([r["range"] for r in sums]), np.cumsum([r["n"] for r in sums])
    sizes = {r["range"]: r["n"] for r in sums}

    def by_range(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for shard in pdf["id"]:
                size = min(shard_slots, total - int(shard) * shard_slots)
                hit = np.searchsorted(ends, np.random.default_rng([seed, int(shard)]).integers(0, total, size), "right")
                at, count = np.unique(hit, return_counts=True)
                yield pd.DataFrame({"shard": shard, "range": names[at], "count": count})

    def by_source(draws: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("source_no")
        number, last, out = own["source_no"].to_numpy(), np.cumsum(own["slots"].to_numpy()), []
        for shard, part, count in zip(draws["shard"], draws["range"], draws["count"], strict=True):
            hit = np.random.default_rng([seed, int(shard), int(part)]).integers(0, sizes[part], count)
            at, found = np.unique(np.searchsorted(last, hit, "right"), return_counts=True)
            out.append(pd.DataFrame({"shard": shard, "source_no": number[at], "count": found}))
        return pd.concat(out) if out else pd.DataFrame({"shard": [], "source_no": [], "count": []})

    chunk = F.expr(f"shard div {CHUNK}")
    ranges = plan.sparkSession.range(shards).mapInPandas(by_range, "shard long, range long, count long").withColumn("chunk", chunk)
    every = F.explode(F.sequence(F.lit(0), F.lit((shards - 1) // CHUNK)).cast("array<long>"))
    own = ranged.select("range", "source_no", "slots", every.alias("chunk"))
    both = ranges.groupBy("range", "chunk").cogroup(own.groupBy("range", "chunk"))
    return checkpointed(both.applyInPandas(by_source, "shard long, source_no long, count long"))


def slots(plan: DataFrame, shard_slots: int = SHARD_SLOTS, seed: int = 11) -> DataFrame:
    """The mix: (shard, drawn, source_no, pass, block, words) of every slot.

    A source drawn more often than it has slots gives its last ones to sources drawn less often:
    both are numbered through, and numbers that are equal meet.
    """
    total, many = plan.agg(F.coalesce(F.sum("slots"), F.lit(0)), F.count("*")).first()
    shards = max(1, -(-total // shard_slots))
    drawn = _drawn(plan, total, shard_slots, seed) if total else plan.sparkSession.createDataFrame([], "shard long, source_no long, count long")
    sums = plan.select("source_no", "slots").join(drawn.groupBy("source_no").agg(F.sum("count").alias("got")), "source_no", "left")
    sums = sums.withColumn("got", F.coalesce("got", F.lit(0))).withColumn("one", F.lit(1))
    sums = checkpointed(sums.withColumn("units", F.abs(F.col("got") - F.col("slots"))))
    line = lambda rows, out: running(rows, ["one"], "units", ["source_no"], many, out)
    # Each step is stored before the next: as one plan they are planned anew with every stage that ends, and the
    # driver's memory fills with plans.
    over = checkpointed(line(sums.where("got > slots"), "at").select("source_no", "slots", "at", "units"))
    under = line(sums.where("got < slots"), "at").select("source_no", "got", "at", "units")
    piece = F.explode(F.sequence(F.expr(f"at div {UNITS}"), F.expr(f"(at + units - 1) div {UNITS}")))
    a = over.withColumn("piece", piece).select("piece", F.col("source_no").alias("drawn"), F.col("at").alias("a"), (F.col("at") + F.col("units")).alias("a_end"))
    b = under.withColumn("piece", piece).select("piece", "source_no", "got", F.col("at").alias("b"), (F.col("at") + F.col("units")).alias("b_end"))
    met = a.join(b, "piece")
    low = F.greatest("a", "b", F.col("piece") * UNITS)
    high = F.least("a_end", "b_end", (F.col("piece") + 1) * UNITS)
    moves = met.select("drawn", "source_no", low.alias("low"), high.alias("high"), (F.col("got") + low - F.col("b")).alias("number")).where("low < high")
    moves = checkpointed(moves)
    # Of each shard's slots of a source those within the source's own, and those that move.
    first = running(drawn, ["source_no"], "count", ["shard"], shards, "first").join(plan.select("source_no", "slots"), "source_no")
    first = checkpointed(first)
    own = first.select("shard", F.col("source_no").alias("drawn"), "source_no", "first", F.least("count", F.col("slots") - F.col("first")).alias("count"))
    late = first.where("first + count > slots").withColumnRenamed("source_no", "drawn").join(over.select(F.col("source_no").alias("drawn"), "at"), "drawn")
    late = late.withColumn("begin", F.col("at") + F.greatest("first", "slots") - F.col("slots")).withColumn("end", F.col("at") + F.col("first") + F.col("count") - F.col("slots"))
    late = late.select("shard", "drawn", "begin", "end").join(moves, "drawn").where("begin < high AND low < end")
    begin, end = F.greatest("begin", "low"), F.least("end", "high")
    moved = late.select("shard", "drawn", "source_no", (F.col("number") + begin - F.col("low")).alias("first"), (end - begin).alias("count"))
    parts = own.where("count > 0").unionByName(moved).join(plan.select("source_no", "size", "passes", "rest", "short", "block"), "source_no")

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                source = Source(int(r.source_no), int(r.size), int(r.passes), int(r.rest), int(r.block), int(r.short))
                turn, block, words = source.taken(np.arange(r.first, r.first + r.count))
                yield pd.DataFrame({"shard": r.shard, "drawn": r.drawn, "source_no": r.source_no, "pass": turn, "block": block, "words": words})

    # A row stands for up to a shard of slots: few bytes, but work for many tasks.
    parts = parts.repartition(shards // 16 + 1, "shard", "source_no")
    parts = checkpointed(parts.select("shard", "drawn", "source_no", "first", "count", "size", "passes", "rest", "short", "block"))
    release(plan.sparkSession)
    return parts.mapInPandas(giving_back(deal), "shard long, drawn long, source_no long, pass long, block long, words long")


def takes(rows: DataFrame, plan: DataFrame, block: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """(row, pass, first, last): the words of every row that the mix takes, by pass; last is exclusive."""
    number = plan.select(F.col("source").alias("name"), "source_no")
    placed = rows.where("size > 0").join(number, F.col("source").eqNullSafe(F.col("name"))).select("row", "doc_id", "size", "source_no")
    placed = running(placed, ["source_no"], "size", ["doc_id", "size", "row"], rows.count(), "start", ["doc_id", "size"])
    placed = checkpointed(placed)
    pieces = placed.withColumn("block", F.explode(F.sequence(F.expr(f"start div {block}"), F.expr(f"(start + size - 1) div {block}"))))
    # Spark cannot know how many slots a shard is, and would take them for few enough to broadcast.
    joined = pieces.join(slots(plan, shard_slots).hint("merge"), ["source_no", "block"])
    first = F.greatest(F.lit(0), F.col("block") * block - F.col("start"))
    last = F.least(F.col("size"), F.col("block") * block + F.col("words") - F.col("start"))
    return joined.select("row", "pass", first.alias("first"), last.alias("last")).where("first < last")


def mix_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """For every row of ``docs``: doc_id, size, source_size, target, taken.

    A null text has no words; a row without words is taken zero times. A null source is a source of
    its own, the last. Rows that repeat an identifier count each for itself; other columns have no
    part. An empty table gives no rows. The mix depends on the rows, not on how they are stored.
    """
    rows = sized(docs, id_col, text_col, source_col)
    plan = source_plan(rows)
    found = plan.select(F.col("source").alias("s"), F.col("size").alias("source_size"), "target")
    sums = takes(rows, plan).groupBy("row").agg(F.sum(F.col("last") - F.col("first")).alias("taken"))
    return (
        rows.join(found, rows["source"].eqNullSafe(found["s"]))
        .join(sums, "row", "left")
        .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
    )


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", length_col: str = "n_chars") -> DataFrame:
    """The mix as documents: for each pass that takes words of a row, the row with those words.

    A row taken whole keeps its text as it is, which does not go through Python; of one taken in part
    the runs of words are kept as they stand, joined by a line break. Columns are those of ``docs``;
    ``length_col``, if there, becomes the length of the new text.
    """
    small_batches(docs.sparkSession)
    held = staged(docs.withColumn("__row", F.monotonically_increasing_id()), "mix")
    rows = sized(held, id_col, text_col, source_col)
    plan = source_plan(rows)
    names = docs.columns
    # A pass takes a word once, so a row of which it takes as many words as there are is taken whole.
    parts = takes(rows, plan).groupBy("row", "pass").agg(
        F.sort_array(F.collect_list(F.struct("first", "last"))).alias("__parts"), F.sum(F.col("last") - F.col("first")).alias("__taken")
    )
    parts = parts.join(rows.select("row", "size"), "row")
    parts = parts.select(F.col("row").alias("__row"), F.when(F.col("__taken") < F.col("size"), F.col("__parts")).alias("__parts"))

    def cut(text: pd.Series, runs: pd.Series) -> pd.Series:
        out = []
        for t, r in zip(text, runs, strict=True):
            if t is None:
                out.append(None)
                continue
            spans: list[list[int]] = []
            for x in r:
                if spans and x["first"] <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], x["last"])
                else:
                    spans.append([x["first"], x["last"]])
            at = [m.span() for m in re.finditer(WORD, t)]
            out.append("\n".join(t[at[a][0] : at[b - 1][1]] for a, b in spans))
        return pd.Series(out, dtype=object)

    mix = held.join(parts, "__row")
    partly = F.pandas_udf(cut, "string")(F.when(F.col("__parts").isNotNull(), F.col(text_col)), F.col("__parts"))
    mix = mix.withColumn(text_col, F.coalesce(partly, F.col(text_col)))
    if length_col in names:
        mix = mix.withColumn(length_col, F.char_length(text_col).cast(docs.schema[length_col].dataType))
    return mix.select(*names)
