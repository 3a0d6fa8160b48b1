"""Helpers that several operators of this package share."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedloom.session import shared_folder

FOREST = 1 << 17  # links that a task joins to trees by itself
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20  # of texts that a Python worker gets at once


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once, its lineage cut, below ``spark.checkpoint.dir``.

    For tables of small rows; Spark removes the files when the frame is no longer used.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark, "checkpoints"))
    return df.checkpoint(eager=True)


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to Parquet in the shared folder, and read from there."""
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of steps whose results are stored by now.

    It does so when the driver collects its garbage, which a driver with little to do puts off
    while executors' disks fill.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def small_batches(spark: SparkSession) -> None:
    """From now on Python workers of this session get some ``BATCH_BYTES`` at once, if it sets no bound itself.

    Spark's own bounds, 10,000 rows and 64 MB, let a batch be all texts of a task: the executor holds
    them beside its heap, twice while a buffer grows, and the worker once more with what it makes of them.
    """
    if BATCH not in spark.conf.getAll:
        spark.conf.set(BATCH, BATCH_BYTES)


def give_back() -> None:
    """Hand memory that this process no longer uses back to the system.

    Python workers outlive their tasks, and their allocators keep what was freed: some 100 MB beside
    what the next stage takes. Where the C library cannot be asked, only Arrow's memory goes.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def giving_back(function: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function of batches that leaves its worker without freed memory when it ends."""

    @functools.wraps(function)
    def run(batches: Iterator) -> Iterator:
        try:
            yield from function(batches)
        finally:
            give_back()

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def smallest_hashes(df: DataFrame, by: list[str], size: int, likely: float = 0.25) -> DataFrame:
    """At most ``size`` rows, those with the smallest hashes of ``by``: a sample that reruns repeat.

    Only rows below a bound on the hash are sorted, so many that ``size`` are left although no more
    than a share ``likely`` of the rows may be in ``df``; a table of any size sends a bounded
    number of rows to the sort.
    """
    share = min(1.0, size / likely / max(1, df.count()))
    h = F.xxhash64(*by)
    low = df if share == 1 else df.where(h < F.lit(int(share * 2**64) - 2**63))
    return low.orderBy(h, *by).limit(size)


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b): every node of the links of one task with the smallest node that they reach from it."""
    up: dict = {}

    def find(x):
        while (y := up.get(x, x)) != x:
            up[x] = x = up.get(y, y)
        return x

    kind = None
    for batch in batches:
        kind = batch.schema.field(0).type
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                up[max(a, b)] = min(a, b)
    if up:
        yield pa.RecordBatch.from_arrays([pa.array(list(up), kind), pa.array([find(x) for x in list(up)], kind)], names=["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """Connected components: (node, root) for every node of ``links`` (a, b).

    ``root`` is the smallest node of the component. The links are dealt to tasks, some ``FOREST`` to
    each however many there are, and a task leaves each of its nodes one link, to the smallest
    node that it can reach. Links that filled one task are done with that. The trees of several
    are joined by alternating large-star and small-star rounds, each one join of the edges with the
    smallest neighbour of their node: what a round holds is never more than the edges. The
    smallest neighbour is an aggregate with a map side, and a hot node only makes a skewed join,
    which Spark splits. A round is some ten stages, which cost the driver, and its logs, the more the
    more partitions there are; few links are not worth that.
    """
    edges = checkpointed(links.select("a", "b").where("a <> b").distinct())
    kind = edges.schema["a"].dataType.simpleString()
    parts = edges.count() // FOREST + 1
    edges = checkpointed(edges.repartition(parts).mapInArrow(giving_back(_trees), f"a {kind}, b {kind}"))
    release(links.sparkSession)
    before = None
    while parts > 1:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
        root = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(root, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = checkpointed(small.union(root.select("a", F.col("m").alias("b"))).distinct())
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        del both, least, large, down, root, small
        release(links.sparkSession)
        if state == before:
            break
        before = state
    # By now every edge leads from a node straight to its root.
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def running(df: DataFrame, key: list[str], size: str, order: list[str], rows: int, out: str, deal: list[str] | None = None) -> DataFrame:
    """``df`` with ``out``: the sum of ``size`` over the rows of its key that come before it.

    A key may hold any number of rows. They are dealt into buckets of some thousand by a hash of
    ``deal`` (``order`` if not given), the buckets into some thousand larger ones, and each level is summed on its own, so
    that no task sorts more than a bucket. The order is by bucket, then by ``order``.
    """
    many = max(1, rows // 8192)
    large = max(1, many // 4096)
    df = df.withColumn("__b", F.pmod(F.xxhash64(*(deal or order)), F.lit(many))).withColumn("__l", F.col("__b") % large)
    before = lambda s, w: F.sum(s).over(w.rowsBetween(Window.unboundedPreceding, -1))
    small = df.groupBy(*key, "__l", "__b").agg(F.sum(size).alias("__s"))
    small = small.withColumn("__p", before("__s", Window.partitionBy(*key, "__l").orderBy("__b")))
    top = small.groupBy(*key, "__l").agg(F.sum("__s").alias("__t"))
    top = top.withColumn("__q", before("__t", Window.partitionBy(*key).orderBy("__l"))).drop("__t")
    starts = small.join(top, [*key, "__l"]).select(*key, "__b", (F.coalesce("__p", F.lit(0)) + F.coalesce("__q", F.lit(0))).alias("__o"))
    df = df.withColumn("__i", before(size, Window.partitionBy(*key, "__b").orderBy(*order)))
    df = df.join(starts, [*key, "__b"])
    return df.withColumn(out, F.coalesce("__i", F.lit(0)) + F.col("__o")).drop("__b", "__l", "__i", "__o")


def numbered(df: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """``df`` with ``number``: the place of a row among those of its group, from 0, by ``order``.

    Rows are sorted by group and order over all partitions, so a group of any size is spread over as
    many as it needs; each partition numbers its own rows, and the rows of a group in the partitions
    before it are added. ``order`` must be total.
    """

    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for pdf in batches:
            if not len(pdf):
                continue
            number = pdf.groupby(group, sort=False).cumcount().to_numpy()
            again = (pdf[group] == last).to_numpy()
            number[again] += seen
            last, seen = pdf[group].iloc[-1], int(number[-1]) + 1
            yield pdf.assign(part=part, number=number)

    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    rows = df.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    rows = checkpointed(rows.mapInPandas(local, f"{kind}, part int, number long"))
    before = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy(group, "part").agg(F.count("*").alias("n"))
    starts = starts.select(group, "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return rows.join(starts, [group, "part"]).withColumn("number", F.col("number") + F.col("start")).drop("part", "start")
