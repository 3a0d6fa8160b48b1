"""Merkle manifest of a dataset, grown by appends that carry incremental witnesses.

A tree takes its leaves one after another. The nodes of a level that still wait for siblings are an
open run; a node that joins a run is attached, with the digests already there as its partial
witness, and extends the witness of every node before it. A full run is hashed and becomes an append
one level up, so a leaf's witness grows with each sibling subtree that is completed later.

A tree of any size is cut into aligned blocks of ``ARITY ** HEIGHT`` leaves. Every block is grown in
a task of its own; the roots of the blocks are then appended to a tree in the same manner, block by
block, until one root is left, and so are the roots of all groups. On the way back each block
extends its leaves' witnesses by that of its root. A task holds the leaves of one block, however
many leaves a group has.
"""

from __future__ import annotations

import hashlib
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import checkpointed, numbered

ARITY, HEIGHT = 8, 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A step of a witness: the place of the own node in its run, and the digests of the others.
STEPS = "array<struct<place:int,others:array<string>>>"


def digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


class Appender:
    """A tree of ``height`` levels that grows by appends."""

    def __init__(self, height: int, arity: int = ARITY) -> None:
        self.height, self.arity, self.root = height, arity, None
        self.steps: list[list[tuple[int, list[str]]]] = []
        # For each level the open run: of each node its digest, its first and end leaf, its witness in the run.
        self.open: list[list[tuple[str, int, int, list[str]]]] = [[] for _ in range(height)]

    def append(self, leaf: str) -> None:
        self.steps.append([])
        self._join(0, leaf, len(self.steps) - 1, len(self.steps))

    def _join(self, level: int, own: str, first: int, end: int) -> None:
        if level == self.height:
            self.root = own
            return
        run = self.open[level]
        witness = [d for d, *_ in run]
        for *_, earlier in run:
            earlier.append(own)
        for steps in self.steps[first:end]:
            steps.append((len(run), witness))  # shared by all leaves below, and extended for all at once
        run.append((own, first, end, witness))
        if len(run) == self.arity:
            self._close(level)

    def _close(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        self._join(level + 1, digest([d for d, *_ in run]), run[0][1], run[-1][2])

    def finish(self) -> str:
        """The root; runs that are still open are closed as they are, even those of one node."""
        for level in range(self.height):
            if self.open[level]:
                self._close(level)
        return self.root


def grown(leaves: list[str], height: int) -> Appender:
    tree = Appender(height)
    for leaf in leaves:
        tree.append(leaf)
    tree.finish()
    return tree


def folded(own: str, steps: list) -> list[str]:
    """The digests on the way up from ``own``, itself first, with the witness's siblings."""
    out = [own]
    for place, others in steps:
        out.append(digest([*others[:place], out[-1], *others[place:]]))
    return out


def height_of(leaves: int) -> int:
    height = 0
    while ARITY**height < leaves:
        height += 1
    return height


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(values: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256)


def _blocks(nodes: DataFrame) -> DataFrame:
    """Nodes (grp, number, digest, ...) with their block, and the height its tree has."""
    span = ARITY**HEIGHT
    sizes = nodes.groupBy("grp").agg(F.count("*").alias("n"))
    whole = F.when(F.col("n") > span, HEIGHT)
    for height in range(HEIGHT, -1, -1):
        whole = F.when(F.col("n") <= ARITY**height, height).otherwise(whole)
    sizes = sizes.select("grp", whole.cast("int").alias("height"))
    return nodes.join(sizes, "grp").withColumn("block", F.expr(f"number div {span}"))


def _roots(blocks: DataFrame) -> DataFrame:
    """(grp, number, digest) of every block's root, the nodes of the next tree."""

    def root(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("number")
        tree = grown(pdf["digest"].tolist(), int(pdf["height"].iloc[0]))
        return pd.DataFrame({"grp": pdf["grp"].iloc[:1], "number": pdf["block"].iloc[:1], "digest": [tree.root]})

    kept = blocks.select("grp", "block", "number", "digest", "height")
    return kept.groupBy("grp", "block").applyInPandas(root, "grp string, number long, digest string")


def _witnessed(blocks: DataFrame, above: DataFrame | None) -> DataFrame:
    """(grp, number, digest, steps): each node's witness, that of its block's root behind its own."""

    def steps(pdf: pd.DataFrame, up: list) -> pd.DataFrame:
        pdf = pdf.sort_values("number")
        tree = grown(pdf["digest"].tolist(), int(pdf["height"].iloc[0]))
        own = [[{"place": p, "others": o} for p, o in s] + up for s in tree.steps]
        return pdf[["grp", "number", "digest"]].assign(steps=own)

    kept = blocks.select("grp", "block", "number", "digest", "height")
    schema = f"grp string, number long, digest string, steps {STEPS}"
    if above is None:
        return kept.groupBy("grp", "block").applyInPandas(lambda pdf: steps(pdf, []), schema)

    def extended(pdf: pd.DataFrame, up: pd.DataFrame) -> pd.DataFrame:
        return steps(pdf, [{"place": s["place"], "others": list(s["others"])} for s in up["steps"].iloc[0]])

    upper = above.select("grp", F.col("number").alias("block"), "steps")
    return kept.groupBy("grp", "block").cogroup(upper.groupBy("grp", "block")).applyInPandas(extended, schema)


def _tiers(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of the leaves, of their blocks' roots and so on, and one root for each group."""
    tiers = [checkpointed(_blocks(nodes))]
    while True:
        roots = checkpointed(_roots(tiers[-1]))
        if not (roots.agg(F.max("number")).first()[0] or 0):
            return tiers, roots
        tiers.append(checkpointed(_blocks(roots)))


def _upper(tiers: list[DataFrame], above: DataFrame | None) -> DataFrame | None:
    """The witnesses of the roots of the lowest tier's blocks."""
    for blocks in reversed(tiers[1:]):
        above = checkpointed(_witnessed(blocks, above))
    return above


def manifest(rows: DataFrame, group: str, order: list[str], leaf: str, changed: str | None = None, with_proofs: bool = True) -> DataFrame:
    """For every row (all its columns, and) subroot, root, proof, proof_sha256, folded_root, verified.

    ``leaf`` is a digest as lowercase hex; rows are leaves by ``group``, ascending by ``order``, nulls
    first. Rows equal in all of them are leaves each, in any order. ``proof`` lists the siblings level
    by level, left to right (null without ``with_proofs``), and ``proof_sha256`` is the hash of all of them in a row. ``folded_root``
    is computed from ``changed`` where that is not null, else from the leaf, with the siblings of the
    row as it was; ``verified`` says whether it is the root. An empty table gives no rows.
    """
    held = rows.select(F.struct(*rows.columns).alias("kept"), field(F.col(group)).alias("grp"), F.col(group).alias("__group"),
                       F.col(leaf).alias("digest"), (F.col(changed) if changed else F.lit(None).cast("string")).alias("__changed"),
                       *[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)], F.monotonically_increasing_id().alias("__row"))
    held = checkpointed(held)
    keys = [*[f"__o{i}" for i in range(len(order))], "digest", "__row"]
    # A row's place is all the sort needs: what is kept of it stays where it is, and is joined by its number.
    slim = held.select("grp", "digest", "__changed", "__row", *[f"__o{i}" for i in range(len(order))])
    nodes = numbered(slim, "grp", [F.col(k).asc_nulls_first() for k in keys]).select("grp", "number", "digest", "__changed", "__row")
    tiers, roots = _tiers(nodes)
    # The groups' roots are appended to a tree of their own, in the order of the groups' values.
    groups = held.select("grp", "__group").distinct().join(roots.select("grp", "digest"), "grp")
    groups = groups.select(F.lit("").alias("tree"), "grp", "__group", "digest")
    top = numbered(groups, "tree", [F.col("__group").asc_nulls_first()])
    named = checkpointed(top.select("grp", F.col("tree"), "number", "digest"))
    top_tiers, root = _tiers(named.select(F.col("tree").alias("grp"), "number", "digest"))
    last = root.first()
    whole = last["digest"] if last else ""
    tops = _witnessed(top_tiers[0], _upper(top_tiers, None))
    above = named.select(F.col("grp").alias("name"), "number").join(tops.select("number", "steps"), "number")
    above = checkpointed(above.select(F.col("name").alias("grp"), F.lit(0).cast("long").alias("number"), "steps"))
    subroots = roots.select("grp", F.col("digest").alias("subroot"))
    # Each block gets the witness of its root, and the root of its group.
    upper = _upper(tiers, above).select("grp", F.col("number").alias("block"), "steps").join(subroots, "grp")

    def leaves(pdf: pd.DataFrame, up: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("number")
        tree = grown(pdf["digest"].tolist(), int(pdf["height"].iloc[0]))
        higher = [(s["place"], list(s["others"])) for s in up["steps"].iloc[0]]
        above_proof = [d for _, others in higher for d in others]
        proofs, hashes, found = [], [], []
        for own, other, low in zip(pdf["digest"], pdf["__changed"], tree.steps, strict=True):
            proof = [d for _, others in low for d in others] + above_proof
            proofs.append(proof if with_proofs else None)
            hashes.append(digest(proof))
            found.append(folded(other if isinstance(other, str) else own, low + higher)[-1])
        return pd.DataFrame({"__row": pdf["__row"].to_numpy(), "subroot": up["subroot"].iloc[0], "proof": proofs, "proof_sha256": hashes, "folded_root": found})

    schema = "__row long, subroot string, proof array<string>, proof_sha256 string, folded_root string"
    proved = tiers[0].groupBy("grp", "block").cogroup(upper.groupBy("grp", "block")).applyInPandas(leaves, schema)
    return held.select("kept", "__row").join(proved, "__row").select(
        "kept.*", "subroot", F.lit(whole).alias("root"), "proof", "proof_sha256", "folded_root", (F.col("folded_root") == whole).alias("verified")
    )


def document_manifest(docs: DataFrame, fields: tuple = FIELDS, id_col: str = "doc_id", group: str = "lang", text_col: str = "text") -> DataFrame:
    """For every row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Texts of rows whose identifier's crc32 is divisible by 3 are tampered with: their letters A-Z
    become small; null texts, and rows without an identifier, stay. Nulls count as ``-`` in a leaf, and
    as the first group. Rows that repeat an identifier are leaves each, by their digest. An empty table
    gives no rows; other columns have no part, whatever their names.
    """
    values = [F.col(c) for c in fields]
    lowered = [F.translate(v, _UPPER, _LOWER) if c == text_col else v for c, v in zip(fields, values, strict=True)]
    hit = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 0, F.lit(False))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(group).alias("lang"), leaf_of(values).alias("leaf"), F.when(hit, leaf_of(lowered)).alias("changed"))
    found = manifest(rows, "lang", ["doc_id"], "leaf", "changed", with_proofs=False)
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
