"""Merkle manifest of a table: every row a leaf, a tree per source, a tree over the sources, and proofs that are folded.

A leaf is the digest of the row's fields. Per source the leaves ascend by id (equal ids by leaf); every 16 nodes become
one until one is left, the source's subroot; subroots ordered by source become the root in the same way. A leaf's proof
is the other nodes of its run on every level. `manifest` returns leaf, subroot, root and proof of the table as it is,
and folds each proof again from the leaf that a possibly tampered table has.

How it runs: leaves are dealt by range of (source, id), so a place in its source is an offset of its task plus its
place there. Blocks of 4,096 leaves, whole subtrees, are reduced to one node each; these are the next level's nodes,
and so on until every source has one. On the way back each block is cogrouped with the one row of nodes outside it that
its leaves need, and finishes the paths below. No group holds more than 4,096 rows however large a source is. Only
digests are shuffled, never texts.

Defined cases: a null field counts as `-`; null ids come first in their source and are never tampered with; null
sources are a source of their own, the first; rows with equal id and content are leaves of their own; an empty table
gives no rows and no root; texts of any length are hashed where they are read; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import keep

FANOUT = 16
LEVELS = 3
#: Leaves of a whole subtree that one task reduces.
BLOCK = FANOUT**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """`-` for null, else the length in bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def layers(nodes: list[str], levels: int | None) -> list[list[str]]:
    """The nodes and the layers above them: as many as told, or until one node is left."""
    out = [nodes]
    while len(out[-1]) > 1 if levels is None else len(out) <= levels:
        below = out[-1]
        out.append([digest(below[i : i + FANOUT]) for i in range(0, len(below), FANOUT)])
    return out


def path_of(tree: list[list[str]], i: int) -> str:
    """Per layer `place,other,other...` of node i's run, joined by blanks."""
    steps = []
    for layer in tree[:-1]:
        begin, at = i - i % FANOUT, i % FANOUT
        run = layer[begin : begin + FANOUT]
        steps.append(",".join([str(at), *run[:at], *run[at + 1 :]]))
        i //= FANOUT
    return " ".join(steps)


def others(path: str) -> list[tuple[int, list[str]]]:
    """(place, the run's other digests) per level of a path."""
    split = [step.split(",") for step in path.split(" ") if step]
    return [(int(at), rest) for at, *rest in split]


def fold(leaf: str, path: list[tuple[int, list[str]]]) -> str:
    """The root that a leaf and the nodes beside its way give."""
    for at, rest in path:
        leaf = digest([*rest[:at], leaf, *rest[at:]])
    return leaf


def _tree(block: pd.DataFrame) -> list[list[str]]:
    """The local layers of a block's nodes, which come in order; LEVELS of them if the group goes on above the block."""
    return layers(block["digest"].tolist(), LEVELS if block["n"].iloc[0] > BLOCK else None)


def ranked(nodes: DataFrame, *order: str) -> DataFrame:
    """The rows (key, ...) with their rank in their key by `order` and the key's count n."""
    placed = keep(
        nodes.repartitionByRange("key", *order)
        .sortWithinPartitions("key", *order)
        .withColumn("place", F.monotonically_increasing_id()),
        "places",
    ).withColumn("part", F.shiftright("place", 33))
    parts = Window.partitionBy("key")
    runs = (
        placed.groupBy("key", "part")
        .agg(F.min("place").alias("first"), F.count("*").alias("size"))
        .withColumn("n", F.sum("size").over(parts))
        .withColumn("before", F.sum("size").over(parts.orderBy("part")) - F.col("size"))
    )
    rank = F.col("place") - F.col("first") + F.col("before")
    return placed.join(runs, ["key", "part"]).select(*nodes.columns, rank.alias("rank"), "n")


def _cogroup(nodes: DataFrame, above: DataFrame):
    """Blocks of nodes and the row above each; the names of one side are told apart from the other's."""
    apart = above.select(F.col("key").alias("outer_key"), F.col("block").alias("outer_block"), "path", "subroot", "root")
    return nodes.groupBy("key", "block").cogroup(apart.groupBy("outer_key", "outer_block"))


def _blocks(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("rank") / BLOCK))


def climb(nodes: DataFrame) -> list[DataFrame]:
    """Levels of (key, rank, n, digest): the nodes, then the blocks' top nodes, until each key has one block."""

    def top(block: pd.DataFrame) -> pd.DataFrame:
        first = block.iloc[0]
        one = _tree(block.sort_values("rank"))[-1][0]
        return pd.DataFrame({"key": [first["key"]], "rank": [first["block"]], "n": [-(-first["n"] // BLOCK)], "digest": [one]})

    levels = [nodes]
    while (levels[-1].agg(F.max("n")).first()[0] or 0) > BLOCK:
        large = _blocks(levels[-1].where(F.col("n") > BLOCK)).select("key", "block", "rank", "n", "digest")
        schema = "key string, rank long, n long, digest string"
        levels.append(keep(large.groupBy("key", "block").applyInPandas(top, schema), "level"))
    return levels


def tops(levels: list[DataFrame]) -> DataFrame:
    """(key, digest): what is left of each key."""

    def last(block: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"key": block["key"].iloc[:1], "digest": [_tree(block.sort_values("rank"))[-1][0]]})

    parts = [x.where(F.col("n") <= BLOCK).select("key", "rank", "n", "digest") for x in levels]
    done = [x.groupBy("key").applyInPandas(last, "key string, digest string") for x in parts]
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return keep(out, "tops")


def expand(level: DataFrame, above: DataFrame) -> DataFrame:
    """(key, block, path, subroot, root) for each node of a level, block being its rank, from such rows for its blocks."""

    def finish(block: pd.DataFrame, end: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("rank")
        tree, end = _tree(block), end.iloc[0]
        return pd.DataFrame(
            {
                "key": block["key"],
                "block": block["rank"],
                "path": [f"{path_of(tree, i)} {end['path']}".strip() for i in range(len(block))],
                "subroot": end["subroot"],
                "root": end["root"],
            }
        )

    nodes = _blocks(level).select("key", "block", "rank", "n", "digest")
    return _cogroup(nodes, above).applyInPandas(finish, "key string, block long, path string, subroot string, root string")


def descend(levels: list[DataFrame], outer: DataFrame) -> DataFrame:
    """(key, block, path, subroot, root) for each block of the lowest level, from (key, path, subroot, root) of keys."""

    def ending(level: DataFrame) -> DataFrame:
        """Rows for keys that have one block on this level."""
        last = level.where((F.col("n") <= BLOCK) & (F.col("rank") == 0)).select("key").join(outer, "key")
        return last.select("key", F.lit(0).cast("long").alias("block"), "path", "subroot", "root")

    above = ending(levels[-1])
    for k in range(len(levels) - 1, 0, -1):
        above = expand(levels[k], above).unionByName(ending(levels[k - 1]))
    return above


def manifest(documents: DataFrame, tampered: Column | None = None) -> DataFrame:
    """One row per document: leaf, subroot, root, proof, and whether the root folded from the present leaf is that root.

    `tampered` is the text as it is now, where it differs from the one the manifest was made of (null: as it was).
    """
    fields = [F.col(name) for name in FIELDS]
    changed = F.lit(None).cast("string")
    if tampered is not None:
        changed = F.when(tampered.isNotNull(), leaf_digest(*fields[:-1], tampered))
    leaves = documents.select(
        F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("-")).alias("key"),  # null first, then by bytes
        "doc_id",
        F.col("doc_id").cast("string").alias("id"),  # pandas would make numbers with nulls inexact
        leaf_digest(*fields).alias("digest"),
        changed.alias("now"),
    )
    nodes = keep(ranked(leaves, "doc_id", "digest"), "leaves")
    by_source = climb(nodes)
    subroots = tops(by_source)
    named = subroots.select(F.lit("").alias("key"), F.col("key").alias("name"), "digest")
    sources = keep(ranked(named, "name"), "sources")
    over_all = climb(sources)
    root = tops(over_all).select("key", F.lit("").alias("path"), F.lit("").alias("subroot"), F.col("digest").alias("root"))
    ends = expand(sources, descend(over_all, root))
    outer = (
        sources.join(ends.select(F.col("block").alias("rank"), "path", "root"), "rank")
        .select(F.col("name").alias("key"), "path", F.col("digest").alias("subroot"), "root")
    )
    above = descend(by_source, keep(outer, "outer"))

    def finish(block: pd.DataFrame, end: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("rank")
        tree, end = _tree(block), end.iloc[0]
        paths = [others(f"{path_of(tree, i)} {end['path']}") for i in range(len(block))]
        leaves, now = block["digest"].tolist(), block["now"].tolist()
        folded = [fold(x or leaf, path) for leaf, x, path in zip(leaves, now, paths, strict=True)]
        return pd.DataFrame(
            {
                "doc_id": block["id"],
                "leaf": leaves,
                "subroot": end["subroot"],
                "root": end["root"],
                "proof_sha256": [digest([x for _, rest in path for x in rest]) for path in paths],
                "folded_root": folded,
                "verified": [x == end["root"] for x in folded],
            }
        )

    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    rows = _cogroup(_blocks(nodes).drop("doc_id"), above).applyInPandas(finish, schema)
    return rows.withColumn("doc_id", F.col("doc_id").cast(kind))
