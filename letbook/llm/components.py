"""Connected components of a table of links, and links from blocks of likely matches, in DataFrame operations.

`components` is the alternating star method: every node tells its larger (then its smaller) neighbours about the
smallest node it knows, until all links lead straight to a smallest node. Links are written to the shared folder between rounds; nothing but
counts reaches the driver. The number of rounds grows with the logarithm of a component's size.

`link_blocks` finds enough verified links to connect all that blocks of candidates connect, without listing all pairs
of a block. First every member of a block is paired with one of the block's members, its head, for a few rounds with
another one where a block still spans several components. With `spread`, heads are chosen by a hash of block and member,
so that the many blocks of one large group have many heads, which joins members of whom few are linked with any one;
without, all blocks of a group ask about its smallest member, which takes fewer questions where most are linked. The
pairs that then remain, those of one block and different components not looked at yet, are all listed and verified, so
no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import keep


def _stars(edges: DataFrame) -> bool:
    """Whether every v has one u, and no u is a v: then the u are the labels."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("v").alias("id"), F.lit(1).alias("n")), F.struct(F.col("u").alias("id"), F.lit(0).alias("n")))).alias("e"))
    seen = ends.groupBy("e.id").agg(F.sum("e.n").alias("as_v"), F.min("e.n").alias("as_u"))
    return not seen.where("as_v > 1 or (as_v = 1 and as_u = 0)").limit(1).count()


def components(links: DataFrame) -> DataFrame:
    """(id, label): every id of links (a, b) with the smallest id it is connected to. Ids are longs, never null."""
    edges = keep(
        links.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(), "links"
    )
    while not _stars(edges):
        # large star: neighbours larger than v get v's smallest neighbour (or v itself)
        both = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        low = both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m"))
        large = both.where("u > v").join(low, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).distinct()
        # small star: v and its smaller neighbours get the smallest of them
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = (
            large.join(low, "v")
            .where("u <> m")
            .select(F.col("u").alias("v"), F.col("m").alias("u"))
            .unionByName(low.select("v", F.col("m").alias("u")))
            .distinct()
        )
        edges = keep(small, "links")
    own = edges.select(F.col("u").alias("id"), F.col("u").alias("label")).distinct()
    return edges.select(F.col("v").alias("id"), F.col("u").alias("label")).unionByName(own)


def link_blocks(
    blocks: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    may: Callable | None = None,
    closer: tuple[Callable[[DataFrame], DataFrame], Callable] | None = None,
    near: tuple[DataFrame, Callable] | None = None,
    rounds: int = 3,
    spread: bool = False,
) -> DataFrame:
    """Verified links (a, b) that connect whatever verified pairs inside blocks connect.

    blocks: (block long, id long, info struct) without repeated rows. `may(left info, right info)` is a cheap column
    condition that every link meets. `closer` makes a table (id, info struct) of the ids it is given, with a condition
    like `may` on it, a stricter one, for the rows of blocks that stay open after the first round. `near` is a table
    (id, whole) with a dear condition on `whole`, asked once a pair of those that are left at last. `verify` takes candidate pairs (a, b), a < b, and returns those that are links.
    """
    fine = may or (lambda left, right: F.lit(True))

    def chosen(turn: int, *fields: str):
        draw = F.xxhash64("block", "id", F.lit(turn)) if spread else F.lit(0).cast("long")
        return F.min(F.struct(draw.alias("draw"), *fields)).alias("head")

    first = blocks.groupBy("block").agg(chosen(0, "id", "info"), F.min("id").alias("low"), F.max("id").alias("high"))
    members = keep(
        blocks.join(first.where("low < high").select("block", "head"), "block"), "members"
    )

    def star(rows: DataFrame, fine: Callable) -> DataFrame:
        """Pairs of each row's id with its head's."""
        return (
            rows.where(F.col("id") != F.col("head.id"))
            .where(fine(F.col("head.info"), F.col("info")))
            .select(F.least("id", "head.id").alias("a"), F.greatest("id", "head.id").alias("b"))
            .distinct()
        )

    asked = keep(star(members, fine), "asked")
    links = keep(verify(asked), "links")
    for turn in range(1, rounds + 1):
        label = components(links)
        labelled = keep(
            members.select("block", "id", "info")
            .join(label, "id", "left")
            .withColumn("label", F.coalesce("label", "id")),
            "labelled",
        )
        # blocks of two were asked whole
        open_ = keep(
            labelled.groupBy("block", "label")
            .agg(F.count("*").alias("n"))
            .groupBy("block")
            .agg(
                F.min("label").alias("low"),
                F.max("label").alias("high"),
                ((F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))) / 2).alias("pairs"),
                F.sum("n").alias("n"),
            )
            .where("low < high and n > 2"),
            "open",
        )
        pairs, rows = open_.agg(F.sum("pairs"), F.sum("n")).first()
        if not rows:
            return links
        rest = labelled.join(open_.select("block", "low"), "block")
        if closer:
            sketches, fine = closer
            rest = rest.drop("info").join(sketches(rest.select("id").distinct()), "id")
        rest = keep(rest, "rest")
        if turn == rounds or pairs <= 4 * rows:
            break
        new = rest if spread else rest.where(F.col("label") != F.col("low"))
        other = new.groupBy("block").agg(chosen(turn, "id", "info", "label"))
        fresh = keep(
            star(rest.join(other, "block").where(F.col("label") != F.col("head.label")), fine).join(asked, ["a", "b"], "left_anti"),
            "asked",
        )
        asked = keep(asked.unionByName(fresh), "asked")
        links = keep(links.unionByName(verify(fresh)), "links")
    # a pair is listed in the first block that both are in; an id is in as many blocks as it has bands or segments
    own = rest.groupBy("id").agg(F.collect_set("block").alias("own"))
    wholes, alike = near or (None, lambda left, right: F.lit(True))
    own = own.join(wholes, "id") if near else own.withColumn("whole", F.lit(True))
    left = rest.select("block", "id", "label", "info").join(own, "id")
    renamed = [F.col(c).alias(f"{c}2") for c in ("id", "label", "info", "own", "whole")]
    right = left.select("block", *renamed)
    first_common = F.array_min(F.array_intersect("own", "own2")) == F.col("block")
    open_pairs = (
        left.join(right, "block")
        .where((F.col("id") < F.col("id2")) & (F.col("label") != F.col("label2")) & fine(F.col("info"), F.col("info2")))
        .where(first_common & alike(F.col("whole"), F.col("whole2")))
        .select(F.col("id").alias("a"), F.col("id2").alias("b"))
        .distinct()
        .join(asked, ["a", "b"], "left_anti")
    )
    return links.unionByName(verify(keep(open_pairs, "asked")))
