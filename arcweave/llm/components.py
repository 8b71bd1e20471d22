"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arcweave.scratch import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): the smallest node it is linked to.

    A round points every node at its smallest neighbour, if that is smaller,
    follows the pointers to their ends, and puts these in the place of the
    links' ends; links inside one tree go. A node without a smaller neighbour
    has one in the next round, so two rounds halve the nodes at least, and later
    rounds see only links between what is not yet together. Minima are combined
    before the shuffle: a node with very many links is one row for each task.
    Rounds are written, nothing is kept in executors only. Nulls and links of a
    node to itself add nothing; an empty table has no nodes.
    """
    apart = scratch.save(_ordered(links), "apart")
    rounds = []
    while not rounds or not apart.isEmpty():
        tree = scratch.save(
            apart.select(F.inline(F.array(F.struct(F.col("a").alias("node"), "b"), F.struct(F.col("b").alias("node"), "b"))))
            .groupBy("node")
            .agg(F.min("b").alias("root")),
            "tree",
        )
        tree = _flat(tree, scratch)
        rounds.append(tree)
        of_a = tree.select(F.col("node").alias("a"), F.col("root").alias("top_a"))
        of_b = tree.select(F.col("node").alias("b"), F.col("root").alias("top_b"))
        moved = apart.join(of_a, "a").join(of_b, "b").select(F.col("top_a").alias("a"), F.col("top_b").alias("b"))
        apart = scratch.save(_ordered(moved), "apart")
    # The roots of a round are nodes of the next, so the last and smallest is resolved first.
    while len(rounds) > 1:
        tops = rounds.pop().select(F.col("node").alias("root"), F.col("root").alias("top"))
        lower = rounds.pop()
        whole = lower.join(tops, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
        rounds.append(scratch.save(whole, "whole"))
    return rounds[0]


def _ordered(links: DataFrame) -> DataFrame:
    """Each link between two nodes once, with the smaller node as b."""
    known = links.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    return known.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _flat(tree: DataFrame, scratch: Scratch) -> DataFrame:
    """The same nodes with the ends of their pointers, of which each step doubles the reach."""
    while True:
        jump = tree.select(F.col("node").alias("root"), F.col("root").alias("further"))
        further = tree.join(jump, "root").select("node", F.col("further").alias("root"), (F.col("further") != F.col("root")).alias("moved"))
        further = scratch.save(further, "further")
        tree = further.select("node", "root")
        if further.where("moved").isEmpty():
            return tree
