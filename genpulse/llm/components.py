"""Connected components of a table of links, and the blocks in which candidates meet."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Nodes of a cell that are paired in one block.
BLOCK = 512


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b", rounds: int = 100) -> DataFrame:
    """(node, component) of every node that a link touches; component is the least node reachable.

    Alternating large and small stars: each round hangs every node's neighbours under the least of
    them, so the number of rounds grows with the logarithm of a component's size, and a round moves
    no more rows than there are links. Nulls and loops link nothing.
    """
    pair = links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"), (F.col(a) != F.col(b)).alias("ok"))
    edges = stored(pair.where("ok").select("a", "b").distinct(), "links")
    before = _state(edges)
    for _ in range(rounds):
        if not before[0]:
            break
        # large star: neighbours above a node go under the least of its neighbourhood
        around = _both_ways(edges)
        least = around.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = around.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b").where("a < b").distinct()
        large = stored(large, "large-star")
        # small star: a node and its neighbours below it go under the least of these
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least, "b").where("a > m").select(F.col("m").alias("x"), F.col("a").alias("y"))
        small = small.unionByName(least.select(F.col("m").alias("x"), F.col("b").alias("y")))
        edges = stored(small.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "small-star")
        after = _state(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(roots)


def in_blocks(rows: DataFrame, cell: list[str], within: bool = False) -> DataFrame:
    """rows (cell, node, component) of cells that hold several components, under a number `cell` that
    cells of the same members share and are taken once for, with own block and each pair of blocks
    (low, high) that it takes part in: every two rows of a cell that differ in component meet in one
    pair of blocks at least. The largest component of a cell has blocks of its own, which don't meet
    one another, so a crowd that is united but for a few nodes costs rows in proportion to it.
    within: only the pair of its own block with itself."""
    cells = rows.groupBy(*cell).agg(
        F.count(F.lit(1)).alias("_n"), F.min("component").alias("_least"), F.max("component").alias("_most"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("_members")
    )
    cells = cells.where("_least < _most").select(*cell, "_n", F.xxhash64("_members", "_n").alias("_cell"))
    rows = rows.join(cells, cell).drop(*cell).withColumnRenamed("_cell", "cell").dropDuplicates(["cell", "node"])
    share = lambda n: F.pmod(F.xxhash64("node"), F.ceil(n / BLOCK)).cast("int")
    if within:
        rows = rows.withColumn("block", share(F.col("_n")))
        return rows.withColumns({"low": F.col("block"), "high": F.col("block")}).drop("_n")
    rows = stored(rows, "cell-rows")
    parts = rows.where(F.col("_n") > BLOCK).groupBy("cell", "component").agg(F.count(F.lit(1)).alias("_size"))
    largest = parts.groupBy("cell").agg(F.max(F.struct("_size", "component")).alias("_top"))
    rows = rows.join(largest, "cell", "left").withColumns({"_in": F.coalesce(F.col("_top.component") == F.col("component"), F.lit(False)), "_size": F.coalesce("_top._size", F.lit(0))})
    rows = rows.withColumn("_rest", F.ceil((F.col("_n") - F.col("_size")) / BLOCK).cast("int"))
    rows = rows.withColumn("block", F.when(F.col("_in"), F.col("_rest") + share(F.col("_size"))).otherwise(share(F.col("_n") - F.col("_size"))))
    last = F.when(F.col("_in"), F.col("_rest")).otherwise(F.col("_rest") + F.ceil(F.col("_size") / BLOCK).cast("int")) - 1
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), last)))
    return rows.withColumns({"low": F.least("block", "_other"), "high": F.greatest("block", "_other")}).drop("_n", "_top", "_in", "_size", "_rest", "_other")


def united(parts: np.ndarray, pairs: Iterable[tuple[int, int, Callable[[], bool]]]) -> list[tuple[int, int]]:
    """The pairs (x, y) of rows that are linked and unite parts. A pair's test runs only where its
    rows are not united yet."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.get(x, x)) != x:
            root[x] = root.get(up, up)
            x = up
        return x

    out = []
    for x, y, linked in pairs:
        p, q = find(int(parts[x])), find(int(parts[y]))
        if p != q and linked():
            out.append((x, y))
            root[p] = q
    return out
