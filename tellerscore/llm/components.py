"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerscore.session import materialize, materialize_measured

#: Links that one task contracts at a time.
CONTRACTED = 500_000


def contract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Replace the links that a task holds by one from each node to the least it reaches among them."""
    parent: dict[int, int] = {}

    def root(n: int) -> int:
        top = n
        while parent.setdefault(top, top) != top:
            top = parent[top]
        while parent[n] != top:
            parent[n], n = top, parent[n]
        return top

    def flush() -> pd.DataFrame:
        pairs = [(n, root(n)) for n in list(parent)]
        parent.clear()
        return pd.DataFrame([p for p in pairs if p[0] != p[1]], columns=["u", "v"], dtype="int64")

    held = 0
    for batch in batches:
        for u, v in zip(batch["u"].tolist(), batch["v"].tolist()):
            a, b = root(u), root(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
        held += len(batch)
        if held > CONTRACTED:
            yield flush()
            held = 0
    yield flush()


def _star(neighbours: DataFrame, small: bool) -> DataFrame:
    """Link each node's neighbours to the least of them and itself: the greater ones, or all and itself.

    Minima are written, so that both sides of the join are plain exchanges, whose hot keys adaptive
    execution splits.
    """
    least = materialize(
        neighbours.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least"
    )
    linked = neighbours.join(least, "u")
    if not small:
        linked = linked.where(F.col("v") > F.col("u"))
    rows = linked.select(F.col("v").alias("u"), F.col("m").alias("v"))
    if small:
        rows = rows.unionByName(least.select("u", F.col("m").alias("v")))
    return rows.where(F.col("u") != F.col("v")).distinct()


def _settled(edges: DataFrame) -> bool:
    """Does every node have one link up, to a node without one?"""
    roles = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    seen = roles.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.where("up > 1 OR up = 1 AND down = 1").isEmpty()


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, component``: the least node that each linked node reaches, itself included.

    ``links`` has two columns of numbers, in any order, with or without repeats and loops. Nodes without a
    link to another do not appear. Tasks first contract the links they hold, which is all there is to do
    for few links; the alternating steps connect the tasks' results. Each step writes its links and reads
    them again. A node with very many links costs no more than they do: minima combine before the
    shuffle, and skewed joins are split. ``rounds`` is far above the logarithm of the longest path that
    could exist; not converging by then is an error.
    """
    a, b = links.columns
    start = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col("u") != F.col("v"))
    written, seen = materialize_measured(start, "links", F.count(F.lit(1)).alias("n"))
    tasks = -(-seen["n"] // CONTRACTED) or 1
    edges = materialize(written.coalesce(tasks).mapInPandas(contract, "u long, v long"), "edges")
    for _ in range(rounds):
        if _settled(edges):
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = materialize(_star(both, small=False), "large-star")
        edges = materialize(_star(large, small=True), "edges")
    else:
        raise RuntimeError("components did not converge")
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.unionByName(roots)
