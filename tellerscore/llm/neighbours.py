"""Approximate nearest neighbours with a hierarchical k-means tree and best-bin-first traversal."""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tellerscore.session import materialize

#: Vectors and queries that one cell compares at most, on average.
CELL_ROWS = 4096
#: Vectors that a leaf holds at most, if k-means can tell them apart; a larger one gets a tree of its own.
LEAF_ROWS = 512


@dataclass
class Tree:
    """Inner nodes hold the centres of their children; a child is an inner node (>= 0) or a leaf (< 0)."""

    centres: list[np.ndarray] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    leaves: int = 0

    def leaf_of(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf that each vector falls into, going to the nearest child from the root on."""
        out = np.zeros(len(vectors), dtype=np.int64)
        todo = [(0, np.arange(len(vectors)))] if self.centres else []
        while todo:
            node, rows = todo.pop()
            nearest = _distances(vectors[rows], self.centres[node]).argmin(axis=1)
            for i, child in enumerate(self.children[node]):
                own = rows[nearest == i]
                if not len(own):
                    continue
                if child < 0:
                    out[own] = -child - 1
                else:
                    todo.append((child, own))
        return out

    def visits(self, query: np.ndarray, bound: float = 0.0) -> Iterator[tuple[int, float]]:
        """Leaves in best-bin-first order: descend to a leaf, queue the branches passed by, take the nearest.

        Beside each leaf goes the distance at which the queue came to it, which never falls. It starts from
        ``bound``, so the queue of a tree goes on in the trees below its leaves.
        """
        if not self.centres:
            yield 0, bound
            return
        queue, order = [(bound, 0.0, 0, 0)], 1
        while queue:
            bound, _, _, node = heapq.heappop(queue)
            while node >= 0:
                distances = ((self.centres[node] - query) ** 2).sum(axis=1)
                best = int(distances.argmin())
                for i, child in enumerate(self.children[node]):
                    if i != best:
                        own = float(distances[i])
                        heapq.heappush(queue, (max(bound, own), own, order, child))
                        order += 1
                node = self.children[node][best]
            yield -node - 1, bound


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances up to a term that is the same for all of ``b``."""
    return (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)


def grow(sample: np.ndarray, branching: int = 8, leaf_rows: int = 64, seed: int = 5) -> Tree:
    """Split by k-means until a part of the sample is small or all alike."""
    tree, rng = Tree(), np.random.default_rng(seed)

    def split(rows: np.ndarray) -> int:
        centres = _k_means(sample[rows], branching, rng) if len(rows) > leaf_rows else None
        if centres is None:
            tree.leaves += 1
            return -tree.leaves
        node = len(tree.centres)
        tree.centres.append(centres)
        tree.children.append([])
        nearest = _distances(sample[rows], centres).argmin(axis=1)
        tree.children[node] = [split(rows[nearest == i]) for i in range(len(centres))]
        return node

    split(np.arange(len(sample)))
    return tree


def _k_means(points: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 10) -> np.ndarray | None:
    distinct = np.unique(points, axis=0)
    if len(distinct) < 2:
        return None
    centres = distinct[rng.choice(len(distinct), min(k, len(distinct)), replace=False)]
    for _ in range(rounds):
        nearest = _distances(points, centres).argmin(axis=1)
        used = np.unique(nearest)
        if len(used) < 2:
            return None
        moved = np.stack([points[nearest == i].mean(axis=0) for i in used])
        if moved.shape == centres.shape and np.allclose(moved, centres):
            break
        centres = moved
    nearest = _distances(points, centres).argmin(axis=1)
    used = np.unique(nearest)
    return centres[used] if len(used) > 1 else None


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in column])


def usable(vector: Column, dim: int) -> Column:
    """Of that many components, all finite, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) == dim) & finite & F.exists(vector, lambda x: x != 0)


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    recall: float = 0.97,
    sample_rows: int = 20_000,
    calibration_queries: int = 200,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    seed: int = 5,
) -> DataFrame:
    """The ``k`` nearest rows found for each row that ``is_query`` marks: ``query_id, rank, vec_id, score``.

    Nearness is Euclidean distance in double precision; ties go to the smaller id; a query is no neighbour
    of itself. Vectors that are null, zero, or hold a null or non-finite component take no part, nor do
    those without an id or with another length than most have. Rows that repeat id and vector count once.
    With fewer candidates than ``k``, all are returned; no rows give no rows.

    The tree is grown from ``sample_rows`` distinct vectors on average, chosen by hash, and every row is
    indexed. A leaf of more than ``LEAF_ROWS`` rows gets a tree of its own, grown in a task from about
    ``sample_rows`` of its rows, and so on, so leaves stay as small when the table grows. How many leaves a
    query visits at each level is calibrated: about ``calibration_queries`` rows are compared with all rows,
    in blocks, and visits widen until the given share of their true neighbours lies in visited leaves; of
    the share that may be lost, half is lost at the first of several levels and half of the rest at each
    further one but the last. Equal vectors are indexed once with their ``k + 1`` smallest ids, which are all that
    can be among ``k`` neighbours; equal queries are searched once.
    """
    vector = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), vector.alias("vector"), is_query.alias("is_query"))
    common = rows.where("vector IS NOT NULL").groupBy(F.size("vector").alias("dim")).count()
    most = common.orderBy(F.desc("count"), "dim").first()
    dim = most["dim"] if most else 0
    rows = materialize(
        rows.where(F.col("id").isNotNull() & usable(F.col("vector"), dim))
        .groupBy("id", "vector")
        .agg(F.max("is_query").alias("is_query"))
        .withColumn("key", F.sha2(F.concat_ws(",", F.col("vector").cast("array<string>")), 256)),
        "vectors",
    )
    by_id = Window.partitionBy("key").orderBy("id")
    classes = materialize(
        rows.select("key", "id", "vector")
        .withColumn("_n", F.row_number().over(by_id))
        .where(F.col("_n") <= k + 1)  # known to Spark as a limit per group, before the shuffle
        .groupBy("key")
        .agg(F.sort_array(F.collect_list("id")).alias("ids"), F.first("vector").alias("vector")),
        "vector-classes",
    )
    asked = materialize(rows.where("is_query").select("key", F.col("id").alias("query_id")), "queries")
    total = classes.count()
    context = vectors.sparkSession.sparkContext

    def about(n: int, salt: int) -> Column:
        parts = 1 << 30
        return F.pmod(F.xxhash64(F.lit(salt), "key"), F.lit(parts)) < int(parts * min(1.0, n / max(total, 1)))

    sample = classes.where(about(sample_rows, seed)).orderBy("key").select("vector").toPandas()["vector"]
    tree = context.broadcast(grow(_matrix(sample), seed=seed) if len(sample) else Tree())

    def to_leaf(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch.assign(leaf=tree.value.leaf_of(_matrix(batch["vector"])))

    index = materialize(
        classes.mapInPandas(to_leaf, "key string, ids array<long>, vector array<double>, leaf long").withColumn(
            "path", F.array("leaf")
        ),
        "index",
    )
    index, levels = _deepen(index, sample_rows, seed)
    judged = index.where(about(calibration_queries, seed + 1)).select("key", "vector")
    visits = _calibrate(index, judged, tree, levels, k, recall)
    queries = index.join(asked.select("key").distinct(), "key", "left_semi").select("key", "vector")
    visiting = materialize(_first_visits(queries, tree, visits[0]), "visits")
    for trees, most in zip(levels, visits[1:]):
        visiting = materialize(_next_visits(visiting, trees, most), "visits")
    tops = _search_cells(index, visiting, k)

    found = (
        asked.join(tops, "key")
        .where(F.col("vec_id") != F.col("query_id"))
        .withColumn(
            "rank", F.row_number().over(Window.partitionBy("query_id", "key").orderBy("score", "vec_id")).cast("int")
        )
    )
    return found.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _nearest(queries: np.ndarray, vectors: np.ndarray, first_ids: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query the rows of its ``n`` nearest, ties to the smaller first id, and their distances."""
    for q, query in enumerate(queries):
        distance = np.sqrt(((vectors - query) ** 2).sum(axis=1))
        near = np.arange(len(vectors))
        if len(near) > n:  # all that are not farther than the n-th
            near = np.nonzero(distance <= np.partition(distance, n - 1)[n - 1])[0]
        near = near[np.lexsort((first_ids[near], distance[near]))][:n]
        yield q, near, distance[near]


def _with_trees(rows: DataFrame, trees: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``run`` on the rows of each leaf that has a tree, with that tree, in parts of bounded size."""
    sizes = materialize(
        rows.groupBy("leaf").count().join(trees.select("leaf"), "leaf").select(
            "leaf", F.ceil(F.col("count") / CELL_ROWS).alias("parts")
        ),
        "tree-parts",
    )
    left = rows.join(sizes, "leaf").withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts"))).drop("parts")
    right = trees.join(sizes, "leaf").select(
        "leaf", "tree", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")
    )

    def both(own: pd.DataFrame, tree: pd.DataFrame) -> pd.DataFrame:
        return run(own.drop(columns="part"), pickle.loads(tree["tree"].iloc[0]))

    cell = ["leaf", "part"]
    return left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInPandas(both, schema)


def _below() -> Column:
    """The name of a leaf below another; two that got one name would be searched as one leaf."""
    return F.xxhash64("leaf", "child")


def _deepen(index: DataFrame, sample_rows: int, seed: int) -> tuple[DataFrame, list[DataFrame]]:
    """Split leaves of more than ``LEAF_ROWS`` rows until k-means finds nothing to split any more.

    Returns the index, whose ``path`` holds each row's leaf by level, and the trees of each level, by leaf.
    """
    levels: list[DataFrame] = []

    def grown(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("key")
        share = len(rows) / rows["count"].iloc[0]
        least = min(64, LEAF_ROWS)
        tree = grow(_matrix(rows["vector"]), leaf_rows=max(least, int(LEAF_ROWS / 4 * share)), seed=seed)
        found = [(rows["leaf"].iloc[0], pickle.dumps(tree))] if tree.leaves > 1 else []
        return pd.DataFrame(found, columns=["leaf", "tree"]).astype({"leaf": "int64"})

    def moved(rows: pd.DataFrame, tree: Tree) -> pd.DataFrame:
        return rows.assign(child=tree.leaf_of(_matrix(rows["vector"])))

    while True:
        large = index.groupBy("leaf").count().where(F.col("count") > LEAF_ROWS)
        dealt = F.pmod(F.xxhash64(F.lit(seed + 2 + len(levels)), "key"), F.lit(1 << 30)) / (1 << 30)
        sampled = index.join(large, "leaf").where(dealt * F.col("count") < sample_rows)
        trees = materialize(
            sampled.select("leaf", "key", "vector", "count").groupBy("leaf").applyInPandas(grown, "leaf long, tree binary"),
            "trees",
        )
        if trees.isEmpty():
            return index, levels
        columns = ["key", "ids", "vector", "leaf"]
        schema = "key string, ids array<long>, vector array<double>, leaf long, path array<long>, child long"
        below = _with_trees(index.select(*columns, "path"), trees, moved, schema)
        same = index.join(trees.select("leaf"), "leaf", "left_anti").select(*columns, "path")
        index = materialize(
            below.withColumn("leaf", _below())
            .select(*columns, "path")
            .unionByName(same)
            .withColumn("path", F.concat("path", F.array("leaf"))),
            "index",
        )
        levels.append(trees)


_VISITS = "key string, vector array<double>, leaf long, bound double, place long"


def _first_visits(queries: DataFrame, tree, visits: int) -> DataFrame:
    """The leaves of the first tree that each query visits."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, vector in zip(batch["key"], batch["vector"]):
                order = tree.value.visits(np.asarray(vector, dtype=np.float64))
                rows += [(key, vector, leaf, bound, n + 1) for n, (leaf, bound) in zip(range(visits), order)]
            yield pd.DataFrame(rows, columns=["key", "vector", "leaf", "bound", "place"])

    return queries.mapInPandas(run, _VISITS)


def _next_visits(visiting: DataFrame, trees: DataFrame, visits: int | None) -> DataFrame:
    """The queue of each query goes on in the trees below the leaves it visits; its nearest leaves are kept."""

    def run(rows: pd.DataFrame, tree: Tree) -> pd.DataFrame:
        out = []
        for key, vector, leaf, bound in zip(rows["key"], rows["vector"], rows["leaf"], rows["bound"]):
            for n, (child, at) in enumerate(tree.visits(np.asarray(vector, dtype=np.float64), bound)):
                if visits is not None and n >= visits:
                    break
                out.append((key, vector, leaf, at, n, child))
        return pd.DataFrame(out, columns=["key", "vector", "leaf", "bound", "place", "child"])

    below = _with_trees(visiting, trees, run, _VISITS + ", child long").withColumn("leaf", _below()).drop("child")
    same = visiting.join(trees.select("leaf"), "leaf", "left_anti").withColumn("place", F.lit(0).cast("long"))
    order = Window.partitionBy("key").orderBy("bound", "place", "leaf")
    placed = below.unionByName(same.select(*below.columns)).withColumn("place", F.row_number().over(order).cast("long"))
    return placed if visits is None else placed.where(F.col("place") <= visits)


def _calibrate(
    index: DataFrame, judged: DataFrame, tree, levels: list[DataFrame], k: int, recall: float
) -> list[int | None]:
    """Leaves to visit at each level so that ``recall`` of the judged rows' true neighbours are met; None is all."""
    spark = index.sparkSession
    rows = judged.orderBy("key").toPandas()
    if not len(rows):
        return [tree.value.leaves or 1] + [None] * len(levels)
    keys, table = rows["key"].tolist(), _matrix(rows["vector"])
    shared = spark.sparkContext.broadcast(table)

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            ids, path = np.array([i[0] for i in batch["ids"]]), batch["path"].to_numpy()
            for q, near, distance in _nearest(shared.value, _matrix(batch["vector"]), ids, k + 1):
                yield pd.DataFrame({"q": q, "id": ids[near], "distance": distance, "path": path[near]})

    closest = Window.partitionBy("q").orderBy("distance", "id")
    true = (
        index.mapInPandas(nearest, "q int, id long, distance double, path array<long>")
        .withColumn("_n", F.row_number().over(closest))
        .where((F.col("_n") <= k + 1) & (F.col("distance") > 0))
        .select("q", "path")
        .collect()
    )
    if not true:
        return [1] * (len(levels) + 1)

    def enough(needed: list[int], depth: int) -> int | None:
        lost = 1 if depth == len(levels) else 1 - 0.5 ** (depth + 1)
        places = sorted(needed)
        at = int(np.ceil((1 - (1 - recall) * lost) * len(true) - 1e-9))
        return places[max(at, 1) - 1] if at <= len(places) else None

    order = {q: {leaf: n + 1 for n, (leaf, _) in enumerate(tree.value.visits(table[q]))} for q in {r.q for r in true}}
    needed = [order[r.q][r.path[0]] for r in true]
    visits: list[int | None] = [enough(needed, 0) or max(tree.value.leaves, 1)]
    visiting = _first_visits(judged, tree, visits[0])
    for depth, trees in enumerate(levels, 1):
        placed = materialize(_next_visits(visiting, trees, None), "judged-visits")
        wanted = spark.createDataFrame([(keys[r.q], r.path[depth]) for r in true], "key string, leaf long")
        met = placed.join(wanted, ["key", "leaf"]).select("place").collect()
        visits.append(enough([r.place for r in met], depth))
        visiting = placed if visits[-1] is None else placed.where(F.col("place") <= visits[-1])
    return visits


def _search_cells(index: DataFrame, visiting: DataFrame, k: int) -> DataFrame:
    """``key, vec_id, score``: the ``k + 1`` nearest ids of each query in the leaves it visits.

    Leaves and the queries that visit them are cut into parts of bounded size; a cell compares two parts.
    """
    sizes = materialize(
        index.groupBy("leaf")
        .agg(F.ceil(F.count(F.lit(1)) / CELL_ROWS).alias("parts"))
        .join(visiting.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / CELL_ROWS).alias("query_parts")), "leaf"),
        "leaf-parts",
    )

    def dealt(table: DataFrame, own: str, other: str) -> DataFrame:
        return (
            table.join(sizes, "leaf")
            .withColumn(own, F.pmod(F.xxhash64("key"), F.col(f"{own}s")))
            .withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"{other}s") - 1)))
        )

    cell = ["leaf", "part", "query_part"]
    left = dealt(visiting, "query_part", "part").select(*cell, "key", "vector")
    right = dealt(index, "part", "query_part").select(*cell, "ids", "vector")

    def compare(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(rows):
            ids = rows["ids"].tolist()
            first = np.array([i[0] for i in ids])
            keys = queries["key"].tolist()
            for q, near, distance in _nearest(_matrix(queries["vector"]), _matrix(rows["vector"]), first, k + 1):
                pairs = sorted((float(d), int(i)) for n, d in zip(near, distance) for i in ids[n])
                out += [(keys[q], i, d) for d, i in pairs[: k + 1]]
        return pd.DataFrame(out, columns=["key", "vec_id", "score"]).astype({"vec_id": "int64", "score": "float64"})

    met = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInPandas(compare, "key string, vec_id long, score double")
    best = F.row_number().over(Window.partitionBy("key").orderBy("score", "vec_id"))
    return materialize(met.withColumn("_n", best).where(F.col("_n") <= k + 1).drop("_n"), "nearest")
