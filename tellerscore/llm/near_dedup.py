"""MinHash near-dedup: many universal hash minima, bands, signature verification, exact confirmation.

Documents with the same set of shingles are one class from the start, so copies cost nothing further.
Classes that share a band bucket join a cluster through the bucket's least member, and the members of a
cluster are compared in cells of bounded size: signatures first, full sets for what passes. Only links
that connect something new leave a cell.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerscore.llm.common import carried, fresh_names
from tellerscore.llm.components import components
from tellerscore.session import materialize

BANDS, ROWS = 32, 5
HASHES = BANDS * ROWS
#: Members of a cluster that one block holds; a cell compares two blocks.
BLOCK = 256
_OUT = ["n_shingles", "component_id", "kept"]
_MULTIPLIERS = np.array(
    [0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64
)


def _universal(n: int = HASHES) -> tuple[np.ndarray, np.ndarray]:
    """``a * x + b`` modulo 2^32 with odd ``a``: the hash functions."""
    rng = np.random.default_rng(20240229)
    return (rng.integers(0, 1 << 31, n, dtype=np.uint32) << 1 | 1)[:, None], rng.integers(0, 1 << 32, n, dtype=np.uint32)[:, None]


_A, _B = _universal()


def shingles(text: bytes, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; a shorter text is one shingle, an empty one none."""
    found = text.lower().split()  # of bytes: A-Z, and the six white-space characters
    if not found:
        return np.empty(0, dtype=np.uint64)
    if len(found) < words:
        return np.array([xxhash.xxh64_intdigest(b" ".join(found), seed=1)], dtype=np.uint64)
    hashed = np.array(list(map(xxhash.xxh64_intdigest, found)), dtype=np.uint64)
    n = len(hashed) - words + 1
    out = np.zeros(n, dtype=np.uint64)
    for i in range(words):  # the order counts: each step mixes what came before
        out = (out ^ (out >> np.uint64(29)) ^ hashed[i : i + n]) * _MULTIPLIERS[i % len(_MULTIPLIERS)]
    out ^= out >> np.uint64(32)
    return np.unique(out)


def signature(hashes: np.ndarray) -> np.ndarray:
    """Minima of all hash functions over a set."""
    x = (hashes >> np.uint64(32)).astype(np.uint32)[None, :]
    least = np.full(HASHES, 0xFFFFFFFF, dtype=np.uint32)
    for start in range(0, x.shape[1], 1024):
        np.minimum(least, (_A * x[:, start : start + 1024] + _B).min(axis=1), out=least)
    return least


def _signed(words: int):
    @F.pandas_udf("n_shingles long, set_key binary, signature binary")
    def signed(texts: pd.Series) -> pd.DataFrame:
        sets = [shingles(t, words) for t in texts]
        return pd.DataFrame(
            {
                "n_shingles": [len(s) for s in sets],
                "set_key": [hashlib.md5(s.tobytes()).digest() if len(s) else None for s in sets],
                "signature": [signature(s).tobytes() if len(s) else None for s in sets],
            }
        )

    return signed


def _sets(words: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingles(t, words) for t in batch["text"]]
            yield pd.DataFrame(
                {
                    "cluster": batch["cluster"],
                    "node": batch["node"],
                    "shingles": [s.tobytes() for s in sets],
                    "signature": [signature(s).tobytes() if len(s) else b"" for s in sets],
                }
            )

    return run


def least_agreement(percent: int) -> int:
    """Equal minima that a pair at the threshold falls short of once in some millions of pairs."""
    p = percent / 100
    return math.floor(HASHES * p - 5 * math.sqrt(HASHES * p * (1 - p)))


def _compare(percent: int):
    """Links of one cell that connect members which were not connected before."""
    needed = least_agreement(percent)

    def run(cell: pd.DataFrame) -> pd.DataFrame:
        cell = cell[cell["signature"].str.len() > 0].drop_duplicates(["node", "shingles"]).reset_index(drop=True)
        nodes, raw = cell["node"].to_numpy(), cell["shingles"].tolist()
        links: list[tuple[int, int]] = []
        if len(nodes) > 1:
            parent = pd.factorize(cell["label"])[0].tolist()
            first = {}
            parent = [first.setdefault(label, i) for i, label in enumerate(parent)]

            def root(i: int) -> int:
                while parent[i] != i:
                    parent[i] = parent[parent[i]]
                    i = parent[i]
                return i

            table = np.frombuffer(b"".join(cell["signature"]), dtype=np.uint32).reshape(len(nodes), HASHES)
            left, right, agreed = [], [], []
            for i in range(len(nodes) - 1):
                equal = (table[i + 1 :] == table[i]).sum(axis=1)
                passing = np.nonzero(equal >= needed)[0]
                left.append(np.full(len(passing), i))
                right.append(passing + i + 1)
                agreed.append(equal[passing])
            left, right, agreed = map(np.concatenate, (left, right, agreed))
            sets: dict[int, set[int]] = {}

            def members(i: int) -> set[int]:
                if i not in sets:
                    sets[i] = set(np.frombuffer(raw[i], dtype=np.uint64).tolist())
                return sets[i]

            for k in np.argsort(-agreed, kind="stable").tolist():
                i, j = int(left[k]), int(right[k])
                a, b = root(i), root(j)
                n, m = len(raw[i]) // 8, len(raw[j]) // 8
                if a == b or 100 * min(n, m) < percent * max(n, m):
                    continue
                both = len(members(i) & members(j))
                if 100 * both >= percent * (n + m - both):
                    parent[max(a, b)] = min(a, b)
                    links.append((int(nodes[i]), int(nodes[j])))
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return run


def _clusters(reps: DataFrame) -> DataFrame:
    """Classes that share a bucket with others: ``node, component``."""
    keys = F.array(
        *[F.xxhash64(F.lit(b), F.substring("signature", 4 * ROWS * b + 1, 4 * ROWS)) for b in range(BANDS)]
    )
    banded = reps.select(F.explode(keys).alias("bucket"), "rep")
    centres = materialize(
        banded.groupBy("bucket")
        .agg(F.min("rep").alias("centre"), F.max("rep").alias("last"))
        .where(F.col("centre") < F.col("last"))
        .select("bucket", "centre"),
        "buckets",
    )
    stars = banded.join(centres, "bucket").where(F.col("rep") != F.col("centre")).select("centre", "rep").distinct()
    return components(stars)


def _links(members: DataFrame, percent: int) -> DataFrame:
    """Confirmed links within clusters, enough to connect all that any links connect.

    First the members of each block are compared. In clusters of several blocks, members are then dealt
    anew, so that connected ones share blocks, and blocks are compared with each other unless both belong
    to one connected part.
    """
    compare, schema = _compare(percent), "a long, b long"
    blocks = F.ceil(F.coalesce("count", F.lit(1)) / BLOCK)
    large = materialize(members.groupBy("cluster").count().where(F.col("count") > BLOCK), "large-clusters")
    dealt = members.join(large, "cluster", "left").withColumn("block", F.pmod(F.xxhash64("node"), blocks))
    within = materialize(
        dealt.withColumn("label", F.col("node")).groupBy("cluster", "block").applyInPandas(compare, schema), "links"
    )
    if large.isEmpty():
        return within
    parts = components(within).select("node", F.col("component").alias("label"))
    rest = materialize(
        members.join(large, "cluster")
        .select("cluster", "node")
        .distinct()
        .join(parts, "node", "left")
        .withColumn("label", F.coalesce("label", "node")),
        "cluster-parts",
    )
    part_sizes = rest.groupBy("label").count().where(F.col("count") > BLOCK)
    own = rest.join(part_sizes.withColumnRenamed("count", "own"), "label", "left")
    loose = own.where("own IS NULL").groupBy("cluster").agg(F.count(F.lit(1)).alias("loose"))
    placed = materialize(
        own.join(loose, "cluster", "left").select(
            "cluster",
            "node",
            "label",
            F.when(F.col("own").isNotNull(), F.col("label")).alias("part"),
            F.when(F.col("own").isNotNull(), F.pmod(F.xxhash64("node"), F.ceil(F.col("own") / BLOCK)))
            .otherwise(F.pmod(F.xxhash64("label"), F.ceil(F.coalesce("loose", F.lit(1)) / BLOCK)))
            .alias("block"),
        ),
        "blocks",
    ).withColumn("block", F.xxhash64("cluster", F.coalesce("part", F.lit(-1)), F.col("part").isNull(), "block"))
    listed = materialize(placed.select("cluster", "block", "part").distinct(), "block-list")
    a, b = (listed.select(*[F.col(c).alias(f"{c}_{side}") for c in listed.columns]) for side in "ab")
    cells = a.join(b, (a["cluster_a"] == b["cluster_b"]) & (a["block_a"] <= b["block_b"])).where(
        "part_a IS NULL OR part_b IS NULL OR part_a <> part_b"
    )
    cells = cells.select("block_a", "block_b", F.explode(F.array_distinct(F.array("block_a", "block_b"))).alias("block"))
    between = (
        placed.select("node", "label", "block")
        .join(members.select("node", "shingles", "signature"), "node")
        .join(cells, "block")
        .groupBy("block_a", "block_b")
        .applyInPandas(compare, schema)
    )
    return within.unionByName(materialize(between, "links"))


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Group documents whose shingle sets have a Jaccard similarity of ``percent`` hundredths or more.

    Returns every input row without its text, with ``n_shingles`` (size of the set), ``component_id`` (the
    smallest id that links reach, itself included) and ``kept`` (the id is the component's).

    A text is lower-cased (A-Z) and cut at the six white-space characters. A text of fewer words is one
    shingle; null, empty and blank texts have none, link with nothing and stay. Links are confirmed on full
    sets. A row without an id is only grouped with equal sets, where another row's id stands for it; if none
    has one, ``component_id`` is null and it stays. Rows with one id are one node: their links unite. No
    rows give no rows. Input columns named like an output are replaced.

    A pair at the threshold shares a bucket but for a chance of 7e-9 (0.85) or 3e-6 (0.8).
    """
    wanted = fresh_names(docs, _OUT)
    ident, text = F.col(id_col).cast("long"), F.coalesce(text_col, F.lit("")).cast("binary")
    signed = wanted.select(carried(wanted, text_col), ident.alias("_id"), _signed(words)(text).alias("_signed"))
    rows = materialize(signed.select("_in", "_id", "_signed.*"), "signatures")
    sets = rows.where("n_shingles > 0").groupBy("set_key").agg(F.min("_id").alias("rep"))
    own = rows.select("set_key", F.col("_id").alias("rep"), "signature").join(sets, ["set_key", "rep"])
    clusters = _clusters(materialize(own.select("rep", "signature"), "classes"))
    members = materialize(
        docs.select(ident.alias("id"), text.alias("text"))
        .join(clusters.hint("merge"), F.col("id") == F.col("node"))  # one plan at every size
        .select("node", F.col("component").alias("cluster"), "text")
        .mapInPandas(_sets(words), "cluster long, node long, shingles binary, signature binary"),
        "members",
    )
    joined = components(_links(members, percent)).withColumnRenamed("node", "rep")
    # Written, so that the join with it is one of plain exchanges, in which the copies of one set can be split.
    labels = materialize(
        sets.join(joined, "rep", "left").select("set_key", F.coalesce("component", "rep").alias("component_id")),
        "labels",
    )
    component = F.coalesce("component_id", "_id").alias("component_id")
    return (
        rows.drop("signature")
        .join(labels, "set_key", "left")
        .select("_in.*", "n_shingles", component, F.col("_id").eqNullSafe(component).alias("kept"))
    )
