"""Ranked lexical search by pipelined term partitioning.

One scan cuts the documents into blocks and writes an inverted index with a row per block and term. Terms
are owned by stages, the rarest by the first. For every block a bundle of each item travels through the
stages: a stage brings the bundle and the lists it owns together by cogroup, adds whole-number
contributions to the bundle's sparse accumulators and sends it on. The last stage selects, and the best of
all blocks are ranked.

A bundle forgets documents that can no longer come among the best of their block: those whose sum and all
that later stages may add stay below the sum of the block's k-th best. This loses no result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tellerscore.session import materialize

#: A block ends with this many documents or terms, whichever comes first; a longer document is one block.
BLOCK_DOCS, BLOCK_TERMS = 8192, 4_000_000
#: Terms of items that travel together; an item with more is a group by itself.
GROUP_TERMS = 16_384
#: Most bytes of the items' terms that workers get to tell which of a document's terms are asked for.
#: Beyond it the index keeps every term.
SENT_BYTES = 32 << 20
#: Stages own the terms of at least these weights that no earlier stage owns.
OWNED_WEIGHTS = (4000, 2000, 1000, 0)
#: No term contributes more than its weight times this.
MOST = 1_000_000
_INDEX = "block long, term binary, docs binary, tfs binary, nulls binary, n_docs long, n_terms long"
_BUNDLE = "block long, part long, item long, terms array<binary>, weights array<long>, docs binary, scores binary"


def _table() -> bytes:
    kept = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(0x80, 0x100))
    lower = {c: c + 32 for c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    return bytes(lower.get(c, c if c in kept else 0x20) for c in range(256))


_TABLE = _table()


def terms_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and digits and of all characters beyond ASCII, A-Z lower-cased."""
    return text.translate(_TABLE).split()


def _index_task(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value if shared else None
        first = TaskContext.get().partitionId() << 32
        ids: list = []
        lengths: list[int] = []
        lists: dict[bytes, tuple[list[int], list[int]]] = {}
        blocks = total = 0

        def flush() -> Iterator[pa.RecordBatch]:
            none = [i is None for i in ids]
            rows = [(first + blocks, None, np.array([i or 0 for i in ids], dtype="<i8").tobytes(), np.array(lengths, dtype="<i8").tobytes(), np.array(none).tobytes() if any(none) else b"", sum(n > 0 for n in lengths), total)]
            rows += [
                (first + blocks, term, np.array(docs, dtype="<u2" if len(ids) <= 1 << 16 else "<u4").tobytes(), np.array(tfs, dtype="<u4").tobytes(), None, len(docs), sum(tfs))
                for term, (docs, tfs) in lists.items()
            ]
            types = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
            names = ["block", "term", "docs", "tfs", "nulls", "n_docs", "n_terms"]
            for start in range(0, len(rows), 4096):
                columns = zip(*rows[start : start + 4096])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = terms_of(text.as_py())
                counts = Counter(words)
                for term in counts if asked is None else counts.keys() & asked:
                    entry = lists.get(term)
                    if entry is None:
                        entry = lists[term] = ([], [])
                    entry[0].append(len(ids))
                    entry[1].append(counts[term])
                ids.append(doc_id)
                lengths.append(len(words))
                total += len(words)
                if len(ids) >= BLOCK_DOCS or total >= BLOCK_TERMS:
                    yield from flush()
                    ids, lengths, lists, blocks, total = [], [], {}, blocks + 1, 0
        if ids:
            yield from flush()

    return run


def _item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Each item's terms, once each."""

    @F.pandas_udf("array<binary>")
    def terms(texts: pd.Series) -> pd.Series:
        return pd.Series([sorted(set(terms_of(t))) for t in texts])

    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    found = items.select(F.col(id_col).alias("item_id"), F.explode(terms(text)).alias("term"))
    return materialize(found.distinct(), "item-terms")


def _asked(terms: DataFrame):
    """The items' terms for the workers, if they are few enough."""
    distinct = terms.select("term").distinct()
    size = distinct.agg(F.sum(F.octet_length("term") + 50)).first()[0] or 0
    if size > SENT_BYTES:
        return None
    return terms.sparkSession.sparkContext.broadcast(frozenset(bytes(r[0]) for r in distinct.collect()))


def _lengths(rows: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """The documents' m; a whole number that 64 bits hold."""
    exact = rows if float(rows.max(initial=0)) * n_docs * 50 < 2.0**62 else rows.astype(object)
    return (100 - 50 + (50 * exact * n_docs) // n_terms).astype(np.int64)


def _visit(n_docs: int, n_terms: int, least: int, k: int, last: bool):
    """A stage: bundles of one block and group of items meet the lists the stage owns."""

    def run(bundles: pd.DataFrame, owned: pd.DataFrame) -> pd.DataFrame:
        own = owned["term"].isna()
        block = owned[own].iloc[0]
        ids = np.frombuffer(block["docs"], dtype="<i8")
        m = _lengths(np.frombuffer(block["tfs"], dtype="<i8"), n_docs, n_terms)
        kind = np.dtype("<u2" if len(ids) <= 1 << 16 else "<u4")
        gains = {}
        for term, weight, docs, tfs in owned.loc[~own, ["term", "weight", "docs", "tfs"]].itertuples(index=False):
            at, tf = np.frombuffer(docs, dtype=kind), np.frombuffer(tfs, dtype="<u4").astype(np.int64)
            gains[bytes(term)] = at, int(weight) * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[at]))
        out = []
        for item, terms, weights, docs, scores in bundles[["item", "terms", "weights", "docs", "scores"]].itertuples(index=False):
            sums = np.zeros(len(ids), dtype=np.int64)
            sums[np.frombuffer(docs, dtype=kind)] = np.frombuffer(scores, dtype="<i8")
            later = []
            for term, weight in zip(terms, weights):
                if weight < least:
                    later.append((bytes(term), int(weight)))
                elif (gain := gains.get(bytes(term))) is not None:
                    sums[gain[0]] += gain[1]
            found = np.nonzero(sums)[0]
            if len(found) > k:
                kth = np.partition(sums[found], len(found) - k)[len(found) - k]
                found = found[sums[found] + MOST * sum(w for _, w in later) >= kth]
            out.append((item, later, found, sums[found]))
        if not last:
            rows = [(item, [t for t, _ in later], [w for _, w in later], f.astype(kind).tobytes(), s.astype("<i8").tobytes()) for item, later, f, s in out]
            made = pd.DataFrame(rows, columns=["item", "terms", "weights", "docs", "scores"])
            made.insert(0, "part", owned["part"].iloc[0])
            made.insert(0, "block", block["block"])
            return made
        null = np.frombuffer(block["nulls"], dtype=bool) if len(block["nulls"]) else np.zeros(len(ids), dtype=bool)
        parts = []
        for item, _, found, sums in out:
            best = np.lexsort((ids[found], ~null[found], -sums))[:k]
            doc_ids = pd.array(ids[found][best], dtype="Int64")
            doc_ids[null[found][best]] = pd.NA
            parts.append(pd.DataFrame({"item": item, "doc_id": doc_ids, "score": sums[best]}))
        empty = pd.DataFrame({"item": [], "doc_id": pd.array([], dtype="Int64"), "score": []})
        return pd.concat([p for p in parts if len(p)] or [empty], ignore_index=True)

    return run


def _weight(df: Column, n_docs: int) -> Column:
    return F.floor(1000 * F.log(F.lit(float(2 * n_docs + 2)) / (2 * df + 1).cast("double"))).cast("long")


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 50,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The ``k`` best documents of each item: ``item_id, rank, doc_id, score``, ranks from 1.

    Documents whose score is 0 are not listed. Ids of documents are whole numbers, those of items anything.
    Equal scores go by document id, a null id first; rows that repeat an id are documents of their own. Items
    that repeat an id are one item with the terms of all. Null and empty texts have no terms: such items get
    no rows, and such documents count for nothing. Without documents or items there are no rows. Very long
    documents are a block by themselves, very long items travel by themselves. Other columns are not read.
    """
    spark = docs.sparkSession
    terms = _item_terms(items, item_id_col, item_text_col)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    index = materialize(texts.mapInArrow(_index_task(_asked(terms)), _INDEX), "term-index")
    whole = index.where("term IS NULL")
    n_docs, n_terms = whole.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    schema = "item_id string, rank int, doc_id long, score long"
    if not n_docs:
        return spark.createDataFrame([], schema).withColumn("item_id", F.col("item_id").cast(items.schema[item_id_col].dataType))

    counted = index.where("term IS NOT NULL").groupBy("term").agg(F.sum("n_docs").alias("df"))
    weights = counted.select("term", _weight(F.col("df"), n_docs).alias("weight")).where("weight > 0")
    groups = -(-terms.count() // GROUP_TERMS) or 1
    part = F.pmod(F.xxhash64("item_id"), F.lit(groups))
    needed = materialize(terms.join(weights, "term").withColumn("part", part), "needed-terms")
    lists = F.collect_list(F.struct("term", "weight"))
    plan = needed.groupBy("item_id", "part").agg(lists.alias("own"))
    plan = materialize(plan.withColumn("item", F.monotonically_increasing_id()), "items").where("item IS NOT NULL")

    # A group of items goes to every block: the join is by group, spread over copies of the items.
    spread = 16
    copies = F.explode(F.sequence(F.lit(0), F.lit(spread - 1)))
    parts = plan.select("part").distinct()
    wanted = whole.select("block", "docs", "tfs", "nulls", F.pmod(F.xxhash64("block"), F.lit(spread)).alias("copy"))
    places = wanted.select("block", "copy").join(plan.withColumn("copy", copies), "copy")
    bundles = places.select(
        F.col("block").alias("block"), "part", "item", F.col("own.term").alias("terms"), F.col("own.weight").alias("weights"),
        F.lit(b"").alias("docs"), F.lit(b"").alias("scores"),
    )
    block_rows = wanted.join(parts.withColumn("copy", copies), "copy").select(
        "block", "part", F.lit(None).cast("binary").alias("term"), F.lit(None).cast("long").alias("weight"), "docs", "tfs", "nulls"
    )
    above = None
    for least in OWNED_WEIGHTS:
        band = (F.col("weight") >= least) & (F.lit(True) if above is None else F.col("weight") < above)
        own = needed.where(band).select("term", "part", "weight").distinct()
        lists = index.join(own, "term").select("block", "part", "term", "weight", "docs", "tfs", F.lit(None).cast("binary").alias("nulls"))
        last = least == OWNED_WEIGHTS[-1]
        stage = _visit(n_docs, n_terms, least, k, last)
        owned = lists.unionByName(block_rows).groupBy("block", "part")
        kind = "item long, doc_id long, score long" if last else _BUNDLE
        bundles = bundles.groupBy("block", "part").cogroup(owned).applyInPandas(stage, kind)
        above = least
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    best = bundles.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(plan.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
