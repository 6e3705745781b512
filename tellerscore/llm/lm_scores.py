"""Language-model scores: corpus counts, and a gated recurrent model trained by parameter averaging.

Counts cover all training documents. The recurrent model knows the most frequent tokens; every other
token is its "outside" token times that token's smoothed frequency among the outside ones, so a text's
probability covers all its tokens and no vocabulary is open-ended on any one machine.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerscore.llm import gru
from tellerscore.llm.common import carried, fresh_names
from tellerscore.session import materialize

#: The key of the end token among the words, which are never empty.
END = b""
#: Most words that a counting task gathers before it hands them on.
COUNTED = 300_000
_CHUNK = 1 << 12
_OUT = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased (A-Z) words between the six white-space characters."""
    return text.lower().split()


@dataclass
class Counts:
    """``table`` has ``word, n``; the rest are its sums, the most frequent words, and the end's count."""

    table: DataFrame
    tokens: int
    distinct: int
    frequent: dict[bytes, int]
    ends: int


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: Counter = Counter()

    def flush() -> pd.DataFrame:
        out = pd.DataFrame({"word": list(counts), "n": list(counts.values())}).astype({"n": "int64"})
        counts.clear()
        return out

    for batch in batches:
        for text in batch["text"]:
            counts.update(words_of(text))
            counts[END] += 1
            if len(counts) > COUNTED:
                yield flush()
    if counts:
        yield flush()


def count_words(texts: DataFrame, frequent: int) -> Counts:
    """Counts over all rows of ``text`` (binary).

    Only sums by size and the most frequent words come to the driver, about ``frequent`` of them. A size is a
    sixteenth of a power of two; in the size that does not fit as a whole, exact counts decide, and among
    words of one count a hash of the word.
    """
    table = materialize(
        texts.mapInPandas(_count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "word-counts"
    )
    size = F.floor(F.log2("n") * 16)
    found = sorted(table.groupBy(size.alias("size")).agg(F.sum("n"), F.count(F.lit(1))).collect(), reverse=True)
    ends = table.where(F.col("word") == F.lit(END)).agg(F.sum("n")).first()[0] or 0
    room, wanted = frequent, F.lit(True)
    for size_, _, words in found:  # a few hundred sizes, the largest first
        if words > room:
            wanted = (size > size_) | ((size == size_) & _most(table.where(size == size_), room))
            break
        room -= words
    kept = table.where(wanted).toPandas()
    most = {bytes(w): -n for n, w in sorted(zip((-kept["n"]).tolist(), map(bytes, kept["word"])))}
    return Counts(table, sum(f[1] for f in found), sum(f[2] for f in found), most, ends)


def _most(words: DataFrame, room: int) -> Column:
    """A condition that about ``room`` of ``words`` meet, the most frequent ones, and of equals by hash."""
    for n, equals in words.groupBy("n").count().orderBy(F.desc("n")).collect():  # counts of one size
        if equals > room:
            share = F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < int(room / equals * (1 << 30))
            return (F.col("n") > n) | ((F.col("n") == n) & share)
        room -= equals
    return F.lit(True)


def _in_groups(texts: Iterable[bytes], most: int = 4 << 20) -> Iterator[list[bytes]]:
    """Texts in their order, in groups of about ``most`` bytes or of one longer text."""
    group, held = [], 0
    for text in texts:
        group.append(text)
        held += len(text)
        if held >= most:
            yield group
            group, held = [], 0
    if group:
        yield group


def words_of_all(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """:func:`words_of` of many texts: the words one after another, and where those of each text end."""
    text = pa.array(texts, pa.large_binary()).view(pa.large_string())
    parts = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.ascii_lower(text)))
    words = parts.values.view(pa.large_binary())
    ends = parts.offsets.to_numpy()[1:].astype(np.int64)
    kept = pc.binary_length(words).to_numpy() > 0  # a text without words is one empty part
    if not kept.all():
        words, ends = words.filter(pa.array(kept)), np.concatenate([[0], np.cumsum(kept)])[ends]
    return words, ends


def _places(words: pa.Array, among: pa.Array) -> np.ndarray:
    """The place of each word among others, or how many those are."""
    return pc.index_in(words, value_set=among).fill_null(len(among)).to_numpy()


@dataclass
class Vocabulary:
    """Ids of the words that the recurrent model knows, in the order of their ids; ``counts`` by id."""

    ids: dict[bytes, int]
    counts: np.ndarray

    def encode(self, texts: Iterable[bytes]) -> list[np.ndarray]:
        """The ids of each text, and the end."""
        known = pa.array(list(self.ids), pa.large_binary())
        number = np.append(np.fromiter(self.ids.values(), np.int32, len(self.ids)), np.int32(gru.OUTSIDE))
        out = []
        for group in _in_groups(texts):
            words, ends = words_of_all(group)
            out += np.split(np.insert(number[_places(words, known)], ends, gru.END), (ends + np.arange(1, len(ends) + 1))[:-1])
        return out


def vocabulary(counts: Counts, size: int) -> Vocabulary:
    words = [w for w in counts.frequent if w != END][: size - 2]
    own = [counts.frequent[w] for w in words]
    outside = counts.tokens - counts.ends - sum(own)
    return Vocabulary({w: i + 2 for i, w in enumerate(words)}, np.array([outside, counts.ends, *own], dtype=float))


def _train_task(shared, rate: float, turn: int, turns: int):
    """Train on a turn's whole documents of a partition, and hand on the weights in chunks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocab, params = shared.value
        trainer = gru.Trainer(params, rate)
        for batch in batches:
            trainer.learn(vocab.encode(t for t in batch["text"] if zlib.crc32(t) % turns == turn))
        if trainer.tokens:
            values = gru.flat(trainer.p)
            chunks = [values[i : i + _CHUNK].tobytes() for i in range(0, len(values), _CHUNK)]
            yield pd.DataFrame({"chunk": range(len(chunks)), "weights": chunks, "tokens": trainer.tokens})

    return run


def _average(rows: pd.DataFrame) -> pd.DataFrame:
    weights = np.zeros(len(rows["weights"].iloc[0]) // 4)
    for part, tokens in zip(rows["weights"], rows["tokens"]):
        weights += np.frombuffer(part, dtype=np.float32).astype(np.float64) * tokens
    tokens = int(rows["tokens"].sum())
    mean = (weights / tokens).astype(np.float32).tobytes()
    return pd.DataFrame({"chunk": [rows["chunk"].iloc[0]], "weights": [mean], "tokens": [tokens]})


def train(
    texts: DataFrame, vocab: Vocabulary, hidden: int = 16, per_class: int = 64, turns: int = 2
) -> gru.Params:
    """Weights averaged over the partitions, ``turns`` times, each on other documents.

    Every document of ``text`` (binary) is learned from once, from its first token to its end; its hash
    chooses the turn. The weights are bounded by the vocabulary; they are averaged by tokens, in two steps, so
    no task holds many partitions' copies.
    """
    params = gru.initial(vocab.counts, hidden, per_class)
    schema = "chunk int, weights binary, tokens long"
    for turn in range(turns):
        shared = texts.sparkSession.sparkContext.broadcast((vocab, params))
        trained = texts.mapInPandas(_train_task(shared, 0.01 / (turn + 1), turn, turns), schema)
        trained = materialize(trained.withColumn("group", F.spark_partition_id() % 64), "weights")
        some = trained.groupBy("chunk", "group").applyInPandas(lambda rows: _average(rows), schema)
        means = some.groupBy("chunk").applyInPandas(lambda rows: _average(rows), schema).orderBy("chunk").collect()
        if means:
            params = gru.shaped(np.concatenate([np.frombuffer(r["weights"], np.float32) for r in means]), params)
    return params


@dataclass
class Lookup:
    """For each frequent word a number, and by number (the last stands for all others) its id in the
    vocabulary, and log10 of its count plus a half, once for all words and once outside the vocabulary."""

    numbers: dict[bytes, int]
    ids: np.ndarray
    logs: np.ndarray
    outside_logs: np.ndarray
    ends: int

    @classmethod
    def of(cls, counts: Counts, vocab: Vocabulary) -> Lookup:
        words = [w for w in counts.frequent if w != END]
        ids = np.array([vocab.ids.get(w, gru.OUTSIDE) for w in words] + [gru.OUTSIDE], dtype=np.int32)
        logs = np.log10(np.array([counts.frequent[w] + 0.5 for w in words] + [1.0]))
        return cls(
            {w: i for i, w in enumerate(words)},
            ids,
            logs,
            np.where(ids == gru.OUTSIDE, logs, 0.0),
            counts.ends,
        )


def _score_udf(shared):
    """What a worker can tell of a text: model score, sums over frequent words, and the other words."""

    @F.pandas_udf(
        "n_tokens long, model double, n_known long, logs double, n_outside long, outside_logs double, "
        "words array<binary>, times array<int>"
    )
    def scored(texts: pd.Series) -> pd.DataFrame:
        params, lookup = shared.value
        frequent, end = pa.array(list(lookup.numbers), pa.large_binary()), float(np.log10(lookup.ends + 0.5))
        ids, rows = [], []
        for group in _in_groups(texts):
            words, ends = words_of_all(group)
            at = _places(words, frequent)
            rare = np.flatnonzero(at == len(frequent))
            rare_words, rare_ends = words.take(pa.array(rare)).to_pylist(), np.searchsorted(rare, ends)
            start = rare_start = 0
            for stop, rare_stop in zip(ends.tolist(), rare_ends.tolist()):
                here = at[start:stop]
                own = np.append(lookup.ids[here], np.int32(gru.END))
                ids.append(own)
                others = Counter(rare_words[rare_start:rare_stop])
                known = stop - start - (rare_stop - rare_start) + (lookup.ends > 0)
                logs, outside_logs = float(lookup.logs[here].sum()) + end, float(lookup.outside_logs[here].sum())
                n_outside = int((own == gru.OUTSIDE).sum())
                rows.append((len(own), known, logs, n_outside, outside_logs, list(others), list(others.values())))
                start, rare_start = stop, rare_stop
        out = pd.DataFrame(
            rows, columns=["n_tokens", "n_known", "logs", "n_outside", "outside_logs", "words", "times"]
        )
        out.insert(1, "model", gru.score(params, ids) / np.log(10))
        return out

    return scored


def score(
    docs: DataFrame,
    training: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    frequent_words: int = 100_000,
    vocabulary_size: int = 4096,
) -> DataFrame:
    """Score all rows with what the rows marked by ``training`` teach.

    Returns every input row without its text, with ``n_tokens`` (words and one end), ``n_known`` (tokens
    that occur in training), ``train_tokens``, ``base_score`` (sum of log10 add-half smoothed frequencies)
    and ``score`` (the model's log10 probability of the text).

    Null text counts as empty: one token, the end. A row without a mark is not trained on. Repeated rows
    come out alike. Without training rows nothing is known, ``base_score`` is 0, and the model is the
    untrained one. No rows give no rows. Input columns named like an output are replaced.

    ``frequent_words`` and ``vocabulary_size`` bound what is sent to workers; the counts of all other words
    are joined by word.
    """
    wanted = fresh_names(docs, _OUT)
    text = F.coalesce(text_col, F.lit("")).cast("binary")
    texts = docs.where(training).select(text.alias("text"))
    counts = count_words(texts, frequent_words)
    vocab = vocabulary(counts, vocabulary_size)
    params = train(texts, vocab)

    outside_tokens = int(vocab.counts[0])
    outside_words = counts.distinct - len(vocab.ids) - (counts.ends > 0)
    share = float(np.log10(outside_tokens + 0.5 * (outside_words + 1)))
    shared = docs.sparkSession.sparkContext.broadcast((params, Lookup.of(counts, vocab)))
    scored = wanted.select(
        carried(wanted, text_col), F.monotonically_increasing_id().alias("_row"), _score_udf(shared)(text).alias("_s")
    )
    rows = materialize(scored.select("_in", "_row", "_s.*"), "lm-rows")
    rest = rows.select("_row", F.explode(F.arrays_zip("words", "times")).alias("r")).select(
        "_row", F.col("r.words").alias("word"), F.col("r.times").alias("times")
    )
    n = F.coalesce("n", F.lit(0))
    rare = (
        rest.join(counts.table, "word", "left")
        .groupBy("_row")
        .agg(
            F.sum(F.col("times") * F.log10(n + F.lit(0.5))).alias("_logs"),
            F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("_known"),
        )
    )
    denominator = float(np.log10(counts.tokens + 0.5 * (counts.distinct + 1)))
    logs = F.coalesce("_logs", F.lit(0.0))
    return (
        rows.drop("words", "times")
        .join(rare, "_row", "left")
        .select(
            "_in.*",
            "n_tokens",
            (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
            F.lit(int(counts.tokens)).cast("long").alias("train_tokens"),
            (F.col("logs") + logs - F.col("n_tokens") * F.lit(denominator)).alias("base_score"),
            (F.col("model") + F.col("outside_logs") + logs - F.col("n_outside") * F.lit(share)).alias("score"),
        )
    )
