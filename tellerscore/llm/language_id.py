"""Language ID, words first: known words by log frequency, others by ever shorter character n-grams."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tellerscore.llm.common import fresh_names

UNDETERMINED = "und"
WORD = re.compile(r"[^\W\d_]+")
#: Lengths of n-grams, longest first; a word is padded with its two ends.
ORDERS = (4, 3, 2, 1)
#: Most entries that a training task counts before it hands them on, and that a worker remembers.
COUNTED, MEMO = 500_000, 300_000
_OUT = ["lang_pred", "score"]


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def grams_of(word: str, n: int) -> list[str]:
    padded = f"^{word}$"
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


@dataclass
class Model:
    """Row numbers of words and n-grams, and a row of log frequencies per language for each."""

    langs: list[str]
    words: dict[str, int]
    grams: dict[str, int]
    rows: np.ndarray

    def backoff(self, word: str) -> np.ndarray:
        """Mean of the known n-grams of the greatest length at which any is known."""
        for n in ORDERS:
            known = [self.grams[g] for g in grams_of(word, n) if g in self.grams]
            if known:
                return self.rows[known].mean(axis=0)
        return np.zeros(len(self.langs))


class Scorer:
    """Scores texts with a model and a bounded memo of unseen words."""

    def __init__(self, model: Model):
        self.model = model
        size = len(model.rows)
        self.first = size
        self.table = np.vstack([model.rows, np.zeros((MEMO, len(model.langs)))])
        self.memo: dict[str, int] = {}

    def _row(self, word: str) -> int:
        at = self.first + len(self.memo)
        self.table[at] = self.model.backoff(word)
        self.memo[word] = at
        return at

    def score(self, text: str | None) -> tuple[str, float]:
        model = self.model
        if not text or not model.langs or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0
        total = np.zeros(len(model.langs))
        words, known = words_of(text), model.words
        for start in range(0, len(words), MEMO):
            part = words[start : start + MEMO]
            if len(self.memo) + len(part) > MEMO:  # only then could this part overfill it
                self.memo.clear()
            memo = self.memo
            at = []
            for word in part:
                row = known.get(word)
                if row is None:
                    row = memo.get(word)
                    if row is None:
                        row = self._row(word)
                at.append(row)
            total += self.table[at].sum(axis=0)
        weights = np.exp(total - total.max())
        best = int(weights.argmax())
        return model.langs[best], float(weights[best] / weights.sum())


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Words (order 0) and n-grams of each language, handed on whenever many words have gathered."""
    words: dict[str, Counter] = {}

    def flush() -> Iterator[pd.DataFrame]:
        for lang, seen in words.items():
            counts = {0: seen, **{n: Counter() for n in ORDERS}}
            for word, times in seen.items():
                for n in ORDERS:
                    grams = counts[n]
                    for gram in grams_of(word, n):
                        grams[gram] += times
            for n, found in counts.items():
                yield pd.DataFrame({"lang": lang, "n": n, "unit": list(found), "count": list(found.values())})
        words.clear()

    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"]):
            words.setdefault(lang, Counter()).update(words_of(text))
        if sum(map(len, words.values())) > COUNTED:
            yield from flush()
    yield from flush()


def _shares(rows: dict[str, int], total: int) -> dict[str, float]:
    """The rate of each language at which ``total`` is shared evenly; what a small one leaves goes to the others."""
    rates, left = {}, total
    for i, (lang, n) in enumerate(sorted(rows.items(), key=lambda r: (r[1], r[0]))):
        own = min(float(n), left / (len(rows) - i))
        rates[lang], left = own / n, left - own
    return rates


def fit(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    max_docs: int = 10_000,
    max_words: int | None = None,
    max_grams: int | None = None,
    id_col: str = "doc_id",
) -> Model:
    """Learn from labelled rows; rows without text or language teach nothing.

    ``max_docs`` bounds the sample on average, chosen by hash of the text and, if there is one, the id.
    The model keeps every word and n-gram of the sample. ``max_words`` and ``max_grams``, where given, keep the
    most frequent units of each language, ties in the order of the unit. Languages share the bounds evenly; what
    one does not need goes to the others. No labelled row gives a model without languages.
    """
    keys = [text_col, *([id_col] if id_col in docs.columns else [])]
    labelled = docs.select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(*keys).alias("mark")
    ).where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = dict(docs.where(F.col(lang_col).isNotNull()).groupBy(lang_col).count().collect())
    if not rows:
        return Model([], {}, {}, np.zeros((0, 0)))
    parts = 1 << 30
    limits = [(F.lit(lang), F.lit(int(parts * rate))) for lang, rate in _shares(rows, max_docs).items() if rate < 1]
    sample = labelled
    if limits:
        limit = F.create_map(*[c for pair in limits for c in pair])[F.col("lang")]
        sample = labelled.where(F.pmod("mark", F.lit(parts)) < F.coalesce(limit, F.lit(parts)))
    sample = sample.select("lang", "text")
    counts = (
        sample.mapInPandas(_count, "lang string, n int, unit string, count long")
        .groupBy("n", "unit", "lang")
        .agg(F.sum("count").alias("count"))
    )
    own = Window.partitionBy("lang").orderBy(F.desc("count"), "n", "unit")

    def most(units: DataFrame, bound: int | None) -> pd.DataFrame:
        if bound is None:
            return units.orderBy("n", "unit", "lang").toArrow().to_pandas()
        ranked = units.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= bound)
        return ranked.orderBy("rank", F.desc("count"), "lang").limit(bound).drop("rank").toArrow().to_pandas()

    kept = [most(counts.where("n = 0"), max_words), most(counts.where("n > 0"), max_grams)]
    table = pd.concat(kept)
    langs = sorted(table["lang"].unique())
    column = {lang: i for i, lang in enumerate(langs)}
    index: list[dict[str, int]] = [{}, {}]
    for n, unit in zip(table["n"], table["unit"]):
        index[n > 0].setdefault(unit, len(index[0]) + len(index[1]))
    found = np.zeros((len(index[0]) + len(index[1]), len(langs)))
    at = [index[n > 0][unit] for n, unit in zip(table["n"], table["unit"])]
    found[at, [column[lang] for lang in table["lang"]]] = table["count"]
    order_of = np.zeros(len(found), dtype=int)
    order_of[at] = table["n"]
    logs = np.empty_like(found)
    for n in (0, *ORDERS):
        own = order_of == n
        if not own.any():
            continue
        smoothed = found[own] + 0.5
        logs[own] = np.log(smoothed) - np.log(smoothed.sum(axis=0, keepdims=True))
    return Model(langs, index[0], index[1], logs)


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score`` (posterior of that language, 0 to 1) to every row.

    Only the text is used, all of it. Null text, text without a letter and a model without languages give
    ``und`` and score 0. A tie goes to the first language in order. Rows keep their number and columns;
    columns named like an output are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by fit's parameters
    scorers: list[Scorer] = []

    @F.pandas_udf("lang_pred string, score double")
    def scored(texts: pd.Series) -> pd.DataFrame:
        if not scorers:
            scorers.append(Scorer(shared.value))
        return pd.DataFrame([scorers[0].score(t) for t in texts], columns=["lang_pred", "score"])

    wanted = fresh_names(docs, _OUT)
    return wanted.withColumn("_scored", scored(F.col(text_col))).select(*wanted.columns, "_scored.*")
