"""A quality classifier as a sparse ensemble of rules.

Statistics of a text are numbers such as its share of symbols. Trees grown on a sample of labelled texts give
conjunctive rules: every path from a root to a node below it. A lasso logistic regression on which rules
hold leaves few of them, and those are compiled into one Spark column expression over the statistics.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerscore.llm.common import carried, fresh_names
from tellerscore.session import materialize

_OUT = ["score", "predicted"]
#: Classes of bytes whose shares are statistics.
BYTES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "space": b" \t\n\x0b\x0c\r",
    "sentence": b".,;:?'\"()-",
    "symbol": b"!#$%&*+/<=>@[\\]^_`{|}~",
    "control": bytes([*range(9), *range(14, 32), 127]),
    "beyond_ascii": bytes(range(128, 256)),
}
#: Statistics of a text, in this order.
STATISTICS = [
    *[f"{name}_share" for name in BYTES],
    "log_bytes", "log_words", "log_longest_word", "mean_word", "distinct_words", "top_word", "capital_words",
    "odd_endings", "odd_words", "log_lines", "words_a_line", "distinct_lines", "ended_lines",
]
_MASKS = np.array([[byte in group for byte in range(256)] for group in BYTES.values()], dtype=np.float64)
_ODD = frozenset(BYTES["symbol"])
_PLAIN = frozenset(BYTES["upper"] + BYTES["lower"] + BYTES["beyond_ascii"])
_CAPITAL = frozenset(BYTES["upper"])


def statistics_of(text: bytes) -> list[float]:
    """All :data:`STATISTICS` of one text; an empty text has zeros."""
    n = len(text)
    shares = _MASKS @ np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256) / max(n, 1)
    counts = Counter(text.split())
    words = max(sum(counts.values()), 1)
    capital = odd = ends = chars = longest = top = 0
    for word, times in counts.items():
        chars += times * len(word)
        longest, top = max(longest, len(word)), max(top, times)
        capital += times * (word[0] in _CAPITAL)
        ends += times * (word[-1] in _ODD)
        odd += times * (word[0] not in _PLAIN)
    lines = [line for line in map(bytes.strip, text.split(b"\n")) if line]
    n_lines = max(len(lines), 1)
    ended = sum(line[-1] in b".!?" for line in lines)
    return [
        *shares.tolist(), math.log1p(n), math.log1p(sum(counts.values())), math.log1p(longest), chars / words,
        len(counts) / words, top / words, capital / words, ends / words, odd / words, math.log1p(len(lines)),
        sum(counts.values()) / n_lines, len(set(lines)) / n_lines, ended / n_lines,
    ]


def statistics(text: Column) -> Column:
    """An array of all :data:`STATISTICS`; null counts as empty."""

    @F.pandas_udf("array<double>")
    def found(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics_of(t) for t in texts])

    return found(F.coalesce(text, F.lit("")).cast("binary"))


@dataclass(frozen=True)
class Rule:
    """Bounds of statistics, by number: each must exceed ``low`` and not exceed ``high``."""

    bounds: tuple[tuple[int, float, float], ...]
    weight: float = 0.0

    def holds(self, found: Column) -> Column:
        tests = [found[i] > low for i, low, _ in self.bounds if low > -math.inf]
        tests += [found[i] <= high for i, _, high in self.bounds if high < math.inf]
        return reduce(Column.__and__, tests)

    def __str__(self) -> str:
        tests = [f"{STATISTICS[i]} > {low:g}" for i, low, _ in self.bounds if low > -math.inf]
        tests += [f"{STATISTICS[i]} <= {high:g}" for i, _, high in self.bounds if high < math.inf]
        return " AND ".join(tests)


@dataclass(frozen=True)
class RuleModel:
    """The log odds of label 1: ``intercept`` and the weights of the rules that hold."""

    intercept: float
    rules: tuple[Rule, ...] = ()

    def log_odds(self, found: Column) -> Column:
        parts = [F.when(rule.holds(found), rule.weight).otherwise(0.0) for rule in self.rules]
        return reduce(Column.__add__, parts, F.lit(self.intercept))

    def probability(self, found: Column) -> Column:
        return 1 / (1 + F.exp(-self.log_odds(found)))


_SPLIT = re.compile(r"^( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)$")


def paths(forest: RandomForestClassificationModel) -> list[Rule]:
    """A rule for every path of the forest that starts at a root, each different one once."""
    found: dict[tuple, Rule] = {}
    tests: list[tuple[int, str, float]] = []
    for line in forest.toDebugString.split("\n"):
        if line.lstrip().startswith("Tree "):
            base, tests = None, []
        elif match := _SPLIT.match(line):
            base = len(match[1]) if base is None else base
            tests = [*tests[: len(match[1]) - base], (int(match[2]), match[3], float(match[4]))]
            bounds: dict[int, tuple[float, float]] = {}
            for i, side, at in tests:
                low, high = bounds.get(i, (-math.inf, math.inf))
                bounds[i] = (max(low, at), high) if side == ">" else (low, min(high, at))
            key = tuple((i, *bounds[i]) for i in sorted(bounds))
            found.setdefault(key, Rule(key))
    return list(found.values())


def _labelled(labels: DataFrame, id_col: str, label_col: str, chosen: Column | None, rows: int) -> DataFrame:
    """Ids with one label, 0 or 1; about ``rows`` of them if there are more, chosen by a hash of the id."""
    usable = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    usable = usable if chosen is None else usable.where(chosen)
    single = usable.groupBy(F.col(id_col).alias("_id")).agg(F.min(label_col).alias("_label"), F.max(label_col).alias("_other"))
    single = materialize(single.where("_label = _other").select("_id", F.col("_label").cast("double")), "labels")
    share = rows / max(single.count(), 1)
    if share < 1:
        single = single.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    return single


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    training: Column | None = None,
    train_rows: int = 20_000,
    trees: int = 20,
    depth: int = 3,
    lasso: float = 0.001,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> RuleModel:
    """Learn from the labelled rows whose ids ``training`` admits (a condition on the columns of ``labels``).

    ``train_rows`` bounds the fit: of more labelled ids about that many are used, chosen by a hash. Labels
    other than 0 and 1, ids with both, and null ids teach nothing; labels may repeat. Of documents that repeat
    an id one is used. Without labelled documents every text scores 0.5; with one label only, its
    smoothed share. At most ``trees * (2 ** (depth + 1) - 2)`` rules are weighed.
    """
    chosen = _labelled(labels, id_col, label_col, training, train_rows)
    # At most about train_rows pairs of numbers, so they go to every task and no text is shuffled.
    known = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(chosen), "_id")
    found = known.select("_id", "_label", statistics(F.col("_text")).alias("found"))
    single = found.groupBy("_id").agg(F.min("_label").alias("label"), F.min("found").alias("found"))
    rows = materialize(single.repartition(8, "_id").sortWithinPartitions("_id"), "labelled-statistics")
    ones, n = rows.agg(F.sum("label"), F.count(F.lit(1))).first()
    ones = ones or 0.0
    if not 0 < ones < n:
        return RuleModel(math.log((ones + 0.5) / (n - ones + 0.5)))
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, maxBins=64, featureSubsetStrategy="onethird", minInstancesPerNode=5, seed=13
    ).fit(rows.select("label", array_to_vector("found").alias("features")))
    rules = paths(forest)
    if not rules:
        return RuleModel(math.log((ones + 0.5) / (n - ones + 0.5)))
    held = F.array(*[rule.holds(F.col("found")).cast("double") for rule in rules])
    table = materialize(rows.select("label", array_to_vector(held).alias("features")), "rules")
    weighed = LogisticRegression(regParam=lasso, elasticNetParam=1.0, maxIter=60).fit(table)
    weights = weighed.coefficients.toArray()
    return RuleModel(float(weighed.intercept), tuple(Rule(r.bounds, float(w)) for r, w in zip(rules, weights) if w))


def score(docs: DataFrame, model: RuleModel, text_col: str = "text") -> DataFrame:
    """All rows without their text, with ``score`` (probability of label 1) and ``predicted`` (1 from 0.5 on).

    Every text is read whole. Null counts as empty and scores like it. Rows that repeat come out alike, no rows
    give none. Input columns named like an output are replaced, all others stay.
    """
    wanted = fresh_names(docs, _OUT)
    found = wanted.select(carried(wanted, text_col), statistics(docs[text_col]).alias("_found"))
    scored = found.select("_in", model.probability(F.col("_found")).alias("score"))
    return scored.select("_in.*", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
