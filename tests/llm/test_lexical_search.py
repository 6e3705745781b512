"""Lexical search against a plain version, over several blocks, groups of items and ways to build the index."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import Row

from tellerscore.llm import lexical_search
from tests.llm.documents import frame, rows

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
ITEMS = "item_id long, text string, score string"


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k):
    counted = [(r[0], Counter(terms(r[1]))) for r in docs]
    n_docs, n_terms = sum(bool(c) for _, c in counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked = {}
    for item, text, *_ in items:
        asked.setdefault(item, set()).update(terms(text))
    out = {}
    for item, own in asked.items():
        scored = []
        for doc_id, c in counted:
            m = 50 + (50 * sum(c.values()) * n_docs) // max(n_terms, 1)
            score = 0
            for t in own:
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m))
            if score:
                scored.append((-score, doc_id is not None, doc_id))
        for rank, (score, _, doc_id) in enumerate(sorted(scored, key=lambda s: (s[0], s[1], s[2] or 0))[:k], 1):
            out[item, rank] = (doc_id, -score)
    return out


def found(df):
    return {(r["item_id"], r["rank"]): (r["doc_id"], r["score"]) for r in df.collect()}


def items_of(docs):
    texts = [r[1] for r in docs[:12] if r[1]]
    items = [(i, " ".join(t.split()[3 * i : 3 * i + 9]), "clash") for i, t in enumerate(texts)]
    items += [(50, None, None), (51, "", None), (52, " .,; ", None), (53, "nowhere to be found", None)]
    items += [(54, "water", None), (54, "HOUSE Wasser", None), (54, "water", None), (None, "morning words", None)]
    return [*items, (55, "É漢字 É x😀 y", None), (56, docs[144][1] or "", None)]


@pytest.mark.parametrize("way", ["one block", "small blocks", "all terms", "small groups"])
def test_against_plain_version(spark, monkeypatch, way):
    docs = rows()
    docs += [(900, "same text of words", "en", "s", 1), (901, "same text of words", "en", "s", 1), (902, "É漢字 z", "fr", "s", 1)]
    docs += [(903, "x😀 \x00nul\x7fdel é", "fr", "s", 1)]
    items = items_of(docs)
    if way != "one block":
        monkeypatch.setattr(lexical_search, "BLOCK_DOCS", 16)
    if way == "all terms":
        monkeypatch.setattr(lexical_search, "SENT_BYTES", 0)
        monkeypatch.setattr(lexical_search, "BLOCK_TERMS", 2000)
    if way == "small groups":
        monkeypatch.setattr(lexical_search, "GROUP_TERMS", 20)
    df = frame(spark, docs, ("rank", "term", "block")).repartition(3)
    got = lexical_search.search(df, spark.createDataFrame(items, ITEMS), k=7)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert found(got) == brute(docs, items, 7)


def test_forgetting_loses_nothing(spark, monkeypatch):
    """Many equal and nearly equal scores around the last place, few places, blocks larger than k."""
    docs = [(i, " ".join(["common"] * (1 + i % 3) + [f"r{i % 11}", f"q{i % 7}", "often" if i % 2 else "seldom"] + ["fill"] * (i % 5)), "en", "s", 1) for i in range(400)]
    items = [(i, f"common r{i} q{i % 5} often seldom fill r{i + 1}", None) for i in range(9)]
    monkeypatch.setattr(lexical_search, "BLOCK_DOCS", 100)
    monkeypatch.setattr(lexical_search, "MOST", 1_000_000)
    for k in (1, 5, 50):
        got = lexical_search.search(frame(spark, docs).coalesce(1), spark.createDataFrame(items, ITEMS), k=k)
        assert found(got) == brute(docs, items, k)


def test_nothing_to_search(spark):
    docs, items = frame(spark, rows(30)), spark.createDataFrame([(1, "water", None)], ITEMS)
    assert lexical_search.search(docs.limit(0), items).collect() == []
    assert lexical_search.search(docs, items.limit(0)).collect() == []
    assert lexical_search.search(docs.where("text IS NULL OR text = ''"), items).collect() == []


def test_text_item_ids(spark):
    docs = frame(spark, rows(30))
    items = spark.createDataFrame([("a", "water house"), ("b", "Wasser")], "name string, words string")
    got = lexical_search.search(docs, items, item_id_col="name", item_text_col="words", k=3)
    assert got.schema["item_id"].dataType.simpleString() == "string"
    assert found(got) == brute(rows(30), [("a", "water house"), ("b", "Wasser")], 3)
