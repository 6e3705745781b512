import random

import pytest

from tellerscore.llm import near_dedup
from tellerscore.llm.components import components
from tests.llm import documents as D


def brute(data, k, percent):
    """Component of each (id, set) by comparing every pair."""
    nodes = []
    for doc_id, text, *_ in data:
        w = D.words_of(text)
        s = frozenset(zip(*(w[i:] for i in range(k)))) if len(w) >= k else frozenset([tuple(w)] if w else [])
        nodes.append((doc_id, s))
    parent = list(range(len(nodes)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (a, s) in enumerate(nodes):
        for j, (b, t) in enumerate(nodes[:i]):
            same = a is not None and a == b
            near = s and t and (s == t or None not in (a, b) and 100 * len(s & t) >= percent * len(s | t))
            if (same and s and t) or near:
                parent[root(i)] = root(j)
    least = {}
    for i, (a, _) in enumerate(nodes):
        if a is not None:
            least[root(i)] = min(least.get(root(i), a), a)
    return sorted(((a, len(s), least.get(root(i), a)) for i, (a, s) in enumerate(nodes)), key=repr)


def got(found):
    rows = found.collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=repr)


def family(n, words, most, seed):
    """Near copies of one text with ever more changed words, so that links are chains, not cliques."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(words)]
    out = []
    for i in range(n):
        text = list(base)
        for at in rng.sample(range(words), rng.randint(0, most)):
            text[at] = f"x{rng.randrange(10**6)}"
        out.append((10_000 * seed + i, " ".join(text), "en", "s", 1))
    return out


@pytest.mark.parametrize(("words", "percent"), [(3, 85), (5, 80)])
def test_against_every_pair(spark, words, percent):
    data = D.rows() + family(60, 120, 8, 1) + family(40, 40, 3, 2)
    data += [(50_000 + i, t, "en", "s", 1) for i, t in enumerate(["one", "ONE ", "one two", "one\ttwo", "two one", "\x0b", "a b c", "A B C"])]
    data += [(None, "a b c", "en", "s", 1), (None, "no other has this text at all", "en", "s", 1)]
    docs = D.frame(spark, data, ["Kept", "cluster", "node", "set_key"])
    found = near_dedup.near_duplicates(docs, words, percent)
    assert {r.cluster for r in found.select("cluster").collect()} == {"kept"}
    assert got(found) == brute(data, words, percent)


def test_clusters_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 7)
    data = family(120, 100, 9, 1) + family(30, 60, 4, 2) + D.rows(40)
    assert got(near_dedup.near_duplicates(D.frame(spark, data), 3, 85)) == brute(data, 3, 85)


def test_no_rows(spark):
    assert near_dedup.near_duplicates(D.frame(spark, [])).count() == 0


def test_agreement_bound():
    assert near_dedup.least_agreement(100) == near_dedup.HASHES
    assert 100 < near_dedup.least_agreement(85) < 0.85 * near_dedup.HASHES


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(i, i + 1) for i in range(1, 60)] + [(200 + i, 199) for i in range(40)] + [(500, 500), (7, 6), (6, 7)]
    links += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)]
    rng.shuffle(links)
    parent = {n: n for link in links for n in link}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    linked = {n for a, b in links if a != b for n in (a, b)}
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert sorted((r.node, r.component) for r in found) == sorted((n, root(n)) for n in linked)
