"""Language ID, language-model scores and nearest neighbours."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tellerscore.llm import gru, language_id, lm_scores, neighbours
from tellerscore.llm.common import fold
from tests.llm import documents as D

# --- language ID ----------------------------------------------------------------------------------


def test_held_out_accuracy_and_odd_texts(spark):
    data = D.rows(300)
    docs = D.frame(spark, data, ["Score", "lang_pred"])
    held_out = fold(F.col("doc_id")) == 0
    model = language_id.fit(docs.where(~held_out))
    found = language_id.predict(docs, model).select("*", held_out.alias("held_out")).collect()
    assert len(found) == len(data)
    for r in found:
        assert 0 <= r.score <= 1
        assert r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 5 == 0)
        if not r.text or not any(map(str.isalpha, r.text)):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in model.langs
    judged = [r.lang == r.lang_pred for r in found if r.held_out and r.lang and r.doc_id is not None and r.doc_id < 300]
    assert len(judged) > 30 and np.mean(judged) > 0.98


def test_unseen_words_back_off(spark):
    model = language_id.fit(D.frame(spark, D.rows(200)))
    scorer = language_id.Scorer(model)
    assert "zwischendurch" not in model.words and scorer.score("zwischendurch gedankenlos")[0] == "de"
    assert scorer.score("ᚠᚢ")[0] in model.langs
    assert model.backoff("ᚠᚢ").shape == (3,)


def test_nothing_to_learn(spark):
    docs = D.frame(spark, [(1, "some words", None, None, None), (2, None, "en", None, None)])
    for learned in (docs.where("doc_id = 1"), D.frame(spark, [])):
        model = language_id.fit(learned)
        assert [r.lang_pred for r in language_id.predict(docs, model).collect()] == ["und", "und"]
    assert language_id.predict(D.frame(spark, []), model).count() == 0


def test_rare_languages_are_learned(spark):
    data = [(i, f"hot{i} der und", "de", None, None) for i in range(3000)]
    data += [(3000 + i, f"rare{i} zwei", "zz", None, None) for i in range(5)]
    data += [(4000 + i, "one text in many rows", "en", None, None) for i in range(3000)]
    model = language_id.fit(D.frame(spark, data), max_docs=300, max_words=20, max_grams=60)
    assert model.langs == ["de", "en", "zz"]
    assert {"zwei", "rare", "der", "many"} <= model.words.keys()
    assert language_id._shares({"de": 3000, "en": 100, "zz": 5}, 300) == {"zz": 1.0, "en": 1.0, "de": 195 / 3000}


def plain_language(labelled, text):
    """The method in plain Python: add-half shares of words, else the mean of the longest known n-grams."""
    langs = sorted({lang for lang, t in labelled})
    units = {n: {} for n in (0, 4, 3, 2, 1)}
    split = lambda t: re.findall(r"[^\W\d_]+", t.lower())
    grams = lambda w, n: [f"^{w}$"[i : i + n] for i in range(len(w) + 3 - n)]
    for lang, t in labelled:
        for word in split(t):
            for n in units:
                for unit in [word] if n == 0 else grams(word, n):
                    units[n].setdefault(unit, Counter())[lang] += 1
    sums = {n: {lang: sum(c[lang] + 0.5 for c in found.values()) for lang in langs} for n, found in units.items()}
    log = lambda n, unit, lang: math.log((units[n][unit][lang] + 0.5) / sums[n][lang])
    total = dict.fromkeys(langs, 0.0)
    for word in split(text):
        known = [(0, [word])] if word in units[0] else [(n, [g for g in grams(word, n) if g in units[n]]) for n in (4, 3, 2, 1)]
        n, found = next(((n, own) for n, own in known if own), (0, []))
        for lang in langs:
            total[lang] += sum(log(n, unit, lang) for unit in found) / max(len(found), 1)
    top = max(total.values())
    weights = {lang: math.exp(v - top) for lang, v in total.items()}
    best = max(langs, key=weights.get)
    return best, weights[best] / sum(weights.values())


def test_predictions_against_plain_version(spark):
    """Learned texts, texts of another draw, and words that only n-grams know."""
    learned = D.frame(spark, D.rows(150)).where("doc_id IS NOT NULL")
    labelled = [(r.lang, r.text) for r in learned.collect() if r.lang is not None and r.text is not None]
    texts = [r[1] for r in D.rows(40, seed=9)] + ["zwischenwater", "ÊTRENT penses hausing", "qqq ééé", "über2water_maison"]
    docs = D.frame(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])
    for r in language_id.predict(docs, language_id.fit(learned)).collect():
        if r.text and any(map(str.isalpha, r.text)):
            lang, score = plain_language(labelled, r.text)
            assert r.lang_pred == lang and r.score == pytest.approx(score, rel=1e-6), r.text


def test_every_unit_of_the_sample_is_learned(spark):
    words = [f"w{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyzabcd'[i // 100 % 10]}{chr(97 + i // 1000 % 26)}{chr(97 + i // 26000)}" for i in range(200_000)]
    rows = [(i, " ".join(words[i * 1000 : (i + 1) * 1000]), "en", None, None) for i in range(200)]
    model = language_id.fit(D.frame(spark, rows))
    assert len(model.words) == len(set(words)) > 150_000


# --- language-model scores ------------------------------------------------------------------------


def test_base_score_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lm_scores, "COUNTED", 20)
    data = D.rows()
    docs = D.frame(spark, data, ["word", "N_known", "model"])
    training = fold(F.col("doc_id")) != 1
    found = lm_scores.score(docs, training, frequent_words=15, vocabulary_size=10).collect()
    counts = Counter()
    tokens = lambda text: D.words_of(text) + [None]
    for doc_id, text, *_ in data:
        if zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 5 != 1:
            counts.update(tokens(text))
    n, v = sum(counts.values()), len(counts)
    assert len(found) == len(data)
    for r in found:
        own = tokens(r_text(data, r))
        base = sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in own)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(counts[t] > 0 for t in own), n)
        assert r.score < 0 and r.model == "kept"


def r_text(data, row):
    return next(t for i, t, _, s, c in data if (i, s, c) == (row.doc_id, row.source, row.n_chars))


def test_model_beats_base_on_held_out_text(spark):
    docs = D.frame(spark, D.rows(1500)[:1500]).coalesce(1)
    held_out = fold(F.col("doc_id")) == 1
    found = lm_scores.score(docs, ~held_out).where(held_out)
    r = found.agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert r[0] > r[1]


def test_model_learns_from_every_token(spark, monkeypatch):
    texts = D.frame(spark, D.rows()).select(F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    counts = lm_scores.count_words(texts, 100)
    seen = []

    def counting(rows, name, materialize=lm_scores.materialize):
        rows = materialize(rows, name)
        seen.append(rows.where("chunk = 0").agg(F.sum("tokens")).first()[0])
        return rows

    monkeypatch.setattr(lm_scores, "materialize", counting)
    lm_scores.train(texts, lm_scores.vocabulary(counts, 50))
    assert sum(seen) == counts.tokens and min(seen) > 0


def test_model_knows_four_thousand_words(spark, monkeypatch):
    docs = spark.createDataFrame([(i, " ".join(f"w{(i * 40 + k) % 4000}" for k in range(80))) for i in range(200)], "doc_id long, text string")
    sizes = []

    def sized(*args, vocabulary=lm_scores.vocabulary):
        sizes.append(len((found := vocabulary(*args)).ids))
        return found

    monkeypatch.setattr(lm_scores, "vocabulary", sized)
    assert lm_scores.score(docs, F.lit(True)).count() == 200
    assert sizes == [4000]


def test_frequent_words_of_one_count(spark):
    """More words of one count than fit do not leave the model without words."""
    docs = spark.createDataFrame([(" ".join(f"w{i}x{k}" for k in range(100)),) for i in range(300)], "text string")
    docs = docs.unionByName(spark.createDataFrame([("top top top of of",)], "text string"))
    counts = lm_scores.count_words(docs.select(F.col("text").cast("binary").alias("text")), 5000)
    assert 4500 < len(counts.frequent) < 5500 and counts.distinct == 30_003 and counts.tokens == 30_005 + 301
    assert [*counts.frequent.items()][:3] == [(lm_scores.END, 301), (b"top", 3), (b"of", 2)]
    assert set([*counts.frequent.values()][3:]) == {1}


def test_rested_weights_make_up_their_decay():
    """Where every class and token is met in every step, the lazy form is plain Adam."""
    rng = np.random.default_rng(5)
    p = gru.initial(np.ones(8), 4, 4)
    trainer = gru.Trainer(p, 0.01)
    weights = {k: v.astype(np.float64) for k, v in p.items()}
    mean, square = ({k: np.zeros_like(v) for k, v in weights.items()} for _ in range(2))
    for step in range(1, 6):
        grads = {k: rng.normal(size=v.shape).astype(np.float32) for k, v in p.items()}
        met = step not in (2, 3)  # the last class and token rest for two steps
        for k in (*gru.Trainer.BY_TOKEN, *gru.Trainer.BY_CLASS):
            grads[k][-1] *= met
        for k, g in grads.items():
            trainer.grads[k][:] = g
            mean[k], square[k] = 0.9 * mean[k] + 0.1 * g, 0.99 * square[k] + 0.01 * g * g
            move = 0.01 * np.sqrt(1 - 0.99**step) / (1 - 0.9**step) * mean[k] / (np.sqrt(square[k]) + 1e-6)
            if not met and k in trainer.met:
                move[-1] = 0
            weights[k] -= move
        trainer._update(np.arange(8 if met else 7), np.arange(2 if met else 1))
    for k, v in weights.items():
        assert trainer.p[k] == pytest.approx(v, abs=1e-5), k
        assert not trainer.grads[k].any()


def test_weights_are_updated_every_64_documents():
    trainer = gru.Trainer(gru.initial(np.arange(11, 0, -1).astype(float), 5, 4), 0.01)
    trainer.learn([np.array([3, 2, gru.END])] * 256)
    assert (trainer.steps, trainer.tokens) == (4, 768)


def test_model_without_training_and_without_rows(spark):
    assert lm_scores.score(D.frame(spark, []), F.lit(True)).count() == 0
    found = lm_scores.score(D.frame(spark, D.rows(5)), F.lit(False)).collect()
    assert {(round(r.base_score, 9), r.n_known, r.train_tokens) for r in found} == {(0.0, 0, 0)}
    assert all(np.isfinite(r.score) for r in found)


def small_model(tokens=11, hidden=5, per_class=4):
    counts = np.arange(tokens, 0, -1).astype(float)
    p = gru.initial(counts, hidden, per_class)
    rng = np.random.default_rng(0)
    return {k: (v + rng.normal(0, 0.3, v.shape) * (v > -1e8)).astype(np.float64) for k, v in p.items()}


def test_probabilities_of_next_tokens_sum_to_one():
    p = small_model()
    state = np.random.default_rng(1).normal(0, 1, (11, 5))
    logs = gru.log_probs(p, state[:1].repeat(11, 0), np.arange(11))
    assert np.exp(logs).sum() == pytest.approx(1, abs=1e-6)


def test_lanes_do_not_wait_for_the_longest_document():
    """Every token is met once, each document from its first to its last, and short ones fill the lanes."""
    rng = np.random.default_rng(6)
    ids = [rng.integers(2, 50, n).astype(np.int32) for n in (160, *[16] * 30, 1, 7)]
    seen, before, steps = {i: [] for i in range(len(ids))}, np.arange(4), 0
    for docs, inputs, targets, left, starts in gru._windows(ids, 4, 16):
        steps += 1
        assert len(docs) == len(left) == len(starts) <= 4
        for lane, doc in enumerate(docs):
            real = targets[:, lane] >= 0
            assert inputs[0, lane] == (gru.END if starts[lane] else seen[doc][-1])
            assert starts[lane] == (not seen[doc]) and (starts[lane] or before[left[lane]] == doc)
            seen[doc] += targets[real, lane].tolist()
        before = docs
    assert all(seen[i] == ids[i].tolist() for i in seen)
    assert steps <= 11 and list(gru._windows([], 4, 16)) == []


def test_state_is_carried_across_windows():
    p = small_model()
    rng = np.random.default_rng(2)
    ids = [rng.integers(0, 11, n) for n in (1, 70, 33, 2, 64)]
    whole = gru.score(p, ids, batch=5, window=100)
    assert gru.score(p, ids, batch=2, window=7) == pytest.approx(whole, rel=1e-5)
    assert gru.score(p, ids, batch=5, window=32) == pytest.approx(whole, rel=1e-5)


def test_gradients_equal_differences():
    p = small_model()
    rng = np.random.default_rng(3)
    tokens, targets = rng.integers(0, 11, (6, 3)), rng.integers(0, 11, 18)
    start = np.zeros((3, 5))

    def loss(q):
        after, _ = gru.states({k: v.astype(np.float64) for k, v in q.items()}, tokens, start)
        return -gru.log_probs(q, after.reshape(18, 5).astype(np.float64), targets).mean()

    grads = {k: np.zeros_like(v) for k, v in p.items()}
    after, kept = gru.states(p, tokens, start, keep=True)
    _, d = gru.log_probs(p, after.reshape(18, 5).astype(np.float64), targets, grads)
    gru._backward(p, tokens, kept, d.reshape(6, 3, 5), grads)
    for k, v in p.items():
        for at in rng.choice(v.size, 6):
            place = np.unravel_index(at, v.shape)
            if v[place] < -1e8:
                continue
            up, down = ({**p, k: v.copy()} for _ in range(2))
            up[k][place] += 1e-3
            down[k][place] -= 1e-3
            assert grads[k][place] == pytest.approx((loss(up) - loss(down)) / 2e-3, abs=5e-4), k


def test_products_of_classes_with_few_and_many_rows():
    """Rows that share a block, and classes of their own, give what each row alone gives."""
    p = small_model()
    rng = np.random.default_rng(7)
    targets = np.concatenate([np.full(40, 1), np.full(16, 5), [9, 0, 10]])
    rng.shuffle(targets)
    state = rng.normal(0, 1, (len(targets), 5))
    assert [c for c, *_ in gru._Classes(np.sort(targets // 4)).many] == [0]
    grads = {k: np.zeros_like(v) for k, v in p.items()}
    logs, d = gru.log_probs(p, state, targets, grads)
    assert logs == pytest.approx(gru.log_probs(p, state, targets))
    alone = {k: np.zeros_like(v) for k, v in p.items()}
    for i in range(len(targets)):
        log, own = gru.log_probs(p, state[i : i + 1], targets[i : i + 1], alone)
        assert (log[0], own[0] / len(targets)) == (pytest.approx(logs[i]), pytest.approx(d[i]))
    for k in p:
        assert grads[k] == pytest.approx(alone[k] / len(targets)), k


def test_large_logits_are_shifted():
    logits = np.array([[400.0, 500.0], [-900.0, -901.0], [0.0, 1.0]], dtype=np.float32)
    found, _, _ = gru._log_softmax(logits, np.array([1, 0, 1]))
    assert found == pytest.approx([0, -np.log1p(np.exp(-1)), -np.log1p(np.exp(-1))], abs=1e-6)


def test_words_of_many_texts_are_those_of_each():
    texts = [b" A b\x0b\x0cC\x1cD \n", b"", b"\t ", "\u00c4\u2003e".encode(), b"\xff X", b"one"]
    words, ends = lm_scores.words_of_all(texts)
    words = words.to_pylist()
    assert [words[i:j] for i, j in zip([0, *ends], ends)] == [lm_scores.words_of(t) for t in texts]
    assert [len(g) for g in lm_scores._in_groups([b"aa", b"b", b"cccc", b"d"], 3)] == [2, 1, 1]
    vocab = lm_scores.Vocabulary({b"one": 2, b"x": 3}, np.ones(4))
    assert [i.tolist() for i in vocab.encode(texts)[-2:]] == [[0, 3, 1], [2, 1]]
    assert [len(i) for i in vocab.encode(texts)] == [len(lm_scores.words_of(t)) + 1 for t in texts]


# --- nearest neighbours ---------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int"


def vectors(n=1500, dim=8, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 3, (12, dim))
    table = (centres[rng.integers(0, 12, n)] + rng.normal(0, 1, (n, dim))).astype(np.float32)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(table)]
    rows += [(n + i, rows[0][1], 0) for i in range(60)]  # copies of a query
    rows += [(n + 100 + i, rows[40][1], 0) for i in range(3)]
    odd = [None, [0.0] * dim, [float("nan")] + [1.0] * (dim - 1), [float("inf")] + [1.0] * (dim - 1), [None] + [1.0] * (dim - 1), [1.0, 2.0], []]
    return rows + [(-20 * (i + 1), v, None) for i, v in enumerate(odd)] + [(None, rows[1][1], 0), rows[5], rows[5]]


def brute_neighbours(rows, step, k):
    dim = 8
    good = {
        (i, tuple(v))
        for i, v, _ in rows
        if i is not None and v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v) and any(v)
    }
    good = sorted(good)
    ids, table = np.array([i for i, _ in good]), np.array([v for _, v in good], dtype=np.float64)
    out = {}
    for q, i in enumerate(ids):
        if i % step == 0:
            distance = np.sqrt(((table - table[q]) ** 2).sum(axis=1))
            order = [j for j in np.lexsort((ids, distance)) if j != q][:k]
            out[int(i)] = [(int(ids[j]), float(distance[j])) for j in order]
    return out


def test_neighbours_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CELL_ROWS", 50)
    rows = vectors()
    docs = spark.createDataFrame(rows, VECTORS).withColumn("score", F.lit("kept")).withColumn("leaf", F.lit(1))
    found = neighbours.search(docs, F.col("vec_id") % 20 == 0, sample_rows=800).collect()
    true = brute_neighbours(rows, 20, 10)
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    assert got.keys() == true.keys()
    hits = sum(len({i for i, _ in true[q]} & {i for i, _ in got[q]}) for q in true)
    assert hits >= 0.9 * sum(map(len, true.values()))
    for q, pairs in got.items():
        assert pairs == sorted(pairs, key=lambda p: (p[1], p[0])) and len(pairs) == len(true[q])
        if q in (0, 40):  # the copies come first, by id
            assert pairs[:3] == true[q][:3]


def test_visiting_every_leaf_is_exact(spark):
    rows = vectors(300)
    found = neighbours.search(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 20 == 0, recall=1.1).collect()
    true = brute_neighbours(rows, 20, 10)
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in found}
    assert got == {(q, n + 1): pair for q, pairs in true.items() for n, pair in enumerate(pairs)}


def test_trees_below_leaves(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "LEAF_ROWS", 20)
    monkeypatch.setattr(neighbours, "CELL_ROWS", 50)
    rows = vectors()
    docs, is_query = spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 20 == 0
    true = brute_neighbours(rows, 20, 10)
    seen = []
    calibrate = neighbours._calibrate

    def calibrated(index, judged, tree, levels, k, recall):
        sizes = [r["count"] for r in index.groupBy("leaf").count().collect()]
        visits = calibrate(index, judged, tree, levels, k, recall)
        seen.append((sizes, len(levels), visits))
        return visits

    monkeypatch.setattr(neighbours, "_calibrate", calibrated)
    for recall in (0.97, 1.1):
        found = neighbours.search(docs, is_query, recall=recall, sample_rows=150).collect()
        got = {}
        for r in found:
            got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
        sizes, levels, visits = seen[-1]
        assert levels >= 1 and max(sizes) <= 20 and len(visits) == levels + 1
        if recall > 1:  # every leaf of every level
            assert visits[1:] == [None] * levels
            assert got == {q: {n + 1: pair for n, pair in enumerate(pairs)} for q, pairs in true.items()}
        else:
            assert visits[-1] is not None and visits[-1] < len(sizes)
            hits = sum(len({i for i, _ in true[q]} & {i for i, _ in got[q].values()}) for q in true)
            assert hits >= 0.93 * sum(map(len, true.values()))


def test_few_and_no_vectors(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, None, 0)], VECTORS)
    assert [(r.query_id, r.vec_id) for r in neighbours.search(few, F.col("vec_id") == 0).collect()] == [(0, 1)]
    assert neighbours.search(few.where("vec_id = 2"), F.lit(True)).count() == 0
    assert neighbours.search(few.where("vec_id = 9"), F.lit(True)).count() == 0


def test_best_bin_first_visits_every_leaf_once():
    sample = np.random.default_rng(1).normal(0, 1, (500, 4))
    tree = neighbours.grow(sample, leaf_rows=20)
    order, bounds = zip(*tree.visits(sample[0]))
    assert bounds[0] == 0 and list(bounds) == sorted(bounds)
    assert sorted(order) == list(range(tree.leaves)) and order[0] == tree.leaf_of(sample[:1])[0]
