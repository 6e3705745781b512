import hashlib
import re
from collections import Counter, defaultdict

import pytest

from tellerscore.llm import exact_dedup, line_dedup
from tests.llm import documents as D


def normalised(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def test_exact_dedup_against_brute_force(spark):
    data = D.rows() + [(900, "A b\nc", "en", "s", 1), (901, "Abc", "en", "s", 1), (899, "A bc ", "en", "s", 1)]
    found = exact_dedup.dedupe(D.frame(spark, data, ["Digest", "other"]), exact_dedup.new_index(spark)).collect()
    groups = defaultdict(list)
    for doc_id, text, *_ in data:
        groups[normalised(text)].append((-len(text or ""), -1 if doc_id is None else doc_id, doc_id))
    expected = Counter()
    for doc_id, text, *_ in data:
        group = groups[normalised(text)]
        digest = hashlib.sha256(normalised(text).encode()).hexdigest()
        keep = min(group, key=lambda g: g[:2])[2]
        expected[doc_id, digest, keep, len(group), doc_id == keep] += 1
    assert Counter((r.doc_id, r.digest, r.keep_id, r.group_size, r.kept) for r in found) == expected
    assert {r.other for r in found} == {"kept"}


def test_index_is_kept_and_appended(spark):
    index = exact_dedup.new_index(spark)
    first = D.frame(spark, [(1, "a b", "en", "s", 3), (2, "c", "en", "s", 1)])
    assert {r.kept for r in exact_dedup.dedupe(first, index).collect()} == {True}
    again = exact_dedup.DigestIndex(spark, index.path, index.buckets)
    second = D.frame(spark, [(3, "ab        ", "en", "s", 3), (4, "d", "en", "s", 1), (0, "d", "en", "s", 1)])
    found = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.dedupe(second, again).collect()}
    assert found == {3: (1, 2, False), 4: (0, 2, False), 0: (0, 2, True)}
    exact_dedup.dedupe(second, again).collect()
    assert sorted(r.keep_id for r in again.read().collect()) == [0, 1, 2]
    plan = again.read().groupBy("digest").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan  # the buckets serve as the partitioning


def test_a_batch_that_runs_again_keeps_its_documents(spark):
    index = exact_dedup.new_index(spark)
    exact_dedup.dedupe(D.frame(spark, [(1, "a b", "en", "s", 3)]), index, batch="monday").collect()
    second = [(3, "ab        ", "en", "s", 3), (4, "d", "en", "s", 1), (0, "d", "en", "s", 1), (5, None, "en", "s", 0)]
    expected = {3: (1, 2, False), 4: (0, 2, False), 0: (0, 2, True), 5: (5, 1, True)}
    exact_dedup.dedupe(D.frame(spark, second[:2]), index, batch="tuesday")  # fails before its output is written
    index.forget()
    index = exact_dedup.DigestIndex(spark, index.path, index.buckets)
    for _ in range(3):
        found = exact_dedup.dedupe(D.frame(spark, second), index, batch="tuesday").collect()
        assert {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in found} == expected
    assert sorted(r.keep_id for r in index.read().collect()) == [0, 1, 5]
    found = exact_dedup.dedupe(D.frame(spark, second), index, batch="wednesday").collect()
    assert not any(r.kept for r in found) and index.read().count() == 3
    with pytest.raises(ValueError):
        exact_dedup.dedupe(D.frame(spark, second), index, batch="a/b")


@pytest.mark.parametrize("operator", ["exact", "lines"])
def test_no_rows(spark, operator):
    empty = D.frame(spark, [])
    if operator == "exact":
        assert exact_dedup.dedupe(empty, exact_dedup.new_index(spark)).count() == 0
    else:
        assert line_dedup.dedupe_lines(empty).count() == 0


def brute_lines(data, min_chars=20, min_docs=3):
    def key(line):
        stripped = re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line)
        return re.sub("[A-Z]", lambda m: m[0].lower(), stripped)

    rank = lambda i: -1 if i is None else i
    holders = defaultdict(set)
    for doc_id, text, *_ in data:
        for line in (text or "").split("\n"):
            holders[key(line)].add(rank(doc_id))
    out = []
    for doc_id, text, *_ in data:
        lines = (text or "").split("\n")
        kept = [
            line
            for line in lines
            if len(key(line)) < min_chars
            or len(holders[key(line)]) < min_docs
            or max(holders[key(line)]) == rank(doc_id)
        ]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(out)


def test_lines_against_brute_force(spark):
    shared = "THIS LINE IS SHARED BY É MANY"
    data = D.rows() + [
        (700, "\n".join([shared] * 3), "en", "s", 1),
        (701, f" {shared.lower().replace('é', 'É')} \r\nown", "en", "s", 1),
        (702, f"{shared}\n", "en", "s", 1),
        (703, "a line of twenty ch.", "en", "s", 1),
        (704, "a line of twenty ch.", "en", "s", 1),
        (705, "\na line of twenty ch.\n\n", "en", "s", 1),
        (706, "only nineteen chars", "en", "s", 1),
        (707, "only nineteen chars", "en", "s", 1),
        (708, "only nineteen chars", "en", "s", 1),
    ]
    found = line_dedup.dedupe_lines(D.frame(spark, data, ["N_LINES", "key", "id"])).collect()
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in found) == brute_lines(data)
    assert {r.key for r in found} == {"kept"}


def test_a_very_long_document_of_shared_lines(spark):
    line = "a line that all the documents here have {}"
    text = "\n".join(line.format(i) for i in range(20_000))
    data = [(i, text, "en", "s", 1) for i in range(3)]
    found = {r.doc_id: (r.n_dropped, len(r.text)) for r in line_dedup.dedupe_lines(D.frame(spark, data)).collect()}
    assert found == {0: (20_000, 0), 1: (20_000, 0), 2: (0, len(text))}
