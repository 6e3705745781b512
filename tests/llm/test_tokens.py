import random
import struct
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tellerscore.llm import packing, token_counts
from tests.llm import documents as D

WORD, BYTE = (public_tokenizers.path(f"{n}.json") for n in ("word_bpe_49k", "byte_bpe_50k"))
PIECES = list("abAB 's\n\té漢１٣ſḰ\x1c\x85　 İß́̂😀\x00ﬁΣ") + ["<|endoftext|>", "<|startoftext|>", "don't", "  ", " the", "\n\n"]


def odd_texts(n):
    rng = random.Random(4)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def test_counts_equal_the_library(spark):
    library = Tokenizer.from_file(WORD)
    data = D.rows() + [(1000 + i, t, "en", "s", 1) for i, t in enumerate(odd_texts(2000))]
    found = token_counts.count_tokens(D.frame(spark, data, ["N_tokens", "count"]), WORD, limit=50).collect()
    assert len(found) == len(data)
    for r in found:
        n = len(library.encode(r.text or "", add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((r.text or "").encode()), n, n > 50)
    assert token_counts.count_tokens(D.frame(spark, []), WORD).count() == 0


def test_merges_of_one_word():
    counter = token_counts.counter(WORD)
    assert counter.count_word("the") == 1
    assert counter.count_word("a" * 3000) == len(Tokenizer.from_file(WORD).encode("a" * 3000).ids)


def test_ids_equal_the_library():
    encoder, library = packing.Encoder(BYTE), Tokenizer.from_file(BYTE)
    for text in odd_texts(5000) + ["a b\nc d", " a", "a ", "a  b", "a\n b", "x\n\ny", "it's <|endoftext|> b\n<|endoftext|>c"]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text) == struct.pack(f"<{len(ids)}I", *ids), text
    assert encoder.fast is not None


def test_ids_of_every_character_equal_the_library():
    encoder, library = packing.Encoder(BYTE), Tokenizer.from_file(BYTE)
    assigned = [c for c in range(0x40000) if not 0xD800 <= c < 0xE000]
    texts = ["a{0}b 1{0} {0}\n{0}2".format(chr(c)) for c in assigned]
    for text, found in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert encoder.encode(text) == np.array(found.ids, dtype="<u4").tobytes(), text


@pytest.mark.parametrize("run", [" ", "\t", "\n", "\u3000", " \n", "é", "a", "-", "1"])
def test_ids_of_very_long_runs_equal_the_library(run):
    """Alone, between words, and one on the way to being too long for the fast library."""
    encoder, library = packing.Encoder(BYTE), Tokenizer.from_file(BYTE)
    space = run.isspace()
    for n in (packing.LONG_SPACE, 1_000_000, 3_000_000) if space else (200_000,):
        for text in (run * n, f"one {run * n}two", f"x{run * (n // 2)}y z{run * (n // 2)}"):
            ids = library.encode(text, add_special_tokens=False).ids
            assert encoder.encode(text) == np.array(ids, dtype="<u4").tobytes()


def test_very_long_white_space_is_packed_and_counted(spark):
    library, counter = Tokenizer.from_file(BYTE), Tokenizer.from_file(WORD)
    texts = [" " * 1_200_000, "a" + "\n" * 1_500_000 + "b", "\t " * 600_000]
    docs = D.frame(spark, [(i, t, "en", "s", 1) for i, t in enumerate(texts)])
    found = packing.pack_documents(docs, BYTE).groupBy("doc_id").sum("length").collect()
    assert dict(map(tuple, found)) == {i: len(library.encode(t).ids) + 1 for i, t in enumerate(texts)}
    found = token_counts.count_tokens(docs, WORD).collect()
    assert {r.doc_id: r.n_tokens for r in found} == {i: len(counter.encode(t).ids) for i, t in enumerate(texts)}


def test_other_files_go_through_their_library():
    encoder, library = packing.Encoder(WORD), Tokenizer.from_file(WORD)
    assert encoder.fast is None
    assert encoder.encode("Some Words") == np.array(library.encode("Some Words").ids, dtype="<u4").tobytes()


def test_packing_is_gapless_and_whole(spark):
    library, data = Tokenizer.from_file(BYTE), D.rows()
    data = [r for r in data if r[0] is not None]
    found = packing.pack_documents(D.frame(spark, data, ["piece", "offset"]), BYTE, capacity=128, with_ids=True).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in found:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for doc_id, text, *_ in data:
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        packed = struct.pack(f"<{len(ids)}I", *ids)
        copies = sum(d[0] == doc_id for d in data)
        rows = sorted(by_doc[doc_id], key=lambda r: r.piece)
        assert len(rows) % copies == 0
        position = 0
        for k, r in enumerate(rows[::copies]):
            part = packed[4 * r.start : 4 * (r.start + r.length)]
            assert (r.piece, r.start, r.ids_crc32, bytes(r.ids)) == (k, position, zlib.crc32(part), part)
            assert k == 0 or r.length == 128
            position += r.length
        assert position == len(ids)
    for rows in by_sequence.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 128
    total = sum(r.length for r in found)
    assert len(by_sequence) <= 1.05 * -(-total // 128) + 1


def test_packing_without_rows_and_ids(spark):
    assert packing.pack_documents(D.frame(spark, []), BYTE).count() == 0
    found = packing.pack_documents(D.frame(spark, [(None, None, None, None, None), (2**62 + 1, "a", "en", "s", 1)]), BYTE)
    assert sorted((r.doc_id or 0, r.length) for r in found.collect()) == [(0, 1), (2**62 + 1, 2)]


@pytest.mark.parametrize(
    "lengths",
    [
        np.minimum(2048, 1 + np.random.default_rng(1).exponential(700, 20_000).astype(int)),
        np.random.default_rng(2).integers(1, 2049, 20_000),
        np.array([5]),
        np.array([1] * 5000 + [2047] * 10),
        np.random.default_rng(3).choice([1, 512, 1024, 682], 3000),
    ],
)
def test_plan_holds_every_piece(lengths):
    counts = dict(zip(*(a.tolist() for a in np.unique(lengths, return_counts=True))))
    runs = packing.plan(dict(counts), 2048)
    held = defaultdict(int)
    for run in runs:
        assert run.count > 0 and sum(run.lengths) <= 2048
        for length in run.lengths:
            held[length] += run.count
    assert held == counts
    bound = max(-(-int(lengths.sum()) // 2048), int((lengths > 1024).sum()))
    assert sum(run.count for run in runs) <= 1.015 * bound + 1


def test_linear_groups_have_equal_cardinality():
    counts = {length: 1 + length % 7 for length in range(300, 1500)}
    groups = packing.linear_groups(counts, 40)
    sizes = [sum(n for _, n in group) for group in groups]
    assert sum(sizes) == sum(counts.values()) and len(groups) <= 41
    assert max(sizes) <= sum(sizes) / 40 + 7
    assert [g[0][0] for g in groups] == sorted({g[0][0] for g in groups}, reverse=True)
