"""Token counts by byte-pair merging with a heap and a linked list; no ids are made."""

from __future__ import annotations

import functools
import heapq
import json
import re

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tellerscore.llm.common import fresh_names

_OUT = ["n_bytes", "n_tokens", "over_limit"]
#: Most entries of a generation of a worker's memo, and most characters of an entry.
MEMO_ENTRIES, MEMO_CHARS = 400_000, 64


class Memo:
    """Counts of two generations of pieces, so that what is met often stays when the rest goes."""

    def __init__(self):
        self.new: dict[str, int] = {}
        self.old: dict[str, int] = {}

    def get(self, key: str) -> int | None:
        value = self.new.get(key)
        if value is None:
            value = self.old.get(key)
            if value is not None:
                self.put(key, value)
        return value

    def put(self, key: str, value: int) -> int:
        if len(key) <= MEMO_CHARS:
            if len(self.new) >= MEMO_ENTRIES:
                self.old, self.new = self.new, {}
            self.new[key] = value
        return value


class MergeCounter:
    """Counts the tokens of a BPE tokenizer file.

    The file's own normaliser and pre-tokenizer cut a text into words; a word then starts as its
    characters, the last with the end-of-word mark, and each merge takes one symbol away.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or model.get("byte_fallback"):
            raise ValueError("only plain BPE models are counted")
        library = Tokenizer.from_file(path)
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer
        self.ranks = {tuple(m.split(" ") if isinstance(m, str) else m): i for i, m in enumerate(model["merges"])}
        self.symbols, self.unknown = model["vocab"].keys(), model.get("unk_token")
        self.suffix = model.get("end_of_word_suffix") or ""
        added = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.plain_words = _plain_words(spec)
        self.chunks, self.words = Memo(), Memo()

    def count_word(self, word: str) -> int:
        """Initial symbols minus merges."""
        symbols = [*word[:-1], word[-1] + self.suffix]
        if self.unknown is None:
            symbols = [s for s in symbols if s in self.symbols]
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ranks = self.ranks
        heap = []
        for i in range(n - 1):
            rank = ranks.get((symbols[i], symbols[i + 1]))
            if rank is not None:
                heap.append((rank, i, symbols[i], symbols[i + 1]))
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != left or j >= n or symbols[j] != right:
                continue
            symbols[i], symbols[j] = left + right, None
            merges += 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                rank = ranks.get((symbols[i], symbols[k]))
                if rank is not None:
                    heapq.heappush(heap, (rank, i, symbols[i], symbols[k]))
            h = before[i]
            if h >= 0:
                rank = ranks.get((symbols[h], symbols[i]))
                if rank is not None:
                    heapq.heappush(heap, (rank, h, symbols[h], symbols[i]))
        return n - merges

    def _segment(self, text: str) -> int:
        if self.plain_words is not None and text.isascii() and text.isprintable():
            words = self.plain_words.findall(text.lower())
        else:
            if self.normalizer is not None:
                text = self.normalizer.normalize_str(text)
            words = [word for word, _ in self.pre_tokenizer.pre_tokenize_str(text)]
        total = 0
        for word in words:
            n = self.words.get(word)
            if n is None:
                n = self.words.put(word, self.count_word(word))
            total += n
        return total

    def _chunk(self, chunk: str) -> int:
        if self.added is None or not self.added.search(chunk):
            return self._segment(chunk)
        # The library takes these strings out first, whatever stands around them.
        return len(self.added.findall(chunk)) + sum(self._segment(s) for s in self.added.split(chunk) if s)

    def count(self, text: str) -> int:
        """Tokens of a whole text. Words never reach over a space, so each chunk counts by itself."""
        total, chunks = 0, self.chunks
        for chunk in text.replace("\n", " ").split(" "):
            if chunk:
                n = chunks.new.get(chunk)
                if n is None:
                    n = chunks.get(chunk)
                    if n is None:
                        n = chunks.put(chunk, self._chunk(chunk))
                total += n
        return total


def _plain_words(spec: dict) -> regex.Pattern | None:
    """How printable ASCII falls into words, if lower-casing and the file's own pattern are all there is to it.

    Byte-level files write these characters as themselves.
    """
    normalizer, cut = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
    steps = [(n["type"], n.get("content")) for n in normalizer.get("normalizers", [])]
    cuts = cut.get("pretokenizers", [])
    if steps != [("NFC", None), ("Replace", " "), ("Lowercase", None)] or [c["type"] for c in cuts] != ["Split", "ByteLevel"]:
        return None
    split, level = cuts
    if (split["behavior"], split["invert"], level["add_prefix_space"], level["use_regex"]) != ("Removed", True, False, False):
        return None
    return regex.compile(split["pattern"]["Regex"])


@functools.lru_cache(maxsize=2)
def counter(path: str) -> MergeCounter:
    """One per worker process and file."""
    return MergeCounter(path)


def count_tokens(docs: DataFrame, path: str, limit: int = 2048, text_col: str = "text") -> DataFrame:
    """Add ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) to every row.

    ``path`` is a BPE tokenizer file in which white space separates words. Null text counts as empty:
    0 bytes, 0 tokens. Rows keep their number and columns; columns named like an output are replaced.
    There is no shuffle; a worker's memos of counted pieces have a fixed bound.
    """

    @F.pandas_udf("long")
    def n_tokens(texts: pd.Series) -> pd.Series:
        count = counter(path).count
        return pd.Series([count(t) if t else 0 for t in texts], dtype="int64")

    wanted = fresh_names(docs, _OUT)
    counted = wanted.withColumns(
        {
            "n_bytes": F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long"),
            "n_tokens": n_tokens(F.col(text_col)),
        }
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
