"""Best-fit packing of tokenised documents into sequences of a fixed capacity.

Only the number of pieces of each length, at most ``capacity`` numbers whatever the input, reaches the
driver. There, large lengths are rounded up within groups of equal cardinality (linear grouping), the
few rounded sizes are packed by optimising configurations, actual lengths take the places of rounded
ones, and small lengths go where they fit best. The result is a table of runs: the pieces of one length
whose rank lies in a range go to consecutive sequences at one offset. Ranks are counted by Spark.
"""

from __future__ import annotations

import bisect
import functools
import json
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from tellerscore.session import materialize

#: Pieces of one length that are ranked together.
RANKED_ROWS = 250


# --- pieces ---------------------------------------------------------------------------------------


# How byte-level files cut texts into words, and which bytes they write as themselves.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PLAIN_BYTES = [*range(33, 127), *range(161, 173), *range(174, 256)]


#: Runs of more white space than this go through the file's own library: the other one keeps a stack
#: entry for each character of a run, and stops between 700,000 and 1,000,000 of them.
LONG_SPACE = 100_000
_SPACE_RUN = re.compile(r"\s+")


def _bytes_of_characters() -> dict[str, int]:
    others = [b for b in range(256) if b not in PLAIN_BYTES]
    return {chr(b): b for b in PLAIN_BYTES} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """Ids of a tokenizer file, as little-endian unsigned 32-bit numbers.

    A plain byte-level BPE file, in which ids follow the merges, goes through the faster of the two
    libraries that read such vocabularies; any other through the file's own. Added tokens inside a text
    are taken out first, as both do by default.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.library = Tokenizer.from_file(path)
        self.fast = _byte_level(spec)

    def encode(self, text: str) -> bytes:
        if self.fast is not None and not _has_long_space(text):
            return self.fast.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False).tobytes()
        ids = self.library.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()


def _has_long_space(text: str) -> bool:
    return len(text) > LONG_SPACE and any(m.end() - m.start() > LONG_SPACE for m in _SPACE_RUN.finditer(text))


def _byte_level(spec: dict) -> tiktoken.Encoding | None:
    model, cut = spec["model"], spec.get("pre_tokenizer") or {}
    odd = [model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")]
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    flags = any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
    if model["type"] != "BPE" or any(odd) or spec.get("normalizer") or flags:
        return None
    if cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True):
        return None
    of = _bytes_of_characters()
    merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
    own = {t: i for t, i in model["vocab"].items() if t not in special}
    ranks = {bytes(of[c] for c in t): i for t, i in own.items()}
    if [own.get(m) for m in merged] != list(range(256, 256 + len(merged))) or len(ranks) != 256 + len(merged):
        return None
    return tiktoken.Encoding("file", pat_str=WORDS, mergeable_ranks=ranks, special_tokens=special)


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per worker process and file."""
    return Encoder(path)


def pieces(
    docs: DataFrame,
    path: str,
    capacity: int = 2048,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Tokenise and cut: ``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids``.

    A document is its ids and then ``end_id``. Documents of more than ``capacity`` ids are cut so that all
    pieces but the first are full. ``ids`` holds little-endian unsigned 32-bit numbers, ``ids_crc32`` their
    checksum.
    """
    last = struct.pack("<I", end_id)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    types = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(path).encode
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["id"], batch["text"]):
                ids = encode(text) + last
                n = len(ids) // 4
                start, end = 0, (n - 1) % capacity + 1
                piece = 0
                while start < n:
                    part = ids[4 * start : 4 * end]
                    row = (doc_id, piece, start, end - start, zlib.crc32(part))
                    rows.append((*row, part) if with_ids else row)
                    piece, start, end = piece + 1, end, end + capacity
            out = pd.DataFrame(rows, columns=columns)
            yield out.astype({"doc_id": "Int64"})

    chosen = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    # Ids may be null, and a nullable integer must not turn into a float on its way to Python.
    return chosen.select(F.col("id").cast("string").alias("id"), "text").mapInPandas(_with_int_ids(cut), types)


def _with_int_ids(cut):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return cut(b.assign(id=[None if i is None else int(i) for i in b["id"]]).astype({"id": object}) for b in batches)

    return run


# --- which lengths go together --------------------------------------------------------------------


@dataclass
class Run:
    """``count`` sequences, each with these lengths in this order."""

    count: int
    lengths: tuple[int, ...]


def linear_groups(counts: dict[int, int], groups: int) -> list[list[tuple[int, int]]]:
    """Lengths with their counts, longest first, cut into ``groups`` parts of equal cardinality.

    With few enough lengths, each is a group by itself and nothing is rounded. Parts that round up to the
    same length are one.
    """
    lengths = sorted(counts, reverse=True)
    if len(lengths) <= groups:
        return [[(length, counts[length])] for length in lengths]
    total = sum(counts.values())
    out: list[list[tuple[int, int]]] = []
    done, part = 0, -1
    for length in lengths:
        left = counts[length]
        while left:
            now = done * groups // total
            if now != part and (not out or out[-1][0][0] != length):
                out.append([])
            part = now
            room = -(-(now + 1) * total // groups) - done
            take = min(left, max(room, 1))
            if out[-1] and out[-1][-1][0] == length:
                out[-1][-1] = (length, out[-1][-1][1] + take)
            else:
                out[-1].append((length, take))
            done, left = done + take, left - take
    return out


def _best_configuration(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of sizes within the capacity (unbounded knapsack)."""
    best = np.zeros(capacity + 1)
    used = np.full(capacity + 1, -1)
    for i in np.argsort(-values / sizes):
        size, value = int(sizes[i]), values[i]
        if value <= 0:
            continue
        for low in range(size, capacity + 1, size):  # a block depends on the one before only
            high = min(low + size, capacity + 1)
            with_it = best[low - size : high - size] + value
            better = with_it > best[low:high] + 1e-12
            best[low:high][better] = with_it[better]
            used[low:high][better] = i
    chosen = np.zeros(len(sizes))
    room = int(best.argmax())
    value = float(best[room])
    while room > 0 and used[room] >= 0:
        i = used[room]
        chosen[i] += 1
        room -= int(sizes[i])
    return value, chosen


def configurations(sizes: list[int], demand: list[int], capacity: int, rounds: int = 4000) -> list[tuple[int, list[int]]]:
    """How often to use which configuration: the linear programme by column generation, rounded down.

    The revised simplex method starts from one configuration per size and brings in the most valuable
    configuration at the current prices until none is worth more than one sequence.
    """
    s, d = np.array(sizes), np.array(demand, dtype=float)
    fit = capacity // s
    columns = np.diag(fit.astype(float))
    inverse = np.diag(1.0 / fit)
    level = d / fit
    for _ in range(rounds):
        value, column = _best_configuration(s, inverse.sum(axis=0), capacity)
        if value <= 1 + 1e-7:
            break
        direction = inverse @ column
        ratio = np.where(direction > 1e-9, level / np.where(direction > 1e-9, direction, 1), np.inf)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        level = np.maximum(level - ratio[out] * direction, 0)
        level[out] = ratio[out]
        row = inverse[out] / direction[out]
        inverse -= np.outer(direction, row)
        inverse[out] = row
        columns[:, out] = column
    times = np.floor(level + 1e-9).astype(int)
    return [(int(times[k]), columns[:, k].astype(int).tolist()) for k in range(len(sizes)) if times[k] > 0]


def _substitute(times: int, slots: list[list[tuple[int, int]]]) -> Iterator[Run]:
    """Fill the slots of ``times`` sequences with the next actual lengths of the slots' groups."""
    drawn = []
    for queue in slots:
        need, taken = times, []
        while need and queue:
            length, count = queue[-1]
            take = min(need, count)
            taken.append((take, length))
            need -= take
            if take == count:
                queue.pop()
            else:
                queue[-1] = (length, count - take)
        if need:
            taken.append((need, 0))
        drawn.append(taken)
    while drawn[0]:
        count = min(taken[0][0] for taken in drawn)
        yield Run(count, tuple(taken[0][1] for taken in drawn if taken[0][1]))
        for taken in drawn:
            left, length = taken[0]
            if left == count:
                taken.pop(0)
            else:
                taken[0] = (left - count, length)


def _best_fit(runs: list[Run], counts: dict[int, int], capacity: int) -> list[Run]:
    """Put lengths, longest first, where the least room that holds them is; open sequences for the rest."""
    by_room: dict[int, list[Run]] = {}
    for run in runs:
        by_room.setdefault(capacity - sum(run.lengths), []).append(run)
    rooms = sorted(by_room)

    def add(run: Run) -> None:
        room = capacity - sum(run.lengths)
        if room not in by_room:
            bisect.insort(rooms, room)
        by_room.setdefault(room, []).append(run)

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                add(Run(-(-left // (capacity // length)), ()))
                continue
            room = rooms[at]
            run = by_room[room].pop()
            if not by_room[room]:
                del by_room[room]
                rooms.pop(at)
            each = min(room // length, left)
            filled = min(run.count, left // each)
            add(Run(filled, run.lengths + (length,) * each))
            if run.count > filled:
                add(Run(run.count - filled, run.lengths))
            left -= filled * each
    return [run for same in by_room.values() for run in same if run.lengths]


def plan(counts: dict[int, int], capacity: int, groups: int = 160, small: float = 0.125) -> list[Run]:
    """Runs that hold each length as often as ``counts`` says, in as few sequences as the method finds.

    Lengths above ``small`` times the capacity are large.
    """
    counts = {length: n for length, n in counts.items() if n}
    full = counts.pop(capacity, 0)
    large = {length: n for length, n in counts.items() if length > small * capacity}
    rest = {length: n for length, n in counts.items() if length not in large}
    runs = [Run(full, (capacity,))] if full else []
    if large:
        grouped = linear_groups(large, groups)
        sizes = [group[0][0] for group in grouped]
        demand = [sum(n for _, n in group) for group in grouped]
        queues = [list(reversed(group)) for group in grouped]
        for times, config in sorted(configurations(sizes, demand, capacity), reverse=True):
            slots = [queues[g] for g, n in enumerate(config) for _ in range(n)]
            runs += [run for run in _substitute(times, slots) if run.lengths]
        for queue in queues:
            for length, n in queue:
                rest[length] = rest.get(length, 0) + n
    return _best_fit(runs, rest, capacity)


def places(runs: list[Run]) -> dict[str, np.ndarray]:
    """The runs as a table: pieces of ``length`` from rank ``first`` on go to sequences from ``sequence`` on."""
    rows, next_rank, sequence = [], {}, 0
    for run in runs:
        offset = 0
        for length in run.lengths:
            first = next_rank.get(length, 0)
            next_rank[length] = first + run.count
            rows.append((length, first, sequence, offset))
            offset += length
        sequence += run.count
    rows.sort()
    table = np.array(rows, dtype=np.int64).reshape(-1, 4)
    return {name: table[:, i] for i, name in enumerate(("length", "first", "sequence", "offset"))}


# --- the operator ---------------------------------------------------------------------------------


def pack(cut: DataFrame, capacity: int = 2048, groups: int = 160) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces of ``length`` 1 to ``capacity``.

    Offsets are gapless from 0 within a sequence. Every piece is placed once, repeated rows too; which of
    several pieces of one length goes where follows from hashes and ids, and is fixed by writing the ranks.
    No rows give no rows.
    """
    cut = materialize(cut, "pieces")
    counts = {int(r["length"]): r["count"] for r in cut.groupBy("length").count().collect()}
    if not counts:
        return cut.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    # At most ``capacity`` numbers: how many parts the pieces of a length are dealt to for ranking.
    parts = [-(-counts.get(length, 0) // RANKED_ROWS) or 1 for length in range(capacity + 1)]
    hashed = F.xxhash64("doc_id", "piece", "ids_crc32")
    dealt = cut.withColumn(
        "_part", F.pmod(hashed, F.get(F.array(*[F.lit(p).cast("long") for p in parts]), F.col("length").cast("int")))
    )
    sizes = dealt.groupBy("length", "_part").count()
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    own = Window.partitionBy("length", "_part").orderBy("doc_id", "piece")
    ranked = materialize(
        dealt.withColumn("_rank", F.row_number().over(own))
        .join(starts, ["length", "_part"])
        .withColumn("_rank", F.col("_before") + F.col("_rank") - 1)
        .select(*cut.columns, "_rank"),
        "ranked-pieces",
    )
    shared = cut.sparkSession.sparkContext.broadcast(places(plan(counts, capacity, groups)))
    step = 1 << 44

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        table = shared.value
        keys = table["length"] * step + table["first"]
        at = np.searchsorted(keys, length.to_numpy() * step + rank.to_numpy(), side="right") - 1
        return pd.DataFrame(
            {"sequence_id": table["sequence"][at] + rank.to_numpy() - table["first"][at], "offset": table["offset"][at]}
        )

    return ranked.withColumn("_place", place("length", "_rank")).select(*cut.columns, "_place.*")


def pack_documents(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, **options) -> DataFrame:
    """Tokenise, cut and pack documents; ``options`` are those of :func:`pieces`.

    Returns one row per piece: ``doc_id, piece, start, length, ids_crc32`` (and ``ids``), ``sequence_id,
    offset``. Null text is empty: one piece that holds the end id. A null id stays null. Other columns
    are not carried. A very long text is encoded whole, in one task, and then cut; long runs of white space
    take a slower library, with equal ids.
    """
    return pack(pieces(docs, path, capacity, end_id, **options), capacity)
