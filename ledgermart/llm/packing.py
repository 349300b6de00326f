"""Packing of tokenized documents into sequences of a fixed length.

Pieces of one length are interchangeable, so the plan is made from counts by length
alone: at most ``capacity`` numbers, whatever the input. Exact-complement hashing
comes first: the sums that one, two and three lengths make are indexed, and for each length, the
longest first, combinations that fill its gap exactly are consumed as long as their
counts last; the index follows the counts. What is left is packed best-fit, longest first. The plan says where the
r-th piece of each length goes; pieces are numbered within their length and placed
where they are, side by side.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from ledgermart.llm.common import written

CAPACITY = 2048
TOKENIZER = "byte_bpe_50k"
END_ID = 0
END_OF_TEXT = {"<|endoftext|>": 50256}
#: Pieces are numbered in groups of about so many, and there are at most so many groups.
GROUP_PIECES = 1_000
MAX_GROUPS = 4096

_loaded: dict[str, tuple] = {}


def token_ids(text: str, name: str = TOKENIZER) -> np.ndarray:
    """Ids of the named public byte-level BPE, special tokens' texts as their ids, none added.

    The vocabulary is used as ranks, which is several times faster and gives the same
    ids. Only where its splitter gives up (on a very long run of white space) does the
    tokenizer file's own encoder take the text.
    """
    if name not in _loaded:
        ranks = dict(map(bytes.split, open(public_tokenizers.path(f"{name}.tiktoken"), "rb")))
        ranks = {base64.b64decode(token): int(rank) for token, rank in ranks.items()}
        fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=END_OF_TEXT)
        _loaded[name] = fast, Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
    fast, own = _loaded[name]
    try:
        return fast.encode_to_numpy(text, allowed_special="all")
    except ValueError:
        return np.array(own.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


def cuts(n: int, capacity: int) -> list[int]:
    """Starts of the pieces of n ids: only the first piece may be shorter than the capacity."""
    first = n % capacity or capacity
    return [0, *range(first, n, capacity)] if n > capacity else [0]


def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, ids: bool = False, tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) for all pieces, with the ids themselves if asked."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for doc, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = token_ids(t.as_py() or "", tokenizer)
                found = np.append(found, np.uint32(END_ID)).astype("<u4")
                starts = cuts(len(found), capacity)
                for i, (a, b) in enumerate(zip(starts, [*starts[1:], len(found)])):
                    own = found[a:b]
                    rows.append((doc, i, a, b - a, zlib.crc32(own.tobytes()), *([own.astype(np.int32)] if ids else [])))
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    names = ["doc_id", "start", "length", "ids_crc32"]
    kinds = {n: pa.int64() for n in names} | {"piece": pa.int32()} | ({"ids": pa.list_(pa.int32())} if ids else {})
    order = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if ids else [])]
    schema = pa.schema([(n, kinds[n]) for n in order])
    declared = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if ids else "")
    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(work, declared)


class Sums:
    """Lengths still there, with an index of the sums that one, two or three of them make.

    ``pairs`` has for each sum how many pairs of lengths make it; it is kept up as lengths run
    out or come back. A third length reaches the sums that it and an indexed pair make.
    """

    def __init__(self, counts: np.ndarray):
        self.counts = counts
        there = (counts > 0).astype(np.int64)
        both = np.convolve(there, there)[: len(counts)]  # each pair twice, and each length with itself
        both[::2] -= there[: len(both[::2])]
        self.pairs = both // 2
        self.pairs[::2] += (counts >= 2)[: len(self.pairs[::2])]

    def change(self, length: int, by: int) -> None:
        """``by`` more (or fewer) pieces of a length."""
        before = int(self.counts[length])
        now = self.counts[length] = before + by
        double = 2 * length
        if double < len(self.pairs):
            self.pairs[double] += int(now >= 2) - int(before >= 2)
        if (now > 0) != (before > 0):
            partners = np.flatnonzero(self.counts[: len(self.counts) - length])
            self.pairs[length + partners[partners != length]] += 1 if now else -1

    def pair(self, total: int) -> tuple[int, int] | None:
        """The most plentiful pair that makes the sum."""
        if not self.pairs[total]:
            return None
        x = np.arange(1, total // 2 + 1)
        both = np.minimum(self.counts[x], self.counts[total - x])
        if total % 2 == 0:
            both[-1] = self.counts[total // 2] // 2
        first = int(x[both.argmax()])
        return first, total - first

    def triple(self, total: int) -> tuple[int, int, int] | None:
        """The longest length that an indexed pair completes, with that pair."""
        firsts = np.flatnonzero((self.counts[1:total] > 0) & (self.pairs[total - 1 : 0 : -1] > 0)) + 1
        for z in firsts[::-1].tolist():
            self.change(z, -1)  # the pair can't take the same piece
            found = self.pair(total - z)
            self.change(z, 1)
            if found:
                return z, *found
        return None

    def fill(self, gap: int, most: int) -> tuple[int, ...] | None:
        """At most ``most`` (up to three) lengths still there whose sum is the gap."""
        found = (gap,) if self.counts[gap] else None
        if found is None and most >= 2:
            found = self.pair(gap)
        return self.triple(gap) if found is None and most >= 3 else found


def plan(counts_by_length: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths with how many sequences each makes up; all pieces are used.

    Exact fills spend short pieces, which long ones may need more where they are scarce;
    so plans with sums of up to three, two and one lengths are made, and one with the
    fewest sequences is taken, the first of equals.
    """
    return min((_plan(counts_by_length, capacity, most) for most in (3, 2, 1)), key=lambda p: sum(n for _, n in p))


def _plan(counts_by_length: dict[int, int], capacity: int, most: int) -> list[tuple[tuple[int, ...], int]]:
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts_by_length.items():
        counts[length] = n
    done = [((capacity,), int(counts[capacity]))]
    counts[capacity] = 0
    rest, sums = np.zeros_like(counts), Sums(counts)
    for length in range(capacity - 1, 0, -1):
        while n := int(counts[length]):
            sums.change(length, -1)  # one is the piece whose gap is filled
            fill = sums.fill(capacity - length, most)
            sums.change(length, 1)
            if fill is None:
                rest[length] = n
                sums.change(length, -n)
                break
            pattern = (length, *fill)
            lengths, uses = np.unique(pattern, return_counts=True)
            times = int((counts[lengths] // uses).min())
            for own, each in zip(lengths.tolist(), uses.tolist()):
                sums.change(own, -times * each)
            done.append((pattern, times))
    # best fit on what is left: open sequences by gap, alike ones counted
    opened: dict[int, dict[tuple[int, ...], int]] = {}

    def put(gap: int, pattern: tuple[int, ...], n: int) -> None:
        if n:
            opened.setdefault(gap, {})
            opened[gap][pattern] = opened[gap].get(pattern, 0) + n

    for length in range(capacity - 1, 0, -1):
        left = int(rest[length])
        while left:
            gap = min((g for g in opened if g >= length), default=None)
            if gap is None:
                each = min(left, capacity // length)
                put(capacity - each * length, (length,) * each, left // each)
                left -= left // each * each
                continue
            pattern, n = opened[gap].popitem()
            if not opened[gap]:
                del opened[gap]
            now = min(n, left)
            put(gap, pattern, n - now)
            put(gap - length, (*pattern, length), now)
            left -= now
    done += [(pattern, n) for by_pattern in opened.values() for pattern, n in by_pattern.items()]
    return [(pattern, n) for pattern, n in done if n]


def segments(patterns: list[tuple[tuple[int, ...], int]], capacity: int = CAPACITY) -> tuple[np.ndarray, ...]:
    """(key, first sequence, offset) of runs of pieces: ranks of one length go to consecutive sequences from there on.

    The key is the length in the high bits and the run's first rank in the low 48.
    """
    used = np.zeros(capacity + 1, dtype=np.int64)
    out, sequence = [], 0
    for pattern, n in patterns:
        offset = 0
        for length in pattern:
            out.append(((length << 48) + int(used[length]), sequence, offset))
            used[length] += n
            offset += length
        sequence += n
    rows = np.array(sorted(out), dtype=np.int64).reshape(-1, 3)
    return rows[:, 0], rows[:, 1], rows[:, 2]


def place(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Written pieces with sequence_id and offset.

    Lengths are counted in groups made by hash; a piece's rank within its length is its
    rank within the group after the counts of the groups before. Only counts by length
    reach the driver.
    """
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # at most capacity rows
    groups = max(1, min(MAX_GROUPS, sum(counts.values()) // GROUP_PIECES))
    keys, sequences, offsets = segments(plan(counts, capacity), capacity)
    grouped = cut.withColumn("group", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(groups)).cast("int"))
    sizes = grouped.groupBy("group", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    ahead = sizes.select("group", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    own = F.row_number().over(Window.partitionBy("group", "length").orderBy("doc_id", "piece", "start", "ids_crc32"))
    ranked = grouped.withColumn("own", own - 1).join(ahead, ["group", "length"])

    @F.pandas_udf("sequence_id long, offset long")
    def placed(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for lengths, ranks in batches:
            key = (lengths.to_numpy() << 48) + ranks.to_numpy()
            at = np.searchsorted(keys, key, side="right") - 1
            yield pd.DataFrame({"sequence_id": sequences[at] + key - keys[at], "offset": offsets[at]})

    return ranked.withColumn("at", placed("length", (F.col("own") + F.col("ahead")).cast("long"))).select(*cut.columns, "at.sequence_id", "at.offset")


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, tokenizer: str = TOKENIZER) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids and one END_ID, so null and empty texts make one piece of one
    id. Only documents over the capacity are cut. Repeated rows are packed each on its
    own. Other columns of ``docs``, whatever their names, aren't read.
    """
    return place(written(pieces(docs, doc_id, text, capacity, tokenizer=tokenizer), "pieces"), capacity)


def sequences(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, tokenizer: str = TOKENIZER) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids, and doc_ids with the offsets where their pieces begin."""
    cut = written(pieces(docs, doc_id, text, capacity, ids=True, tokenizer=tokenizer), "pieces")
    part: Column = F.struct("offset", "doc_id", "ids")
    joined = place(cut, capacity).groupBy("sequence_id").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    return joined.select(
        "sequence_id",
        F.flatten(F.col("parts.ids")).alias("ids"),
        F.col("parts.doc_id").alias("doc_ids"),
        F.col("parts.offset").alias("offsets"),
    )
