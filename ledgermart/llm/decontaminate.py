"""Benchmark decontamination with a generalised suffix automaton over the words of the test items.

Documents stream through the automaton word by word while the length of the longest
match that ends there is tracked. A match of ``window`` words, or of a whole item that
is shorter, makes the words it covers hits. Spans of hits are cut; a document whose
hits cover too much of it is contaminated and goes as a whole.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgermart.llm.common import free_name, utf8, written

WINDOW = 13
#: A document is contaminated from this share of hit words on, as (numerator, denominator).
COVERAGE = (1, 20)
#: Items are taken in blocks of about so many words (and of whole items); each block is one automaton and one broadcast.
BLOCK_WORDS = 200_000
#: Buckets in which items are numbered side by side.
BUCKETS = 64

#: Bytes to words: A-Z in lower case, other ASCII that is neither digit nor letter to spaces.
_AS_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return utf8(text).translate(_AS_WORDS).split()


class Automaton:
    """The suffix automaton of several word sequences, with the items that hold each window."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = [(item, [self.ids.setdefault(w, len(self.ids)) for w in words]) for item, words in items if words]
        for _, seq in coded:
            last = 0
            for c in seq:
                last = self._extend(last, c)
        self.items: dict[int, set[str | None]] = {}  # by the state that holds a window as its shortest matches
        self.short: dict[int, list[tuple[int, str | None]]] = {}  # by state: whole items below the window's length
        self.least = window
        self.over = self._window_states()
        for item, seq in coded:
            state = 0
            for i, c in enumerate(seq):
                state = self.next[state][c]
                if i + 1 >= window:
                    self.items.setdefault(self.over[state], set()).add(item)
            if len(seq) < window:
                self.short.setdefault(state, []).append((len(seq), item))
                self.least = min(self.least, len(seq))
        self.marked = self._marked_states()

    @classmethod
    def of(cls, parts: dict) -> Automaton:
        """An automaton from the vars() of another; these are what is pickled, which needs no class to be read."""
        made = cls.__new__(cls)
        made.__dict__ = parts
        return made

    def _new(self, length: int, link: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """The part of state q that ends the matches of p followed by c."""
        copy = self._new(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def _extend(self, p: int, c: int) -> int:
        q = self.next[p].get(c)
        if q is not None:  # another item has this word here
            return q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
        new = self._new(self.length[p] + 1, 0, {})
        while p != -1 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p != -1:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
        return new

    def _by_length(self) -> list[int]:
        return sorted(range(1, len(self.length)), key=self.length.__getitem__)

    def _window_states(self) -> list[int]:
        """For each state, the one on its suffix links whose matches of the window's length it ends with, or -1."""
        over = [-1] * len(self.length)
        for s in self._by_length():
            if self.length[s] >= self.window:
                over[s] = s if self.length[self.link[s]] < self.window else over[self.link[s]]
        return over

    def _marked_states(self) -> list[int]:
        """For each state, the nearest one on its suffix links, itself included, that whole short items end in, or -1."""
        marked = [-1] * len(self.length)
        for s in self._by_length():
            marked[s] = s if s in self.short else marked[self.link[s]]
        return marked

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set[str | None], int]:
        """Hit words as a mask, the items found, and the length of the longest match (0 if no run is long enough to matter)."""
        hit = np.zeros(len(words) + 1, dtype=np.int32)  # +1 where hits begin, -1 after they end
        found: set[str | None] = set()
        longest = 0
        if len(words) < self.least:
            return hit[:-1] > 0, found, longest
        codes = np.fromiter(map(self.ids.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        edges = np.flatnonzero(np.diff(np.concatenate(([False], codes >= 0, [False])).astype(np.int8)))
        moves, link, length, window = self.next, self.link, self.length, self.window
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if b - a < self.least:
                continue
            state = matched = 0
            for i, c in enumerate(codes[a:b].tolist(), a):
                to = moves[state].get(c)
                while to is None and state:
                    state = link[state]
                    matched = length[state]
                    to = moves[state].get(c)
                state, matched = (to, matched + 1) if to is not None else (0, 0)
                longest = max(longest, matched)
                if matched >= window:
                    hit[i + 1 - window] += 1
                    hit[i + 1] -= 1
                    found |= self.items[self.over[state]]
                s = self.marked[state]
                while s > 0:
                    for n, item in self.short[s]:
                        if n <= matched:
                            hit[i + 1 - n] += 1
                            hit[i + 1] -= 1
                            found.add(item)
                    s = self.marked[link[s]]
        return np.cumsum(hit)[:-1] > 0, found, longest


def item_blocks(items: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(block, automaton), written: blocks of about ``block_words`` words, numbered from 0, each with its pickled automaton.

    A block begins with the item that reaches a multiple of ``block_words`` in the running
    count of words, so it holds fewer words than that and one item more.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pa.array([len(words_of(t.as_py())) for t in batch.column(1)], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, sizes], names=["item", "text", "n"])

    def build(block: pa.Table) -> pa.Table:
        own = [(i, words_of(t)) for i, t in zip(block.column("item").to_pylist(), block.column("text").to_pylist())]
        made = pickle.dumps(vars(Automaton(own, window)), pickle.HIGHEST_PROTOCOL)
        return pa.table({"block": block.column("block").slice(0, 1), "automaton": pa.array([made], pa.binary())})

    named = items.select(F.col(item_id).cast("string").alias("item"), F.col(text).cast("string").alias("text"))
    sized = named.mapInArrow(counted, "item string, text string, n long").filter("n > 0").withColumn("bucket", F.pmod(F.xxhash64("item", "text"), F.lit(BUCKETS)))
    sized = written(sized, "items")
    sums = sized.groupBy("bucket").agg(F.sum("n").alias("n"))  # at most BUCKETS rows
    ahead = sums.select("bucket", F.coalesce(F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("ahead"))
    own = Window.partitionBy("bucket").orderBy("item", "text").rowsBetween(Window.unboundedPreceding, -1)
    running = F.coalesce(F.sum("n").over(own), F.lit(0)) + F.col("ahead")
    dealt = sized.join(F.broadcast(ahead), "bucket").withColumn("place", F.floor(running / block_words).cast("long"))
    blocks = dealt.select("item", "text", F.col("place").alias("block")).groupBy("block").applyInArrow(build, "block long, automaton binary")
    return written(blocks, "automata")


def _ready(shared: Broadcast) -> Automaton:
    """The automaton of a broadcast, made once by each Python worker."""
    if not hasattr(shared, "automaton"):
        shared.automaton = Automaton.of(pickle.loads(shared.value))
    return shared.automaton


def _spans(hit: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.diff(np.concatenate(([False], hit, [False])).astype(np.int8))).astype(np.int32)


_FOUND = "n_words int, starts array<int>, ends array<int>, items array<string>, longest int, left string"


def _one_pass(shared: Broadcast, cut: bool):
    """A function of text that gives what the automaton finds."""

    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scan = _ready(shared).scan
        for texts in batches:
            yield _as_found((text, words, *scan(words)) for text, words in ((t, words_of(t)) for t in texts))

    def _as_found(scanned) -> pd.DataFrame:
        rows = []
        for text, words, hit, items, longest in scanned:
            edges = _spans(hit)
            left = _without(text, edges) if cut and len(edges) else None
            rows.append((len(words), edges[::2], edges[1::2], sorted(items, key=lambda i: (i is None, i)), longest, left))
        return pd.DataFrame(rows, columns=["n_words", "starts", "ends", "items", "longest", "left"])

    return F.pandas_udf(found, _FOUND)


def _merged(cut: bool):
    """A function of text and what the passes have found in it, as one finding."""

    def found(texts: pd.Series, starts: pd.Series, ends: pd.Series, items: pd.Series, longest: pd.Series) -> pd.DataFrame:
        rows = []
        for text, a, b, own, far in zip(texts, starts, ends, items, longest):
            words = words_of(text)
            hit = np.zeros(len(words), dtype=bool)
            for x, y in zip(*(([] if s is None else s) for s in (a, b))):
                hit[x:y] = True
            edges = _spans(hit)
            left = _without(text, edges) if cut and len(edges) else None
            named = set() if own is None else set(own)
            rows.append((len(words), edges[::2], edges[1::2], sorted(named, key=lambda i: (i is None, i)), 0 if pd.isna(far) else int(far), left))
        return pd.DataFrame(rows, columns=["n_words", "starts", "ends", "items", "longest", "left"])

    return F.pandas_udf(found, _FOUND)


def _pass_by_pass(docs: DataFrame, automata: DataFrame, blocks: list[int], name: str, text: str, cut: bool) -> DataFrame:
    """One pass for each block over the written documents, each leaving what it found; the findings of a row are put together."""
    spark = docs.sparkSession
    row = free_name(docs, "row_number")
    base = written(docs.withColumn(row, F.monotonically_increasing_id()), "documents")
    passes: DataFrame | None = None
    for block in blocks:
        shared = spark.sparkContext.broadcast(_automaton(automata, block))

        def scanned(batches: Iterator[pa.RecordBatch], shared: Broadcast = shared) -> Iterator[pa.RecordBatch]:
            scan = _ready(shared).scan
            for batch in batches:
                rows = []
                for at, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                    hit, items, longest = scan(words_of(t.as_py()))
                    if longest:
                        edges = _spans(hit).tolist()
                        rows.append((at, edges[::2], edges[1::2], list(items), longest))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["row", "starts", "ends", "items", "longest"])

        kinds = [pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.string()), pa.int32()]
        own = base.select(row, text).mapInArrow(scanned, "row long, starts array<int>, ends array<int>, items array<string>, longest int")
        own = written(own, "hits")
        shared.unpersist()
        passes = own if passes is None else passes.unionByName(own)
    lists = [F.flatten(F.collect_list(c)).alias(c) for c in ("starts", "ends", "items")]  # at most an entry for each block
    found = passes.groupBy(F.col("row").alias(row)).agg(*lists, F.max("longest").alias("longest"))
    parts = free_name(base, "parts")
    joined = base.join(found.select(row, F.struct("starts", "ends", "items", "longest").alias(parts)), row, "left")
    merged = _merged(cut)(F.col(text), *[F.col(parts)[c] for c in ("starts", "ends", "items", "longest")])
    return joined.withColumn(name, merged).select(*docs.columns, name)


def _automaton(automata: DataFrame, block: int) -> bytes:
    return bytes(automata.filter(F.col("block") == block).first()["automaton"])


def _without(text: str, edges: np.ndarray) -> str:
    """The text without its words [edges[0], edges[1]), [edges[2], edges[3]) and so on, and what lies within each span."""
    raw = utf8(text)
    flat = np.frombuffer(raw.translate(_AS_WORDS), dtype=np.uint8) != 32
    bounds = np.flatnonzero(np.diff(np.concatenate(([False], flat, [False])).astype(np.int8)))
    parts, at = [], 0
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
        parts.append(raw[at : bounds[2 * a]])
        at = bounds[2 * b - 1]
    return b"".join([*parts, raw[at:]]).decode("utf-8")


def with_hits(docs: DataFrame, items: DataFrame, name: str, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, cut: bool = False, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with a struct column: n_words, starts and ends of hit spans (in words), items, longest match, left.

    ``left`` is the text without its hit spans where it has any and ``cut`` is set.
    Null and empty texts have no words. Items without words match nothing; repeated
    items count once by id, and those without id as one, whose id is null. Each block of items
    is one pass over the texts; where there are several, the documents are written once before.
    """
    automata = item_blocks(items, item_id, item_text, window, block_words)
    blocks = sorted(r["block"] for r in automata.select("block").collect())  # numbers only
    if len(blocks) > 1:
        return _pass_by_pass(docs, automata, blocks, name, text, cut)
    made = _automaton(automata, blocks[0]) if blocks else pickle.dumps(vars(Automaton([], window)))
    return docs.withColumn(name, _one_pass(docs.sparkSession.sparkContext.broadcast(made), cut)(F.col(text)))


def measures(found: Column, coverage: tuple[int, int] = COVERAGE) -> dict[str, Column]:
    """Columns of a document's hits."""
    n_words = found["n_words"].cast("long")
    lengths = F.zip_with(found["starts"], found["ends"], lambda a, b: b - a)
    n_hit = F.aggregate(lengths, F.lit(0).cast("long"), lambda x, n: x + n)
    return {
        "n_words": n_words,
        "n_hit": n_hit,
        "n_items": F.size(found["items"]).cast("long"),
        "items_sha256": F.sha2(F.array_join(F.array_sort(found["items"]), ",").cast("binary"), 256),
        "contaminated": (n_hit > 0) & (coverage[1] * n_hit >= coverage[0] * n_words),
        "longest_match": found["longest"],
    }


def judge(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """One row per input row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, longest_match.

    Settings as for ``with_hits``. A document without words has zeros and isn't
    contaminated; without items nothing is. An item without id is in n_items, and its id
    left out of items_sha256. Repeated rows stay. Other columns of
    ``docs``, whatever their names, aren't read.
    """
    kept = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = with_hits(kept, items, "found", "text", **settings)
    return found.select("doc_id", *[c.alias(n) for n, c in measures(F.col("found")).items()])


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", coverage: tuple[int, int] = COVERAGE, **settings) -> DataFrame:
    """``docs`` without the contaminated rows; in the others hit spans are cut from the text. Columns stay as they are."""
    name = free_name(docs, "found")
    found = with_hits(docs, items, name, text, cut=True, **settings)
    kept = found.filter(~measures(F.col(name), coverage)["contaminated"])
    return kept.withColumn(text, F.coalesce(F.col(name)["left"], F.col(text))).select(*docs.columns)
