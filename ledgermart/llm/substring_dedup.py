"""Exact removal of repeated word windows by super-k-mer partitioning.

A window is ``window`` consecutive words; its minimiser is its word gram of least hash
(the leftmost of equal ones). Consecutive windows with the same minimiser travel as
one packed string, a super-k-mer, to the bucket of that minimiser's hash: equal
windows have equal minimisers and so meet in one bucket. There, super-k-mers are sorted
by minimiser and place, and each window's first start is found by comparing words.

Super-k-mers that occur again among those that a task sends at once don't travel: they
are repeats of the first of them. What a task sends to one bucket is one compressed
row. A bucket too large for a task's memory is opened into single windows, which
Spark groups by content. Opening needs no rows to meet, so the rows of a bucket that a
sample of the documents shows to be hot are dealt over all tasks.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermart.llm.common import free_name, utf8, written

WINDOW = 20
GRAM = 4
#: Bytes of packed words: of a bucket on average, of what a task sends at once, and of what it resolves in memory.
BUCKET_BYTES = 16 << 20
SEND_BYTES = 16 << 20
RESOLVE_BYTES = 48 << 20
MAX_BUCKETS = 1 << 30
#: Documents of the sample, and when a bucket is hot: from so many times RESOLVE_BYTES, and so much of the sample's bytes, on.
SAMPLE_DOCS = 4000
HOT_TIMES, HOT_SHARE = 4, 0.001
#: Buckets are dealt over at most so many tasks, each of which takes its buckets one after another.
MAX_TASKS = 20_000
#: Packed words take about so many times the text's bytes.
EXPANSION = 3
LEVEL = 3

SPANS = "did long, tie long, start int, n int, words binary"
_SPANS = pa.schema([("did", pa.int64()), ("tie", pa.int64()), ("start", pa.int32()), ("n", pa.int32()), ("words", pa.binary())])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(33))


def super_kmers(words: list[bytes], window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, end (exclusive) and minimiser hash of each run of windows that share a minimiser."""
    count = len(words) - gram + 1
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    grams = np.zeros(count, dtype=np.uint64)
    for i in range(gram):
        grams = _mixed(grams * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + count])
    low = np.uint64(0xFFFFFFFF)
    least = (grams & ~low) | np.arange(count, dtype=np.uint64)  # by hash, then the leftmost
    ranked, width, wanted = least, 1, window - gram + 1
    while width < wanted:
        step = min(width, wanted - width)
        ranked = np.minimum(ranked[:-step], ranked[step:])
        width += step
    at = (ranked & low).astype(np.int64)
    cuts = np.flatnonzero(at[1:] != at[:-1]) + 1
    first = np.concatenate(([0], cuts))
    return first, np.append(cuts, len(at)), grams[at[first]]


def hot_buckets(docs: DataFrame, rows: int, size: int, buckets: int, window: int, gram: int, resolve_bytes: int) -> set[int]:
    """Buckets that hold much more than a task resolves, by a bounded sample of the documents; at most 1 / HOT_SHARE of them.

    They only decide where rows are dealt: results don't depend on the sample.
    """

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes: dict[int, int] = {}
        for batch in batches:
            for text in batch.column(0):
                words = utf8(text.as_py()).split()
                if len(words) >= window:
                    first, end, keys = super_kmers(words, window, gram)
                    for a, b, key in zip(first.tolist(), end.tolist(), (keys % np.uint64(buckets)).tolist()):
                        sizes[key] = sizes.get(key, 0) + sum(map(len, words[a : b + window - 1])) + b - a + window - 1
        yield pa.RecordBatch.from_arrays([pa.array(list(sizes), pa.int64()), pa.array(list(sizes.values()), pa.int64())], names=["bucket", "bytes"])

    drawn = docs.filter(F.pmod(F.xxhash64("did", "tie"), F.lit(max(1, rows))) < SAMPLE_DOCS).limit(2 * SAMPLE_DOCS)
    found = {r["bucket"]: r["bytes"] for r in _heaviest(drawn.select("text").mapInArrow(measure, "bucket long, bytes long")).collect()}
    total = found.pop(None, 0)
    least = max(HOT_SHARE, HOT_TIMES * resolve_bytes / max(1, EXPANSION * size))
    return {b for b, n in found.items() if n >= least * total}


def _heaviest(sizes: DataFrame) -> DataFrame:
    """The heaviest buckets, as many as can be hot, and the sum over all under no bucket."""
    by_bucket = sizes.groupBy("bucket").agg(F.sum("bytes").alias("bytes"))
    whole = by_bucket.agg(F.sum("bytes").alias("bytes")).select(F.lit(None).cast("long").alias("bucket"), F.coalesce("bytes", F.lit(0)).alias("bytes"))
    return by_bucket.orderBy(F.desc("bytes")).limit(int(1 / HOT_SHARE)).unionByName(whole)


class _Sender:
    """Super-k-mers of one task, given out as (bucket, blob) rows when enough have come together."""

    def __init__(self, buckets: int, window: int, gram: int):
        self.buckets, self.window, self.gram = buckets, window, gram
        self._clear()

    def _clear(self) -> None:
        self.size = 0
        self.known: dict[bytes, int] = {}  # packed words: their place in rows
        self.rows: list[tuple[int, int, int, int]] = []  # key, did, tie, start
        self.repeats: list[tuple[int, int, int, int, int]] = []  # key, did, tie, start, windows

    def add(self, did: int, tie: int, text: str | None) -> None:
        words = utf8(text).split()
        if len(words) < self.window:
            return
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
        begins = np.concatenate(([0], ends[:-1] + 1))
        first, end, keys = super_kmers(words, self.window, self.gram)
        spans = zip(first.tolist(), end.tolist(), begins[first].tolist(), ends[end + self.window - 2].tolist(), keys.tolist())
        for a, b, x, y, key in spans:
            packed = joined[x:y]
            at = self.known.setdefault(packed, len(self.rows))
            if at == len(self.rows):
                self.rows.append((key, did, tie, a))
                self.size += y - x
                continue
            old = self.rows[at]
            if (did, tie, a) < old[1:]:
                self.rows[at] = (key, did, tie, a)
                self.repeats.append((*old, b - a))
            elif (did, tie, a) != old[1:]:  # a row that comes twice is one document
                self.repeats.append((key, did, tie, a, b - a))

    def send(self) -> Iterator[tuple[int, bytes]]:
        rows = np.array(self.rows, dtype=object).reshape(-1, 4)
        repeats = np.array(self.repeats, dtype=object).reshape(-1, 5)
        packed = list(self.known)
        keys = rows[:, 0].astype(np.uint64)
        buckets, of_repeats = ((k % np.uint64(self.buckets)).astype(np.int64) for k in (keys, repeats[:, 0].astype(np.uint64)))
        order, order_repeats = np.lexsort((keys, buckets)), np.argsort(of_repeats, kind="stable")
        used = np.unique(buckets)  # a repeat's bucket is that of the row it repeats
        edges = np.searchsorted(buckets[order], [*used, self.buckets]).tolist()
        edges_repeats = np.searchsorted(of_repeats[order_repeats], [*used, self.buckets]).tolist()
        for i, bucket in enumerate(used.tolist()):
            own = order[edges[i] : edges[i + 1]]
            body = (
                (keys[own] >> np.uint64(32)).astype(np.uint32),
                *[rows[own, c].astype(t) for c, t in ((1, np.int64), (2, np.int64), (3, np.int32))],
                b"\n".join([packed[j] for j in own.tolist()]),
                repeats[order_repeats[edges_repeats[i] : edges_repeats[i + 1]], 1:].astype(np.int64),
            )
            yield bucket, zstandard.compress(pickle.dumps(body, protocol=5), LEVEL)
        self._clear()


def _spans(rows: list[tuple], words: bool = False) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * 4
    last = pa.array(columns[4] if words else [None] * len(rows), type=pa.binary())
    return pa.RecordBatch.from_arrays([*[pa.array(c, type=f.type) for c, f in zip(columns, _SPANS)][:4], last], schema=_SPANS)


def _windows(packed: bytes, window: int) -> Iterator[bytes]:
    begins = [0]
    at = packed.find(b" ")
    while at >= 0:
        begins.append(at + 1)
        at = packed.find(b" ", at + 1)
    ends = [b - 1 for b in begins[1:]] + [len(packed)]
    for x, y in zip(begins, ends[window - 1 :]):
        yield packed[x:y]


def _resolve(bodies: list[tuple], window: int) -> Iterator[tuple[int, int, int, int]]:
    """Spans of windows that also start earlier: (did, tie, first window, windows). Empties ``bodies``."""
    keys, dids, ties, starts = (np.concatenate([b[i] for b in bodies]) for i in range(4))
    packed: list[bytes] = []
    for body in bodies:
        packed += body[4].split(b"\n")
    del body
    bodies.clear()
    order = np.lexsort((starts, ties, dids, keys))
    sorted_keys = keys[order]
    edges = np.concatenate(([0], np.flatnonzero(sorted_keys[1:] != sorted_keys[:-1]) + 1, [len(order)]))
    several = np.flatnonzero(np.diff(edges) > 1)
    for x, y in zip(edges[several].tolist(), edges[several + 1].tolist()):
        whole: dict[bytes, tuple] = {}
        seen: set[bytes] = set()
        for i in order[x:y].tolist():
            did, tie, start, p = int(dids[i]), int(ties[i]), int(starts[i]), packed[i]
            if p in whole:
                if whole[p] != (did, tie, start):  # else a row that comes twice
                    yield did, tie, start, p.count(b" ") + 2 - window
                continue
            whole[p] = (did, tie, start)
            run = 0
            for j, w in enumerate(_windows(p, window)):
                if w in seen:
                    run += 1
                    continue
                seen.add(w)
                if run:
                    yield did, tie, start + j - run, run
                    run = 0
            if run:
                yield did, tie, start + j + 1 - run, run


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, resolve_bytes: int = RESOLVE_BYTES, buckets: int | None = None) -> DataFrame:
    """(did, tie, start, n): runs of n windows that also start earlier, in order of did, tie and start.

    ``docs`` has did and tie (no nulls) and text. Spans may touch and come in any order.
    """
    measured = docs.agg(F.sum(F.octet_length("text")).alias("size"), F.count(F.lit(1)).alias("rows")).first()
    size = measured["size"] or 0
    if buckets is None:
        buckets = max(1, min(MAX_BUCKETS, EXPANSION * size // BUCKET_BYTES + 1))
    hot = hot_buckets(docs, measured["rows"], size, buckets, window, gram, resolve_bytes) if EXPANSION * size > HOT_TIMES * resolve_bytes else set()
    tasks = min(buckets, MAX_TASKS)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender = _Sender(buckets, window, gram)

        def rows() -> Iterator[pa.RecordBatch]:
            for bucket, blob in sender.send():
                task = (zlib.crc32(blob) if bucket in hot else bucket) % tasks
                yield pa.RecordBatch.from_arrays([pa.array([task], pa.int32()), pa.array([bucket], pa.int32()), pa.array([blob], pa.binary())], names=["task", "bucket", "blob"])

        for batch in batches:
            for did, tie, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                sender.add(did, tie, text.as_py())
                if sender.size >= SEND_BYTES or len(sender.repeats) >= SEND_BYTES >> 6:
                    yield from rows()
        if sender.rows:
            yield from rows()

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        current, size, opened = -1, 0, False

        def close() -> Iterator[pa.RecordBatch]:
            rows = []
            for row in _resolve(held, window) if held else ():
                rows.append(row)
                if len(rows) >= 50_000:
                    yield _spans(rows)
                    rows = []
            yield _spans(rows)

        def open_held() -> Iterator[pa.RecordBatch]:
            for keys, dids, ties, starts, text, _ in held:
                rows = []
                for did, tie, start, p in zip(dids.tolist(), ties.tolist(), starts.tolist(), text.split(b"\n")):
                    rows += [(did, tie, start + j, 1, w) for j, w in enumerate(_windows(p, window))]
                    if len(rows) > 20_000:
                        yield _spans(rows, words=True)
                        rows = []
                yield _spans(rows, words=True)
            held.clear()

        for batch in batches:
            for bucket, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                if bucket != current:
                    yield from close()
                    current, size, opened = bucket, 0, bucket in hot
                body = pickle.loads(zstandard.decompress(blob.as_py()))
                if len(body[5]):
                    yield _spans([tuple(r) for r in body[5].tolist()])
                held.append(body)
                size += len(body[4])
                opened = opened or size > resolve_bytes
                if opened:
                    yield from open_held()
        yield from close()

    sent = docs.select("did", "tie", "text").mapInArrow(send, "task int, bucket int, blob binary")
    dealt = sent.repartitionById(tasks, F.col("task")).sortWithinPartitions("bucket")
    found = written(dealt.select("bucket", "blob").mapInArrow(resolve, SPANS), "repeated-spans")
    single = found.filter("words is not null")
    place = F.struct("did", "tie", "start")
    firsts = single.groupBy("words").agg(F.min(place).alias("first"))
    later = single.join(firsts, "words").filter(place != F.col("first"))
    return found.filter("words is null").drop("words").unionByName(later.select("did", "tie", "start", "n"))


def with_kept(docs: DataFrame, name: str, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM, **sizes) -> DataFrame:
    """``docs`` with a struct column: n_words, n_removed, and kept, the kept words joined by one space.

    A word goes if it lies in a window that also starts earlier: at a smaller doc_id
    (null is the smallest), or earlier in the document. Rows that share a doc_id are
    ordered by the hash of their text; rows equal in both are one document and get the
    same result. Null texts have no words.
    """
    did, tie, spans = (free_name(docs, n) for n in ("did", "tie", "spans"))
    keyed = docs.withColumns({did: F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63))), tie: F.xxhash64(text)})
    found = repeated_spans(keyed.select(F.col(did).alias("did"), F.col(tie).alias("tie"), F.col(text).alias("text")), window, gram, **sizes)
    by_doc = found.groupBy(F.col("did").alias(did), F.col("tie").alias(tie)).agg(F.collect_list(F.struct("start", "n")).alias(spans))

    @F.pandas_udf("n_words int, n_removed int, kept string")
    def kept(texts: pd.Series, starts: pd.Series, counts: pd.Series) -> pd.DataFrame:
        rows = []
        for t, begin, n in zip(texts, starts, counts):
            words = utf8(t).split()
            removed = 0
            if begin is not None and len(begin):
                edges = np.zeros(len(words) + 1, dtype=np.int64)
                begin, n = np.asarray(begin, dtype=np.int64), np.asarray(n, dtype=np.int64)
                np.add.at(edges, begin, 1)
                np.add.at(edges, begin + n + (window - 1), -1)
                stays = np.cumsum(edges)[:-1] == 0
                removed = len(words) - int(stays.sum())
                left = [words[i] for i in np.flatnonzero(stays).tolist()]
            else:
                left = words
            rows.append((len(words), removed, b" ".join(left).decode("utf-8")))
        return pd.DataFrame(rows, columns=["n_words", "n_removed", "kept"])

    joined = keyed.join(by_doc, [did, tie], "left")
    return joined.withColumn(name, kept(F.col(text), F.col(spans)["start"], F.col(spans)["n"])).select(*docs.columns, name)


def measure(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256. Other columns aren't read."""
    kept = with_kept(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "kept", **settings)
    return kept.select(
        "doc_id",
        F.col("kept.n_words").cast("long").alias("n_words"),
        F.col("kept.n_removed").cast("long").alias("n_removed"),
        F.sha2(F.col("kept.kept").cast("binary"), 256).alias("kept_sha256"),
    )


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """``docs`` with each text's kept words joined by one space; nulls stay null. Columns and rows stay."""
    name = free_name(docs, "kept")
    kept = with_kept(docs, name, doc_id, text, **settings)
    return kept.withColumn(text, F.when(F.col(text).isNotNull(), F.col(name)["kept"])).select(*docs.columns)
