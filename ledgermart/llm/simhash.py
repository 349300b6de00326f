"""Near-duplicate documents by SimHash fingerprints and covering locality-sensitive hashing.

A fingerprint has one bit for each of 64 majority votes over the hashed word shingles.
Fingerprints that differ in at most ``radius`` bits are linked. The tables of the
covering family are bit masks made so that for any ``radius`` bit positions some mask
leaves all of them out: every pair within the radius falls into one bucket of that
table, so no link is missed. Documents with one fingerprint travel as one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgermart.llm.common import components, free_name, runs, utf8, written
from ledgermart.operators.sizing import broadcast_if_small

SHINGLE_WORDS = 3
RADIUS = 3
SEED = 42
BITS = 64
#: Buckets with more fingerprints get a second key; what is still larger is compared block by block, each pair of blocks on its own.
BLOCK = 2048

#: For each byte value, its eight bits.
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The unsigned fingerprint; zero where there are no words."""
    words = utf8(text).lower().split()  # of bytes, both touch ASCII only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle_words:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], dtype=np.uint64)
    else:
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = ends - lengths
        spans = zip(starts[: len(words) - shingle_words + 1].tolist(), ends[shingle_words - 1 :].tolist())
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), dtype=np.uint64, count=len(words) - shingle_words + 1)
    octets = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    votes = np.concatenate([np.bincount(octets[:, i], minlength=256) @ _BYTE_BITS for i in range(8)])
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, text_hash, fp): fp is the fingerprint's 64 bits as a long."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle_words) for t in batch.column(2)), dtype=np.uint64, count=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps.view(np.int64))], names=["doc_id", "text_hash", "fp"])

    kept = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    return kept.mapInArrow(work, "doc_id long, text_hash long, fp long")


def covering_masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """The 2^(radius+1) - 1 masks, as signed longs.

    Position i gets a non-zero vector of radius + 1 bits; a mask holds the positions
    whose vector has odd parity with the mask's own vector. Any ``radius`` vectors
    span too little to meet every mask's vector: some mask's is orthogonal to all of
    them, and that mask leaves their positions out.
    """
    return [_signed(m) for m in _covering(list(range(bits)), radius)]


def _covering(positions: list[int], radius: int) -> list[int]:
    size = 1 << (radius + 1)
    own = [1 + i % (size - 1) for i in range(len(positions))]
    return [sum(1 << p for p, x in zip(positions, own) if (x & v).bit_count() & 1) for v in range(1, size)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def finer_masks(mask: int, radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """Masks that hold ``mask`` and cover the positions that it leaves out in the same way.

    Two fingerprints within the radius that agree on ``mask`` agree on one of these.
    """
    free = [i for i in range(bits) if not mask >> i & 1]
    return [_signed((mask & ((1 << 64) - 1)) | m) for m in _covering(free, radius)]


def _forest(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that hold the fingerprints within the radius together: a spanning forest, searched breadth first."""
    rest = np.sort(fps)
    links = []
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            near = np.bitwise_count(rest ^ x) <= radius
            if near.any():
                found = rest[near]
                links += [(x, y) for y in found]
                queue += list(found)
                rest = rest[~near]
    return links


def near_links(fps: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """(a, b) links between the distinct longs of column fp, enough for the same components as all links.

    The fingerprints of a bucket of more than ``block`` are dealt again by the covering masks of
    the positions that its mask leaves out. A bucket that is too large even then is cut into
    blocks by hash and each pair of blocks is one cell, so no task holds more than about two
    blocks; each cell gives at most one link for each of its fingerprints.
    """
    masks = covering_masks(radius)
    tables = F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("k")) for i, m in enumerate(masks)])
    keyed = fps.select("fp", F.explode(tables).alias("at")).select("fp", "at.t", "at.k")
    more = F.count(F.lit(1)) > block
    large = keyed.groupBy("t", "k").agg(more.alias("large")).filter("large")
    finer = F.element_at(F.lit([finer_masks(m, radius) for m in masks]), F.col("t") + 1)
    again = F.transform(finer, lambda m, i: F.struct(i.alias("v"), F.col("fp").bitwiseAND(m).alias("own")))
    once = F.array(F.struct(F.lit(-1).alias("v"), F.col("k").alias("own")))
    dealt = keyed.join(broadcast_if_small(large), ["t", "k"], "left").select("fp", "t", F.inline(F.when(F.col("large"), again).otherwise(once)))

    sizes = dealt.filter("v >= 0").groupBy("t", "v", "own").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block)
    blocks = sizes.select("t", "v", "own", F.ceil(F.col("n") / (block // 2)).cast("long").alias("blocks"))
    part = F.pmod(F.xxhash64(F.lit(radius), "fp"), F.col("blocks")).cast("long")
    cells = F.when(
        F.col("blocks").isNotNull(),
        F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda c: F.least(c, part) * F.col("blocks") + F.greatest(c, part)),
    ).otherwise(F.array(F.lit(-1).cast("long")))
    dealt = (
        dealt.join(broadcast_if_small(blocks), ["t", "v", "own"], "left")
        .select("fp", "t", "v", "own", F.explode(cells).alias("cell"))
        .withColumn("g", F.xxhash64("t", "v", "own", "cell"))
        .repartition("g")
        .sortWithinPartitions("g")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run, _ in runs(batches, ["g"]):
            links = _forest(run.column("fp").to_numpy().view(np.uint64), radius)
            if links:
                pair = np.array(links, dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(pair[:, 0]), pa.array(pair[:, 1])], names=["a", "b"])

    return dealt.select("fp", "g").mapInArrow(work, "a long, b long").distinct()


def _classes(prints: DataFrame, radius: int) -> DataFrame:
    """(fp, component_id, first) for each fingerprint; ``first`` tells the row that stays."""
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    classes = written(prints.groupBy("fp").agg(F.min(row).alias("least")), "simhash-classes")
    roots = components(prints.sparkSession, near_links(classes.select("fp"), radius), "a", "b")
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    first = rooted.groupBy("root").agg(F.min("least").alias("first"))
    return rooted.select("fp", "root").join(first, "root").select("fp", F.col("first.doc_id").alias("component_id"), "first")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS
) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest doc_id that chains of links reach, the row's own
    included. Null, empty and blank texts have fingerprint zero and are linked like
    any other; a null doc_id is a component's only if it has no other. Repeated rows
    stay. Other columns of ``docs``, whatever their names, aren't read.
    """
    prints = written(with_fingerprints(docs, doc_id, text, shingle_words), "simhash")
    named = _classes(prints, radius).select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS
) -> DataFrame:
    """``docs`` with one row of each component, columns unchanged.

    The row with the smallest doc_id stays; rows without one stay only where the
    component has no other. Of rows that share that doc_id the one whose text has the
    least hash stays, and of rows equal in both any one.
    """
    prints = written(with_fingerprints(docs, doc_id, text, shingle_words), "simhash")
    firsts = _classes(prints, radius).select("first.doc_id", "first.text_hash").distinct()
    key, tie, turn = (free_name(docs, n) for n in ("first_id", "first_hash", "turn"))
    firsts = firsts.toDF(key, tie)
    own = F.xxhash64(docs[text])
    kept = docs.join(firsts, docs[doc_id].cast("long").eqNullSafe(firsts[key]) & (own == firsts[tie]))
    once = kept.withColumn(turn, F.row_number().over(Window.partitionBy(key, tie).orderBy(key)))
    return once.filter(F.col(turn) == 1).select(*[docs[c] for c in docs.columns])
