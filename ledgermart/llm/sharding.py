"""Reproducible shuffle and sharding by a Feistel permutation of global row numbers.

Rows are numbered by key. A keyed Feistel network permutes [0, a*b), a little more
than the number of rows n; a value that falls outside [0, n) is permuted again until
it falls inside (cycle walking), which makes a permutation of [0, n). A row's shard
and slot follow from its permuted number alone, so any row's place can be computed
without moving data, and the same seed gives the same order.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermart.llm.common import free_name, global_rank, order_bounds, written

SHARDS = 16
SEED = 42
ROUNDS = 6
LAW = "rows"

_MASK = (1 << 64) - 1


def _mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser; uint64 arithmetic wraps."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def round_keys(seed: int, rounds: int = ROUNDS) -> list[int]:
    return [((seed + 1) * 0x9E3779B97F4A7C15 + r * 0xD1B54A32D192ED03) & _MASK for r in range(rounds)]


def permute(rows: np.ndarray, n: int, seed: int = SEED, rounds: int = ROUNDS) -> np.ndarray:
    """The permutation of [0, n) at ``rows``."""
    if n < 2:
        return rows.astype(np.int64)
    a = isqrt(n - 1) + 1
    b = -(-n // a)
    keys = [np.uint64(k) for k in round_keys(seed, rounds)]

    def network(x: np.ndarray) -> np.ndarray:
        left, right = x // np.uint64(b), x % np.uint64(b)  # left < a, right < b
        for i, key in enumerate(keys):
            if i % 2 == 0:
                left = (left + _mix(right ^ key) % np.uint64(a)) % np.uint64(a)
            else:
                right = (right + _mix(left ^ key) % np.uint64(b)) % np.uint64(b)
        return left * np.uint64(b) + right

    out = network(rows.astype(np.uint64))
    while (outside := out >= np.uint64(n)).any():
        out[outside] = network(out[outside])
    return out.astype(np.int64)


def assign(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, law, shard, slot, grown_shard, row_number.

    Rows are numbered by doc_id (nulls first), then size and checksum; rows equal in
    all three are alike in the result. Shards' row counts differ by one at most, and a
    shard's slots run from 0 without gaps. size is the text's UTF-8 bytes plus one; a
    null text has none, like an empty one. The law is ``rows``, so grown_shard is null.
    Other columns of ``docs``, whatever their names, aren't read.
    """
    return _placed(docs.select(*_measured(docs, doc_id, text)), shards, seed)


def _measured(docs: DataFrame, doc_id: str, text: str) -> list[Column]:
    raw = F.coalesce(docs[text], F.lit("")).cast("binary")
    return [docs[doc_id].cast("long").alias("doc_id"), (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32")]


def _placed(narrow: DataFrame, shards: int, seed: int) -> DataFrame:
    """``narrow`` (doc_id, size, text_crc32, and what is to be kept) with the places of its rows."""
    kept = [c for c in narrow.columns if c not in ("doc_id", "size", "text_crc32")]
    narrow = written(narrow, "shard-rows")
    n = narrow.count()
    ranked = global_rank(narrow, ["doc_id", "size", "text_crc32", *kept], order_bounds(narrow, "doc_id", n), "row_number")

    @F.pandas_udf("long")
    def place(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for rows in batches:
            yield pd.Series(permute(rows.to_numpy(), n, seed))

    placed = ranked.withColumn("place", place("row_number"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        (F.col("place") % shards).cast("int").alias("shard"),
        F.expr(f"place div {shards}").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "row_number",
        *kept,
    )


def write_shards(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS, seed: int = SEED) -> None:
    """Writes ``docs`` as Parquet folders shard=0, shard=1 and so on.

    A shard's files hold consecutive ranges of slots in their order. Rows that share a
    doc_id, also repeated ones, each have a place of their own: for that ``docs`` are written once with a
    number, which no result shows. Columns named shard or slot are replaced.
    """
    row = free_name(docs, "row")
    numbered = written(docs.drop("shard", "slot").withColumn(row, F.monotonically_increasing_id()), "shard-documents")
    places = _placed(numbered.select(*_measured(numbered, doc_id, text), F.col(row).alias("own_row")), shards, seed)
    placed = numbered.join(places.select(F.col("own_row").alias(row), "shard", "slot"), row).drop(row)
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
