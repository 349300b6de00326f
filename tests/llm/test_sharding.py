import zlib

import numpy as np
import pytest
from helpers import clashing, collected, frame, texts

from ledgermart.llm import sharding


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1000, 65_537])
def test_it_is_a_permutation(n):
    out = sharding.permute(np.arange(n), n)
    assert sorted(out.tolist()) == list(range(n))
    assert (sharding.permute(np.arange(n)[::-1], n) == out[::-1]).all()  # each place by itself
    if n > 90:
        assert (sharding.permute(np.arange(n), n, seed=7) != out).mean() > 0.9


def test_neighbours_are_spread():
    out = sharding.permute(np.arange(100_000), 100_000)
    assert abs(np.corrcoef(np.arange(100_000), out)[0, 1]) < 0.02
    assert np.bincount(out[:1600] % 16, minlength=16).min() > 60


def check(rows, shards=16):
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    sizes = [len(slots.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_awkward_documents(spark):
    docs = clashing(frame(spark))
    rows = sharding.assign(docs).collect()
    check(rows)
    want = [(r["doc_id"], (r["text"] or "").encode()) for r in docs.collect()]
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in rows), key=repr) == sorted(((i, len(t) + 1, zlib.crc32(t)) for i, t in want), key=repr)
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("rows", None)}


def test_rows_are_numbered_in_order_whatever_the_buckets(spark, monkeypatch):
    from ledgermart.llm import common

    docs = texts(spark, [(i * i % 5003, "x" * (i % 7)) for i in range(3000)]).repartition(7)
    whole = sorted(collected(sharding.assign(docs), "doc_id", "size", "row_number", "shard", "slot"))
    assert [r[2] for r in whole] == list(range(3000))
    monkeypatch.setattr(sharding, "order_bounds", lambda df, key, n: common.order_bounds(df, key, n, 50))
    assert sorted(collected(sharding.assign(docs), "doc_id", "size", "row_number", "shard", "slot")) == whole


def test_written_shards(spark, tmp_path):
    docs = texts(spark, [(i, f"text {i}") for i in range(100)])
    sharding.write_shards(docs, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    check(back.collect())
    assert sorted(collected(back, "doc_id", "text")) == sorted(collected(docs, "doc_id", "text"))


def test_written_shards_keep_repeated_rows_and_ids(spark, tmp_path):
    docs = clashing(texts(spark, [(1, "a")] * 5 + [(1, "b"), (None, "n"), (None, None), (2, "c")]))
    sharding.write_shards(docs, str(tmp_path / "out"), shards=4)
    back = spark.read.parquet(str(tmp_path / "out"))
    check(back.collect(), 4)
    assert sorted(collected(back, "doc_id", "text"), key=repr) == sorted(collected(docs, "doc_id", "text"), key=repr)
    assert set(back.columns) == {*docs.columns, "shard", "slot"}


def test_few_rows(spark):
    assert sharding.assign(texts(spark, [])).count() == 0
    check(sharding.assign(texts(spark, [(1, None)])).collect())
