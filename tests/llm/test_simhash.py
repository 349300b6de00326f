import random
import re

import numpy as np
import pytest
import xxhash
from helpers import clashing, collected, frame, texts
from pyspark.sql import functions as F

from ledgermart.llm import simhash


def plain_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", lower) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(pairs, radius=3):
    """By row, its component's first row and smallest doc_id; every pair is compared."""
    parent = list(range(len(pairs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(pairs)):
        for j in range(i):
            if (pairs[i][1] ^ pairs[j][1]).bit_count() <= radius:
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(pairs):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return [(find(i), least.get(find(i))) for i in range(len(pairs))]


def test_masks_cover_every_three_positions():
    masks = [m & (2**64 - 1) for m in simhash.covering_masks()]
    assert len(masks) == 15
    for a in range(64):
        for b in range(a, 64):
            for c in range(b, 64):
                flips = 1 << a | 1 << b | 1 << c
                assert any(m & flips == 0 for m in masks)


def test_finer_masks_cover_what_a_mask_leaves_out():
    full = 2**64 - 1
    rng = random.Random(2)
    for m in (m & full for m in simhash.covering_masks()):
        free = [i for i in range(64) if not m >> i & 1]
        finer = [f & full for f in simhash.finer_masks(m)]
        assert len(finer) == 15 and all(f & m == m for f in finer)
        for _ in range(400):
            flips = sum(1 << i for i in set(rng.choices(free, k=3)))
            assert any(f & flips == 0 for f in finer)


def test_awkward_documents_equal_brute_force(spark):
    docs = clashing(frame(spark))
    got = collected(simhash.near_duplicates(docs), "doc_id", "fingerprint", "component_id")
    rows = [(r["doc_id"], plain_fingerprint(r["text"])) for r in docs.collect()]
    want = [(d, f"{f:016x}", c) for (d, f), c in zip(rows, (c for _, c in plain_components(rows)))]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_spark_hash_is_the_fingerprints_hash(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("a é b"))).first()[0] & (2**64 - 1) == xxhash.xxh64_intdigest("a é b".encode(), 42)


@pytest.mark.parametrize("block", [8, 2048])
def test_links_hold_components_together_in_hot_buckets(spark, block):
    rng = random.Random(3)
    seeds = [rng.getrandbits(64) for _ in range(40)]
    base = rng.getrandbits(64)
    seeds += [base ^ sum(1 << rng.randrange(64) for _ in range(5)) & (2**64 - 1) for _ in range(25)]  # share most masked bits
    fps = {s ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(4))) & (2**64 - 1) for s in seeds for _ in range(12)}
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    links = simhash.near_links(spark.createDataFrame([(f,) for f in signed], "fp long"), block=block).collect()
    parent = {f: f for f in signed}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        assert ((a ^ b) & (2**64 - 1)).bit_count() <= 3
        parent[find(a)] = find(b)
    for i, a in enumerate(signed):
        for b in signed[:i]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= 3:
                assert find(a) == find(b)


def test_drop_keeps_one_row_of_each_component(spark):
    docs = clashing(frame(spark))
    kept = simhash.drop_near_duplicates(docs)
    assert kept.schema == docs.schema
    rows = [(r["doc_id"], plain_fingerprint(r["text"])) for r in docs.collect()]
    parts = plain_components(rows)
    ids = sorted((r["doc_id"] for r in kept.collect()), key=repr)
    assert ids == sorted((least for _, least in set(parts)), key=repr)


def test_no_documents(spark):
    none = texts(spark, [])
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.drop_near_duplicates(none).columns == ["doc_id", "text"]


def test_chains_join(spark):
    from ledgermart.llm.common import components

    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000 + i, 1000) for i in range(1, 50)], "a long, b long")
    roots = dict(collected(components(spark, links, "a", "b"), "node", "root"))
    assert len({roots[i] for i in range(201)}) == 1
    assert len({roots[i] for i in range(1000, 1050)}) == 1
    assert roots[0] != roots[1000]
