import hashlib
import random
import zlib

import pytest
from helpers import CLASHES
from pyspark.sql import functions as F

from ledgermart.llm import conversation_trie as ct

SCHEMA = "conv_id long, turn long, role string, text string"


def key(role, text):
    return hashlib.sha256(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).digest()[:16]


def plain_rebuilt(rows):
    own = {}
    for conv, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0, key(*r[2:]))):
        own.setdefault(conv, []).append((role or "", text or ""))
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = tuple(own.get(c - (abs(c) % 5) * (1 if c >= 0 else -1), [])[:h] + turns[h:])
    return out


def plain(rows):
    """Every node with its members, by definition."""
    convs = plain_rebuilt(rows)
    members = {}
    for c, path in convs.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    kids = {p: sum(len(q) == len(p) + 1 and q[: len(p)] == p for q in members) for p in members}
    found = []
    for p, own in members.items():
        below = [q for q in members if q[: len(p)] == p]
        ends = ",".join(str(c) for c in sorted(c for c in own if convs[c] == p))
        found.append((
            min(own), len(p), min(members[p[:-1]]) if p else None, len(own), kids[p], sum(kids[q] == 0 for q in below),
            sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(found, key=repr)


def got(spark, rows, **more):
    turns = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("own") for c in CLASHES if c not in ("turn", "text", "role")})
    nodes = ct.trie(ct.branched(ct.paths_of(turns)), **more)
    assert nodes.columns == [f.split()[0] for f in ct.NODES.split(", ")]
    return sorted([tuple(r) for r in nodes.collect()], key=repr)


def made(n, seed):
    """Few different turns, so that many prefixes are shared; some conversations are copies, one is long."""
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for turn in range(rng.randrange(1, 12)):
            rows.append((c * 5 if rng.random() < 0.01 else c, turn, rng.choice(["user", "a"]), rng.choice(["x", "yé"])))
    for c in range(2000, 2040):
        rows += [(c, turn, "user", "same") for turn in range(10)]
    return rows + [(3000, turn, "user", f"t{turn % 3}") for turn in range(300)]


@pytest.mark.parametrize("shards, turns, chars", [(1, 1000, 1 << 20), (4, 1 << 18, 1 << 20), (40, 1 << 18, 20), (25, 50, 1)])
def test_equals_the_definition(spark, shards, turns, chars):
    rows = made(120, 1)
    assert got(spark, rows, shards=shards, skeleton_turns=turns, list_chars=chars) == plain(rows)


def test_nulls_ties_repeated_rows_and_turnless_conversations(spark):
    long = "w " * 200_000
    rows = [
        (None, 1, "user", "lost"), (0, None, None, None), (0, 1, "user", None), (0, 1, None, "b"), (0, 1, "user", "b"), (0, 1, "user", "b"),
        (1, 5, "user", ""), (2, 0, "user", long), (3, 0, "user", long), (7, None, "a", "b"), (7, None, "a", "b"), (-3, 0, "user", "x"), (-5, 1, "u", "x"),
    ]
    rows += [(c, 0, "user", "only") for c in range(100, 140)]
    assert any(not path for path in plain_rebuilt(rows).values())
    assert got(spark, rows) == plain(rows)


def test_no_conversations_no_nodes(spark):
    assert got(spark, []) == [] and got(spark, [(None, 1, "user", "x")]) == []


def test_a_role_is_not_part_of_the_text(spark):
    rows = [(0, 0, "ab", "c"), (5, 0, "a", "bc"), (10, 0, "", "abc")]
    assert got(spark, rows) == plain(rows)


def test_skeleton_is_bounded(spark):
    rows = made(120, 2)
    paths = ct.branched(ct.paths_of(spark.createDataFrame(rows, SCHEMA)))
    flat = paths.select("conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["key"])), "")).alias("path"))
    tree = ct.skeleton_of(flat, flat.count(), 20, turns=100)
    assert 10 < len(tree.splitters) < 20 and len(tree.parent) <= 101 and max(tree.depth) <= 5


def test_copies_are_cut_between_shards(spark):
    rows = [(c, turn, "user", f"{turn}") for c in range(0, 2000, 5) for turn in range(9)]
    flat = ct.branched(ct.paths_of(spark.createDataFrame(rows, SCHEMA))).select("conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["key"])), "")).alias("path"))
    tree = ct.skeleton_of(flat, flat.count(), 8)
    sizes = {}
    for r in flat.collect():
        at = tree.shard(bytes(r["path"]), r["conv_id"])
        sizes[at] = sizes.get(at, 0) + 1
    assert len(sizes) == 8 and max(sizes.values()) < 150
    assert got(spark, rows, shards=8) == plain(rows)
