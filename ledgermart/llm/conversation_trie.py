"""Prefix trie of conversations by range partitioning and a skeleton of the splitters' paths.

A conversation is a path of turns from the root. Paths are brought into order and cut
into shards at splitters. The members of a node are consecutive in that order, so a
node that lies in more than one shard is a prefix of a splitter's path. The trie of
those paths, the skeleton, is broadcast; its size is bounded. Each shard finishes all
other nodes of its sorted paths by itself, with a stack as deep as the longest path, and
sends one partial row for each skeleton node it meets. Partial rows are summed, and the
sums are carried up the skeleton.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermart.llm.common import written

#: Bytes of a turn's key: equal keys, equal role and text.
KEY = 16
#: Conversations of a shard (about), the most shards, and the most turns of all splitters together.
SHARD_ROWS = 50_000
MAX_SHARDS = 4096
SKELETON_TURNS = 1 << 18
#: Sampled paths for each splitter.
OVERSAMPLE = 8
#: Characters of a list of ids that travels as one row.
LIST_CHARS = 1 << 20

NODES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_SHARD_ROWS = f"{NODES}, skeleton long, parent_skeleton long, turn_bytes long, ends string, ends_at long"
#: Of an empty list.
NO_ENDS = hashlib.sha256(b"").hexdigest()


# -- conversations as paths ----------------------------------------------------


def paths_of(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns): an array of (key, bytes) in the order of turn, null first.

    A null role or text is empty. Turns of one number, repeated rows among them, all count; they are
    in the order of their keys. Rows without conv_id belong to no conversation and are left out.
    """
    said = [F.coalesce(turns[c].cast("string"), F.lit("")) for c in (role, text)]
    key = F.substring(F.unhex(F.sha2(F.concat(F.octet_length(said[0]).cast("string"), F.lit(":"), *said), 256)), 1, KEY)
    each = turns.select(turns[conv_id].cast("long").alias("conv_id"), F.struct(turns[turn].alias("turn"), key.alias("key"), F.octet_length(said[1]).cast("long").alias("bytes")).alias("t"))
    listed = each.filter("conv_id is not null").groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    return listed.select("conv_id", F.transform("turns", lambda t: F.struct(t["key"].alias("key"), t["bytes"].alias("bytes"))).alias("turns"))


def branched(paths: DataFrame, every: int = 5, spread: int = 9) -> DataFrame:
    """Conversations rebuilt as branches: h turns of the first of ``every``, then the own turns after h.

    h = crc32 of the decimal conv_id, modulo ``spread``. Without a first conversation
    there are none of its turns; of fewer than h all are taken.
    """
    paths = written(paths, "conversations")
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(spread)).cast("int")
    own = paths.select("conv_id", "turns", (F.col("conv_id") - F.col("conv_id") % every).alias("base"), h.alias("h"))
    heads = paths.select(F.col("conv_id").alias("base"), F.slice("turns", 1, max(1, spread - 1)).alias("head"))
    head = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    rest = F.slice("turns", F.col("h") + 1, F.size("turns"))
    return own.join(heads, "base", "left").select("conv_id", F.concat(head, rest).alias("turns"))


# -- splitters and skeleton ----------------------------------------------------


@dataclass
class Skeleton:
    """The trie of the splitters' paths; node 0 is the root, and children come after their parent."""

    splitters: list[tuple[bytes, int]] = field(default_factory=list)
    children: list[dict[bytes, int]] = field(default_factory=lambda: [{}])
    parent: list[int] = field(default_factory=lambda: [-1])
    depth: list[int] = field(default_factory=lambda: [0])

    def add(self, path: bytes) -> None:
        at = 0
        for i in range(0, len(path), KEY):
            key = path[i : i + KEY]
            if key not in self.children[at]:
                self.children[at][key] = len(self.parent)
                self.children.append({})
                self.parent.append(at)
                self.depth.append(self.depth[at] + 1)
            at = self.children[at][key]

    def shard(self, path: bytes, conv_id: int) -> int:
        return bisect_right(self.splitters, (path, conv_id))


def skeleton_of(paths: DataFrame, rows: int, shards: int, turns: int = SKELETON_TURNS) -> Skeleton:
    """Splitters that cut the ``rows`` of ``paths`` (path, conv_id) into about equal shards; results don't depend on them.

    They come from a sample of about OVERSAMPLE * ``shards`` paths, each cut to ``turns`` // ``shards``
    turns, so what reaches the driver and what is broadcast is bounded.
    """
    out = Skeleton()
    if shards < 2 or not rows:
        return out
    wanted, longest = OVERSAMPLE * shards, max(1, turns // shards)
    drawn = paths.filter(F.pmod(F.xxhash64(F.lit(shards), "conv_id"), F.lit(rows)) < wanted).limit(2 * wanted)
    sample = drawn.select(F.substring("path", 1, KEY * longest).alias("path"), "conv_id").toArrow()
    places = sorted(zip(sample["path"].to_pylist(), sample["conv_id"].to_pylist()))
    if places:
        out.splitters = sorted({places[i * len(places) // shards] for i in range(1, shards)})
    for path, _ in out.splitters:
        out.add(path)
    return out


# -- one shard -----------------------------------------------------------------


class _Open:
    """A node whose members are still coming."""

    __slots__ = ("key", "size", "least", "n", "kids", "leaves", "saved", "ends", "held", "skeleton", "sent")

    def __init__(self, key: bytes, size: int, skeleton: int | None):
        self.key, self.size, self.skeleton = key, size, skeleton
        self.least, self.n, self.kids, self.leaves, self.saved = None, 0, 0, 0, 0
        self.ends = None  # a hash, or for a skeleton node the ids not yet sent
        self.held: list[list] = []  # finished children, which wait for this node's least member
        self.sent = 0


class _Shard:
    """Sorted paths of one shard in, finished nodes and partial rows out."""

    def __init__(self, skeleton: Skeleton, number: int, list_chars: int):
        self.tree, self.number, self.list_chars = skeleton, number, list_chars
        self.stack = [_Open(b"", 0, 0)]
        self.path = b""
        self.out: list[list] = []

    def add(self, conv_id: int, path: bytes, sizes: list[int]) -> None:
        same = 0
        while same < len(path) and path[same : same + KEY] == self.path[same : same + KEY]:
            same += KEY
        self.close(same // KEY)
        for i in range(same, len(path), KEY):
            key, above = path[i : i + KEY], self.stack[-1].skeleton
            inside = None if above is None else self.tree.children[above].get(key)
            self.stack.append(_Open(key, sizes[i // KEY], inside))
        self.path = path
        for node in self.stack:
            node.n += 1
            node.least = conv_id if node.least is None or conv_id < node.least else node.least
        self._end(self.stack[-1], conv_id)

    def _end(self, node: _Open, conv_id: int) -> None:
        text = str(conv_id)
        if node.skeleton is None:
            if node.ends is None:
                node.ends = hashlib.sha256(text.encode())
            else:
                node.ends.update(b"," + text.encode())
            return
        node.ends = text if node.ends is None else f"{node.ends},{text}"
        if len(node.ends) >= self.list_chars:
            self._send_ends(node)

    def _send_ends(self, node: _Open) -> None:
        self.out.append([None] * 8 + [node.skeleton, None, None, node.ends, (self.number << 32) + node.sent])
        node.ends, node.sent = None, node.sent + 1

    def close(self, depth: int) -> None:
        """Finishes the open nodes below ``depth``."""
        while len(self.stack) > depth + 1:
            node = self.stack.pop()
            above, at = self.stack[-1], len(self.stack)
            if node.skeleton is not None:
                self._partial(node)
                continue
            leaves = node.leaves if node.kids else 1
            saved = node.saved + (node.n - 1) * node.size
            ends = NO_ENDS if node.ends is None else node.ends.hexdigest()
            for row in node.held:
                row[2] = node.least
            self.out += node.held
            row = [node.least, at, None, node.n, node.kids, leaves, saved, ends, None, above.skeleton, None, None, None]
            above.kids, above.leaves, above.saved = above.kids + 1, above.leaves + leaves, above.saved + saved
            (above.held if above.skeleton is None else self.out).append(row)

    def _partial(self, node: _Open) -> None:
        if node.ends is not None:
            self._send_ends(node)
        if node.n:
            self.out.append([node.least, None, None, node.n, node.kids, node.leaves, node.saved, None, node.skeleton, None, node.size, None, None])

    def finish(self) -> None:
        self.close(0)
        self._partial(self.stack.pop())

    def taken(self) -> pa.RecordBatch:
        rows, self.out = self.out, []
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _TYPES)], names=_NAMES)


_NAMES = [f.split()[0] for f in _SHARD_ROWS.split(", ")]
_TYPES = [pa.string() if f.split()[1] == "string" else pa.int64() for f in _SHARD_ROWS.split(", ")]


# -- the trie ------------------------------------------------------------------


def trie(paths: DataFrame, shards: int | None = None, skeleton_turns: int = SKELETON_TURNS, list_chars: int = LIST_CHARS) -> DataFrame:
    """One row per node of the trie of ``paths`` (conv_id, turns): see NODES.

    conv_id is the node's smallest member, parent_conv_id its parent's (null for the root);
    n_convs counts members, n_leaves the childless nodes of the subtree, itself
    included; saved_tokens sums (n_convs - 1) * bytes of the last text over the subtree;
    ends_sha256 is of the sorted ids of the members that end here. Without
    conversations there are no nodes, not even the root. A conversation's keys and byte
    counts, not its texts, are held as one value. The ids that end at a node are hashed one after
    another, as the hash has it; those of a skeleton node stream through one task as long strings.
    """
    spark = paths.sparkSession
    joined = F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["key"])), ""))
    flat = written(paths.select("conv_id", joined.alias("path"), F.transform("turns", lambda t: t["bytes"]).alias("sizes")), "paths")
    rows = flat.count()
    if shards is None:
        shards = min(MAX_SHARDS, max(spark.sparkContext.defaultParallelism, -(-rows // SHARD_ROWS)))
    tree = skeleton_of(flat.select("path", "conv_id"), rows, shards, skeleton_turns)
    shared = spark.sparkContext.broadcast(tree)

    @F.pandas_udf("int")
    def shard_of(path: pd.Series, conv_id: pd.Series) -> pd.Series:
        return pd.Series([shared.value.shard(p, c) for p, c in zip(path, conv_id)], dtype="int32")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = None
        for batch in batches:
            for number, conv_id, path, sizes in zip(*(c.to_pylist() for c in batch.columns)):
                if at is None or at.number != number:
                    if at is not None:
                        at.finish()
                        yield at.taken()
                    at = _Shard(shared.value, number, list_chars)
                at.add(conv_id, path, sizes)
                if len(at.out) > 10_000:
                    yield at.taken()
        if at is not None:
            at.finish()
            yield at.taken()

    dealt = flat.withColumn("shard", shard_of("path", "conv_id")).repartitionById(len(tree.splitters) + 1, F.col("shard"))
    ordered = dealt.sortWithinPartitions("shard", "path", "conv_id").select("shard", "conv_id", "path", "sizes")
    found = written(ordered.mapInArrow(work, _SHARD_ROWS), "trie-shards")
    return _joined(found, tree)


def _joined(found: DataFrame, tree: Skeleton) -> DataFrame:
    """Finished nodes with the parent's member, and the skeleton's nodes from their partial rows."""
    spark = found.sparkSession
    names = [f.split()[0] for f in NODES.split(", ")]
    top = _carried_up(found, tree)
    ends = _ends(found)
    nodes = spark.createDataFrame(top, "skeleton long, " + NODES.replace(", ends_sha256 string", ""))
    nodes = nodes.join(ends, "skeleton", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS)))
    least = F.broadcast(nodes.select(F.col("skeleton").alias("parent_skeleton"), F.col("conv_id").alias("above")))  # at most SKELETON_TURNS + 1 rows
    done = found.filter("skeleton is null").join(least, "parent_skeleton", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
    return done.select(*names).unionByName(nodes.select(*names))


def _carried_up(found: DataFrame, tree: Skeleton) -> list[tuple]:
    """The skeleton's nodes; partial rows are summed by Spark, and at most one row for each node comes here."""
    total = lambda c: F.sum(c).alias(c)
    partial = found.filter("skeleton is not null and n_convs is not null").groupBy("skeleton")
    summed = partial.agg(F.min("conv_id").alias("conv_id"), *map(total, ("n_convs", "n_children", "n_leaves", "saved_tokens")), F.max("turn_bytes").alias("size"))
    rows = {r["skeleton"]: r.asDict() for r in summed.collect()}
    for at in sorted(rows, reverse=True):  # children before their parent
        r = rows[at]
        r["n_leaves"] = r["n_leaves"] if r["n_children"] else 1
        r["saved_tokens"] += (r["n_convs"] - 1) * r["size"]
        if at:
            above = rows[tree.parent[at]]
            above["n_children"] += 1
            above["n_leaves"] += r["n_leaves"]
            above["saved_tokens"] += r["saved_tokens"]
    parent = lambda at: rows[tree.parent[at]]["conv_id"] if at else None
    return [(at, r["conv_id"], tree.depth[at], parent(at), r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"]) for at, r in rows.items()]


def _ends(found: DataFrame) -> DataFrame:
    """(skeleton, ends_sha256): lists of ids that lie in several shards, hashed in order as they stream by."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own = None, None
        done: list[tuple[int, str]] = []
        for batch in batches:
            for skeleton, ends in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if skeleton != at:
                    if own:
                        done.append((at, own.hexdigest()))
                    at, own = skeleton, hashlib.sha256(ends.encode())
                else:
                    own.update(b"," + ends.encode())
        if own:
            done.append((at, own.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.string())], names=["skeleton", "ends_sha256"])

    lists = found.filter("ends is not null").select("skeleton", "ends", "ends_at").repartition("skeleton").sortWithinPartitions("skeleton", "ends_at")
    return lists.select("skeleton", "ends").mapInArrow(work, "skeleton long, ends_sha256 string")
