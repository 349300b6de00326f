import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from helpers import clashing, collected, frame, texts
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgermart.llm import packing

OWN = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def plain_ids(text):
    return [*OWN.encode(text or "", add_special_tokens=False).ids, 0]


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_ranks_give_the_tokenizers_ids(text):
    assert packing.token_ids(text).tolist() == plain_ids(text)[:-1]


@pytest.mark.parametrize("text", ["a<|endoftext|>b <|endoftext|>", " " * 700_000, "ab" * 40_000, "1" * 9_999, "\r\n\t " * 500, "'S 'll don'T"])
def test_odd_texts_give_the_tokenizers_ids(text):
    assert packing.token_ids(text).tolist() == plain_ids(text)[:-1]


def check(rows, documents, capacity):
    """Layout and contents of packed rows (doc_id, piece, start, length, ids_crc32, sequence_id, offset)."""
    by_sequence, by_doc = {}, {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["doc_id"], []).append(r)
    for parts in by_sequence.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    for doc, ids in documents.items():
        own = sorted(by_doc[doc], key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own)))
        assert own[0]["length"] == (len(ids) % capacity or capacity if len(ids) > capacity else len(ids))
        assert all(r["length"] == capacity for r in own[1:])
        for r in own:
            part = np.array(ids[r["start"] : r["start"] + r["length"]], dtype="<u4")
            assert len(part) == r["length"] and zlib.crc32(part.tobytes()) == r["ids_crc32"]
    return len(by_sequence)


def test_given_table(spark):
    from ledgermart.llm.common import read

    docs = read(spark, "/root/testdata/sf0.001", "documents")
    documents = {i: plain_ids(t) for i, t in collected(docs, "doc_id", "text")}
    rows = packing.pack(docs).collect()
    assert {r["doc_id"] for r in rows} == documents.keys()
    used = check(rows, documents, 2048)
    assert used <= -(-sum(map(len, documents.values())) // 2048) + 1


def test_awkward_documents(spark):
    docs = clashing(frame(spark)).filter("doc_id is not null and doc_id not in (6, 7)")
    documents = {i: plain_ids(t) for i, t in collected(docs, "doc_id", "text")}
    check(packing.pack(docs, capacity=64).collect(), documents, 64)
    whole = packing.pack(clashing(frame(spark)))
    assert whole.filter("doc_id = 6").count() == 2 and whole.filter("doc_id is null").count() == 2
    assert packing.pack(texts(spark, [])).count() == 0


def test_sequences_hold_the_ids(spark):
    docs = texts(spark, [(i, "word " * (i * 7 % 90)) for i in range(60)])
    ids = {i: plain_ids(t) for i, t in collected(docs, "doc_id", "text")}
    found = packing.sequences(docs, capacity=128).collect()
    for r in found:
        assert len(r["ids"]) <= 128
        for doc, a, b in zip(r["doc_ids"], r["offsets"], [*r["offsets"][1:], len(r["ids"])]):
            assert r["ids"][a:b] == ids[doc]
    assert sorted(d for r in found for d in r["doc_ids"]) == list(range(60))


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 50), max_size=40))
def test_plans_use_every_piece_once(counts):
    patterns = packing.plan(counts, 40)
    used = {}
    for pattern, n in patterns:
        assert n > 0 and sum(pattern) <= 40
        for length in pattern:
            used[length] = used.get(length, 0) + n
    assert used == counts
    keys, first, offsets = packing.segments(patterns, 40)
    assert len(keys) == sum(len(p) for p, _ in patterns)


def test_exact_fills_come_first():
    assert packing.plan({60: 2, 40: 2}, 100) == [((60, 40), 2)]
    assert packing.plan({50: 1, 30: 1, 20: 1}, 100) == [((50, 20, 30), 1)]
    assert sorted(packing.plan({40: 1, 30: 1, 20: 1, 10: 1}, 100)[0][0]) == [10, 20, 30, 40]
    rng = random.Random(9)
    counts = {n: rng.randrange(1, 300) for n in range(1, 2049)}
    least = max(-(-sum(length * n for length, n in counts.items()) // 2048), sum(n for length, n in counts.items() if length > 1024))
    assert sum(n for _, n in packing.plan(counts)) <= 1.02 * least


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(0, 4), max_size=30), st.lists(st.tuples(st.integers(1, 30), st.integers(-3, 3)), max_size=25))
def test_index_has_the_sums_of_what_is_there(counts, changes):
    own = np.zeros(41, dtype=np.int64)
    for length, n in counts.items():
        own[length] = n
    sums = packing.Sums(own)
    for length, by in changes:
        if own[length] + by >= 0:
            sums.change(length, by)
    there = [n for n in range(41) if own[n]]
    pairs = [(a, b) for a in there for b in there if a < b or a == b and own[a] >= 2]
    for total in range(1, 41):
        assert sums.pairs[total] == sum(a + b == total for a, b in pairs), total
        fits = lambda found, size: found is None or len(found) == size and sum(found) == total and all(own[x] >= found.count(x) for x in found)
        two, three = sums.pair(total), sums.triple(total)
        assert fits(two, 2) and (two is None) == (sums.pairs[total] == 0)
        triples = [(a, b, c) for a, b in pairs for c in there if a + b + c == total and own[c] >= 1 + (a, b).count(c)]
        assert fits(three, 3) and (three is None) == (not triples)
        assert sums.fill(total, 1) == ((total,) if own[total] else None)
