import hashlib
import random

import pytest
from helpers import clashing, collected, frame, texts

from ledgermart.llm import substring_dedup
from ledgermart.llm.common import read


def plain(rows, window=20):
    """Of rows in order of doc_id: words, removed words, and the hash of the kept ones."""
    seen, out = set(), []
    for text in rows:
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for j in range(len(words) - window + 1):
            own = b" ".join(words[j : j + window])
            if own in seen:
                gone[j : j + window] = [True] * window
            seen.add(own)
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out.append((len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("sizes", [{}, {"buckets": 50}, {"buckets": 2, "resolve_bytes": 5_000}])
def test_random_passages_equal_brute_force(spark, sizes, monkeypatch):
    monkeypatch.setattr(substring_dedup, "MAX_TASKS", 7)
    rng = random.Random(1)
    words = [f"w{i}" for i in range(30)]
    passages = [[rng.choice(words) for _ in range(rng.randrange(18, 60))] for _ in range(6)]
    rows = []
    for _ in range(80):
        parts = [[rng.choice(words) for _ in range(rng.randrange(30))], rng.choice(passages), [rng.choice(words)] * rng.randrange(30)]
        rng.shuffle(parts)
        rows.append(" ".join(sum(parts, [])))
    got = sorted(collected(substring_dedup.measure(texts(spark, enumerate(rows)).repartition(5), **sizes), "doc_id", "n_words", "n_removed", "kept_sha256"))
    assert got == [(i, *x) for i, x in enumerate(plain(rows))]
    assert sum(x[2] for x in got) > 500


def test_awkward_documents(spark):
    docs = clashing(frame(spark))
    measured = {}
    for r in substring_dedup.measure(docs).collect():
        measured.setdefault(r["doc_id"], []).append((r["n_words"], r["n_removed"]))
    assert measured[1] == [(0, 0)] and measured[2] == [(0, 0)] and measured[3] == [(0, 0)]
    assert sorted(measured[None]) == [(0, 0), (60, 0)]  # the smallest doc_id keeps its text
    assert measured[6] == [(60, 60), (60, 60)]  # repeated rows are one document
    assert measured[17] == [(60, 60)]  # other white space, same words
    assert measured[11] == [(300, 299)]  # all windows but the first repeat it; they cover all but the first word
    assert measured[9][0][1] == 40
    assert measured[13] == [(1, 0)]
    kept = substring_dedup.dedup(docs)
    assert kept.schema == docs.schema and kept.count() == docs.count()
    assert dict(collected(kept, "doc_id", "text"))[1] is None


def test_given_table_equals_brute_force(spark):
    docs = read(spark, "/root/testdata/sf0.001", "documents")
    rows = sorted(collected(docs, "doc_id", "text"))
    got = sorted(collected(substring_dedup.measure(docs), "doc_id", "n_words", "n_removed", "kept_sha256"))
    assert got == [(i, *x) for (i, _), x in zip(rows, plain([t for _, t in rows]))]


def test_no_documents(spark):
    assert substring_dedup.measure(texts(spark, [])).count() == 0


def test_super_kmers_cover_all_windows_once():
    rng = random.Random(2)
    for n in (20, 21, 50, 400):
        words = [rng.choice([b"a", b"b", b"cc"]) for _ in range(n)]
        first, end, _ = substring_dedup.super_kmers(words)
        assert first[0] == 0 and end[-1] == n - 19
        assert (first[1:] == end[:-1]).all() and (end > first).all()


def test_a_passage_of_many_documents_is_dealt_over_all_tasks(spark, monkeypatch):
    """A third of the documents share a passage between differing neighbours: its windows' bucket is hot."""
    rng = random.Random(3)
    pick = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    passage = pick(40)
    rows = [f"{pick(30)} {passage} {pick(30)}" if i % 3 == 0 else pick(100) for i in range(300)]
    docs = texts(spark, enumerate(rows)).repartition(6)
    keyed = docs.selectExpr("doc_id as did", "xxhash64(text) as tie", "text")
    size = sum(map(len, rows))
    hot = substring_dedup.hot_buckets(keyed, 300, size, 64, 20, 4, 6_000)
    assert 0 < len(hot) < 12
    seen = []
    spy = substring_dedup.hot_buckets
    monkeypatch.setattr(substring_dedup, "hot_buckets", lambda *a: seen.append(spy(*a)) or seen[-1])
    for sizes in ({"buckets": 64, "resolve_bytes": 6_000}, {"buckets": 64}):
        got = sorted(collected(substring_dedup.measure(docs, **sizes), "doc_id", "n_words", "n_removed", "kept_sha256"))
        assert got == [(i, *x) for i, x in enumerate(plain(rows))]
    assert len(seen) == 1 and seen[0] == hot  # far below what a task resolves there is no sample


def test_no_sample_of_no_documents(spark):
    none = texts(spark, []).selectExpr("doc_id as did", "xxhash64(text) as tie", "text")
    assert substring_dedup.hot_buckets(none, 0, 0, 5, 20, 4, 100) == set()
