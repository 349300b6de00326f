import hashlib
import pickle
import random
import re

import pytest
from helpers import clashing, collected, frame, texts

from ledgermart.llm import decontaminate
from ledgermart.llm.queries import ORACLES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(items, text):
    """n_words, n_hit, n_items, items_sha256, contaminated; every window against every place."""
    windows = {}
    for item, t in items:
        words = plain_words(t)
        size = min(13, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            windows.setdefault(tuple(words[i : i + size]), set()).add(str(item))
    words = plain_words(text)
    hit, found = [False] * len(words), set()
    for size in {len(w) for w in windows}:
        for i in range(len(words) - size + 1):
            own = windows.get(tuple(words[i : i + size]))
            if own:
                found |= own
                hit[i : i + size] = [True] * size
    n = sum(hit)
    return len(words), n, len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), n > 0 and 20 * n >= len(words)


COLUMNS = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@pytest.mark.parametrize("block_words", [50, 200_000])
def test_random_items_equal_brute_force(spark, block_words):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(12)] + ["É", "日本"]
    pick = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, pick(rng.choice([1, 2, 5, 12, 13, 14, 30]))) for i in range(3, 20)] + [(20, None), (21, ""), (22, "!!"), (None, pick(3))]
    long = [t for i, t in items if t and len(t.split()) > 12]
    docs = [f"{pick(rng.randrange(40))}. {rng.choice(long).upper()[rng.randrange(9):]} - {pick(rng.randrange(200))}" for _ in range(60)]
    docs = [d.replace("w", "unknown w") if i % 3 else d for i, d in enumerate(docs)]
    found = decontaminate.judge(texts(spark, enumerate(docs)), spark.createDataFrame(items, "item_id long, text string"), block_words=block_words)
    known = [(i, t) for i, t in items if i is not None]
    assert sorted(collected(found, "doc_id", *COLUMNS)) == [(i, *plain(known, d)) for i, d in enumerate(docs)]


def test_shared_windows_name_all_their_items(spark):
    same = " ".join(f"x{i}" for i in range(15))
    items = spark.createDataFrame([(10, same), (9, same), (2, f"y {same}"), (9, same)], "item_id long, text string")
    row = decontaminate.judge(texts(spark, [(1, f"a {same} b")]), items).first()
    assert row["items_sha256"] == hashlib.sha256(b"10,2,9").hexdigest()
    assert (row["n_hit"], row["longest_match"]) == (15, 15)


def test_awkward_documents(spark):
    docs = clashing(frame(spark))
    items = spark.createDataFrame([(1, " ".join(f"i{n}" for n in range(20)))], "item_id long, text string")
    assert decontaminate.judge(docs, items).count() == docs.count()
    kept = decontaminate.decontaminate(docs, items)
    assert kept.schema == docs.schema
    assert sorted(collected(kept, "doc_id", "text"), key=repr) == sorted(collected(docs, "doc_id", "text"), key=repr)


def test_spans_are_cut_below_the_limit_and_documents_go_above(spark):
    passage = "Alpha, beta gamma! delta é1 zeta eta theta iota kappa lambda mu nu xi"
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")
    filler = " ".join(f"clean{i}" for i in range(400))
    docs = texts(spark, [(1, f"{filler}\n {passage.upper()}. end"), (2, f"short {passage} text"), (3, filler), (4, None)])
    kept = dict(collected(decontaminate.decontaminate(docs, items), "doc_id", "text"))
    assert kept.keys() == {1, 3, 4}
    assert "BETA" in docs.filter("doc_id = 1").first()["text"] and kept[3] == filler and kept[4] is None
    assert kept[1].startswith(filler) and "BETA" in kept[1]  # É is another letter than é: 14 words with a foreign one


def test_cut_leaves_the_rest_as_it_was(spark):
    passage = " ".join(f"p{i}" for i in range(14))
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")
    filler = " ".join(f"Ünï{i}" for i in range(300))
    kept = decontaminate.decontaminate(texts(spark, [(1, f"{filler}, {passage}! x")]), items).first()["text"]
    assert kept == f"{filler}, ! x"


def test_no_items_and_no_documents(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert collected(decontaminate.judge(texts(spark, [(1, "a b")]), none), "n_hit", "contaminated") == [(0, False)]
    assert decontaminate.judge(texts(spark, []), none).count() == 0


@pytest.mark.parametrize("block_words", [15, 200_000])
def test_items_without_id_are_hits_as_in_the_query(spark, block_words):
    duck = pytest.importorskip("duckdb").connect()
    passage = lambda p, n: " ".join(f"{p}{i}" for i in range(n))
    items = [(None, passage("a", 14)), (None, passage("b", 13)), (7, passage("c", 15)), (None, "d0 d1"), (None, "!")]
    docs = [(1, passage("a", 14)), (2, f"x {passage('c', 15)} {passage('b', 13)} d0 d1"), (3, passage("c", 15)), (4, "d0 d2"), (5, None)]
    docs.append((6, f"{passage('clean', 400)} {passage('b', 13)}"))
    for table, names, rows in (("documents", "doc_id bigint, text varchar", docs), ("benchmark", "item_id bigint, text varchar", items)):
        duck.execute(f"create table {table} ({names})")
        duck.executemany(f"insert into {table} values (?, ?)", rows)
    want = duck.execute(f"select doc_id, {', '.join(COLUMNS)} from ({ORACLES['op10_decontamination']})").fetchall()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.judge(texts(spark, docs), benchmark, block_words=block_words)
    assert sorted(collected(found, "doc_id", *COLUMNS)) == sorted(want)
    assert [r[2:4] for r in sorted(want)] == [(14, 1), (30, 2), (15, 1), (0, 0), (0, 0), (13, 1)]
    kept = dict(collected(decontaminate.decontaminate(texts(spark, docs), benchmark, block_words=block_words), "doc_id", "text"))
    assert kept == {4: "d0 d2", 5: None, 6: passage("clean", 400) + " "}


def test_blocks_are_numbered_by_running_word_counts(spark):
    items = spark.createDataFrame([(i, " ".join(f"w{i}x{j}" for j in range(i % 7))) for i in range(60)] + [(100, "big " * 90)], "item_id long, text string")
    blocks = decontaminate.item_blocks(items, block_words=30).collect()
    made = [decontaminate.Automaton.of(pickle.loads(bytes(b["automaton"]))) for b in blocks]
    assert len(blocks) == len({b["block"] for b in blocks}) >= 6
    assert sum(len(m.ids) for m in made) == sum(i % 7 for i in range(60)) + 1
    assert all(len(m.ids) <= 30 + 90 for m in made)
    assert decontaminate.item_blocks(items.filter("item_id % 7 = 0 and item_id < 100")).count() == 0


def test_several_blocks_keep_rows_columns_and_cuts(spark):
    passages = [" ".join(f"p{k}x{i}" for i in range(20)) for k in range(6)]
    items = spark.createDataFrame(list(enumerate(passages)), "item_id long, text string")
    filler = " ".join(f"clean{i}" for i in range(900))
    docs = clashing(texts(spark, [(1, f"{passages[0]} {filler}, {passages[4]}!"), (1, f"{passages[0]} {filler}, {passages[4]}!"), (2, None), (3, passages[2]), (None, filler)]))
    kept = decontaminate.decontaminate(docs, items, block_words=25)
    assert kept.dtypes == docs.dtypes
    assert sorted(collected(kept, "doc_id", "text"), key=repr) == sorted([(1, f" {filler}, !")] * 2 + [(2, None), (None, filler)], key=repr)
