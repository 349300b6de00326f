import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import clashing, collected, frame

from ledgermart.llm import divergence

COLUMNS = ("lang", "source", "part", "item", "value", "rank")


def plain(rows, min_docs, top=10):
    """The whole matrix, cell by cell."""
    upper = {c: c + 32 for c in range(65, 91)}
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(upper))) for _, text, lang, source, _ in rows]
    found = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        holds = Counter(t for _, _, words in own for t in set(words))
        kept = [t for t, n in holds.items() if n >= min_docs]
        counts = defaultdict(Counter)
        for _, source, words in own:
            counts[source].update(w for w in words if holds[w] >= min_docs)
        chance = lambda n: {t: 1 + 10**9 * (n[t] + 2) // (sum(n.values()) + 2 * len(kept)) for t in kept}
        p = {s: chance(n) for s, n in counts.items()}
        q = chance(sum(counts.values(), Counter()))
        f = lambda x, y: (x - y) ** 2 // (x + y)
        for s in p:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in p if o != s]
            terms = [(f(p[s][t], q[t]), t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                items = sorted(items, key=lambda x: (-x[0], x[1].encode()))[: top if part == "term" else None]
                found += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(items)]
    return sorted(found)


def made(n, seed, sources=7):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("Al", "be", "cé", "日") for b in ("x", "y", "zz", "Ω", "q", "w")]
    text = lambda own: " 1,".join(rng.choice(words[own % 9 :]) for _ in range(rng.randrange(40)))
    return [(i, text(i % sources), rng.choice(["en", "de"]), f"s{i % sources}", None) for i in range(n)]


@pytest.mark.parametrize("strip, band", [(4096, 128), (5, 2), (1, 1)])
def test_equals_the_whole_matrix(spark, strip, band):
    rows = made(200, 1) + [(900, "none of these words", "en", "alone", None), (901, None, "xx", "a", None), (902, "", "xx", "b", None)]
    got = collected(divergence.audit(frame(spark, rows), strip_terms=strip, band_groups=band), *COLUMNS)
    assert sorted(got) == plain(rows, 10)


def test_bands_wider_than_a_leaf(spark):
    rows = made(900, 2, sources=45)
    got = collected(divergence.audit(frame(spark, rows), min_docs=3, strip_terms=40, band_groups=20), *COLUMNS)
    assert sorted(got) == plain(rows, 3)


def test_awkward_rows(spark):
    rows = [(i, t, lang, source, n) for lang in ("en", None) for i, t, _, source, n in frame(spark).collect()]
    rows += [(None, "alpha1", None, None, None), (3, "BETA", "", None, None)]
    got = divergence.audit(clashing(frame(spark, rows)), min_docs=2)
    assert got.columns == list(COLUMNS)
    assert sorted(collected(got, *COLUMNS)) == plain(rows, 2)


def test_empty_table_and_no_kept_terms(spark):
    assert divergence.audit(frame(spark, [])).count() == 0
    few = frame(spark, [(1, "a b", "en", "x", 3), (2, "a c", "en", "y", 3)])
    assert sorted(collected(divergence.audit(few), *COLUMNS)) == [("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]


def test_counts_sent_on_early_add_up(spark, monkeypatch):
    rows = made(60, 3)
    batch = frame(spark, rows).select("lang", "source", "text").toArrow().to_batches()
    whole = Counter()
    for b in divergence._count(iter(batch)):
        whole.update({tuple(r.values())[:3]: r["n"] for r in b.to_pylist()})
    monkeypatch.setattr(divergence, "HELD_CELLS", 5)
    parts = Counter()
    for b in divergence._count(iter(batch)):
        parts.update({tuple(r.values())[:3]: r["n"] for r in b.to_pylist()})
    assert parts == whole and len(whole) > 20


def test_counts_beyond_64_bits_stay_exact(spark):
    n = 4 * 10**17
    row = spark.createDataFrame([(n, 5 * 10**17, 7)], "n long, total long, kept long")
    got = row.select(divergence.probability(*(row[c] for c in row.columns))).first()[0]
    assert got == 1 + 10**9 * (n + 2) // (5 * 10**17 + 14)


def test_quadtree_has_the_quadrants_with_cells():
    levels = divergence.quadtree(np.array([0, 17, 40]), np.array([3, 60, 5]), 2)
    assert levels[0] == {0} and len(levels[1]) == 3 and len(levels[2]) == 3
    assert divergence.quadtree(np.array([], dtype=np.int64), np.array([], dtype=np.int64), 1) == [set(), set()]
