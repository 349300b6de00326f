import hashlib
import random
import re
import struct

import xxhash
from helpers import clashing, collected, frame, texts

from ledgermart.llm import fingerprint

COLUMNS = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def edits(rows):
    """n_chars and the hash of the edited text, of texts in order."""
    out = []
    for text, after in zip(rows, rows[1:] + rows[:1]):
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + after[:quarter]
        out.append((len(text), hashlib.sha256(edited.encode()).hexdigest()))
    return out


def likeness(a, b):
    """From written fingerprints: equal ten-digit tuples among the slots that either has."""
    a, b = ({x[i : i + 10] for i in range(0, len(x), 10)} for x in (a, b))
    used = {t[:2] for t in a | b}
    return len(a & b) / len(used) if used else 1.0


def test_awkward_documents(spark):
    docs = clashing(frame(spark))
    ordered = sorted(collected(docs, "doc_id", "text"), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want = edits([t or "" for _, t in ordered])
    for size in (3, 128):
        found = fingerprint.with_neighbours(docs, bucket_docs=size).collect()
        assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in found), key=repr) == sorted(((i, *w) for (i, _), w in zip(ordered, want)), key=repr)
    empty = [r for r in found if r["doc_id"] in (2, 3)]
    assert all(r["fingerprint"] == "" for r in empty)


def test_results_do_not_depend_on_buckets(spark):
    rng = random.Random(13)
    docs = texts(spark, [(i * 3, " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(60)))) for i in range(150)]).repartition(5)
    whole = sorted(collected(fingerprint.with_neighbours(docs, bucket_docs=1000), *COLUMNS))
    assert sorted(collected(fingerprint.with_neighbours(docs, bucket_docs=7), *COLUMNS)) == whole
    for row, after in zip(whole, whole[1:] + whole[:1]):
        assert abs(row[5] - likeness(row[3], row[4])) < 1e-12
        assert abs(row[6] - likeness(row[3], after[3])) < 1e-12


def test_likeness_falls_with_edits_and_sees_order(spark):
    rng = random.Random(14)
    words = [f"w{rng.randrange(10**6)}" for _ in range(1000)]
    halves = words[500:] + words[:500]
    shuffled = rng.sample([words[i : i + 3] for i in range(0, 999, 3)], 333)
    few = [w if i % 50 else "edit" for i, w in enumerate(words)]
    many = [w if i % 8 else "edit" for i, w in enumerate(words)]
    variants = [words, words, few, many, halves, sum(shuffled, []), [f"z{i}" for i in range(1000)]]
    rows = []
    for i, v in enumerate(variants):
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(v))]
    near = dict(collected(fingerprint.with_neighbours(texts(spark, rows)), "doc_id", "near_next"))
    same, _, a_few, a_lot, swapped, mixed, other = (near[2 * i] for i in range(7))
    assert same == 1 and other == 0
    assert 1 > a_few > a_lot > 0
    assert a_few > swapped > mixed  # the same words in another order


def test_repeats_count(spark):
    docs = texts(spark, [(1, "a b c " * 10), (2, "a b c " * 60)])
    prints = dict(collected(fingerprint.with_neighbours(docs), "doc_id", "fingerprint"))
    assert prints[1] != prints[2]


def test_equal_texts_have_equal_fingerprints_and_single_rows_follow_themselves(spark):
    docs = texts(spark, [(1, "x y z w"), (2, "x y z w"), (9, "x  y\nz w")])
    found = {r["doc_id"]: r for r in fingerprint.with_neighbours(docs).collect()}
    assert len({r["fingerprint"] for r in found.values()}) == 1 and found[1]["near_next"] == 1
    row = fingerprint.with_neighbours(texts(spark, [(5, "one two three four five")])).first()
    assert row["near_next"] == 1 and row["n_chars"] == 23
    assert fingerprint.with_neighbours(texts(spark, [])).count() == 0


def test_main_path_has_no_python(spark):
    plan = fingerprint.with_neighbours(frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def chained(values, kind):
    """Spark's hash of several values: each is hashed with the hash before it as seed."""
    seed = 42
    for v in values:
        data = v.encode() if kind == "text" else struct.pack("<q", v)
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def plain_print(text, slots=64, lanes=2):
    """Order MinHash by its definition: numbered k-mers, the least of each lane of a slot, hashed in text order."""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    grams = [signed(chained(words[i : i + 3], "text")) for i in range(len(words) - 2)]
    if 0 < len(words) < 3:
        grams = [signed(chained([" ".join(words)], "text"))]
    seen, least = {}, {}
    for place, g in enumerate(grams):
        seen[g] = seen.get(g, 0) + 1
        h = signed(xxhash.xxh64_intdigest(struct.pack("<i", seen[g]), xxhash.xxh64_intdigest(struct.pack("<q", g), 42)))
        at = (h % slots, (h >> 8) % lanes)
        least[at] = min(least.get(at, (1 << 64, 0)), (h, place))
    out = []
    for slot in sorted({s for s, _ in least}):
        own = sorted((place, h) for (s, _), (h, place) in least.items() if s == slot)
        out.append(f"{slot:02x}{chained([h for _, h in own], 'long') & 0xFFFFFFFF:08x}")
    return "".join(out)


def test_tuples_equal_the_definition(spark):
    rng = random.Random(15)
    made = ["", "one", "one two", "a b c", "é 日本 😀 é 日本 😀", "loop " * 400] + [" ".join(rng.choice(["x", "y", "z", f"w{rng.randrange(90)}"]) for _ in range(n)) for n in (3, 10, 70, 300, 2_000)]
    got = dict(collected(fingerprint.with_neighbours(texts(spark, enumerate(made))), "doc_id", "fingerprint"))
    assert got == {i: plain_print(t) for i, t in enumerate(made)}


def test_likeness_follows_edit_distance(spark):
    """The estimator's error: likeness beside the share of k-mers that edits leave, over texts of several lengths."""
    rng = random.Random(16)
    rows, kept = [], []
    for i in range(240):
        n = rng.choice([60, 200, 800])
        words = [f"w{rng.randrange(10**6)}" for _ in range(n)]
        share = rng.choice([0, 0.02, 0.05, 0.1, 0.2])
        changed = [w if rng.random() >= share else f"e{rng.randrange(10**6)}" for w in words]
        same = sum(words[j : j + 3] == changed[j : j + 3] for j in range(n - 2)) / (n - 2)
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(changed))]
        kept.append(same)
    near = dict(collected(fingerprint.with_neighbours(texts(spark, rows)), "doc_id", "near_next"))
    got = [near[2 * i] for i in range(240)]
    # two lanes' k-mers must both be left; a replaced one also takes places of others
    expected = [((k / (2 - k)) ** 2) for k in kept]
    errors = [abs(a - b) for a, b in zip(got, expected)]
    assert sum(errors) / len(errors) < 0.08 and sorted(errors)[int(0.95 * len(errors))] < 0.25
