import hashlib
import random
import re

from helpers import clashing, collected, frame, texts

from ledgermart.llm import pii
from ledgermart.llm.common import read, written

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(n - 9 * (n > 9) for n in (int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits)))) % 10 == 0


def holds(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def plain_base(text):
    out = []
    for rank, (kind, pattern) in enumerate(BASE.items()):
        out += [(m.start(), rank, m.end(), kind) for m in re.finditer(pattern, text or "", re.ASCII) if holds(kind, m[0])]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


def check_base(found, rows):
    for r in found:
        want = plain_base(rows[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest(), (want, r["spans"])
        own = [s for s in r["spans"].split(",") if s and s.split(":")[0] in BASE]
        assert own == [s for s in want.split(",") if s]
        assert [r[f"n_{k}"] for k in BASE] == [sum(s.startswith(k) for s in own) for k in BASE]


def with_check_digit(digits):
    return next(digits + str(c) for c in range(10) if luhn(digits + str(c)))


def test_base_spans_of_random_texts(spark):
    rng = random.Random(11)
    bits = ["a", "b.c", "@", "x@y.z", ".", "-", "_", "%", "é", "😀", "1", "255", "256", "0.0", "1.2.3.4", "999", " ", "  ", "+", "+1 (", ") 555-", "2028",
            with_check_digit("411111111111111"), with_check_digit("5500 0000 0000 000".replace(" ", "")), "4111 1111-1111 1111", "0007", "\n", "٣"]
    rows = {i: "".join(rng.choice(bits) for _ in range(rng.randrange(30))) for i in range(600)} | {1000: None, 1001: ""}
    check_base(pii.scan(texts(spark, rows.items())).collect(), rows)


def long_runs(n):
    return {1: "a" * n, 2: "1" * n, 3: "1." * n, 4: "a@b" + ".c" * n, 5: "+1" + "-" * n, 6: "1 " * n, 7: "x@" * n, 8: "mail a.b@c.de, " * (n // 20)}


def test_long_runs_equal_brute_force(spark):
    rows = long_runs(2_000)
    check_base(pii.scan(texts(spark, rows.items())).collect(), rows)


def test_long_runs_take_linear_time(spark):
    n = 100_000
    found = {r["doc_id"]: r for r in pii.scan(texts(spark, long_runs(n).items())).collect()}
    assert found[3]["n_ip"] == n // 4 and found[8]["n_email"] == n // 20
    assert found[4]["spans"] == f"email:0:{3 + 2 * n}"
    assert not any(found[i]["n_email"] + found[i]["n_ip"] + found[i]["n_card"] + found[i]["n_phone"] for i in (1, 2, 5, 6, 7))


def test_estimated_reliabilities_come_near_the_true_ones():
    rng = random.Random(12)
    true = [(0.9, 0.95), (0.8, 0.9), (0.7, 0.85), (0.95, 0.6)]
    counts = {}
    for _ in range(40_000):
        personal = rng.random() < 0.3
        votes = tuple(
            pii.ABSTAIN if rng.random() < 0.2 else pii.YES if rng.random() < (yes if personal else 1 - no) else pii.NO for yes, no in true
        )
        counts[votes] = counts.get(votes, 0) + 1
    prior, reliable, beliefs = pii.estimate(sorted(counts.items()))
    assert abs(prior - 0.3) < 0.05
    assert all(abs(a - b) < 0.06 for got, want in zip(reliable, true) for a, b in zip(got, want))
    assert beliefs[(1, 1, 1, 1)] > 0.95 > 0.05 > beliefs[(0, 0, 0, 0)]


def test_failing_candidates_are_added_by_evidence_only(spark):
    good = [(i, f"write to ann{i}@mail.example.com or call +1 (555) 555-{2000 + i}, card {with_check_digit(f'41111111{i:07d}')}") for i in range(60)]
    bad = [(100 + i, f"order no {1234567890123 + i * 7}, version 300.{i}.2.999, isbn 97831614{i:05d}") for i in range(60)]
    rows = dict(good + bad) | {300: "phone 555-867-5309 anytime", 301: "joe.doe (at) mail (dot) com"}
    found = pii.scan(texts(spark, rows.items())).collect()
    check_base(found, rows)
    by = {r["doc_id"]: r for r in found}
    assert all(by[i]["n_added"] == 0 for i, _ in bad)
    assert "handle:" in by[301]["spans"]


def test_awkward_documents(spark):
    docs = clashing(frame(spark))
    assert pii.scan(docs).count() == docs.count()
    clean = pii.redact(docs)
    assert clean.schema == docs.schema
    assert sorted(collected(clean, "doc_id", "text"), key=repr) == sorted(collected(docs, "doc_id", "text"), key=repr)
    assert pii.scan(texts(spark, [])).count() == 0
    assert collected(pii.scan(texts(spark, [(1, None)])), "spans", "n_email") == [("", 0)]


def test_redaction(spark):
    docs = texts(spark, [(1, "é a@b.co, 1.2.3.4!"), (2, None)])
    assert dict(collected(pii.redact(docs), "doc_id", "text")) == {1: "é [email], [ip]!", 2: None}


def test_main_path_has_no_python(spark):
    plan = pii.candidates(frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)


def planted(seed=21):
    """Texts with personal data that no base pattern has, and with what only looks like it; the spans that are to be added."""
    rng = random.Random(seed)
    names = ["Anna Schmidt", "Peter Novak", "Maria Garcia Lopez", "Thomas Becker", "Julia Moreau", "Hans Weber", "Zoltan Kovacs", "Ingrid Olsen"]
    words = "the of and in green table walks slowly under bright windows while many people talk about small things every day".split()
    filler = lambda: " ".join(rng.choice(words) for _ in range(rng.randrange(4, 12)))
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    user = lambda: rng.choice(["joe.doe", "ann_lee", "k.miller", "office77"])
    good = {
        "person": lambda: (rng.choice(["Mr ", "Frau ", "Dr. ", "name: ", "customer: ", "Dear "]), rng.choice(names), rng.choice([" lives here", ", thanks", ".", " called"])),
        "handle": lambda: (rng.choice(["write to ", "mail ", "contact "]), rng.choice(["{} (at) mail (dot) com", "{}[at]post.de", "{} at example dot org"]).format(user()), rng.choice([" today", ".", ", please"])),
        "number": lambda: (rng.choice(["call ", "phone ", "my mobile "]), rng.choice([f"555-{digits(3)}-{digits(4)}", f"030 {digits(3)} {digits(4)}", f"{digits(3)}-{digits(2)}-{digits(4)}"]), rng.choice([" anytime", ".", " at home"])),
        "iban": lambda: (rng.choice(["IBAN ", "account ", "konto "]), f"DE{digits(2)} {digits(4)} {digits(4)} {digits(4)} {digits(4)} {digits(2)}", rng.choice([" thanks", "."])),
    }
    bad = [
        lambda: ("order no ", digits(13), " total"), lambda: ("serial ", f"{digits(4)}-{digits(4)}-{digits(3)}", " batch"), lambda: ("Dear ", "Sales Team", " page"),
        lambda: ("version ", f"{rng.randrange(300, 999)}.{digits(2)}.{digits(3)}.{digits(4)}", " build"), lambda: ("isbn ", f"978{digits(10)}", " kg"), lambda: ("Dr. ", "Pepper Store", " street"),
    ]
    base = [lambda: ("", f"user{digits(2)}@mail{digits(1)}.example.com", ""), lambda: ("", f"{rng.randrange(11, 120)}.{rng.randrange(256)}.{rng.randrange(256)}.{rng.randrange(256)}", ""), lambda: ("", f"+1 ({digits(3)}) 555-{digits(4)}", "")]
    rows, wanted, decoys = {}, {}, {}
    for i in range(900):
        ahead, value, after = (bad[i % len(bad)] if i % 3 == 0 else good[list(good)[i % 4]] if i % 3 == 1 else base[i // 3 % 3])()
        head = f"{filler()} {ahead}"
        rows[i] = f"{head}{value}{after} {filler()}"
        span = (len(head), len(head) + len(value))
        if i % 3 == 1:
            wanted[i] = f"{list(good)[i % 4]}:{span[0]}:{span[1]}"
        elif i % 3 == 0:
            decoys[i] = span
    return rows, wanted, decoys


def test_added_spans_have_recall_and_precision(spark):
    rows, wanted, decoys = planted()
    added = {}
    for r in pii.scan(texts(spark, rows.items())).collect():
        added[r["doc_id"]] = [s for s in r["spans"].split(",") if s.split(":")[0] in pii.ADDED]
        assert len(added[r["doc_id"]]) == r["n_added"]
    by_kind = {k: [i for i, s in wanted.items() if s.startswith(k)] for k in pii.ADDED}
    for kind, own in by_kind.items():
        assert len(own) > 50
        assert sum(wanted[i] in added[i] for i in own) >= 0.9 * len(own), (kind, [(rows[i], added[i]) for i in own if wanted[i] not in added[i]][:5])
    total = sum(map(len, added.values()))
    right = sum(wanted.get(i) in own for i, own in added.items())
    assert right >= 0.9 * total, [(rows[i], own) for i, own in added.items() if own and wanted.get(i) not in own][:8]
    assert len(decoys) == 300 and sum(bool(added[i]) for i in decoys) <= 0.1 * len(decoys)


def test_each_labeler_votes_and_learns(spark):
    rows, _, _ = planted()
    found = written(pii.candidates(texts(spark, rows.items())), "planted")
    votes = [s.asDict() for r in found.collect() for s in r["found"]]
    assert len(votes) >= 700
    for labeler, share in (("shape", 1.0), ("gazetteer", 0.5), ("context", 0.5), ("edge", 0.8)):
        assert sum(v[labeler] != pii.ABSTAIN for v in votes) >= share * len(votes), labeler
        assert {pii.YES, pii.NO} <= {v[labeler] for v in votes} or labeler == "edge"
    reliable = pii.train(found).reliability
    assert all(max(pair) > 0.6 for pair in reliable.values()), reliable
    assert min(reliable["context"]) > 0.6 and min(reliable["shape"]) > 0.5
    given = written(pii.candidates(read(spark, "/root/testdata/sf0.01", "documents")), "given")
    votes = [s.asDict() for r in given.collect() for s in r["found"]]
    assert all(any(v[labeler] != pii.ABSTAIN for v in votes) for labeler in pii.LABELERS)
