"""Awkward documents, and the words of texts as plain Python has them."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside.
CLASHES = (
    "fp", "fingerprint", "component_id", "component", "text_hash", "first_id", "turn", "root", "bucket", "found", "spans", "kept", "n_words",
    "group", "length", "piece", "ids", "severity", "grade", "at", "side", "guest", "whole_text", "scanned", "did", "tie", "id", "words", "row_number",
)


def awkward():
    """Nulls, empty and blank texts, repeated rows, one doc_id twice, a very long text and a very long word."""
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "épsilon", "ζήτα", "eta", "theta", "日本"]
    passage = " ".join(rng.choice(words) + str(rng.randrange(50)) for _ in range(40))
    text = lambda n: " ".join(rng.choice(words) + str(rng.randrange(200)) for _ in range(n))
    shared = text(60)
    rows = [
        (None, shared), (None, None), (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "one two"), (6, shared), (6, shared),
        (7, text(30)), (7, text(31)), (8, f"{text(10)} {passage} {text(10)}"), (9, f"{text(12)}\n{passage}"), (10, shared.upper()),
        (11, " ".join(["loop"] * 300)), (12, text(20_000)), (13, "x" * 300_000), (14, " ".join(["a b c d e f g h i j"] * 30)),
        (15, "trailing space "), (16, "a b c d"), (17, shared.replace(" ", "  ")), (18, "😀 " * 25),
    ]
    return [(i, t, "en", f"s{(i or 0) % 2}", None if t is None else len(t)) for i, t in rows]


def frame(spark, rows=None):
    return spark.createDataFrame(awkward() if rows is None else rows, SCHEMA)


def clashing(docs):
    """With further columns named like those that operators make."""
    return docs.withColumns({c: F.lit(f"own {c}") for c in CLASHES})


def texts(spark, pairs):
    return spark.createDataFrame([(i, t) for i, t in pairs], "doc_id long, text string")


def collected(df, *names):
    return [tuple(r[n] for n in names) for r in df.collect()]
