"""Secrets in texts: known shapes, and entropy for the unknown ones. DataFrame functions only.

Base kinds are found by their patterns. Other long strings of token characters are
candidates, and so is what base spans leave of them. A window slides over a candidate; Shannon
entropy and the window's character class are kept up by the counts of the character that
enters and the one that leaves, and a candidate is a secret if any window reaches
the bound of its class. Windows lie beside what is on the allow-list, not over it: plain
words between separators, identifiers, checksums with their names and sequences typed
by hand cut a candidate, and hide nothing that stands beside them.
"""

from __future__ import annotations

from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermart.llm.common import free_name
from ledgermart.llm.spans import joined, listed, masked, with_matches

KINDS = ("assign", "access", "hex", "entropy")
BASE_KINDS = KINDS[:3]
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
PATTERNS = {
    "assign": ASSIGN,
    "access": "AKIA[A-Z0-9]{16,}",  # a shorter run can't hold a longer one, so the length may be in the pattern
    "hex": "[0-9a-f]{24,}",
    "entropy": "[A-Za-z0-9+/_=-]{20,}",
}
ASSIGNED = 6

WINDOW = 20
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Entropy in bits a character that a window must reach: of digits and hex digits of one case, of letters, of anything.
HEX_BITS, LETTER_BITS, MIXED_BITS = 3.05, 4.0, 3.8
#: Entropies are compared as whole numbers: c * log2(c) in units of 2^-20 bits.
UNIT = 1 << 20
TERMS = [0, *[round(c * log2(c) * UNIT) for c in range(1, WINDOW + 1)], 0]

# What looks random, or stands beside what does, and is no secret.
CHECKSUMS = "sha-?(?:1|224|256|384|512)|md5|checksum|digest|integrity|commit|revision|etag|fingerprint"
#: By what stands before the candidate.
ALLOWED_AFTER = rf"(?i)(?:{CHECKSUMS})[\s\"'=:(-]*$|[a-z]://$|data:[a-z/+-]+;base64,$"
#: Parts of a candidate: identifiers, checksums with their name, sequences.
ALLOWED_PARTS = (
    "[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}",
    f"(?i)(?:{CHECKSUMS})[=/_-]+[0-9a-f]+",
    "(?i)0123456789?0?|123456789?0?|abcdefgh[i-z]*|qwerty[a-z]*|x{4,}",
)
SEPARATORS = "=_/-"
#: A word of one case, or with a capital, between separators.
WORD = " (?:[a-z]{1,15}|[A-Z]{1,15}|[A-Z][a-z]{1,14}) "
#: Keys that documentation uses.
DOCUMENTED = "EXAMPLE(?:KEY)?$"


def least_sum(value: Column) -> Column:
    """The least sum of c * log2(c) over the characters' counts c in any window: that of the window of most entropy."""
    return _slid(value)["least"]


def _slid(value: Column) -> Column:
    """least, and hit: whether any window has the entropy of its class."""
    once = F.array(F.split(value, ""))  # bound to a variable below: a long value isn't split anew at every step
    return F.element_at(F.transform(once, _windows), 1)


def _allowed_sum(bits: float) -> Column:
    """The sum of terms at or below which a window has so many bits."""
    return F.lit(round((WINDOW * log2(WINDOW) - WINDOW * bits) * UNIT))


#: Last place in ALPHABET of capitals A-F and others, small letters a-f and others, digits, and the rest.
_GROUPS = (("upper_hex", 6), ("upper", 26), ("lower_hex", 32), ("lower", 52), ("digit", 62), ("sign", len(ALPHABET)))


def _windows(chars: Column) -> Column:
    place = lambda i: F.instr(F.lit(ALPHABET), F.element_at(chars, i))
    term = lambda c: F.element_at(F.lit(TERMS), c + 1)
    start = F.struct(
        F.array_repeat(F.lit(0), len(ALPHABET)).alias("counts"), F.lit(0).cast("long").alias("sum"), F.lit(1 << 40).cast("long").alias("least"),
        F.lit(False).alias("hit"), *[F.lit(0).alias(g) for g, _ in _GROUPS],
    )

    def step(a: Column, i: Column) -> Column:
        enters = place(i)
        leaves = F.when(i > WINDOW, place(i - WINDOW)).otherwise(F.lit(0))
        more = F.element_at(a["counts"], enters)
        same = enters == leaves
        less = F.when(leaves > 0, F.element_at(a["counts"], F.greatest(leaves, F.lit(1)))).otherwise(F.lit(1))
        total = F.when(same, a["sum"]).otherwise(a["sum"] + term(more + 1) - term(more) + F.when(leaves > 0, term(less - 1) - term(less)).otherwise(F.lit(0)))
        counts = F.when(same, a["counts"]).otherwise(
            F.transform(a["counts"], lambda c, k: c + F.when(k + 1 == enters, 1).when(k + 1 == leaves, -1).otherwise(0))
        )
        least = F.when(i >= WINDOW, F.least(a["least"], total)).otherwise(a["least"])
        groups, low = {}, 0
        for g, high in _GROUPS:
            within = lambda x, low=low, high=high: ((x > low) & (x <= high)).cast("int")
            groups[g], low = a[g] + within(enters) - within(leaves), high
        hex_digits = (groups["upper"] + groups["lower"] + groups["sign"] == 0) & ((groups["upper_hex"] == 0) | (groups["lower_hex"] == 0))
        letters = groups["digit"] + groups["sign"] == 0
        bound = F.when(hex_digits, _allowed_sum(HEX_BITS)).when(letters, _allowed_sum(LETTER_BITS)).otherwise(_allowed_sum(MIXED_BITS))
        hit = a["hit"] | ((i >= WINDOW) & (total <= bound))
        return F.struct(
            counts.alias("counts"), total.cast("long").alias("sum"), least.cast("long").alias("least"), hit.alias("hit"), *[c.alias(g) for g, c in groups.items()]
        )

    return F.aggregate(F.sequence(F.lit(1), F.size(chars)), start, step, lambda a: F.struct(a["least"].alias("least"), a["hit"].alias("hit")))


def judged(value: Column) -> Column:
    """The pieces of a candidate that the allow-list leaves, of WINDOW characters or more, without separators at their ends."""
    for part in ALLOWED_PARTS:
        value = F.regexp_replace(value, part, "!")
    spaced = F.concat(F.lit(" "), F.regexp_replace(value, f"([!{SEPARATORS}])", " $1 "), F.lit(" "))  # a word has both of its spaces for itself
    left = F.replace(F.regexp_replace(spaced, WORD, "!"), F.lit(" "), F.lit(""))
    pieces = F.transform(F.split(left, "!"), lambda p: F.btrim(p, F.lit(SEPARATORS)))
    return F.filter(pieces, lambda p: F.char_length(p) >= WINDOW)


def is_random(value: Column) -> Column:
    """Whether a window of what the allow-list leaves of a candidate has the entropy of its class."""
    return ~value.rlike(DOCUMENTED) & F.exists(judged(value), lambda p: _slid(p)["hit"])


def _parts(s: Column, taken: Column) -> Column:
    """What the ``taken`` spans, sorted by start, leave of a candidate, in pieces of WINDOW characters or more."""
    own = lambda a, b, ahead: F.struct(
        a.alias("start"), b.alias("end"), F.substring(s["value"], a - s["start"] + 1, b - a).alias("value"), ahead.alias("ahead")
    )
    whole = F.struct(s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), s["ahead"].alias("ahead"))
    touching = F.filter(taken, lambda x: (x["start"] < s["end"]) & (s["start"] < x["end"]))
    end = F.struct(s["end"].alias("start"), s["end"].alias("end"))

    def step(a: Column, x: Column) -> Column:
        ahead = F.when(a["at"] == s["start"], s["ahead"]).otherwise("")
        kept = F.when(x["start"] - a["at"] >= WINDOW, F.concat(a["kept"], F.array(own(a["at"], x["start"], ahead)))).otherwise(a["kept"])
        return F.struct(F.greatest(a["at"], x["end"]).alias("at"), kept.alias("kept"))

    start = F.struct(s["start"].alias("at"), F.filter(F.array(whole), lambda _: F.lit(False)).alias("kept"))
    cut = F.aggregate(F.concat(touching, F.array(end)), start, step, lambda a: a["kept"])
    return F.when(F.exists(taken, lambda x: (x["start"] < s["end"]) & (s["start"] < x["end"])), cut).otherwise(F.array(whole))


def with_secrets(docs: DataFrame, name: str, text: str = "text") -> DataFrame:
    """``docs`` with an array column of all spans: struct<start, rank, end, kind>, by start, then by kind as in KINDS.

    Base spans are all there, also where they overlap across kinds. An entropy span is a
    whole candidate, or where base spans touch it, a part that they leave of it.
    """
    own = free_name(docs, "scanned")
    whole = docs.withColumn(own, F.coalesce(F.col(text), F.lit("")))
    names = {k: free_name(docs, f"spans_{k}") for k in KINDS}
    whole = with_matches(whole, own, {names[k]: p for k, p in PATTERNS.items()})
    assigned = F.filter(names["assign"], lambda s: F.char_length(F.regexp_extract(s["value"], ASSIGN, 1)) >= ASSIGNED)
    whole = whole.withColumn(names["assign"], assigned)
    bare = lambda k: F.transform(names[k], lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    taken = free_name(docs, "taken")
    whole = whole.withColumn(taken, F.array_sort(F.concat(*[bare(k) for k in BASE_KINDS])))
    parts = F.flatten(F.transform(names["entropy"], lambda s: _parts(s, F.col(taken))))

    def secret(s: Column) -> Column:
        return ~s["ahead"].rlike(ALLOWED_AFTER) & is_random(s["value"])

    whole = whole.withColumn(names["entropy"], F.filter(parts, secret))
    whole = whole.withColumn(name, listed({k: F.col(names[k]) for k in KINDS}))
    return whole.select(*[docs[c] for c in docs.columns], name)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_assign, n_access, n_hex, n_entropy, base_sha256, spans. Other columns aren't read."""
    found = with_secrets(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "found")
    count = lambda k: F.size(F.filter("found", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.filter("found", lambda s: s["rank"] < len(BASE_KINDS))
    return found.select(
        "doc_id", *[count(k) for k in KINDS], F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("found")).alias("spans")
    )


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every secret replaced by its kind in brackets; overlapping ones by that of the first. Columns and rows stay."""
    name = free_name(docs, "found")
    found = with_secrets(docs, name, text)
    clean = masked(F.col(text), F.col(name), lambda s: F.concat(F.lit("["), s["kind"], F.lit("]")))
    return found.withColumn(text, F.when(F.size(name) > 0, clean).otherwise(F.col(text))).select(*docs.columns)
