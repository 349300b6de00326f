"""Personal data by weak supervision. DataFrame functions only.

Patterns give candidate spans. Labelers vote on each: its shape (does the rule of its
kind hold), gazetteers (known domains, issuers, country codes, address ranges, given names), its
context (cue words and numbers on either side) and its edges (what touches it). They may abstain. Expectation-maximisation over
the counts of vote patterns estimates each labeler's reliability and gives every pattern a
probability; a span classifier over the candidates' own features is trained on these.
Candidates that hold their kind's rule are base spans and always stay; of the others those
that the classifier takes for personal data are added.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import exp, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermart.llm.common import free_name, written
from ledgermart.llm.spans import joined, listed, masked, with_matches

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED = ("handle", "iban", "number", "person")
KINDS = BASE_KINDS + ADDED

# What stands right before a person's name.
TITLES = "Mr|Mrs|Ms|Miss|Dr|Prof|Herr|Herrn|Frau|Mme|Monsieur|Madame|Señor|Señora|Sr|Sra|Dear|Liebe|Lieber|Cher|Chère|Querida|Querido"
FIELDS = "[Nn]ame|[Cc]ustomer|[Pp]atient|[Cc]lient|[Cc]ontact|[Aa]ttn|[Nn]ombre|[Nn]om|[Kk]unde|[Pp]erson"

#: Runs start at their first character or where the match before ended, and give nothing back: same matches, linear time.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){6,}+",  # shorter runs can't hold 14 digits, and aren't numbers to add
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "handle": r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{2,}+"
    r"(?:\x20?(?:\(at\)|\[at\])\x20?[a-z0-9-]{2,}+(?:(?:\.|\x20?(?:\(dot\)|\[dot\])\x20?)[a-z0-9-]{2,}+)++|\x20at\x20[a-z0-9-]{2,}+(?:\x20dot\x20[a-z0-9-]{2,}+)++)",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    # what costs little is asked first: a capital after a blank or a colon
    "person": rf"(?<=[\x20:=])(?=\p{{Lu}}\p{{Ll}})(?<=\b(?:{TITLES})\.?\x20|\b(?:{FIELDS})\x20?[:=]\x20?)\p{{Lu}}\p{{Ll}}++(?:[\x20-]\p{{Lu}}\p{{Ll}}++){{1,3}}+",
}

#: The gazetteers, and cue words by kind.
DOMAIN_ENDS = "com|net|org|edu|gov|info|biz|io|de|fr|es|it|nl|uk|ch|at|pt|pl|eu|us|ca|au|jp|cn|in|br|mx|ru"
RESERVED_IPS = r"^(?:0|10|127|255|169\.254|192\.168|172\.(?:1[6-9]|2[0-9]|3[01]))\."
#: First numbers that are given out, and four small numbers as versions have them.
PUBLIC_IPS = r"^(?:[1-9]|[1-9][0-9]|1[0-9]{2}|2[01][0-9]|22[0-3])\."
VERSION_LIKE = r"^[0-9]\.[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{1,2}$"
ISSUERS = "^(?:4|5[1-5]|2[2-7]|3[47]|36|38|6011|65)"
COUNTRY_CODES = r"^\+(?:1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
IBAN_COUNTRIES = "^(?:AT|BE|CH|DE|DK|ES|FI|FR|GB|IE|IT|LU|NL|NO|PL|PT|SE)"
_CUE = (
    "e-?mail|mail|contact|write|phone|telephone|tel|tél|call|mobile|cell|fax|handy|telefon|teléfono|card|visa|mastercard|amex|karte|carte|tarjeta"
    "|ip|address|host|client|account|iban|konto|compte|cuenta|ssn|passport|customer|name|dear|mr|mrs|ms|dr|herr|frau|mme|señor|señora|reach|text me|ring"
)
_COUNTER_CUE = "isbn|issn|doi|version|ver|rev|page|pp|fig|table|section|chapter|order|invoice|sku|serial|build|year|no|nr|id|part|item|lot|batch|ticket|total|sum|rows|points"
CUES = rf"(?i)\b(?:{_CUE})\b[^\n]{{0,20}}$"
CUES_AFTER = rf"(?i)^[^\n]{{0,12}}\b(?:{_CUE}|lives|born|moved|signed|home|work)\b"
COUNTER_CUES = rf"(?i)\b(?:{_COUNTER_CUE})\b[^\n]{{0,6}}$"
COUNTER_CUES_AFTER = rf"(?i)^[^\n]{{0,6}}\b(?:{_COUNTER_CUE}|kg|km|ms|px|eur|usd|gmbh|inc|ltd|street|avenue|university|river|museum|store)\b"
#: Numbers and signs of calculation, tables and code beside a span.
FIGURES_AHEAD, FIGURES_AFTER = r"[0-9$%&*#=|/\\]\s*$", r"^\s*[0-9$%&*#=|/\\]"

# Frequent given names, and capitalised words that aren't names.
GIVEN_NAMES = (
    "Adam|Alan|Alice|Amy|Ana|Andrea|Andreas|Angela|Anna|Anne|Antonio|Barbara|Ben|Brian|Carla|Carlos|Carmen|Caroline|Charles|Chloe|Christian|Claire|Claudia"
    "|Daniel|David|Diana|Diego|Elena|Elisabeth|Ella|Emily|Emma|Eric|Erika|Eva|Felix|Fernando|Francisco|Frank|Gabriel|George|Hannah|Hans|Heinz|Helen|Helga"
    "|Hugo|Ines|Isabel|Jack|James|Jane|Javier|Jean|John|Jonas|Jorge|Jose|Juan|Julia|Karl|Katharina|Klaus|Laura|Lea|Leo|Linda|Lisa|Louis|Lucas|Lucia|Luis"
    "|Manuel|Marc|Maria|Marie|Mark|Martin|Mary|Max|Michael|Miguel|Monika|Nicolas|Olivia|Pablo|Patricia|Paul|Pedro|Peter|Petra|Philippe|Pierre|Rachel|Robert"
    "|Rosa|Ruth|Sabine|Sarah|Sofia|Sophie|Stefan|Susan|Sven|Thomas|Tim|Tom|Ursula|Uwe|Victor|Werner|William|Wolfgang"
)
NOT_NAMES = (
    "The|This|That|And|For|With|From|Monday|Tuesday|Wednesday|Thursday|Friday|Saturday|Sunday|January|February|March|April|June|July|August|September|October"
    "|November|December|Street|Road|Avenue|Strasse|City|County|University|Institute|Company|Support|Service|Team|Department|Office|Center|Museum|Store|Shop|Sales"
    "|Product|Products|Order|Orders|Settings|Page|Table|Data|Sir|Madam|Customers|Colleagues|Friends|All|New|North|South|East|West|Windows|Server"
)

LABELERS = ("shape", "gazetteer", "context", "edge")
YES, NO, ABSTAIN = 1, 0, 2
FEATURES = ("kind", "rule", "digits", "groups", "ahead", "behind", "cue")
TAKE_AT = 0.5

EM_ROUNDS = 50
FIT_STEPS = 500
PENALTY = 1.0


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def passes_luhn(digits: Column) -> Column:
    """Of up to 19 digits: every second one from the right doubled, its digits summed."""
    padded = F.lpad(digits, 20, "0")
    at = lambda i: F.substring(padded, i, 1).cast("int")
    single = sum((at(i) for i in range(4, 21, 2)), at(2))
    double = sum(((at(i) * 2).cast("int") % 10 + F.floor(at(i) * 2 / 10).cast("int") for i in range(1, 20, 2)), F.lit(0))
    return (single + double) % 10 == 0


def holds(kind: str, value: Column) -> Column:
    """Whether the rule of the span's kind holds."""
    digits = digits_of(value)
    n = F.char_length(digits)
    if kind == "ip":
        return value.rlike(r"^(?:0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.|$)){4}$")
    if kind == "card":
        return n.between(14, 19) & passes_luhn(F.substring(digits, 1, 19))
    if kind == "phone":
        return n.between(10, 15)
    return F.lit(True)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, YES).when(no, NO).otherwise(ABSTAIN)


def _gazetteer(kind: str, value: Column) -> Column:
    if kind in ("email", "handle"):
        known = value.rlike(f"(?i)[.\\])\\x20](?:{DOMAIN_ENDS})$")
        return _vote(known, ~known)
    if kind == "ip":
        reserved = value.rlike(RESERVED_IPS)
        return _vote(value.rlike(PUBLIC_IPS) & ~reserved, reserved | value.rlike(VERSION_LIKE))
    if kind == "person":
        return _vote(value.rlike(rf"^(?:{GIVEN_NAMES})\b") & ~value.rlike(rf"\b(?:{NOT_NAMES})\b"), value.rlike(rf"\b(?:{NOT_NAMES})\b"))
    if kind == "phone":
        known = value.rlike(COUNTRY_CODES)
        return _vote(known, ~known)
    if kind == "iban":
        known = value.rlike(IBAN_COUNTRIES)
        return _vote(known, ~known)
    known = digits_of(value).rlike(ISSUERS)
    return _vote(known & (F.char_length(digits_of(value)) >= 14), F.char_length(digits_of(value)) < 9)


def _shape(kind: str, value: Column) -> Column:
    if kind == "card":  # failing ones may be another number of a person: a social security or a local phone number
        personal = value.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$|^[0-9]{3}[\x20-][0-9]{3}[\x20-][0-9]{4}$|^0[0-9]{2,4}[\x20-][0-9]{3,4}[\x20-]?[0-9]{3,5}$")
        return F.when(holds(kind, value) | personal, YES).otherwise(NO)
    if kind == "person":
        return F.when(F.size(F.split(value, "[ -]")) <= 3, YES).otherwise(NO)
    if kind == "iban":
        return F.when(F.char_length(F.regexp_replace(value, " ", "")).between(15, 32), YES).otherwise(NO)
    return F.when(holds(kind, value), YES).otherwise(NO)


#: What a span that stands by itself doesn't touch: all but white space, brackets, quotes and marks of a sentence.
NOT_CALM = r"""[^\s.,;:!?()\[\]"'<>«»]"""


def _class(c: Column) -> Column:
    """Of the character next to a span: 0 none, 1 white space, 2 letter or digit, 3 other."""
    return F.when(c == "", 0).when(c.rlike(r"^\s$"), 1).when(c.rlike(r"^[\p{L}\p{N}]$"), 2).otherwise(3)


def _candidates(kind: str, spans: Column) -> Column:
    """Spans with their votes and features, all small whole numbers."""

    def measured(s: Column) -> Column:
        value, ahead, after = s["value"], s["ahead"], s["after"]
        last = F.substring(ahead, -1, 1)
        touched = (_class(last) == 2) | (_class(s["behind"]) == 2)
        set_off = ~last.rlike(NOT_CALM) & ~s["behind"].rlike(NOT_CALM)
        counter = ahead.rlike(COUNTER_CUES) | after.rlike(COUNTER_CUES_AFTER) | ahead.rlike(FIGURES_AHEAD) | after.rlike(FIGURES_AFTER)
        cue = (ahead.rlike(CUES) | after.rlike(CUES_AFTER)) & ~counter
        digits = F.char_length(digits_of(value))
        groups = F.size(F.split(value, r"[^0-9A-Za-z]+"))
        return F.struct(
            s["start"].alias("start"),
            s["end"].alias("end"),
            F.lit(KINDS.index(kind)).alias("kind"),
            holds(kind, value).cast("int").alias("rule"),
            _shape(kind, value).alias("shape"),
            _gazetteer(kind, value).alias("gazetteer"),
            _vote(cue, counter).alias("context"),
            _vote(set_off, touched).alias("edge"),
            F.least(F.floor(digits / 3), F.lit(7)).cast("int").alias("digits"),
            F.least(groups, F.lit(6)).cast("int").alias("groups"),
            _class(last).alias("ahead"),
            _class(s["behind"]).alias("behind"),
            F.when(cue, 1).when(counter, 2).otherwise(0).alias("cue"),
        )

    return F.transform(spans, measured)


def candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, found): all candidate spans of every row, with votes and features. Null texts are empty."""
    whole = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    matched = with_matches(whole, "text", PATTERNS)
    return matched.select("doc_id", F.concat(*[_candidates(k, F.col(k)) for k in PATTERNS]).alias("found"))


@dataclass
class Model:
    reliability: dict[str, tuple[float, float]]  # by labeler: P(yes | personal), P(no | not personal), of votes given
    prior: float
    bias: float
    weights: dict[str, dict[int, float]]  # by feature and its value


def estimate(patterns: list[tuple[tuple[int, ...], int]], rounds: int = EM_ROUNDS) -> tuple[float, list[tuple[float, float]], dict[tuple[int, ...], float]]:
    """Prior, reliabilities and each pattern's probability, by expectation-maximisation over (votes, count) rows.

    It starts from the share of yes among the votes. Counts are smoothed by one vote for
    and one against, so that no labeler is ever certain; reliabilities stay at half or
    more, which keeps "personal" on the side of the yes votes.
    """
    share = lambda votes: (1 + votes.count(YES)) / (2 + votes.count(YES) + votes.count(NO))
    beliefs = {votes: share(votes) for votes, _ in patterns}
    prior, reliable = 0.5, [(0.5, 0.5)] * len(LABELERS)
    for _ in range(rounds):
        total = sum(n for _, n in patterns)
        prior = (1 + sum(n * beliefs[v] for v, n in patterns)) / (2 + total)
        reliable = []
        for i in range(len(LABELERS)):
            hit = [sum(n * beliefs[v] for v, n in patterns if v[i] == vote) for vote in (YES, NO)]
            off = [sum(n * (1 - beliefs[v]) for v, n in patterns if v[i] == vote) for vote in (YES, NO)]
            reliable.append((max(0.5, (1 + hit[0]) / (2 + sum(hit))), max(0.5, (1 + off[1]) / (2 + sum(off)))))
        for votes in beliefs:
            odds = log(prior / (1 - prior))
            for vote, (yes, no) in zip(votes, reliable):
                odds += 0 if vote == ABSTAIN else log(yes / (1 - no)) if vote == YES else log((1 - yes) / no)
            beliefs[votes] = 1 / (1 + exp(-max(-30.0, min(30.0, odds))))
    return prior, reliable, beliefs


def fit(rows: list[tuple[tuple[int, ...], float, float]], steps: int = FIT_STEPS, penalty: float = PENALTY) -> tuple[float, dict[str, dict[int, float]]]:
    """Bias and weights of a logistic regression on (feature values, count, sum of probabilities) rows."""
    keys = sorted({(f, v) for values, _, _ in rows for f, v in zip(FEATURES, values)})
    weights, bias = dict.fromkeys(keys, 0.0), 0.0
    weight_of = dict.fromkeys(keys, 0.0)
    for values, n, _ in rows:
        for key in zip(FEATURES, values):
            weight_of[key] += n
    total = sum(n for _, n, _ in rows)
    curve = 0.25 * (len(FEATURES) + 1)
    for _ in range(steps):
        slope, lean = {k: penalty * w for k, w in weights.items()}, 0.0
        for values, n, belief in rows:
            own = list(zip(FEATURES, values))
            p = 1 / (1 + exp(-max(-30.0, min(30.0, bias + sum(weights[k] for k in own)))))
            lean += n * p - belief
            for k in own:
                slope[k] += n * p - belief
        bias -= lean / (curve * total + 1e-9)
        for k in keys:
            weights[k] -= slope[k] / (curve * weight_of[k] + penalty)
    by_feature: dict[str, dict[int, float]] = {f: {} for f in FEATURES}
    for (f, v), w in weights.items():
        by_feature[f][v] = w
    return bias, by_feature


def train(found: DataFrame) -> Model:
    """A model from all candidates. The driver gets counts by vote pattern and by feature values, a bounded number of rows."""
    spans = found.select(F.explode("found").alias("s")).select("s.*")
    names = list(dict.fromkeys((*LABELERS, *FEATURES)))
    table = [r.asDict() for r in spans.groupBy(*names).count().orderBy(*names).collect()]
    by_votes: dict[tuple[int, ...], int] = {}
    for r in table:
        votes = tuple(r[x] for x in LABELERS)
        by_votes[votes] = by_votes.get(votes, 0) + r["count"]
    prior, reliable, beliefs = estimate(sorted(by_votes.items()))
    sums: dict[tuple[int, ...], list[float]] = {}
    for r in table:
        own = sums.setdefault(tuple(r[x] for x in FEATURES), [0.0, 0.0])
        own[0] += r["count"]
        own[1] += r["count"] * beliefs[tuple(r[x] for x in LABELERS)]
    bias, weights = fit([(values, n, belief) for values, (n, belief) in sorted(sums.items())]) if sums else (0.0, {f: {} for f in FEATURES})
    return Model(dict(zip(LABELERS, reliable)), prior, bias, weights)


def probability(span: Column, model: Model) -> Column:
    """The classifier's probability that a candidate is personal data."""
    score = F.lit(model.bias)
    for feature, by_value in model.weights.items():
        part = F.lit(0.0)
        for value, weight in by_value.items():
            part = F.when(span[feature] == value, F.lit(weight)).otherwise(part)
        score += part
    return 1 / (1 + F.exp(-score))


def labelled(found: Column, model: Model, take_at: float = TAKE_AT) -> Column:
    """Base spans, and added ones under their names in ADDED, by start and then by kind."""
    taken = lambda s: probability(s, model) >= take_at

    def of(kind: str) -> Column:
        at = KINDS.index(kind)
        if kind in BASE_KINDS:
            return F.filter(found, lambda s: (s["kind"] == at) & (s["rule"] == 1))
        if kind == "number":
            return F.filter(found, lambda s: (s["kind"] < len(BASE_KINDS)) & (s["rule"] == 0) & taken(s))
        return F.filter(found, lambda s: (s["kind"] == at) & taken(s))

    return listed({k: of(k) for k in KINDS})


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", take_at: float = TAKE_AT) -> DataFrame:
    """One row per input row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added. Other columns aren't read.

    Texts are read once; labelers, classifier and result work on the written candidates.
    """
    found = written(candidates(docs, doc_id, text), "pii-candidates")
    spans = found.select("doc_id", labelled(F.col("found"), train(found), take_at).alias("spans"))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.filter("spans", lambda s: s["rank"] < len(BASE_KINDS))
    added = F.size(F.filter("spans", lambda s: s["rank"] >= len(BASE_KINDS))).cast("long")
    return spans.select(
        "doc_id",
        *[count(k) for k in BASE_KINDS],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        added.alias("n_added"),
    )


def redact(docs: DataFrame, text: str = "text", model: Model | None = None, take_at: float = TAKE_AT) -> DataFrame:
    """``docs`` with personal data replaced by its kind in brackets; a model is trained on ``docs`` if none is given. Columns and rows stay."""
    whole_text, found = (free_name(docs, n) for n in ("whole_text", "found"))
    names = {k: free_name(docs, f"pii_{k}") for k in PATTERNS}
    if model is None:
        model = train(written(candidates(docs.select(F.lit(0).alias("doc_id"), F.col(text).alias("text"))), "pii-candidates"))
    whole = docs.withColumn(whole_text, F.coalesce(F.col(text), F.lit("")))
    matched = with_matches(whole, whole_text, {names[k]: p for k, p in PATTERNS.items()})
    all_found = F.concat(*[_candidates(k, F.col(names[k])) for k in PATTERNS])
    spans = matched.withColumn(found, all_found).withColumn(found, labelled(F.col(found), model, take_at))
    clean = masked(F.col(text), F.col(found), lambda s: F.concat(F.lit("["), s["kind"], F.lit("]")))
    return spans.withColumn(text, F.when(F.size(found) > 0, clean).otherwise(F.col(text))).select(*docs.columns)
