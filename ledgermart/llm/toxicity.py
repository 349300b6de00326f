"""Toxicity by cumulative-link ordinal regression over sparse character grams.

Severity has ordered grades 0 (fine) to K - 1. One weight vector serves all thresholds:
P(severity >= k) = sigmoid(w.x - t_k) with t_1 < t_2 < ..., so expected severity is the
sum of these. x holds, for a small vocabulary of words' character grams, how often each
comes per word of the document. The vocabulary is chosen, and the model fitted, on a
bounded sample of labelled rows; every document is scored over its whole text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermart.llm.common import free_name, written

#: At most so many labelled documents, one row of each, first by the hash of doc_id, train the model.
TRAIN_ROWS = 10_000
#: At most so many grams, those that tell toxic rows most clearly. More of them don't raise recall on held-out labels (README).
VOCABULARY = 500
#: A gram needs so many labelled rows, and its count in toxic rows so many standard deviations above chance.
MIN_ROWS = 3
MIN_Z = 3.0
SIZES = (4, 5, 6)
#: Ridge penalty on the weights, in labelled rows.
PENALTY = 0.3
STEPS = 600
#: A document is toxic from this probability of grade 1 or more on.
REJECT_AT = 0.5
#: Words whose grams a task remembers; a full memory is emptied.
REMEMBERED = 200_000

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> Counter:
    """Runs of letters in lower case, with their counts."""
    return Counter(_WORD.findall((text or "").lower()))


def grams_of(word: str) -> set[str]:
    """The word between marks, and its grams of SIZES characters, marks included."""
    marked = f"^{word}$"
    return {marked[i : i + n] for n in SIZES for i in range(len(marked) - n + 1)} | {marked}


def gram_counts(words: Counter, vocabulary: dict[str, int], memory: dict[str, list[int]]) -> Counter:
    """How often each of the vocabulary's grams comes in the words. ``memory`` holds what words have given before."""
    found: Counter = Counter()
    if len(memory) > REMEMBERED:
        memory.clear()
    for word, n in words.items():
        own = memory.get(word)
        if own is None:
            own = memory[word] = sorted(vocabulary[g] for g in grams_of(word) & vocabulary.keys())
        for i in own:
            found[i] += n
    return found


def rate(count, n_words):
    """A gram's value in a document: its share of the words, on a logarithmic scale."""
    return np.log1p(200 * count / (n_words + 20))


@dataclass
class Model:
    vocabulary: dict[str, int]
    weights: list[float]
    thresholds: list[float]  # ascending; severity is at least k + 1 past the k-th
    memory: dict[str, list[int]] = field(default_factory=dict)

    def at_least(self, text: str | None) -> np.ndarray:
        """P(severity >= 1), P(severity >= 2) and so on."""
        words = words_of(text)
        n = words.total()
        found = gram_counts(words, self.vocabulary, self.memory)
        score = sum(self.weights[i] * rate(c, n) for i, c in sorted(found.items()))
        return 1 / (1 + np.exp(np.clip(np.array(self.thresholds) - score, -50, 50)))


def fit_ordinal(rows: np.ndarray, features: np.ndarray, values: np.ndarray, grades: np.ndarray, width: int, penalty: float = PENALTY, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of the penalised likelihood's maximum, by accelerated gradient steps.

    The design matrix has ``values`` at (rows, features). The likelihood is concave in
    weights and thresholds together; a step's thresholds are kept in order.
    """
    n, levels = len(grades), int(grades.max(initial=0)) + 1
    if levels < 2:
        return np.zeros(width), np.array([])
    share = np.array([np.clip((grades >= k).mean(), 1e-6, 1 - 1e-6) for k in range(1, levels)])
    apart = np.arange(levels - 1) * 1e-3

    def ordered(p: np.ndarray) -> np.ndarray:
        p[width:] = np.maximum.accumulate(p[width:] - apart) + apart
        return p

    # each coordinate's curvature is at most a quarter of its values times its rows' sums
    sums = np.bincount(rows, weights=values, minlength=n) + 1
    curvature = np.concatenate((np.bincount(features, weights=values * sums[rows], minlength=width), np.full(levels - 1, sums.sum())))
    ridge = np.concatenate((np.full(width, penalty), np.zeros(levels - 1)))
    step = 1 / (0.5 * curvature + ridge + 1e-9)
    at = np.arange(n)

    def gradient(p: np.ndarray) -> np.ndarray:
        score = np.bincount(rows, weights=p[features] * values, minlength=n)
        reached = 1 / (1 + np.exp(np.clip(p[None, width:] - score[:, None], -50, 50)))
        reached = np.concatenate((np.ones((n, 1)), reached, np.zeros((n, 1))), axis=1)
        low, high = reached[at, grades], reached[at, grades + 1]
        likely = np.maximum(low - high, 1e-12)
        slope_low, slope_high = low * (1 - low) / likely, high * (1 - high) / likely
        by_threshold = np.zeros((n, levels + 1))
        by_threshold[at, grades] += slope_low
        by_threshold[at, grades + 1] -= slope_high
        by_weight = np.bincount(features, weights=(slope_high - slope_low)[rows] * values, minlength=width)
        return np.concatenate((by_weight, by_threshold[:, 1:levels].sum(axis=0))) + ridge * p

    old = ahead = np.concatenate((np.zeros(width), np.log(1 / share - 1)))
    for i in range(steps):
        new = ordered(ahead - step * gradient(ahead))
        ahead = ordered(new + i / (i + 3) * (new - old))
        old = new
    return old[:width], old[width:]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (id, grade, text) rows, grams with the rows and toxic rows that have them, summed as far as memory allows."""
    rows: Counter = Counter()
    toxic: Counter = Counter()

    def out() -> pa.RecordBatch:
        grams = list(rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(grams, pa.string()), pa.array([rows[g] for g in grams], pa.int64()), pa.array([toxic[g] for g in grams], pa.int64())],
            names=["gram", "rows", "toxic"],
        )

    for batch in batches:
        for grade, text in zip(batch.column(1).to_pylist(), batch.column(2)):
            own: set[str] = set()
            for word in words_of(text.as_py()):
                own |= grams_of(word)
            rows.update(own)
            if grade:
                toxic.update(own)
            if len(rows) > REMEMBERED:
                yield out()
                rows.clear()
                toxic.clear()
    yield out()


def train(docs: DataFrame, labels: DataFrame, grade: str = "grade", doc_id: str = "doc_id", text: str = "text", train_rows: int = TRAIN_ROWS, vocabulary: int = VOCABULARY, refine: bool = True) -> Model:
    """A model from ``labels`` (doc_id, grade from 0 on; of several the worst) of rows in ``docs``.

    Labels without doc_id, grade or document are left out before ``train_rows`` are
    chosen; of several rows with a labelled doc_id the first by text counts. Where no grade is above 1,
    ``refine`` makes grade 2 of the toxic rows whose telling grams are denser than the
    median's: the labels don't say so, and an expected severity above 1 then tells density only. Without toxic labels, or telling grams, the model knows no word. The
    driver gets ``vocabulary`` grams and how often ``train_rows`` rows have them.
    """
    known = labels.select(F.col(doc_id).cast("long").alias("id"), F.col(grade).cast("int").alias("grade")).dropna()
    known = known.groupBy("id").agg(F.max("grade").alias("grade"))
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    there = known.join(texts.select("id").distinct(), "id")
    chosen = there.orderBy(F.xxhash64("id"), "id").limit(train_rows)  # bounded, so it may be broadcast
    one_each = texts.join(F.broadcast(chosen), "id").groupBy("id", "grade").agg(F.min("text").alias("text"))
    sample = written(one_each, "labelled")
    total = sample.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum((F.col("grade") > 0).cast("int")), F.lit(0)).alias("toxic")).first()
    if not total["toxic"]:
        return Model({}, [], [])
    share = total["toxic"] / total["n"]
    counts = sample.mapInArrow(_counted, "gram string, rows long, toxic long").groupBy("gram").agg(F.sum("rows").alias("rows"), F.sum("toxic").alias("toxic"))
    z = (F.col("toxic") - F.col("rows") * share) / F.sqrt(F.col("rows") * share * (1 - share) + 1)
    telling = counts.filter(F.col("rows") >= MIN_ROWS).withColumn("z", z).filter(F.col("z") >= MIN_Z)
    place = {r["gram"]: i for i, r in enumerate(telling.orderBy(F.desc("z"), "gram").limit(vocabulary).collect())}

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("id", pa.int64()), ("grade", pa.int32()), ("n", pa.int64()), ("grams", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))])
        memory: dict[str, list[int]] = {}
        for batch in batches:
            rows = []
            for i, g, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                words = words_of(t.as_py())
                found = sorted(gram_counts(words, place, memory).items())
                rows.append((i, g, words.total(), [f for f, _ in found], [c for _, c in found]))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    columns = "id long, grade int, n long, grams array<int>, counts array<long>"
    design = sample.mapInArrow(measured, columns).orderBy("id", "n", "grams").toPandas()
    rows = np.repeat(np.arange(len(design)), [len(g) for g in design["grams"]])
    features = np.concatenate([*design["grams"], np.array([], dtype=np.int64)]).astype(np.int64)
    counted = np.concatenate([*design["counts"], np.array([], dtype=np.int64)]).astype(np.float64)
    grades, n_words = design["grade"].to_numpy(dtype=np.int64), design["n"].to_numpy(dtype=np.float64)
    if refine and grades.max() == 1:
        dense = np.bincount(rows, weights=counted, minlength=len(grades)) / (n_words + 1)
        grades = np.where(grades == 1, 1 + (dense > np.median(dense[grades == 1])), 0)
    weights, thresholds = fit_ordinal(rows, features, rate(counted, n_words[rows]), grades, len(place))
    return Model(place, weights.tolist(), thresholds.tolist())


def with_severity(docs: DataFrame, model: Model, name: str, text: str = "text") -> DataFrame:
    """``docs`` with a struct column: expected_severity, p_toxic, and grade, the last one reached with even odds.

    Null and empty texts have no words: they score what the thresholds alone give.
    """
    state = (model.vocabulary, model.weights, model.thresholds)

    @F.pandas_udf("expected_severity double, p_toxic double, grade int")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = Model(*state)
        for texts in batches:
            reached = [own.at_least(t) for t in texts]
            yield pd.DataFrame(
                [(float(p.sum()), float(p[0]) if len(p) else 0.0, int((p >= 0.5).sum())) for p in reached],
                columns=["expected_severity", "p_toxic", "grade"],
            )

    return docs.withColumn(name, score(F.col(text)))


def judge(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", reject_at: float = REJECT_AT) -> DataFrame:
    """One row per input row: doc_id, expected_severity, p_toxic, grade, toxic. Other columns aren't read."""
    kept = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    scored = with_severity(kept, model, "severity").select("doc_id", "severity.*")
    return scored.withColumn("toxic", F.col("p_toxic") >= reject_at)


def drop_toxic(docs: DataFrame, model: Model, text: str = "text", reject_at: float = REJECT_AT) -> DataFrame:
    """The rows of ``docs`` that aren't toxic, columns unchanged."""
    name = free_name(docs, "severity")
    return with_severity(docs, model, name, text).filter(F.col(name)["p_toxic"] < reject_at).select(*docs.columns)
