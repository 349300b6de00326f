import math
import random
import re

import numpy as np
from helpers import clashing, collected, frame, texts

from ledgermart.llm import toxicity
from ledgermart.llm.common import read


def corpus(n, seed):
    rng = random.Random(seed)
    clean = [f"{a}{b}" for a in ("lor", "ips", "dol", "sit", "ame") for b in ("um", "or", "et", "is", "ara", "ene")]
    rude = ["blasted", "rotten"]
    rows, grades = [], []
    for i in range(n):
        grade = rng.choice([0, 0, 0, 1, 2])
        words = [rng.choice(clean) for _ in range(rng.randrange(30, 200))]
        for _ in range(len(words) * grade // 15):
            words.insert(rng.randrange(len(words)), rng.choice(rude))
        rows.append((i, " ".join(words)))
        grades.append((i, grade))
    return rows, grades


def test_held_out_grades(spark):
    rows, grades = corpus(400, 1)
    model = toxicity.train(texts(spark, rows), spark.createDataFrame(grades[:200], "doc_id long, grade int"))
    assert len(model.thresholds) == 2 and model.thresholds[0] < model.thresholds[1]
    found = {r["doc_id"]: r for r in toxicity.judge(texts(spark, rows), model).collect()}
    held = grades[200:]
    assert np.mean([found[i]["grade"] == g for i, g in held]) > 0.85
    assert np.mean([found[i]["toxic"] == (g > 0) for i, g in held]) > 0.97
    mean = [np.mean([found[i]["expected_severity"] for i, g in held if g == k]) for k in range(3)]
    assert mean[0] < 0.3 < mean[1] < mean[2]


def test_thresholds_share_weights_and_never_cross():
    rng = np.random.default_rng(3)
    x = rng.random((600, 4))
    score = x @ np.array([3.0, -2.0, 1.0, 0.0])
    grades = np.searchsorted([0.5, 1.5, 2.5], score + rng.logistic(size=600) * 0.3)
    rows, features = np.repeat(np.arange(600), 4), np.tile(np.arange(4), 600)
    weights, thresholds = toxicity.fit_ordinal(rows, features, x.ravel(), grades, 4, penalty=0.01, steps=3000)
    assert (np.diff(thresholds) > 0).all()
    assert weights[0] > weights[2] > abs(weights[3]) > 0 > weights[1]


def test_fit_is_the_maximum_of_the_likelihood():
    """Against the penalised likelihood in plain Python: no other weights or thresholds near by are better."""
    rng = random.Random(4)
    x = [[rng.random() if rng.random() < 0.6 else 0.0 for _ in range(3)] for _ in range(120)]
    grades = [min(3, max(0, int(2.5 * a[0] - 1.5 * a[1] + rng.gauss(1, 0.7)))) for a in x]
    at = [(i, j) for i in range(120) for j in range(3) if x[i][j]]
    weights, thresholds = toxicity.fit_ordinal(
        np.array([i for i, _ in at]), np.array([j for _, j in at]), np.array([x[i][j] for i, j in at]), np.array(grades), 3, penalty=0.5, steps=4000
    )

    def loss(w, t):
        out = sum(0.25 * a * a for a in w)
        for own, g in zip(x, grades):
            score = sum(a * b for a, b in zip(w, own))
            reached = [1.0, *[1 / (1 + math.exp(c - score)) for c in t], 0.0]
            out -= math.log(max(1e-12, reached[g] - reached[g + 1]))
        return out

    best = loss(weights, thresholds)
    for _ in range(300):
        size = rng.choice([0.3, 0.05, 0.01])
        w, t = ([a + rng.gauss(0, size) for a in p] for p in (weights, thresholds))
        assert list(t) != sorted(t) or loss(w, t) >= best - 1e-6
    assert (np.diff(thresholds) > 0).all()


def test_scores_equal_plain_python(spark):
    rows, grades = corpus(120, 6)
    model = toxicity.train(texts(spark, rows), spark.createDataFrame(grades, "doc_id long, grade int"))
    found = {r["doc_id"]: r for r in toxicity.judge(texts(spark, rows), model).collect()}
    for i, text in rows[:40]:
        words = re.findall(r"[^\W\d_]+", text.lower())
        counts = {}
        for w in words:
            marked = f"^{w}$"
            for g in {marked[a:b] for a in range(len(marked)) for b in range(a + 4, min(a + 6, len(marked)) + 1)} | {marked}:
                counts[g] = counts.get(g, 0) + 1
        score = sum(model.weights[j] * math.log(1 + 200 * counts.get(g, 0) / (len(words) + 20)) for g, j in model.vocabulary.items())
        reached = [1 / (1 + math.exp(t - score)) for t in model.thresholds]
        assert abs(found[i]["expected_severity"] - sum(reached)) < 1e-9 and abs(found[i]["p_toxic"] - reached[0]) < 1e-9
        assert found[i]["grade"] == sum(p >= 0.5 for p in reached)


def test_given_grades_order_expected_severity(spark):
    """Four grades that the labels give: held-out expected severity rises with them, and refining leaves them alone."""
    rng = random.Random(8)
    clean = [f"{a}{b}" for a in ("lor", "ips", "dol", "sit") for b in ("um", "or", "et", "is", "ara")]
    rows, grades = [], []
    for i in range(600):
        grade = i % 4
        words = [rng.choice(clean) for _ in range(120)]
        rows.append((i, " ".join(words + [rng.choice(["blasted", "rotten", "vile"]) for _ in range(grade * 5 + rng.randrange(2) * (grade > 0))])))
        grades.append((i, grade))
    model = toxicity.train(texts(spark, rows), spark.createDataFrame(grades[:400], "doc_id long, grade int"))
    assert len(model.thresholds) == 3
    found = dict(collected(toxicity.judge(texts(spark, rows[400:]), model), "doc_id", "expected_severity"))
    mean = [np.mean([found[i] for i, g in grades[400:] if g == k]) for k in range(4)]
    assert mean[0] < 0.4 < mean[1] < mean[2] < mean[3]
    assert np.mean([abs(found[i] - g) for i, g in grades[400:]]) < 0.4


def test_held_out_labels_of_the_given_tables(spark):
    docs, labels = read(spark, "/root/testdata/sf0.1", "documents"), read(spark, "/root/testdata/sf0.1", "labels")
    model = toxicity.train(docs, labels.filter("doc_id % 3 <> 0"), grade="toxic")
    held = labels.filter("doc_id % 3 = 0").select("doc_id", "toxic").collect()
    toxic = dict(collected(toxicity.judge(docs.filter("doc_id % 3 = 0"), model), "doc_id", "toxic"))
    assert np.mean([toxic[r["doc_id"]] for r in held if r["toxic"] == 0]) < 0.02
    assert np.mean([toxic[r["doc_id"]] for r in held if r["toxic"] == 1]) > 0.9


def test_awkward_documents_and_labels(spark):
    docs = clashing(frame(spark))
    labels = spark.createDataFrame([(None, 1), (4, None), (6, 1), (6, 0), (99, 1), (12, 0), (7, 0)], "doc_id long, grade int")
    model = toxicity.train(docs, labels)
    found = toxicity.judge(docs, model)
    assert found.count() == docs.count()
    assert all(0 <= p <= 1 for (p,) in collected(found, "p_toxic"))
    kept = toxicity.drop_toxic(docs, model)
    assert kept.schema == docs.schema


def test_no_labels_no_toxic_ones_no_documents(spark):
    none = spark.createDataFrame([], "doc_id long, grade int")
    docs = frame(spark)
    for labels in (none, spark.createDataFrame([(4, 0)], "doc_id long, grade int")):
        model = toxicity.train(docs, labels)
        assert toxicity.drop_toxic(docs, model).count() == docs.count()
    assert toxicity.judge(texts(spark, []), toxicity.train(texts(spark, []), none)).count() == 0


def test_labels_without_documents_take_no_places(spark):
    rows, grades = corpus(200, 2)
    labels = [(i, g) for i, g in grades] + [(i, 0) for i in range(1000, 9000)]
    model = toxicity.train(texts(spark, rows), spark.createDataFrame(labels, "doc_id long, grade int"), train_rows=200)
    alone = toxicity.train(texts(spark, rows), spark.createDataFrame(grades, "doc_id long, grade int"), train_rows=200)
    assert model.vocabulary and (model.vocabulary, model.weights, model.thresholds) == (alone.vocabulary, alone.weights, alone.thresholds)


def test_repeated_documents_stay_within_the_bound(spark):
    rows, grades = corpus(60, 5)
    labels = spark.createDataFrame(grades, "doc_id long, grade int")
    once = toxicity.train(texts(spark, rows), labels, train_rows=60)
    often = toxicity.train(texts(spark, [*rows, *[rows[0]] * 500, (rows[0][0], None)]), labels, train_rows=60)
    assert (often.vocabulary, often.weights, often.thresholds) == (once.vocabulary, once.weights, once.thresholds)
