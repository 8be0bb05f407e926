import random

import numpy as np
from pyspark.sql import functions as F

from waitband.llm import toxicity

from . import cases

BAD = ["vilewort", "vilemaggot", "rotten", "stinkard"]


def corpus(n=1500, seed=4):
    rng = random.Random(seed)
    words = ["".join(rng.choice("aeiourstnlm") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    rows = []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(5, 200))]
        bad = rng.random() < 0.15
        for _ in range(rng.randint(2, 8) if bad else 0):
            text[rng.randrange(len(text))] = rng.choice(BAD)
        rows.append((i, " ".join(text), int(bad)))
    return rows


def test_held_out_accuracy(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, b) for i, _, b in rows if i % 3], "doc_id long, label int")
    model = toxicity.train(docs, labels)
    assert list(model.thresholds) == sorted(model.thresholds) and len(model.thresholds) == toxicity.LEVELS
    out = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    held = [(i, b) for i, _, b in rows if i % 3 == 0]
    assert np.mean([out[i].toxic == bool(b) for i, b in held]) > 0.98
    # severity rises with the number of such words
    many = spark.createDataFrame([(k, "mild words here " + " ".join(BAD[:k])) for k in range(5)], "doc_id long, text string")
    sev = [r.expected_severity for r in toxicity.score(many, model).orderBy("doc_id").collect()]
    assert sev == sorted(sev) and sev[0] < 0.2 < 1 < sev[4]
    kept = {r.doc_id for r in toxicity.keep_clean(docs.withColumn("toxic", F.lit(1)), model).collect()}
    assert kept == {i for i, r in out.items() if not r.toxic}


def test_gradient_of_the_likelihood():
    """The fitted thresholds and weights are at a minimum: no small step lowers the loss."""
    rng = np.random.default_rng(0)
    rows = [([c for c in range(4) if rng.random() < 0.4], 0) for _ in range(300)]
    rows = [(c, int(np.clip(sum(c) / 2 + rng.normal(), 0, 3))) for c, _ in rows]
    w, theta = toxicity.fit(rows, 4, 4, rounds=3000, ridge=1e-3)

    def loss(w, theta):
        model = toxicity.Model({}, w, theta)
        x = np.array([w[c].sum() for c, _ in rows])
        p = model.probabilities(x)[np.arange(len(rows)), [g for _, g in rows]]
        return -np.log(p).mean() + 0.5e-3 * (w ** 2).sum()

    here = loss(w, theta)
    for k in range(4):
        for s in (-0.05, 0.05):
            assert loss(w + s * np.eye(4)[k], theta) > here
    for k in range(3):
        for s in (-0.05, 0.05):
            assert loss(w, theta + s * np.eye(3)[k]) > here


def test_given_grades(spark):
    rows = [(i, " ".join(["word"] + BAD[:i % 4]), i % 4) for i in range(800)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, g) for i, _, g in rows], "doc_id long, label int")
    out = toxicity.score(docs, toxicity.train(docs, labels, binary=False)).collect()
    assert all(r.grade == r.doc_id % 4 and abs(r.expected_severity - r.grade) < 0.6 for r in out)


def test_edge_rows(spark):
    docs = cases.documents(spark)
    none = spark.createDataFrame([(1, 0), (2, None), (None, 1)], "doc_id long, label int")
    model = toxicity.train(docs, none)
    out = toxicity.score(docs, model)
    assert out.count() == docs.count() and not any(r.toxic for r in out.collect())
    assert toxicity.keep_clean(docs, model).columns == docs.columns
    assert toxicity.keep_clean(docs, model).count() == docs.count()
    assert toxicity.score(cases.empty(spark), toxicity.train(cases.empty(spark), none.limit(0))).count() == 0


def test_a_labelled_id_in_many_rows_does_not_break_the_bound(spark):
    docs = spark.range(100_000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("text "), (F.col("id") % 30_000).cast("string")).alias("text"))
    docs = docs.unionByName(spark.createDataFrame([(i, f"other {i}") for i in range(50)], "doc_id long, text string"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, label int")
    sample = toxicity.sampled(docs, labels, 12_000)
    assert sample.count() == 12_000 and sample.select("doc_id", "text").distinct().count() == 12_000
    few = toxicity.sampled(docs, labels, 10).collect()
    assert len(few) == 10
    # one row per text where there is room
    once = docs.filter("text < 'text 100'").unionByName(docs.filter("text < 'text 100'"))
    assert toxicity.sampled(once, labels, 12_000).count() == once.select("doc_id", "text").distinct().count()


def test_grades_are_out_of_fold_and_severity_ranks_held_out_documents(spark):
    rng = random.Random(12)
    words = ["".join(rng.choice("aeiourstnlm") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    bad = [f"vile{c}" for c in "abcdefghijklmnopqrst"]
    rows = []
    for i in range(2400):
        n = rng.randint(20, 200)
        strength = rng.choice([0, 0, 0, 0.03, 0.1, 0.25])
        rows.append((i, " ".join(rng.choice(bad) if rng.random() < strength else rng.choice(words) for _ in range(n)), strength))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(s > 0)) for i, _, s in rows if i % 2], "doc_id long, label int")
    sample = toxicity.sampled(docs, labels, toxicity.SAMPLE)
    grades = toxicity.graded(sample)
    toxic = {i: s for i, _, s in rows if i % 2 and s > 0}
    assert set(grades) == set(toxic) and set(grades.values()) == {1, 2, 3}
    # the grade follows how many different such words there are
    different = {i: len(set(t.split()) & set(bad)) for i, t, _ in rows}
    order = lambda xs: np.argsort(np.argsort(xs))
    ids = sorted(toxic)
    assert np.corrcoef(order([grades[i] for i in ids]), order([different[i] for i in ids]))[0, 1] > 0.8
    # a document's own label does not reach its grade
    half = {r.doc_id: r.half for r in sample.collect()}
    assert 0.4 < np.mean(list(half.values())) < 0.6
    out = {r.doc_id: r for r in toxicity.score(docs, toxicity.train(docs, labels)).collect()}
    held = [i for i, _, s in rows if i % 2 == 0 and different[i]]
    assert np.corrcoef(order([out[i].expected_severity for i in held]), order([different[i] for i in held]))[0, 1] > 0.8
    # grades do not cost the verdict: telling toxic from clean on documents that were not fitted on
    assert np.mean([out[i].toxic == bool(different[i]) for i, _, _ in rows if i % 2 == 0]) > 0.97
