import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.llm import toxicity

DATA = "/root/testdata/sf0.1"
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables not present")


def loss(theta, rows, columns, values, grades, width):
    t = toxicity._thresholds(theta[width:])
    score = np.bincount(rows, theta[:width][columns] * values, len(grades))
    over = np.hstack([np.ones((len(grades), 1)), 1 / (1 + np.exp(-(score[:, None] - t))), np.zeros((len(grades), 1))])
    own = np.arange(len(grades))
    return -np.log(over[own, grades] - over[own, grades + 1]).mean()


def test_slope_is_the_derivative_of_the_loss():
    rng = np.random.default_rng(0)
    rows, columns, values = rng.integers(0, 30, 90), rng.integers(0, 5, 90), rng.random(90)
    grades = rng.integers(0, 4, 30)
    theta = rng.normal(size=8) * 0.3
    slope = toxicity._slope(theta, rows, columns, values, grades, 5, 3, 30)
    for i in range(8):
        step = np.zeros(8)
        step[i] = 1e-6
        numeric = (loss(theta + step, rows, columns, values, grades, 5) - loss(theta - step, rows, columns, values, grades, 5)) / 2e-6
        assert np.isclose(slope[i], numeric, atol=1e-6)


def test_grades_are_recovered_in_order():
    rng = np.random.default_rng(1)
    x = rng.random((2000, 3))
    grades = np.searchsorted([0.8, 1.3, 1.9], x[:, 0] + x[:, 1] * 1.5)
    rows, columns = np.repeat(np.arange(2000), 3), np.tile(np.arange(3), 2000)
    weights, thresholds = toxicity.fit_ordinal(rows, columns, x.ravel(), grades, 3)
    assert np.all(np.diff(thresholds) > 0)
    expected = (1 / (1 + np.exp(-((x @ weights)[:, None] - thresholds)))).sum(axis=1)
    assert np.mean(np.abs(expected - grades) < 0.75) > 0.9
    assert abs(weights[2]) < 0.2 * weights[0] < weights[1]


@needs_data
def test_held_out_toxic_documents_are_found(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    rows = toxicity.severity(docs, model).withColumnRenamed("toxic", "flag").join(labels, "doc_id").where(toxicity.held_out()).collect()
    bad = [r for r in rows if r.toxic == 1]
    assert np.mean([r.flag for r in bad]) > 0.9  # a few hundred toxic texts to learn from
    assert np.mean([r.flag for r in rows if r.toxic == 0]) < 0.01
    assert min(np.mean([r.expected_severity for r in bad]), 3) > 10 * np.mean([r.expected_severity for r in rows if r.toxic == 0])


def test_odd_rows_and_labels(spark):
    texts = ["good words here"] * 8 + ["vile nasty words"] * 6 + [None, "", "word " * 50_000, "nasty nasty"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(None, "nasty", "y"), (9, texts[9], "x")],
                                 "doc_id long, text string, label string")
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    none = toxicity.severity(docs, toxicity.fit(docs, empty)).collect()
    assert len(none) == len(texts) + 2 and all(r.expected_severity == 0 and not r.toxic for r in none)
    rows = [(i, None, int(8 <= i < 14)) for i in range(14)] + [(9, 1, 0), (3, None, None), (None, None, 1)]
    model = toxicity.fit(docs, spark.createDataFrame(rows, "doc_id long, quality int, toxic int"))
    got = {r.doc_id: r for r in toxicity.severity(docs, model).collect()}
    assert got[9].toxic and not got[0].toxic and not got[14].toxic and not got[15].toxic
    assert toxicity.severity(docs.limit(0), model).count() == 0
    graded = spark.createDataFrame([(i, 0, 0 if i < 8 else 2 + i % 2) for i in range(14)], "doc_id long, quality int, toxic int")
    assert len(toxicity.fit(docs, graded).thresholds) == 2
    assert toxicity.fit(docs, graded.withColumn("toxic", F.lit(0))).thresholds.size == 0


def test_counts_have_no_upper_bound():
    lookup = toxicity.Lookup(np.unique(toxicity.runs_of("zzzzz")[0]))
    once = lookup.vector("zzzzz ")[1]
    at, counts, total, marked = lookup.vector("zzzzz " * 70_000)
    assert counts.tolist() == (once * 70_000).tolist() and total == 70_000 == marked
