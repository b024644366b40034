import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.llm import quality

DATA = "/root/testdata/sf0.1"
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables not present")


def plain_score(model, row):
    total = model.intercept
    for i, table in enumerate(model.tables):
        total += table[sum(1 for e in model.edges[i] if e <= row[i])]
    for (i, j), table in zip(model.pairs, model.pair_tables):
        total += table[sum(1 for e in model.coarse[i] if e <= row[i]), sum(1 for e in model.coarse[j] if e <= row[j])]
    return 1 / (1 + np.exp(-total))


def test_additive_model_learns_single_features_and_pairs():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 4))
    y = ((x[:, 0] > 0.6) | ((x[:, 1] > 0.5) != (x[:, 2] > 0.5))).astype(float)  # the second part needs a pair
    model = quality.fit_model(x[:3000], y[:3000])
    assert {frozenset(p) for p in model.pairs} >= {frozenset((1, 2))}
    score = model.score(x[3000:])
    assert np.mean((score > 0.5) == y[3000:]) > 0.95
    assert np.allclose(score[:50], [plain_score(model, r) for r in x[3000:3050]])


def test_cut_is_the_best_of_all():
    rng = np.random.default_rng(1)
    g, h = rng.normal(size=12), rng.random(12) + 1
    gains = [g[:c].sum() ** 2 / (h[:c].sum() + 2) + g[c:].sum() ** 2 / (h[c:].sum() + 2) for c in range(1, 12)]
    assert quality._cut(g, h, 2.0, 0.0) == int(np.argmax(gains)) + 1
    grid_g, grid_h = rng.normal(size=(4, 5)), rng.random((4, 5)) + 1
    best = max(sum(a.sum() ** 2 / (b.sum() + 2) for a, b in (
        (grid_g[:i, :j], grid_h[:i, :j]), (grid_g[:i, j:], grid_h[:i, j:]), (grid_g[i:, :j], grid_h[i:, :j]),
        (grid_g[i:, j:], grid_h[i:, j:]))) for i in range(1, 4) for j in range(1, 5))
    gain, _ = quality._four_way(grid_g, grid_h, 2.0, 0.0)
    assert np.isclose(gain + grid_g.sum() ** 2 / (grid_h.sum() + 2), best)


@needs_data
def test_held_out_documents_are_told_apart(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.classify(docs, labels).join(labels, "doc_id").where("held_out").select("doc_id", "score", "predicted", "quality").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    order = np.argsort(np.argsort(good + bad)) + 1
    auc = (order[:len(good)].sum() - len(good) * (len(good) + 1) / 2) / (len(good) * len(bad))
    assert auc > 0.97
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95


def test_odd_rows_and_missing_labels(spark):
    rows = [(1, None, "a"), (1, "", "b"), (None, "x " * 50_000, "c"), (2, "\n\n", "d"), (2, "é" * 1000, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, features string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality.classify(docs, none).collect()
    assert len(got) == 5 and all(r.score == 0.5 and r.predicted == 1 for r in got)
    some = spark.createDataFrame([(1, 1, None), (2, 0, None), (2, None, None), (None, 1, None), (2, 1, 1)], "doc_id long, quality int, toxic int")
    assert all(0 <= r.score <= 1 for r in quality.classify(docs, some).collect())
    assert quality.classify(docs.limit(0), some).count() == 0
    kept = quality.keep_good(docs, some)
    assert kept.columns == docs.columns and kept.where(F.lit(True)).count() <= 5
