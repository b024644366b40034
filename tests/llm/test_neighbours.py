import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from barloom.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, rank int"


def brute(rows, k):
    """Exact answers by definition; rows of (id, vector)."""
    good = sorted({(i, tuple(v)) for i, v in rows if i is not None and v and None not in v and np.all(np.isfinite(v)) and any(v)})
    out = {}
    for i, v in good:
        if i % 20 == 0:
            scored = sorted((-float(np.dot(np.float32(v).astype(float), np.float32(w).astype(float))), j) for j, w in good if j != i)
            out[i] = scored[:k]
    return out


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in rows], SCHEMA)


def answers(df):
    got = {}
    for r in df.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((-r.score, r.vec_id))
        assert r.rank == len(got[r.query_id])
    return got


@pytest.mark.parametrize("block", [16, 8192])
def test_all_leaves_give_the_exact_answer(spark, block):
    rng = np.random.default_rng(block)
    rows = [(i, rng.integers(-3, 4, 4).tolist()) for i in range(300)]  # many ties and equal vectors
    rows += [(1000 + i, [1, 2, 3, 0]) for i in range(60)]
    rows += [(2000, None), (2020, [0, 0, 0, 0]), (2040, [1, None, 0, 0]), (2060, [float("nan"), 1, 1, 1]), (2080, [1, 2]), (None, [1, 1, 1, 1]), rows[20]]
    got = answers(neighbours.search(table(spark, rows), F.pmod("vec_id", F.lit(20)) == 0, k=5, trees=3, leaf=20, probes=10_000, block=block))
    want = brute([(i, v) for i, v in rows if not v or len(v) == 4], 5)
    assert got == want


def test_recall_of_fewer_leaves(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(3000, 24))
    base *= rng.uniform(0.5, 2, (3000, 1))  # lengths matter for inner products
    rows = [(i, np.float32(v).tolist()) for i, v in enumerate(base)]
    got = answers(neighbours.search(table(spark, rows), F.pmod("vec_id", F.lit(20)) == 0, k=20, sample=1024, leaf=32))
    want = brute(rows, 20)
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    found = [len({i for _, i in got[q]} & {i for _, i in want[q]}) / 20 for q in want]
    assert np.mean(found) >= 0.9
    assert all(abs(-s - np.dot(np.float32(base[q]).astype(float), np.float32(base[i]).astype(float))) < 1e-12 for q in got for s, i in got[q])


def test_recall_with_strongly_uneven_lengths(spark):
    rng = np.random.default_rng(3)
    x = np.repeat(rng.normal(size=(1000, 64)), 20, axis=0) + rng.normal(size=(20_000, 64)) * 0.5
    x *= rng.lognormal(0, 1, (20_000, 1)) / np.linalg.norm(x, axis=1)[:, None]
    given = spark.createDataFrame(pa.table({"vec_id": np.arange(20_000), "embedding": list(x)}))
    got = answers(neighbours.search(given, F.pmod("vec_id", F.lit(100)) == 0, k=20))
    found = []
    for q in range(0, 20_000, 100):
        score = x @ x[q]
        score[q] = -np.inf
        found.append(len({i for _, i in got[q]} & set(np.argsort(-score)[:20].tolist())) / 20)
    assert np.mean(found) >= 0.9


def test_few_or_no_candidates(spark):
    two = table(spark, [(0, [1.0, 0.0]), (3, [0.5, 0.5])])
    assert answers(neighbours.search(two, F.pmod("vec_id", F.lit(20)) == 0)) == {0: [(-0.5, 3)]}
    assert neighbours.search(table(spark, [(0, [1.0])]), F.lit(True)).count() == 0
    assert neighbours.search(table(spark, []), F.lit(True)).count() == 0
