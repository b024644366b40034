"""Quality classifier: a generalised additive model with pairwise interactions.

Each text becomes a few numbers (shares of character classes, word and line statistics). Every feature is
binned at quantiles of the training rows; boosting goes round the features, each time adding a shallow tree
over one feature's bins to that feature's lookup table. The strongest pairs, by the gain of the best
four-way cut of what is left to explain, get two-dimensional tables in the same way. A score is the sum of
the looked-up values, put through the logistic function.

The model is fitted on the driver to about ``sample`` labelled rows (by the hashes of their ids).
Features are computed where the rows lie; only they are joined with the labels, never the texts.

Defined results: a null text is empty and has a score; ids whose labels disagree count as their largest
label; null labels and ids are not learned from; without labels every score is 0.5; rows may repeat.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.sampling import hashed_sample
from barloom.session import stage

FEATURES = ["log_words", "word_length", "capitals", "digits", "symbols", "pipes", "accents", "distinct_words", "commonest_word",
            "short_words", "odd_words", "sentence_ends", "repeated_lines", "line_words", "letter_entropy", "repeated_pairs"]

_CLASS = np.zeros(256, np.int64)  # 0 other, 1 white space, 2 lower case, 3 capital, 4 digit, 5 symbol, 6 part of a non-ASCII letter
for _chars, _kind in ((b" \t\n\r\x0b\x0c", 1), (bytes(range(97, 123)), 2), (bytes(range(65, 91)), 3), (bytes(range(48, 58)), 4),
                      (b"!\"#$%&()*+/:;<=>?@[\\]^_`{|}~", 5), (bytes(range(128, 256)), 6)):
    _CLASS[list(_chars)] = _kind
_PLAIN = bytes(sorted({*range(256)} - {*b"!\"#$%&()*+/:;<=>?@[\\]^_`{|}~0123456789"}))


def features(text: str | None) -> list[float]:
    """The numbers in the order of ``FEATURES``."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    if not words:
        return [0.0] * len(FEATURES)
    count = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    kind = np.bincount(_CLASS, weights=count, minlength=7)
    n, solid = len(words), max(1.0, len(data) - kind[1])
    lengths = np.fromiter(map(len, words), np.int64, n)
    common = Counter(words)
    lines = [x for x in data.split(b"\n") if x.strip()]
    pairs = len(set(zip(words, words[1:]))) if n > 1 else 1
    odd = n - sum(1 for w in words if not w.translate(None, _PLAIN))
    letters = count[(_CLASS == 2) | (_CLASS == 3)]
    share = letters[letters > 0] / max(1, letters.sum())
    return [np.log1p(n), solid / n, kind[3] / solid, kind[4] / solid, kind[5] / solid, count[ord("|")] / solid, kind[6] / solid,
            len(common) / n, common.most_common(1)[0][1] / n, float(np.mean(lengths <= 3)), odd / n,
            (count[ord(".")] + count[ord("?")] + count[ord("!")]) / n, 1 - len(set(lines)) / len(lines), np.log1p(n / len(lines)),
            float(-(share * np.log(share)).sum()), 1 - pairs / max(1, n - 1)]


def feature_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, features`` for each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], ["doc_id", "features"])

    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return given.mapInArrow(run, T.StructType([given.schema["doc_id"], T.StructField("features", T.ArrayType(T.DoubleType()))]))


@dataclass
class Model:
    """Lookup tables over the bins of single features and of pairs."""

    edges: list[np.ndarray]
    intercept: float = 0.0
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for i, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[i], x[:, i], "right")]
        for (i, j), table in zip(self.pairs, self.pair_tables):
            total += table[np.searchsorted(self.coarse[i], x[:, i], "right"), np.searchsorted(self.coarse[j], x[:, j], "right")]
        return 1 / (1 + np.exp(-total))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    values = np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))
    return values[values > x.min()]


def _leaf(g, h, ridge):
    return g / (h + ridge)


def _cut(g: np.ndarray, h: np.ndarray, ridge: float, least: float) -> int:
    """The bin before which to split for the largest gain, 0 for none."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = np.where((hl >= least) & (hr >= least), gl**2 / (hl + ridge) + gr**2 / (hr + ridge), -np.inf)
    if not len(gain) or gain.max() <= g.sum() ** 2 / (h.sum() + ridge) + 1e-9:
        return 0
    return int(gain.argmax()) + 1


def _shallow_tree(g: np.ndarray, h: np.ndarray, ridge: float, least: float) -> np.ndarray:
    """Leaf values per bin of a tree of depth two."""
    at = _cut(g, h, ridge, least)
    parts = [(0, at), (at, len(g))] if at else [(0, len(g))]
    out = np.zeros(len(g))
    for a, b in parts:
        inner = _cut(g[a:b], h[a:b], ridge, least) if at else 0
        for c, d in ([(a, a + inner), (a + inner, b)] if inner else [(a, b)]):
            out[c:d] = _leaf(g[c:d].sum(), h[c:d].sum(), ridge)
    return out


def _four_way(g: np.ndarray, h: np.ndarray, ridge: float, least: float) -> tuple[float, np.ndarray]:
    """Gain and values of the best cut of both features of a pair at one bin each."""
    gc, hc = (np.pad(a.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for a in (g, h))
    def quadrants(c):
        a = c[1:-1, 1:-1]
        b, d = c[1:-1, -1:] - a, c[-1:, 1:-1] - a
        return a, b, d, c[-1, -1] - a - b - d
    gq, hq = quadrants(gc), quadrants(hc)
    if not gq[0].size:
        return 0.0, np.zeros(g.shape)
    gain = sum(np.where(y >= least, x**2 / (y + ridge), 0.0) for x, y in zip(gq, hq))
    i, j = np.unravel_index(gain.argmax(), gain.shape)
    values = [_leaf(x[i, j], y[i, j], ridge) if y[i, j] >= least else 0.0 for x, y in zip(gq, hq)]
    out = np.empty(g.shape)
    out[:i + 1, :j + 1], out[:i + 1, j + 1:], out[i + 1:, :j + 1], out[i + 1:, j + 1:] = values
    return float(gain[i, j] - g.sum() ** 2 / (h.sum() + ridge)), out


def fit_model(x: np.ndarray, y: np.ndarray, bins: int = 48, coarse_bins: int = 12, rounds: int = 120, pair_count: int = 8,
              pair_rounds: int = 40, rate: float = 0.15, ridge: float = 2.0, least: float = 3.0) -> Model:
    """Boost single features in turn, then the strongest pairs."""
    width = x.shape[1]
    if not len(y):
        return Model([np.empty(0)] * width)
    model = Model([_edges(x[:, i], bins) for i in range(width)], coarse=[_edges(x[:, i], coarse_bins) for i in range(width)])
    prior = (y.sum() + 1) / (len(y) + 2)
    model.intercept = float(np.log(prior / (1 - prior)))
    total = np.full(len(y), model.intercept)
    fine = [np.searchsorted(e, x[:, i], "right") for i, e in enumerate(model.edges)]
    rough = [np.searchsorted(e, x[:, i], "right") for i, e in enumerate(model.coarse)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]

    def slopes():
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for i in range(width):
            g, h = (np.bincount(fine[i], v, len(model.tables[i])) for v in slopes())
            step = rate * _shallow_tree(g, h, ridge, least)
            model.tables[i] += step
            total += step[fine[i]]

    def grid(i, j):
        a, b = len(model.coarse[i]) + 1, len(model.coarse[j]) + 1
        return tuple(np.bincount(rough[i] * b + rough[j], v, a * b).reshape(a, b) for v in slopes())

    gains = {(i, j): _four_way(*grid(i, j), ridge, least)[0] for i in range(width) for j in range(i)}
    model.pairs = sorted(gains, key=gains.get, reverse=True)[:pair_count]
    model.pair_tables = [np.zeros((len(model.coarse[i]) + 1, len(model.coarse[j]) + 1)) for i, j in model.pairs]
    for _ in range(pair_rounds):
        for table, (i, j) in zip(model.pair_tables, model.pairs):
            step = rate * _four_way(*grid(i, j), ridge, least)[1]
            table += step
            total += step[rough[i], rough[j]]
    return model


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept out of learning: its id's checksum is divisible by five."""
    return F.coalesce(F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")) % 5 == 0, F.lit(False))


def fit(table: DataFrame, labels: DataFrame, label_col: str = "quality", label_id: str = "doc_id", sample: int = 20_000,
        **options) -> Model:
    """A model of the labelled rows of a feature table that are not held out."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(label_id).isNotNull()).groupBy(F.col(label_id).alias("doc_id")).agg(
        F.max(label_col).cast("double").alias("label")).where(~held_out())
    rows = hashed_sample(table.join(known, "doc_id"), ["doc_id"], sample).select("features", "label").toPandas()
    x = np.array(rows["features"].tolist(), float).reshape(-1, len(FEATURES))
    order = np.lexsort(x.T)  # sums, and so the model, do not depend on the order of arrival
    return fit_model(x[order], rows["label"].to_numpy(float)[order], **options)


def score_column(model: Model, text: Column) -> Column:
    """The score of a text column, for use inside other plans."""
    @F.pandas_udf(T.DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.array([features(t) for t in texts], float).reshape(-1, len(FEATURES))))

    return score(text)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text",
             **options) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row."""
    table = stage(feature_table(docs, id_col, text_col), "features")
    model = fit(table, labels, **options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x))], ["doc_id", "score"])

    schema = T.StructType([table.schema["doc_id"], T.StructField("score", T.DoubleType())])
    return table.mapInArrow(run, schema).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text",
              **options) -> DataFrame:
    """The rows that score at least ``threshold``; all columns as they came."""
    model = fit(stage(feature_table(docs, id_col, text_col), "features"), labels, **options)
    return docs.where(score_column(model, F.col(text_col)) >= threshold)
