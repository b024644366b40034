"""Toxicity severity by cumulative-link ordinal regression over sparse text features.

Features are the runs of four and five bytes inside words, the break before a word counting as a byte
(lower case where ASCII), hashed into ``SPACE`` numbers; the ``keep`` numbers that set toxic training texts apart best are used. One weight vector is shared by all severity
thresholds: P(grade > k) = logistic(w.x - t_k) with rising t_k, and the expected severity is the sum of these.

The model is fitted on the driver to about ``sample`` labelled rows (by the hashes of their ids);
only hashed counts of the sample reach it, at most ``SPACE`` totals and ``keep`` numbers a row. The sampled
labels are broadcast, so texts are never shuffled.

Labels with more than two values are used as grades. Labels of 0 and 1 say only whether a text is toxic;
toxic texts are then graded 1 to 3 by how many words with features of toxic texts they hold, cut at thirds
of the toxic sample.

Defined results: a null text is empty; ids whose labels disagree count as their largest label; null labels
and ids are not learned from; without toxic labels every severity is 0; rows may repeat.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.quality import held_out
from barloom.llm.sampling import hashed_sample

SPACE = 1 << 20
RUNS = (4, 5)
LEAST = 3  # toxic texts that must hold a feature
IN_WORD = np.zeros(256, bool)
IN_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def runs_of(text: str | None) -> tuple[np.ndarray, np.ndarray, int]:
    """Hashed runs of a text, the word that each lies in, and the number of words."""
    data = np.frombuffer(b" " + (text or "").encode("utf-8", "surrogatepass").lower(), np.uint8)
    inside = IN_WORD[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    word = np.cumsum(starts)
    wide = np.where(inside, data, 32).astype(np.uint64)
    code, hashes, words = wide, [], []
    for n in range(2, max(RUNS) + 1):
        if len(data) < n:
            break
        code = code[:-1] | wide[n - 1:] << np.uint64(8 * (n - 1))
        if n in RUNS:  # all bytes but perhaps the first, then a break, lie in one word
            at = np.flatnonzero(inside[1:len(code) + 1] & inside[n - 1:] & (word[1:len(code) + 1] == word[n - 1:]))
            hashes.append(((code[at] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(44)).astype(np.int64))
            words.append(word[n - 1:][at])
    if not hashes:
        return np.empty(0, np.int64), np.empty(0, np.int64), int(starts.sum())
    return np.concatenate(hashes), np.concatenate(words), int(starts.sum())


class Lookup:
    """Positions of the chosen features by hash."""

    def __init__(self, chosen: np.ndarray):
        self.at = np.full(SPACE, -1, np.int32)
        self.at[chosen] = np.arange(len(chosen))

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray, int, int]:
        """Feature positions and counts of a text, its words, and how many of them hold a feature."""
        hashes, words, total = runs_of(text)
        found = self.at[hashes]
        held = found >= 0
        at, counts = np.unique(found[held], return_counts=True)
        return at, counts, total, len(np.unique(words[held]))


@dataclass
class Model:
    """Weights shared by all thresholds; a weight for the log number of words comes last."""

    chosen: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def exceed(self, lookup: Lookup, text: str | None) -> np.ndarray:
        """P(grade > k) for every k."""
        if not len(self.thresholds):
            return np.zeros(1)
        at, counts, words, _ = lookup.vector(text)
        total = float(self.weights[at] @ np.log1p(counts) + self.weights[-1] * np.log1p(words))
        return 1 / (1 + np.exp(-np.clip(total - self.thresholds, -500, 500)))


def fit_ordinal(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, grades: np.ndarray, width: int, steps: int = 800,
                rate: float = 0.1, ridge: float = 5e-5) -> tuple[np.ndarray, np.ndarray]:
    """Shared weights and rising thresholds for sparse rows, by adaptive gradient steps on the mean log loss."""
    n, levels = len(grades), int(grades.max())
    share = np.array([np.mean(grades > k) for k in range(levels)])
    theta = np.concatenate(([0.0] * width, _gaps(-np.log(np.clip(share, 1e-6, 1 - 1e-6) / np.clip(1 - share, 1e-6, 1)))))
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        slope = _slope(theta, rows, columns, values, grades, width, levels, n)
        slope[:width] += ridge * theta[:width]
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        theta -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return theta[:width], _thresholds(theta[width:])


def _gaps(thresholds: np.ndarray) -> np.ndarray:
    """First threshold and logs of the steps between the others, so that any numbers give rising thresholds."""
    return np.concatenate((thresholds[:1], np.log(np.maximum(np.diff(thresholds), 1e-3))))


def _thresholds(gaps: np.ndarray) -> np.ndarray:
    return np.cumsum(np.concatenate((gaps[:1], np.exp(gaps[1:]))))


def _slope(theta, rows, columns, values, grades, width, levels, n):
    """Gradient of the mean of -log P(grade)."""
    t = _thresholds(theta[width:])
    score = np.bincount(rows, theta[:width][columns] * values, n)
    over = 1 / (1 + np.exp(-np.clip(score[:, None] - t, -500, 500)))  # P(grade > k)
    padded = np.hstack([np.ones((n, 1)), over, np.zeros((n, 1))])
    own = np.arange(n)
    p = np.maximum(padded[own, grades] - padded[own, grades + 1], 1e-12)
    d = np.hstack([np.zeros((n, 1)), over * (1 - over), np.zeros((n, 1))])  # slope of P(grade > k) in the score
    by_score = -(d[own, grades] - d[own, grades + 1]) / p / n
    by_threshold = np.zeros((n, levels + 2))
    by_threshold[own, grades] += d[own, grades] / p / n
    by_threshold[own, grades + 1] -= d[own, grades + 1] / p / n
    per = by_threshold.sum(axis=0)[1:-1]
    tail = np.cumsum(per[::-1])[::-1]
    weights = np.bincount(columns, by_score[rows] * values, width)
    return np.concatenate((weights, tail[:1], tail[1:] * np.exp(theta[width + 1:])))


def _choose(positive: np.ndarray, negative: np.ndarray, n_pos: int, n_neg: int, keep: int) -> np.ndarray:
    """Features with the largest log-odds, damped where few texts hold them; only those that speak for toxicity."""
    odds = np.log((positive + 0.5) / (n_pos - positive + 0.5)) - np.log((negative + 0.5) / (n_neg - negative + 0.5))
    error = np.sqrt(1 / (positive + 0.5) + 1 / (negative + 0.5))
    z = np.where(positive >= LEAST, odds / error, 0.0)
    best = np.argsort(-z, kind="stable")[:keep]
    return np.sort(best[z[best] > 3])


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
        label_id: str = "doc_id", sample: int = 16_000, keep: int = 3_000) -> Model:
    """A model of the labelled documents that are not held out."""
    known = hashed_sample(labels.where(F.col(label_col).isNotNull() & F.col(label_id).isNotNull()).groupBy(
        F.col(label_id).alias("doc_id")).agg(F.max(label_col).cast("int").alias("label")).where(~held_out()), ["doc_id"], sample)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(known), "doc_id").select("label", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((2, SPACE + 1), np.int64)
        for batch in batches:
            for label, text in zip(batch.column(0), batch.column(1)):
                group = int(label.as_py() > 0)
                totals[group, np.unique(runs_of(text.as_py())[0])] += 1
                totals[group, SPACE] += 1
        at = np.flatnonzero(totals.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(totals[1, at]), pa.array(totals[0, at])], ["feature", "positive", "negative"])

    counts = texts.mapInArrow(count, "feature long, positive long, negative long").groupBy("feature").agg(
        F.sum("positive").alias("positive"), F.sum("negative").alias("negative"))
    counts = counts.where((F.col("positive") >= LEAST) | (F.col("feature") == SPACE)).toArrow()  # at most SPACE + 1 rows
    totals = np.zeros((2, SPACE + 1), np.int64)
    totals[:, counts["feature"].to_numpy()] = [counts["positive"].to_numpy(), counts["negative"].to_numpy()]
    n_pos, n_neg = totals[:, SPACE]
    nothing = Model(np.empty(0, np.int64), np.zeros(1), np.empty(0))
    if not n_pos:
        return nothing
    chosen = _choose(totals[0, :SPACE], totals[1, :SPACE], n_pos, n_neg, keep)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(chosen)
        for batch in batches:
            rows = [lookup.vector(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r[0] for r in rows], pa.list_(pa.int32())), pa.array([r[1] for r in rows], pa.list_(pa.int32())),
                 pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.int64())],
                ["label", "at", "counts", "words", "marked"])

    data = texts.mapInArrow(vectors, "label int, at array<int>, counts array<int>, words long, marked long").toArrow().combine_chunks()
    words, n, width = data["words"].to_numpy().astype(float), data.num_rows, len(chosen) + 1
    grades = _grades(data["label"].to_numpy().astype(np.int64), data["marked"].to_numpy().astype(float))
    sizes = pc.list_value_length(data["at"]).to_numpy()
    rows = np.concatenate((np.repeat(np.arange(n), sizes), np.arange(n)))
    columns = np.concatenate((pc.list_flatten(data["at"]).to_numpy(), np.full(n, width - 1))).astype(np.int64)
    values = np.concatenate((np.log1p(pc.list_flatten(data["counts"]).to_numpy().astype(float)), np.log1p(words)))
    weights, thresholds = fit_ordinal(rows, columns, values, grades, width)
    return Model(chosen, weights, thresholds)


def _grades(labels: np.ndarray, marked: np.ndarray) -> np.ndarray:
    """Grades from 0 without gaps; 0 and below is not toxic."""
    labels = np.maximum(labels, 0)
    if labels.max() <= 1:
        cuts = np.quantile(marked[labels > 0], (1 / 3, 2 / 3))
        labels = np.where(labels > 0, 1 + np.searchsorted(cuts, marked, "left"), 0)
    return np.unique(np.append(labels, 0), return_inverse=True)[1][:-1]


def severity(docs: DataFrame, model: Model, toxic_at: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, expected_severity, severity, toxic_probability, toxic`` for each row.

    ``toxic`` says that the probability of any grade above 0 is at least ``toxic_at``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(model.chosen)
        for batch in batches:
            over = np.array([model.exceed(lookup, t.as_py()) for t in batch.column(1)]).reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(over.sum(axis=1)), pa.array((over >= 0.5).sum(axis=1).astype(np.int32)),
                 pa.array(over[:, 0]), pa.array(over[:, 0] >= toxic_at)],
                schema.fieldNames())

    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = T.StructType([given.schema["doc_id"], T.StructField("expected_severity", T.DoubleType()), T.StructField("severity", T.IntegerType()),
                           T.StructField("toxic_probability", T.DoubleType()), T.StructField("toxic", T.BooleanType())])
    return given.mapInArrow(run, schema)
