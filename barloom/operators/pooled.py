"""A ridge regression per code, pooled towards the one of all codes (F1, the code effect).

The coefficients of a code minimise ``sum (y - x b)**2 + ridge * |b|**2 + pooling * |b - b0|**2``, where ``b0`` is the ridge
regression of all codes. Without pooling every code stands alone; with much of it a code with few rows takes over what
all codes have in common. Rows only enter through sums of products, which tasks add up per code before the shuffle:
what moves is one matrix for each code of a task, however many rows a code has.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.operators.series import DAILY, Series, attach
from barloom.session import stage

#: codes whose sums a task holds at a time, as numbers
HELD = 1 << 22


def _packed(sums: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.string()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["code", "sums"])


def products(rows: DataFrame, features: Sequence[str], target: str, key: str = "code") -> DataFrame:
    """``code, sums``: the packed matrix of sums of products of (1, features, target) over a code's complete rows, in parts."""
    width = len(features) + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            codes = batch.column(0).dictionary_encode()
            z = np.column_stack([np.ones(batch.num_rows), *[c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]]])
            at, names = codes.indices.to_numpy(), codes.dictionary.to_pylist()
            order = np.argsort(at, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(at[order])) + 1):
                if len(part):
                    name = names[at[part[0]]]
                    held[name] = held.get(name, 0.0) + z[part].T @ z[part]
            if len(held) * width * width > HELD:
                yield _packed(held)
                held = {}
        if held:
            yield _packed(held)

    columns = [F.col(c).cast("double").alias(c) for c in (*features, target)]
    return rows.select(F.col(key).cast("string").alias("code"), *columns).dropna().mapInArrow(run, "code string, sums binary")


def _summed(parts: DataFrame) -> DataFrame:
    """One matrix per code, added up as a stream: a task holds one matrix at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, None
        for batch in batches:
            for code, sums in zip(*(c.to_pylist() for c in batch.columns)):
                sums = np.frombuffer(sums, np.float64)
                if code != now:
                    if now is not None:
                        yield _packed({now: total})
                    now, total = code, sums.copy()
                else:
                    total += sums
        if now is not None:
            yield _packed({now: total})

    return parts.repartition("code").sortWithinPartitions("code").mapInArrow(run, "code string, sums binary")


def _solved(matrix: np.ndarray, width: int, ridge: float, pooling: float, towards: np.ndarray | None) -> np.ndarray:
    m = matrix.reshape(width, width)
    left, right = m[:-1, :-1] + (ridge + pooling) * np.eye(width - 1), m[:-1, -1]
    return np.linalg.solve(left, right if towards is None else right + pooling * towards)


def fit_pooled(
    rows: DataFrame, features: Sequence[str], target: str = "target_scaled", s: Series = DAILY, ridge: float = 1.0, pooling: float = 0.0,
) -> DataFrame:
    """A row per code: the key, ``n`` rows, and ``coefficients`` (intercept first, penalised like the others)."""
    width = len(features) + 2
    if ridge + pooling <= 0:
        raise ValueError("ridge or pooling must be positive")
    sums = stage(_summed(products(rows, features, target, s.key)), "products")

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width * width)
        for batch in batches:
            for x in batch.column(0).to_pylist():
                total += np.frombuffer(x, np.float64)
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["total"])

    whole = sums.select("sums").mapInArrow(folded, "total array<double>").select(F.posexplode("total").alias("at", "x"))
    whole = whole.groupBy("at").agg(F.sum("x").alias("x")).collect()  # width ** 2 numbers
    total = np.zeros(width * width)
    for r in whole:
        total[r["at"]] = r["x"]
    common = _solved(total, width, ridge, 0.0, None) if ridge > 0 else np.linalg.lstsq(
        total.reshape(width, width)[:-1, :-1], total.reshape(width, width)[:-1, -1], rcond=None)[0]

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrices = [np.frombuffer(x, np.float64) for x in batch.column(1).to_pylist()]
            found = [_solved(m, width, ridge, pooling, common).tolist() for m in matrices]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([round(m[0]) for m in matrices], pa.int64()),
                                              pa.array(found, pa.list_(pa.float64()))], ["code", "n", "coefficients"])

    return sums.mapInArrow(solve, "code string, n long, coefficients array<double>").withColumnRenamed("code", s.key)


def predict_pooled(
    rows: DataFrame, coefficients: DataFrame, features: Sequence[str], s: Series = DAILY, name: str = "prediction",
) -> DataFrame:
    """``rows`` with the prediction of their code's regression; NULL for a code that has none or a NULL feature."""
    joined = attach(rows, s, coefficients.select(s.key, "coefficients"), "left")
    value = F.get("coefficients", F.lit(0))
    for i, c in enumerate(features, 1):
        value = value + F.get("coefficients", F.lit(i)) * F.col(c)
    return joined.withColumn(name, value).drop("coefficients")
