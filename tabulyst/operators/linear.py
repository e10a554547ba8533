"""Linear families, from sufficient statistics and on MLlib, with penalties on the scale of the usual closed forms."""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Task functions travel by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NORMAL_LIMIT = 4096  # fixed value: widest design the normal-equation solver takes


def penalised(
    df: DataFrame, width: int, l1: float = 0.0, l2: float = 0.0, max_iter: int = 10_000
) -> LinearRegressionModel:
    """Minimise mean squared error / 2 + l1 |w| + l2 |w|^2 / 2 over df(features, label).

    MLlib divides the squared part of its penalty by the label's deviation, so l2 is multiplied by it.
    """
    spread = df.agg(F.stddev_pop("label").alias("s")).first()["s"] or 1.0 if l2 else 1.0
    total = l1 + l2 * spread
    return LinearRegression(
        solver="normal" if width <= NORMAL_LIMIT else "auto",
        standardization=False,
        regParam=total,
        elasticNetParam=l1 / total if total else 0.0,
        maxIter=max_iter,
        tol=1e-10,
    ).fit(df)


def ols(df: DataFrame, width: int) -> LinearRegressionModel:
    return penalised(df, width)


def ridge(df: DataFrame, width: int, rows: int, alpha: float = 10.0) -> LinearRegressionModel:
    """|y - Xw|^2 + alpha |w|^2."""
    return penalised(df, width, l2=alpha / rows)


def lasso(df: DataFrame, width: int, alpha: float = 0.001, max_iter: int = 10_000):
    """|y - Xw|^2 / 2n + alpha |w|."""
    return penalised(df, width, l1=alpha, max_iter=max_iter)


def elasticnet(
    df: DataFrame, width: int, alpha: float = 0.001, l1_ratio: float = 0.5, max_iter: int = 10_000
):
    return penalised(df, width, alpha * l1_ratio, alpha * (1.0 - l1_ratio), max_iter)


def univariate_ols(df: DataFrame, x: str, y: str) -> DataFrame:
    """(rows, slope, intercept) in one aggregate, rows with a null side left out."""
    return df.agg(
        F.regr_count(y, x).alias("rows"),
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
    )


@dataclass
class Moments:
    """Sufficient statistics of a design: n rows, means, scales (1 / deviation, 0 for a constant column), and of the
    centred and scaled columns z and the centred label y the products z'z and z'y, both divided by n."""

    n: int
    means: np.ndarray
    scales: np.ndarray
    label: float
    gram: np.ndarray
    cross: np.ndarray


def _products(known, width: int):
    """Per task, a row for each column of [z, y]: its products with all of them, summed over the task's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        means, scales, label = known.value
        total = np.zeros((width + 1, width + 1))
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(batch), width)
            both = np.column_stack([(x - means) * scales, batch.column("label").to_numpy() - label])
            total += both.T @ both
        lists = pa.ListArray.from_arrays(np.arange(0, total.size + 1, width + 1, dtype=np.int32), pa.array(total.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width + 1, dtype=np.int32)), lists], names=["i", "products"])

    return run


def moments(df: DataFrame, width: int, rows: int) -> Moments:
    """Two passes over (features, label): means and deviations, then products about them, added up row by row of the matrix."""
    if width > NORMAL_LIMIT:
        raise ValueError(f"Products are counted for up to {NORMAL_LIMIT} columns; there are {width}")
    first = df.agg(Summarizer.mean(F.col("features")).alias("m"), Summarizer.std(F.col("features")).alias("s"), F.avg("label").alias("y")).first()
    spread = first["s"].toArray() * np.sqrt((rows - 1) / rows)
    means, scales = first["m"].toArray(), np.array([1.0 / s if s > 0 else 0.0 for s in spread])
    known = df.sparkSession.sparkContext.broadcast((means, scales, first["y"]))
    found = df.select(vector_to_array("features").alias("x"), F.col("label").cast("double").alias("label")).mapInArrow(_products(known, width), "i int, products array<double>")
    summed = found.groupBy("i").agg(Summarizer.sum(array_to_vector("products")).alias("p")).orderBy("i").collect()
    whole = np.stack([r["p"].toArray() for r in summed]) / rows
    return Moments(rows, means, scales, first["y"], whole[:width, :width], whole[:width, width])


def solve(found: Moments, settings: list[tuple[float, float]], tolerance: float = 1e-13, most: int = 100_000) -> np.ndarray:
    """Weights (setting, column) of the scaled columns that minimise mean squared error / 2 + l1 |w| + l2 |w|^2 / 2.

    All settings without l1 share one decomposition; the others go by coordinate descent on the products, from the
    strongest penalty on, each from the weights before.
    """
    out = np.zeros((len(settings), len(found.cross)))
    smooth = [i for i, (l1, _) in enumerate(settings) if not l1]
    if smooth:
        values, vectors = np.linalg.eigh(found.gram)
        turned = vectors.T @ found.cross
        for i in smooth:
            damped = np.maximum(values, 0) + settings[i][1]
            floor = 1e-12 * max(damped.max(initial=0.0), 1e-300)
            out[i] = vectors @ np.where(damped > floor, turned / np.maximum(damped, floor), 0.0)
    w = np.zeros(len(found.cross))
    for i in sorted(set(range(len(settings))) - set(smooth), key=lambda i: -settings[i][0]):
        l1, l2 = settings[i]
        rest = found.cross - found.gram @ w
        for _ in range(most):
            moved = 0.0
            for j in range(len(w)):
                own = found.gram[j, j]
                if own + l2 <= 0:
                    continue
                pull = rest[j] + own * w[j]
                new = np.sign(pull) * max(abs(pull) - l1, 0.0) / (own + l2)
                if new != w[j]:
                    rest -= found.gram[:, j] * (new - w[j])
                    moved = max(moved, abs(new - w[j]))
                    w[j] = new
            if moved <= tolerance * max(1.0, np.abs(w).max(initial=0.0)):
                break
        out[i] = w
    return out


def penalties(family: str, rows: int, alpha: float | None = None, l1_ratio: float = 0.5) -> tuple[float, float]:
    """(l1, l2) of a family's setting, as the single fits take them."""
    if family == "linear":
        return 0.0, 0.0
    if family == "ridge":
        return 0.0, (10.0 if alpha is None else alpha) / rows
    alpha = 0.001 if alpha is None else alpha
    return (alpha, 0.0) if family == "lasso" else (alpha * l1_ratio, alpha * (1.0 - l1_ratio))


def _dot(features: str, weights: np.ndarray, start: float) -> Column:
    products = F.zip_with(vector_to_array(features), F.lit([float(v) for v in weights]), lambda a, b: a * b)
    return F.aggregate(products, F.lit(float(start)), lambda total, v: total + v)


def predictions(found: Moments, weights: np.ndarray, features: str = "features") -> Column:
    """Array of predictions, one for each row of weights."""
    own = weights * found.scales
    return F.array(*[_dot(features, w, b) for w, b in zip(own, found.label - own @ found.means)])


class LinearModel:
    """Weights of the columns and an intercept, solved from moments."""

    def __init__(self, coefficients: np.ndarray, intercept: float):
        self.coefficients, self.intercept, self.column = coefficients, intercept, "prediction"

    @classmethod
    def solved(cls, found: Moments, l1: float, l2: float) -> LinearModel:
        weights = solve(found, [(l1, l2)])[0] * found.scales
        return cls(weights, float(found.label - weights @ found.means))

    def setPredictionCol(self, name: str) -> LinearModel:
        self.column = name
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.column, _dot("features", self.coefficients, self.intercept))

    def write(self) -> LinearModel:
        return self

    def save(self, path: str) -> None:
        state = json.dumps({"coefficients": self.coefficients.tolist(), "intercept": self.intercept})
        SparkSession.getActiveSession().createDataFrame([(state,)], "value string").coalesce(1).write.text(path)

    @classmethod
    def load(cls, path: str) -> LinearModel:
        state = json.loads(SparkSession.getActiveSession().read.text(path, wholetext=True).first()["value"])
        return cls(np.array(state["coefficients"], float), state["intercept"])
