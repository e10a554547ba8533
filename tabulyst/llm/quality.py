"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A document's features are its hashed words (log counts, scaled to length one) and binned statistics of
its structure and size. The machine adds to a linear part the interaction of every pair of
features by low-rank factors; all pairs are scored in time linear in the features, as half of the
squared sum less the sum of squares, per factor. It is fitted on a bounded sample and broadcast;
scoring reads each text once and shuffles nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import FMClassifier
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tabulyst.llm.frames import Stages, pick
from tabulyst.llm.labelled import sample
from tabulyst.llm.textbytes import ALNUM, NONSPACE, chunks, split_words, utf8

#: Labelled documents at most, by label.
SAMPLE = {1: 8_000, 0: 8_000}
#: Buckets of hashed words, factors, rounds, step and regularisation of the fit.
BUCKETS, FACTORS, ROUNDS, STEP, REGULAR = 1 << 13, 8, 80, 0.05, 1e-2
THRESHOLD = 0.3
BINS = 8
_CLASSES = {
    "letters": np.array([65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)]),
    "capitals": np.array([65 <= b <= 90 for b in range(256)]),
    "digits": np.array([48 <= b <= 57 for b in range(256)]),
    "ends": np.array([b in b".!?" for b in range(256)]),
    "symbols": np.array([b in b"#$%&*+/<=>@[]\\^_{|}~" for b in range(256)]),
    "shouts": np.array([b == 33 for b in range(256)]),
    "lines": np.array([b == 10 for b in range(256)]),
}
#: Statistics with the bounds of their bins; below the first is bin 0.
STATISTICS = {
    "letters": (0.3, 0.5, 0.6, 0.7, 0.75, 0.8, 0.85), "capitals": (0.002, 0.01, 0.02, 0.05, 0.1, 0.3, 0.6),
    "digits": (0.001, 0.005, 0.01, 0.02, 0.05, 0.1, 0.3), "ends": (0.001, 0.005, 0.01, 0.02, 0.04, 0.08, 0.15),
    "symbols": (0.001, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2), "shouts": (0.001, 0.002, 0.005, 0.01, 0.02, 0.05, 0.1),
    "lines": (0.0005, 0.001, 0.002, 0.005, 0.01, 0.02, 0.05), "token_length": (3, 4, 5, 6, 7, 9, 12),
    "distinct": (0.05, 0.1, 0.2, 0.35, 0.5, 0.7, 0.9), "most_frequent": (0.03, 0.05, 0.08, 0.12, 0.2, 0.4, 0.7),
    "same_neighbours": (0.01, 0.03, 0.1, 0.2, 0.4, 0.6, 0.8), "wordless_tokens": (0.01, 0.03, 0.1, 0.2, 0.4, 0.6, 0.8),
    "words": (5, 15, 40, 100, 300, 1000, 4000), "declared_length": (30, 100, 300, 1000, 3000, 10000, 40000),
}
SIZE = BUCKETS + BINS * len(STATISTICS)


def _per_row(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
    return total[rows[1:]] - total[rows[:-1]]


def features(data: np.ndarray, offsets: np.ndarray, declared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first entry of each row, feature, value), features ascending within a row."""
    words, tokens = split_words(data, offsets, ALNUM), split_words(data, offsets, NONSPACE)
    n_rows, size = len(offsets) - 1, np.maximum(np.diff(offsets), 1)
    count = words.counts()
    row = np.repeat(np.arange(n_rows), count)
    bucket = (words.hashes >> np.uint64(51)).astype(np.int64)
    cell, n = np.unique(row * BUCKETS + bucket, return_counts=True)
    cell_row, value = cell // BUCKETS, np.log1p(n)
    bounds = np.searchsorted(cell_row, np.arange(n_rows + 1))
    value /= np.sqrt(np.maximum(_per_row(value**2, bounds), 1e-12))[cell_row]

    share = {name: _per_row(known[data], offsets) / size for name, known in _CLASSES.items()}
    n_tokens, some = np.maximum(tokens.counts(), 1), np.maximum(count, 1)
    share["token_length"] = _per_row(tokens.ends - tokens.starts, tokens.rows) / n_tokens
    share["distinct"] = np.diff(bounds) / some
    top = np.zeros(n_rows)
    filled = np.flatnonzero(np.diff(bounds))
    if len(filled):
        top[filled] = np.maximum.reduceat(n, bounds[filled])
    share["most_frequent"] = top / some
    same = np.zeros(len(words.hashes))
    same[1:] = (words.hashes[1:] == words.hashes[:-1]) & (row[1:] == row[:-1])
    share["same_neighbours"] = _per_row(same, words.rows) / some
    letters = np.concatenate(([0], np.cumsum(ALNUM[data])))
    share["wordless_tokens"] = _per_row(letters[tokens.ends] == letters[tokens.starts], tokens.rows) / n_tokens
    share["words"], share["declared_length"] = count, declared
    binned = np.stack([BUCKETS + BINS * i + np.searchsorted(edges, share[name], "right") for i, (name, edges) in enumerate(STATISTICS.items())], 1)

    k = len(STATISTICS)
    starts = bounds + k * np.arange(n_rows + 1)
    index, values = np.empty(starts[-1], np.int64), np.empty(starts[-1])
    is_word = np.ones(starts[-1], bool)
    last = (starts[1:, None] - k + np.arange(k)).ravel()
    is_word[last] = False
    index[is_word], values[is_word] = cell % BUCKETS, value
    index[last], values[last] = binned.ravel(), 2 / np.sqrt(k)
    return starts, index, values


@dataclass
class Model:
    """Intercept, weights (feature), factors (feature, factor); without weights the intercept is every score."""

    intercept: float
    weights: np.ndarray | None
    factors: np.ndarray | None
    shift: float = 0.0

    def score(self, starts: np.ndarray, index: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Probability of each row, by the sum-of-squares identity."""
        if self.weights is None:
            return np.full(len(starts) - 1, self.intercept)
        margin = self.intercept + _per_row(self.weights[index] * values, starts)
        for factor in self.factors.T:
            part = factor[index] * values
            margin += 0.5 * (_per_row(part, starts) ** 2 - _per_row(part**2, starts))
        return 1 / (1 + np.exp(-np.clip(margin + self.shift, -40, 40)))


def _mapped(df: DataFrame, schema: str, make, kept: list[str]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            declared = batch.column("declared").fill_null(0).to_numpy(zero_copy_only=False)
            for low, high in chunks(offsets):
                at = offsets[low]
                found = make(features(data[at : offsets[high]], offsets[low : high + 1] - at, declared[low:high]))
                columns = [batch.column(x).slice(low, high - low) for x in kept]
                yield pa.RecordBatch.from_arrays([*columns, *found.values()], names=[*kept, *found])

    return df.mapInArrow(run, schema)


def _vectors(found) -> dict[str, pa.Array]:
    """Sparse vectors as the struct that Spark stores them in: kind 0, size, indices, values."""
    starts, index, values = found
    starts, n = pa.array(starts.astype(np.int32)), len(starts) - 1
    lists = [pa.ListArray.from_arrays(starts, pa.array(x)) for x in (index.astype(np.int32), values)]
    return {"x": pa.StructArray.from_arrays([pa.array(np.zeros(n, np.int8)), pa.array(np.full(n, SIZE, np.int32)), *lists], names=["type", "size", "indices", "values"])}


def _plain(docs: DataFrame, doc_id: str, text: str, length: str | None) -> DataFrame:
    """doc_id, text and the declared length; without such a column the text's own."""
    names = {"doc_id": doc_id, "text": text} | ({"declared": length} if length else {})
    plain = pick(docs, names)
    return plain if length else plain.withColumn("declared", F.length("text").cast("bigint"))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", modulus: int = 5, held_out: int = 0, bounds: dict[int, int] = SAMPLE, doc_id: str = "doc_id", text: str = "text", length: str | None = "n_chars") -> Model:
    """Learn from labelled documents whose crc32 of the id modulo `modulus` is not `held_out`.

    Labels drawn unevenly are put right by a shift of the log odds.
    """
    stages = Stages(docs.sparkSession)
    rows = sample(_plain(docs, doc_id, text, length), labels, label, modulus, held_out, bounds, more=("declared",))
    # The sample is written by as many tasks as read the corpus; what follows is as bounded as the sample.
    rows = stages.keep(rows.select(F.col("label").cast("double").alias("label"), "weight", "text", "declared"), "sample")
    found = _mapped(rows, StructType([*rows.schema.fields[:2], StructField("x", VectorUDT())]), _vectors, ["label", "weight"])
    found = stages.keep(found.coalesce(4), "features")
    seen = {r["label"]: (r["n"], r["w"]) for r in found.groupBy("label").agg(F.count("*").alias("n"), F.sum("weight").alias("w")).collect()}
    if set(seen) != {0, 1}:
        return Model(1.0 if 1 in seen else 0.0, None, None)
    machine = FMClassifier(featuresCol="x", labelCol="label", factorSize=FACTORS, maxIter=ROUNDS, stepSize=STEP, regParam=REGULAR, initStd=0.05, seed=7)
    fitted = machine.fit(found)
    shift = np.log(seen[1][1] / seen[0][1]) - np.log(seen[1][0] / seen[0][0])
    return Model(float(fitted.intercept), fitted.linear.toArray(), fitted.factors.toArray(), float(shift))


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", length: str | None = "n_chars", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, score (0 to 1), predicted (1 from `threshold` on).

    Null texts count as empty ones, null lengths as 0; both are scored. Repeated rows are each scored. Extra columns are
    ignored. Without labels of both classes every score is 0 or 1 as the labels have it.
    """
    known = docs.sparkSession.sparkContext.broadcast(model)
    plain = _plain(docs, doc_id, text, length)
    kind = plain.schema["doc_id"].dataType.simpleString()
    rows = _mapped(plain, f"doc_id {kind}, score double", lambda x: {"score": pa.array(known.value.score(*x))}, ["doc_id"])
    return rows.select("doc_id", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
