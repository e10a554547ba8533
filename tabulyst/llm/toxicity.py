"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

A lexicon of words and of letter n-grams inside words is learned from labelled documents, by how much more of the toxic
ones hold an entry than of the others. Dense features of a text follow: lexicon densities and counts, hits near
second-person words, capitals, punctuation, obfuscated spellings and their hits once undone. Gradient-boosted trees judge
them, and an isotonic calibration turns margins into rates.

Everything is cross-fitted, so that all labels teach all three and no document is judged by what it taught: the labelled documents
are dealt into folds; each fold's features come from the lexicon of the others, each fold's margins for the calibration
from trees of the others. The last lexicon and trees see all folds. Scoring reads each text once; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulyst.llm.frames import Stages, pick
from tabulyst.llm.labelled import sample
from tabulyst.llm.textbytes import ALNUM, LOWER, NONSPACE, HashSet, Words, chunks, mix, split_words, utf8

#: Labelled documents at most, by label. They bound the lexicon too, which holds entries of several toxic ones.
SAMPLE = {1: 6_000, 0: 14_000}
FOLDS = 3
#: Least toxic documents and least z (signed root of the likelihood ratio) of an entry.
LEAST_DOCUMENTS, LEAST_Z = 3, 3.5
GRAM, NEAR = 6, 5
TREES, DEPTH, STEP = 60, 4, 0.15
THRESHOLD = 0.3

# Second-person words of the languages served, lower case.
SECOND_PERSON = "you your yours yourself ur u tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch sie tú ti usted ustedes vosotros".split()
# Characters that stand for letters in obfuscated spellings.
DISGUISES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}

_PLACES = mix(np.arange(5001, 5001 + GRAM, dtype=np.uint64)) | np.uint64(1)
_UNDONE = LOWER.copy()
for _from, _to in DISGUISES.items():
    _UNDONE[ord(_from)] = ord(_to)
_LETTER = np.array([65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])
_UPPER = np.array([65 <= b <= 90 for b in range(256)])
_MARK = np.array([33 <= b <= 47 or 58 <= b <= 64 or 91 <= b <= 96 or 123 <= b <= 126 for b in range(256)])
_SIGN = np.zeros(256, bool)
_SIGN[[ord(x) for x in DISGUISES] + [ord("*")]] = True


def _word_hash(word: str) -> int:
    data = np.frombuffer(word.encode(), np.uint8)
    return int(split_words(data, np.array([0, len(data)]), ALNUM).hashes[0])


_YOU = np.array(sorted({_word_hash(x) for x in SECOND_PERSON}), np.uint64)


def gram_hashes(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(first byte, hash) of every run of GRAM bytes inside a word."""
    lengths = words.ends - words.starts
    count = np.maximum(lengths - GRAM + 1, 0)
    total = int(count.sum())
    at = np.arange(total) + np.repeat(words.starts - (np.cumsum(count) - count), count)
    out = np.zeros(total, np.uint64)
    wide = words.raw.astype(np.uint64) + np.uint64(1)
    for i in range(GRAM):
        out += wide[at + i] * _PLACES[i]
    return at, mix(out)


def _entries_of(words: Words, row: int) -> np.ndarray:
    """Distinct word and gram hashes of one row."""
    low, high = words.rows[row], words.rows[row + 1]
    own = Words(words.raw, words.starts[low:high], words.ends[low:high], words.hashes[low:high], np.array([0, high - low]))
    return np.unique(np.concatenate([own.hashes, gram_hashes(own)[1]]))


def _document_counts(known: HashSet | None):
    """Rows (entry, n): documents of a chunk with each entry, of the known ones only if there is a set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for low, high in chunks(offsets):
                at = offsets[low]
                words = split_words(data[at : offsets[high]], offsets[low : high + 1] - at, ALNUM)
                found = [_entries_of(words, row) for row in range(high - low)]
                if known is not None:
                    found = [x[known.contains(x)] for x in found]
                entry, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(entry.view(np.int64)), pa.array(n)], names=["entry", "n"])

    return run


def learn_lexicon(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(sorted entry hashes, z of their log odds) from rows (text, label)."""
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    toxic, clean = counts.get(1, 0), counts.get(0, 0)
    if not toxic or not clean:
        return np.empty(0, np.uint64), np.empty(0)

    def counted(part: DataFrame, known: HashSet | None) -> DataFrame:
        return part.select("text").mapInArrow(_document_counts(known), "entry bigint, n bigint").groupBy("entry").agg(F.sum("n").alias("n"))

    often = counted(rows.where("label = 1"), None).where(F.col("n") >= LEAST_DOCUMENTS).toArrow()
    entry, pos = often.column("entry").to_numpy().view(np.uint64), often.column("n").to_numpy().astype(float)
    order = np.argsort(entry)
    entry, pos = entry[order], pos[order]
    seen = counted(rows.where("label = 0"), HashSet(entry)).toArrow()
    neg = np.zeros(len(entry))
    neg[np.searchsorted(entry, seen.column("entry").to_numpy().view(np.uint64))] = seen.column("n").to_numpy()
    z = _signed_root(pos, toxic, neg, clean)
    best = z >= LEAST_Z
    return entry[best], z[best]


def _signed_root(pos: np.ndarray, toxic: int, neg: np.ndarray, clean: int) -> np.ndarray:
    """Signed root of the likelihood ratio of two rates against one common rate; right for small counts too."""
    def information(hits, n, rate):
        miss = n - hits
        return hits * np.log(np.maximum(rate, 1e-300)) + miss * np.log(np.maximum(1 - rate, 1e-300))

    common = (pos + neg) / (toxic + clean)
    gained = information(pos, toxic, pos / toxic) + information(neg, clean, neg / clean) - information(pos, toxic, common) - information(neg, clean, common)
    return np.sign(pos / toxic - neg / clean) * np.sqrt(np.maximum(2 * gained, 0))


@dataclass
class Lexicon:
    known: HashSet
    weight: np.ndarray

    def weights(self, hashes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(hashes))
        hit = np.flatnonzero(self.known.contains(hashes))
        out[hit] = self.weight[np.searchsorted(self.known.values, hashes[hit])]
        return out


#: Names of the features, in order.
FEATURES = (
    "log_words", "word_hits", "word_rate", "word_weight", "word_best", "gram_words", "gram_rate", "gram_weight", "gram_best",
    "near_you", "you_rate", "capital_rate", "capital_words", "mark_rate", "exclamation_rate", "disguised_rate", "undone_hits",
)


def _per_row(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
    return total[rows[1:]] - total[rows[:-1]]


def _best_per_row(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    out = np.zeros(len(rows) - 1)
    filled = np.flatnonzero(rows[1:] > rows[:-1])
    if len(filled):
        out[filled] = np.maximum.reduceat(values, rows[filled])
    return out


def features(data: np.ndarray, offsets: np.ndarray, lexicon: Lexicon) -> np.ndarray:
    """Feature rows of a chunk of texts; a text without words has zeros but for its marks."""
    words = split_words(data, offsets, ALNUM)
    rows, n = words.rows, np.maximum(words.counts(), 1).astype(float)
    size = np.maximum(np.diff(offsets), 1).astype(float)
    weight = lexicon.weights(words.hashes)
    hit = weight > 0
    at, hashes = gram_hashes(words)
    gram = lexicon.weights(hashes)
    first = np.searchsorted(at, words.starts)
    gram_word = _best_per_row(gram, np.append(first, len(at)))
    either = hit | (gram_word > 0)
    you = np.isin(words.hashes, _YOU)
    # Second-person words within NEAR words of the same row.
    passed = np.concatenate(([0], np.cumsum(you)))
    row = np.repeat(np.arange(len(rows) - 1), words.counts())
    index = np.arange(len(you))
    low, high = np.maximum(index - NEAR, rows[:-1][row]), np.minimum(index + NEAR + 1, rows[1:][row])
    near = either & (passed[high] - passed[low] > 0)
    letters, capitals = _LETTER[data], _UPPER[data]
    capital_sums = np.concatenate(([0], np.cumsum(capitals)))
    all_capital = (words.ends - words.starts > 1) & (capital_sums[words.ends] - capital_sums[words.starts] == words.ends - words.starts)
    # Tokens with a sign or digit before a letter, read as the letters they stand for.
    tokens = split_words(data, offsets, NONSPACE)
    inner = _SIGN[data].copy()
    inner[:-1] &= letters[1:]
    inner[offsets[1:][offsets[1:] > offsets[:-1]] - 1] = False
    signs = np.concatenate(([0], np.cumsum(inner)))
    disguised = signs[tokens.ends] > signs[tokens.starts]
    undone = np.zeros(len(n))
    if disguised.any():
        plain = split_words(_UNDONE[data], offsets, _LETTER)
        undone = _per_row(lexicon.weights(plain.hashes) > 0, plain.rows)
    columns = (
        np.log1p(words.counts()), np.log1p(_per_row(hit, rows)), 100 * _per_row(hit, rows) / n, 100 * _per_row(weight, rows) / n, _best_per_row(weight, rows),
        np.log1p(_per_row(gram_word > 0, rows)), 100 * _per_row(gram_word > 0, rows) / n, 100 * _per_row(gram_word, rows) / n, _best_per_row(gram_word, rows),
        100 * _per_row(near, rows) / n, 100 * _per_row(you, rows) / n,
        _per_row(capitals, offsets) / np.maximum(_per_row(letters, offsets), 1), _per_row(all_capital, rows) / n,
        _per_row(_MARK[data], offsets) / size, _per_row(data == 33, offsets) / size,
        100 * _per_row(disguised, tokens.rows) / np.maximum(tokens.counts(), 1), np.log1p(undone),
    )
    return np.stack(columns, 1).astype(np.float64)


def _with_features(df: DataFrame, lexicon: tuple[np.ndarray, np.ndarray], text: str) -> DataFrame:
    """df without its text, with an array of features."""
    known = df.sparkSession.sparkContext.broadcast(Lexicon(HashSet(lexicon[0]), lexicon[1]))
    kept = [x for x in df.columns if x != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(text))
            for low, high in chunks(offsets):
                at = offsets[low]
                found = features(data[at : offsets[high]], offsets[low : high + 1] - at, known.value)
                lists = pa.ListArray.from_arrays(np.arange(0, found.size + 1, found.shape[1], dtype=np.int32), pa.array(found.ravel()))
                columns = [batch.column(x).slice(low, high - low) for x in kept]
                yield pa.RecordBatch.from_arrays([*columns, lists], names=[*kept, "features"])

    fields = ", ".join(f"{x.name} {x.dataType.simpleString()}" for x in df.select(*kept).schema)
    return df.mapInArrow(run, f"{fields}, features array<double>")


@dataclass
class Model:
    """Learned lexicon, trees and calibration; constant `rate` where the labels hold one class or none."""

    lexicon: tuple[np.ndarray, np.ndarray]
    trees: object | None
    calibration: object | None
    rate: float


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", modulus: int = 4, held_out: int = 2, bounds: dict[int, int] = SAMPLE) -> Model:
    """Learn from labelled documents whose crc32 of the id modulo `modulus` is not `held_out`."""
    stages = Stages(docs.sparkSession)
    rows = sample(docs, labels, label, modulus, held_out, bounds).withColumn("fold", F.floor(F.col("draw") * FOLDS).cast("int"))
    rows = stages.keep(rows.select("text", F.col("label").cast("double").alias("label"), "weight", "fold"), "sample")
    rate = rows.agg(F.sum(F.col("label") * F.col("weight")) / F.sum("weight")).first()[0]
    lexicon, known = learn_lexicon(rows), None
    for fold in range(FOLDS):
        own = _with_features(rows.where(F.col("fold") == fold), learn_lexicon(rows.where(F.col("fold") != fold)), "text")
        known = own if known is None else known.union(own)
    # As bounded as the sample; four tasks fit it.
    known = stages.keep(known.withColumn("x", array_to_vector("features")).drop("features").coalesce(4), "features")
    both = known.groupBy("fold").agg(F.countDistinct("label").alias("n")).where("n = 2").count()
    if both < FOLDS:
        return Model(lexicon, None, None, float(rate or 0.0))
    margins = None
    for fold in range(FOLDS):
        own = _trees(known.where(F.col("fold") != fold)).transform(known.where(F.col("fold") == fold))
        margins = own if margins is None else margins.union(own)
    margins = margins.select(vector_to_array("probability")[1].alias("margin"), "label", "weight")
    calibration = IsotonicRegression(featuresCol="margin", labelCol="label", weightCol="weight").fit(margins)
    return Model(lexicon, _trees(known), calibration, float(rate))


def _trees(known: DataFrame):
    return GBTClassifier(featuresCol="x", labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, subsamplingRate=0.8, seed=7, maxBins=64, minInstancesPerNode=5).fit(known)


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, score (0 to 1), predicted (1 from `threshold` on).

    Null texts count as empty ones and are scored too. Repeated rows are each scored. Extra columns are ignored.
    Without labels of both classes in every fold every score is the labels' rate.
    """
    rows = _with_features(pick(docs, {"doc_id": doc_id, "text": text}), model.lexicon, "text")
    if model.trees is None:
        rows = rows.withColumn("score", F.lit(model.rate))
    else:
        rows = model.trees.transform(rows.withColumn("x", array_to_vector("features"))).withColumn("margin", vector_to_array("probability")[1])
        rows = model.calibration.transform(rows.select("doc_id", "margin")).withColumn("score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), "prediction")))
    return rows.select("doc_id", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
