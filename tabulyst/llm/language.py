"""Language identification as a mixture of languages per document.

Learning counts hashed letter n-grams of whole texts per language. A word's likelihood under a
language is that of its n-grams. Per document, expectation-maximisation estimates which share of its
words each language of a set has, and the set is selected forward by penalised likelihood: the
language that promises most is added while the gain exceeds half a log of the number of words. All
documents of a chunk go through the rounds together as NumPy arrays.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulyst.llm.frames import bounded_batches, crc_class, id_key, pick
from tabulyst.llm.textbytes import LOWER, chunks, utf8

UNKNOWN = "und"
#: Labelled documents fitted per language: a sample by a hash of the id; fewer are all used.
SAMPLE = 4_000
#: Bytes of an n-gram, and n-gram buckets at most; with many languages fewer, for MODEL_BYTES in all.
NGRAM, BUCKETS, MODEL_BYTES = 3, 1 << 16, 16 << 20
SMOOTHING = 0.5
#: Rounds of expectation and maximisation go on until no share changes by more.
TOLERANCE = 1e-3
_LETTER = regex.compile(r"\p{L}")
#: Letters of words: ASCII letters and every byte of other scripts.
LETTERS = np.array([65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])


def letter_grams(data: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each n-gram, first n-gram of each word, first word of each row, both with an end entry).

    A word is a run of letters with one blank before and after; every letter ends one n-gram.
    """
    within = LETTERS[data]
    raw = np.where(within, LOWER[data], np.uint8(32)).astype(np.uint32)
    new = within.copy()
    new[1:] &= ~within[:-1]
    heads = offsets[:-1][offsets[1:] > offsets[:-1]]
    new[heads] = within[heads]
    # One byte back and two back, blank beyond the start of the word.
    back = np.concatenate(([32], raw[:-1])).astype(np.uint32)
    back[new] = 32
    far = np.concatenate(([32, 32], raw[:-2]))[: len(raw)].astype(np.uint32)
    far[new] = 32
    after = np.flatnonzero(new) + 1
    far[after[after < len(raw)]] = 32
    code = (far << np.uint32(16)) | (back << np.uint32(8)) | raw
    code = (code * np.uint32(2654435761)) >> np.uint32(33 - buckets.bit_length())
    at = np.flatnonzero(within)
    starts = np.flatnonzero(new)
    rows = np.searchsorted(starts, offsets)
    return code[at], np.append(np.searchsorted(at, starts), len(at)), rows


@dataclass
class Model:
    """Log probabilities (language, bucket) of n-grams."""

    languages: list[str]
    table: np.ndarray
    buckets: int


def _counts(languages: list[str], buckets: int):
    number = {name: i for i, name in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(languages) * buckets, np.int64)
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            of = np.array([number[x] for x in batch.column("lang").to_pylist()], np.int64)
            for low, high in chunks(offsets):
                at = offsets[low]
                grams, words, rows = letter_grams(data[at : offsets[high]], offsets[low : high + 1] - at, buckets)
                per_row = np.diff(words[rows])
                total += np.bincount(grams + np.repeat(of[low:high], per_row) * buckets, minlength=len(total))
        cell = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(total[cell])], names=["cell", "n"])

    return run


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", sample: int = SAMPLE) -> Model:
    """n-gram model of every language of labelled documents; rows without text or label teach nothing.

    At most about `sample` documents of a language are read, chosen by a hash of their id; texts are
    read whole. Languages are compared exactly; more than the model's bound of them are refused.
    """
    rows = pick(docs, {"doc_id": doc_id, "text": text, "lang": lang}).where("text IS NOT NULL AND lang IS NOT NULL")
    found = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(found)
    if len(languages) * 4096 * 4 > MODEL_BYTES:
        raise ValueError(f"{len(languages)} languages exceed the model's bound")
    buckets = BUCKETS
    while buckets * max(1, len(languages)) * 4 > MODEL_BYTES:
        buckets //= 2
    if not languages:
        return Model([], np.zeros((0, buckets), np.float32), buckets)
    share = F.lit(sample) / F.create_map(*[x for k, n in found.items() for x in (F.lit(k), F.lit(n))])[F.col("lang")]
    draw = F.pmod(F.xxhash64(id_key("doc_id"), F.lit("fit")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    cells = rows.where(draw < share).select("lang", "text").mapInArrow(_counts(languages, buckets), "cell bigint, n bigint")
    counted = cells.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(len(languages) * buckets)
    table[counted.column("cell").to_numpy()] = counted.column("n").to_numpy()
    table = table.reshape(len(languages), buckets) + SMOOTHING
    return Model(languages, np.log(table / table.sum(1, keepdims=True)).astype(np.float32), buckets)


def _sum_rows(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sums of values[rows[i]:rows[i + 1]], empty ranges as 0."""
    total = np.concatenate((np.zeros((1, *values.shape[1:])), np.cumsum(values, 0, dtype=np.float64)))
    return total[rows[1:]] - total[rows[:-1]]


def mixtures(likely: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(shares (row, language), log likelihood per row) of the selected language sets.

    likely: log likelihood (word, language); rows: first word of each row. A row without words has
    no share.
    """
    n, k = len(rows) - 1, likely.shape[1]
    words = np.diff(rows)
    top = likely.max(1, keepdims=True)
    scaled = np.exp(np.maximum(likely - top, -60))
    whole = _sum_rows(likely, rows)
    shares, best = np.zeros((n, k)), whole.argmax(1)
    filled = np.flatnonzero(words)
    shares[filled, best[filled]] = 1
    value = whole[np.arange(n), best] - _sum_rows(top[:, 0], rows)
    open_ = filled
    for _ in range(k - 1):
        # Words of the rows still open, one after another.
        sizes = words[open_]
        bounds = np.concatenate(([0], np.cumsum(sizes)))
        at = np.arange(bounds[-1]) + np.repeat(rows[open_] - bounds[:-1], sizes)
        own, part = np.repeat(np.arange(len(open_)), sizes), scaled[at]
        share = shares[open_]
        mixed = np.maximum((part * share[own]).sum(1), 1e-300)
        slope = _sum_rows(part / mixed[:, None], bounds)
        slope[share > 0] = -np.inf
        new = slope.argmax(1)
        promising = np.flatnonzero(slope[np.arange(len(open_)), new] > sizes)
        # Only a language with a rising likelihood can gain anything.
        if not len(promising):
            break
        keep = np.zeros(len(open_), bool)
        keep[promising] = True
        pick_words = keep[own]
        open_, share, new, sizes = open_[keep], share[keep], new[keep], sizes[keep]
        bounds = np.concatenate(([0], np.cumsum(sizes)))
        own, part = np.repeat(np.arange(len(open_)), sizes), part[pick_words]
        share = share * 0.8
        share[np.arange(len(open_)), new] = 0.2
        if len(open_) and (share > 0).sum(1).max() == 2:  # the two columns that matter are all
            pair = np.argsort(-share, 1)[:, :2]
            two, weight = np.take_along_axis(part, pair[own], 1), np.take_along_axis(share, pair, 1)
            weight = _maximise(two, weight, own, bounds)
            share = np.zeros_like(share)
            np.put_along_axis(share, pair, weight, 1)
        else:
            share = _maximise(part, share, own, bounds)
        reached = _sum_rows(np.log(np.maximum((part * share[own]).sum(1), 1e-300)), bounds)
        better = reached - value[open_] > 0.5 * np.log(np.maximum(sizes, 2))
        open_, share, reached = open_[better], share[better], reached[better]
        shares[open_], value[open_] = share, reached
        if not len(open_):
            break
    return shares, value


def _maximise(part: np.ndarray, share: np.ndarray, own: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Shares after rounds of expectation (each word's languages) and maximisation (their mean), until none changes by TOLERANCE."""
    sizes = np.maximum(np.diff(bounds), 1)[:, None]
    changed = np.inf
    while changed > TOLERANCE:
        joint = part * share[own]
        joint /= np.maximum(joint.sum(1, keepdims=True), 1e-300)
        before, share = share, _sum_rows(joint, bounds) / sizes
        changed = np.abs(share - before).max(initial=0.0)
    return share


def _predict(broadcast, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = broadcast.value
        for batch in batches:
            data, offsets = utf8(batch.column(text))
            names, scores, sets = [], [], []
            for low, high in chunks(offsets):
                at = offsets[low]
                found = predict_chunk(model, data[at : offsets[high]], offsets[low : high + 1] - at)
                for out, values in zip((names, scores, sets), found):
                    out += values
            columns = batch.columns + [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(sets, pa.map_(pa.string(), pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "_lang", "_score", "_mixture"])

    return run


def predict_chunk(model: Model, data: np.ndarray, offsets: np.ndarray) -> tuple[list, list, list]:
    """(language, share, mixture) of each row of a chunk."""
    n = len(offsets) - 1
    names, scores, sets = [UNKNOWN] * n, [0.0] * n, [[] for _ in range(n)]
    if not model.languages:
        return names, scores, sets
    grams, words, rows = letter_grams(data, offsets, model.buckets)
    likely = np.empty((len(words) - 1, len(model.languages)))
    for i, own in enumerate(model.table) if len(likely) else ():
        likely[:, i] = np.add.reduceat(own[grams], words[:-1])
    shares, _ = mixtures(likely, rows)
    for row in np.flatnonzero(np.diff(rows)).tolist():
        if not _LETTER.search(data[offsets[row] : offsets[row + 1]].tobytes().decode()):
            continue
        own = shares[row]
        top = int(own.argmax())
        names[row], scores[row] = model.languages[top], min(1.0, float(own[top]))
        sets[row] = [(model.languages[i], float(own[i])) for i in np.flatnonzero(own).tolist()]
    return names, scores, sets


def _labelled(docs: DataFrame, model: Model, text: str) -> DataFrame:
    """docs as c0.. by place with _lang, _score and _mixture."""
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    fields = ", ".join(f"{x.name} {x.dataType.simpleString()}" for x in plain.schema)
    bounded_batches(docs.sparkSession)
    known = docs.sparkSession.sparkContext.broadcast(model)
    return plain.mapInArrow(_predict(known, f"c{docs.columns.index(text)}"), f"{fields}, _lang string, _score double, _mixture map<string,double>")


def identify(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, lang_pred, score (the language's share of the words), mixture.

    A null text and one without a letter have language `und`, score 0 and no mixture; equal shares go to the
    first language by name. Extra columns are ignored. Without any learned language all is `und`.
    """
    found = _labelled(pick(docs, {"doc_id": doc_id, "text": text}), model, "text")
    return found.select(F.col("c0").alias("doc_id"), F.col("_lang").alias("lang_pred"), F.col("_score").alias("score"), F.col("_mixture").alias("mixture"))


def keep_known(docs: DataFrame, model: Model, text: str = "text", least: float = 0.5) -> DataFrame:
    """docs, all columns, without those of no language and those of which no language has the share `least`."""
    found = _labelled(docs, model, text).where((F.col("_lang") != UNKNOWN) & (F.col("_score") >= least))
    return found.select(*[f"c{i}" for i in range(len(docs.columns))]).toDF(*docs.columns)


def training_rows(docs: DataFrame, doc_id: str = "doc_id", modulus: int = 5, held_out: int = 0) -> DataFrame:
    """Rows that a model may learn from: crc32 of the id as text, modulo `modulus`, is not `held_out`."""
    names, place = docs.columns, f"c{docs.columns.index(doc_id)}"
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    return plain.where(crc_class(place, modulus) != held_out).toDF(*names)
