"""Importance resampling towards a target by bit-sliced sums of hashed features.

Words (or runs of words) fall into buckets by CRC-32. A document's bucket counts are laid out as bit planes: plane j has,
for each bucket, bit j of its count. The gains of the buckets are bit planes too, one set for each sign. The weight of a
document, the sum of count times gain, is then the sum over all pairs of planes of 2^(j + k) times the number of bits set
in both: AND and popcount over 64 buckets at a time, exact in 64-bit integers. Gumbel noise from a hash of the id
turns weights into scores; the greatest scores are a draw without replacement.

Scale. One scan counts buckets per task (no more rows than buckets leave a task), one weighs; only (id, counts, score) are
sorted, by range partitions with offsets, never in one task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulyst.llm.frames import Stages, pick
from tabulyst.llm.textbytes import ALNUM, Words, chunks, split_words, utf8
from tabulyst.operators.ordering import with_row_index

BUCKETS, RUN = 10_000, 1
LEAST_WORDS, PERCENT, SEED = 20, 10, 2024
#: Documents whose planes are laid out at once.
TILE = 512
#: Bytes of a word up to which all words are hashed byte by byte together; of longer ones the rest alone.
TOGETHER = 64
_POLYNOMIAL = 0xEDB88320  # fixed value: of CRC-32, lowest bit first


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(_POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


_TABLE = _crc_table()


def _fed(state: np.ndarray, words: Words, which: np.ndarray) -> np.ndarray:
    """CRC registers `state` after the bytes of the words `which`."""
    starts, lengths = words.starts[which], words.ends[which] - words.starts[which]
    order = np.argsort(-lengths, kind="stable")
    starts, sizes, now = starts[order], lengths[order], state[order]
    for i in range(min(TOGETHER, int(sizes[0]) if len(sizes) else 0)):
        n = int(np.searchsorted(-sizes, -i, "left"))  # words of more than i bytes
        now[:n] = _TABLE[(now[:n] ^ words.raw[starts[:n] + i]) & 255] ^ (now[:n] >> np.uint32(8))
    for w in range(int(np.searchsorted(-sizes, -TOGETHER, "left"))):
        rest = words.raw[starts[w] + TOGETHER : starts[w] + sizes[w]].tobytes()
        now[w] = zlib.crc32(rest, int(now[w]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    out = np.empty_like(now)
    out[order] = now
    return out


def features(words: Words, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every run of 1 to `longest` consecutive words of a row, joined by one blank."""
    row = np.repeat(np.arange(len(words.rows) - 1), words.counts())
    first = np.arange(len(row))
    state = np.full(len(row), 0xFFFFFFFF, np.uint32)
    rows, found = [], []
    for n in range(longest):
        if n:
            whole = first + n < words.rows[1:][row[first]]
            first, state = first[whole], state[whole]
            state = _TABLE[(state ^ np.uint32(32)) & 255] ^ (state >> np.uint32(8))
        state = _fed(state, words, first + n)
        rows.append(row[first])
        found.append(((state ^ np.uint32(0xFFFFFFFF)) % np.uint32(buckets)).astype(np.int64))
    return np.concatenate(rows), np.concatenate(found)


def _split(batch: pa.RecordBatch) -> Iterator[Words]:
    data, offsets = utf8(batch.column("text"))
    for low, high in chunks(offsets):
        at = offsets[low]
        yield split_words(data[at : offsets[high]], offsets[low : high + 1] - at, ALNUM)


def _bucket_counts(longest: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for words in _split(batch):
                counts += np.bincount(features(words, longest, buckets)[1], minlength=buckets)
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts[found])], names=["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, longest: int = RUN, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts by bucket."""
    found = texts.select("text").mapInArrow(_bucket_counts(longest, buckets), "bucket bigint, n bigint")
    summed = found.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[summed.column("bucket").to_numpy()] = summed.column("n").to_numpy()
    return out


def gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the smoothed target share over the smoothed own share) of each bucket."""
    n = len(own)
    ratio = ((target + 1.0) * (own.sum() + float(n))) / ((own + 1.0) * (target.sum() + float(n)))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def _planes(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words."""
    packed = np.packbits(bits, axis=1, bitorder="little")
    wide = np.zeros((len(packed), -(-packed.shape[1] // 8) * 8), np.uint8)
    wide[:, : packed.shape[1]] = packed
    return wide.view(np.uint64)


class GainPlanes:
    """Signed bit planes of the gains: (sign, k, buckets whose magnitude has bit k)."""

    def __init__(self, gain: np.ndarray):
        self.buckets, self.planes = len(gain), []
        for sign in (1, -1):
            size = np.where(sign * gain > 0, sign * gain, 0)
            for k in range(int(size.max()).bit_length()):
                self.planes.append((sign, k, _planes(((size >> k) & 1).astype(bool)[None, :])[0]))

    def weights(self, rows: int, row: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Sum of the gains over each row's features."""
        out = np.zeros(rows, np.int64)
        cells, count = np.unique(row * self.buckets + bucket, return_counts=True)
        row, bucket = cells // self.buckets, cells % self.buckets
        for start in range(0, rows, TILE):
            a, b = np.searchsorted(row, (start, start + TILE))
            own, place, number = row[a:b], bucket[a:b], count[a:b]
            for j in range(int(number.max()).bit_length() if b > a else 0):
                has = (number >> j) & 1 == 1
                held, at = np.unique(own[has], return_inverse=True)
                bits = np.zeros((len(held), self.buckets), bool)
                bits[at, place[has]] = True
                plane = _planes(bits)
                for sign, k, gain in self.planes:
                    common = np.bitwise_count(plane & gain).sum(axis=1, dtype=np.int64)
                    out[held] += sign * (common << (j + k))
        return out


def _weigh(broadcast, longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain: GainPlanes = broadcast.value
        for batch in batches:
            n_words, n_features, weight = [], [], []
            for words in _split(batch):
                rows = len(words.rows) - 1
                row, bucket = features(words, longest, gain.buckets)
                n_words.append(words.counts())
                n_features.append(np.bincount(row, minlength=rows))
                weight.append(gain.weights(rows, row, bucket))
            if n_words:
                columns = [pa.array(np.concatenate(x).astype(np.int64)) for x in (n_words, n_features, weight)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", "n_words", "n_features", "weight"])

    return run


def noise(doc_id: str, seed: int):
    """floor(1000 * Gumbel noise) from the first 32 bits of sha256 of `seed:id`; a null id counts as the empty text."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def weighted(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text", longest: int = RUN, buckets: int = BUCKETS) -> DataFrame:
    """One row per document: doc_id, n_words, n_features, weight; null and wordless texts have none and weigh 0."""
    plain = pick(docs, {"doc_id": doc_id, "text": text})
    own = bucket_counts(plain, longest, buckets)
    gain = gains(own, bucket_counts(pick(target, {"text": target_text}), longest, buckets))
    known = docs.sparkSession.sparkContext.broadcast(GainPlanes(gain))
    kind = plain.schema["doc_id"].dataType.simpleString()
    return plain.mapInArrow(_weigh(known, longest), f"doc_id {kind}, n_words bigint, n_features bigint, weight bigint")


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text", percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED, longest: int = RUN, buckets: int = BUCKETS) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score, rank (from 1 by score, then id, null id first; null if not drawn).

    Of the documents with `least_words` words and more, `percent` hundredths, rounded down, are drawn. A null or
    wordless text has no feature and weight 0; an empty target gives every bucket the same share. Repeated rows
    are documents of their own; of those equal in score and id the one with fewer features comes first. Whole texts
    count, however long. Extra columns are ignored, whatever their names.
    """
    stages = Stages(docs.sparkSession)
    found = weighted(docs, target, doc_id, text, target_text, longest, buckets)
    scored = stages.keep(found.withColumn("score", F.col("weight") + noise("doc_id", seed)), "scored")
    able = scored.where(F.col("n_words") >= least_words)
    drawn = percent * able.count() // 100
    ranked = with_row_index(able, [F.desc("score"), F.asc_nulls_first("doc_id"), F.col("n_features")], "row_index")
    place = F.when(F.col("row_index") < drawn, F.col("row_index") + 1).cast("bigint")
    columns = ["doc_id", "n_features", "weight", "score"]
    return ranked.select(*columns, place.alias("rank")).union(
        scored.where(F.col("n_words") < least_words).select(*columns, F.lit(None).cast("bigint").alias("rank")))


def sample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """The drawn documents themselves, all columns; ids are taken to be unique, rows that repeat a drawn id are all kept."""
    names, place = docs.columns, f"c{docs.columns.index(doc_id)}"
    drawn = resample(docs, target, doc_id, **options).where("rank IS NOT NULL").select(F.col("doc_id").alias("drawn")).distinct()
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    return plain.join(drawn, plain[place].eqNullSafe(drawn["drawn"]), "left_semi").toDF(*names)
