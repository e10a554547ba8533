"""Document fingerprints by Order MinHash.

The k-mers of a text, each numbered by its occurrence, are hashed once per sketch; the least L of them
are taken, put back into text order, and the tuple is hashed. Two texts share a sketch if they share
the same least k-mers in the same order, so the share of equal sketches falls with edit distance and
not just with set overlap.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulyst.llm.frames import pick
from tabulyst.llm.textbytes import mix

#: Bytes of a k-mer, least k-mers of a sketch, sketches of a fingerprint.
KMER, TUPLE, SKETCHES = 8, 2, 64
#: Sketch hashes of about this many k-mers are compared at a time, whatever the length of the text.
TILE = 8192
#: Rows of one bucket of neighbouring documents; more buckets than the bound only if rows are added to each.
BUCKET_ROWS, BUCKETS = 5_000, 100_000

_SEEDS = (mix(np.arange(7001, 7001 + SKETCHES, dtype=np.uint64)) | np.uint64(1)).astype(np.uint32)
_PLACES = mix(np.arange(9001, 9001 + 64, dtype=np.uint64)) | np.uint64(1)


def numbered_kmers(data: np.ndarray, k: int = KMER) -> np.ndarray:
    """Hash of every (k-mer, number of its occurrence) in text order; a text of fewer than k bytes is one k-mer."""
    n = max(1, len(data) - k + 1)
    if len(data) < k:
        data = np.append(data, np.zeros(k - len(data), np.uint8) + np.uint8(255))
    wide = data.astype(np.uint64) + np.uint64(1)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out += wide[i : i + n] * _PLACES[i]
    mix(out)
    ordered = np.sort(out)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if len(twice):
        twice = twice[np.concatenate(([True], twice[1:] != twice[:-1]))]
        at = np.searchsorted(twice, out)
        at[at == len(twice)] = 0
        where = np.flatnonzero(twice[at] == out)
        order = where[np.argsort(at[where], kind="stable")]
        group = at[order]
        heads = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        number = np.arange(len(group)) - np.repeat(heads, np.diff(np.append(heads, len(group))))
        out[order] = mix(out[order] + number.astype(np.uint64) * _PLACES[63])
    return out


def sketches(kmers: np.ndarray) -> np.ndarray:
    """SKETCHES hashes of the TUPLE least k-mers in text order; one k-mer alone stands for all of the tuple."""
    folded = (kmers >> np.uint64(32)).astype(np.uint32)
    rows = np.arange(SKETCHES)
    values = np.full((SKETCHES, TUPLE), 2**33, np.uint64)
    places = np.zeros((SKETCHES, TUPLE), np.int64)
    for low in range(0, len(kmers), TILE):
        part = folded[low : low + TILE] * _SEEDS[:, None]
        own_values, own_places = [values], [places]
        for _ in range(min(TUPLE, part.shape[1])):
            at = part.argmin(1)
            own_values.append(part[rows, at][:, None].astype(np.uint64))
            own_places.append(at[:, None] + low)
            part[rows, at] = np.uint32(2**32 - 1)
        values, places = np.concatenate(own_values, 1), np.concatenate(own_places, 1)
        best = np.lexsort((places, values), axis=1)[:, :TUPLE]
        values, places = np.take_along_axis(values, best, 1), np.take_along_axis(places, best, 1)
    out = np.zeros(SKETCHES, np.uint64)
    places = np.where(values < 2**33, places, places[:, :1])
    places.sort(1)
    for i in range(TUPLE):
        out = mix(out * _PLACES[i] + kmers[places[:, i]])
    return (out >> np.uint64(32)).astype(np.uint32)


def fingerprint(text: bytes) -> np.ndarray:
    return sketches(numbered_kmers(np.frombuffer(text, np.uint8)))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal sketches, 0 to 1."""
    return float(np.mean(a == b))


def _hex(sketch: np.ndarray) -> str:
    return sketch.astype(">u4").tobytes().hex()


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of every row, null texts as empty ones; no shuffle."""
    plain = pick(docs, {"doc_id": doc_id, "text": text})

    def run(batches):
        for batch in batches:
            found = [_hex(fingerprint((x.as_py() or "").encode())) for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.string())], names=["doc_id", "fingerprint"])

    return plain.mapInArrow(run, f"doc_id {plain.schema['doc_id'].dataType.simpleString()}, fingerprint string")


def _buckets(ids: pa.Array, cuts: np.ndarray) -> np.ndarray:
    """Bucket of each id: 0 has the largest ids, the last one also null ids."""
    values = ids.fill_null(0).to_numpy(zero_copy_only=False)
    return np.where(ids.is_null().to_numpy(zero_copy_only=False), len(cuts), len(cuts) - np.searchsorted(cuts, values, "right")).astype(np.int64)


def _bucketed(plain: DataFrame, cuts: np.ndarray, handed: dict | None = None) -> DataFrame:
    """plain with its bucket; with `handed`, the rows that head a bucket again, as `extra` of the bucket before."""
    names = [*plain.columns, "bucket", "extra"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bucket = _buckets(batch.column("doc_id"), cuts)
            columns = [*batch.columns, pa.array(bucket), pa.array(np.zeros(len(batch), bool))]
            yield pa.RecordBatch.from_arrays(columns, names=names)
            if handed:
                ids, versions = batch.column("doc_id").to_pylist(), batch.column("version").to_pylist()
                heads = [i for i, b in enumerate(bucket.tolist()) if handed[b][:2] == (ids[i], versions[i])]
                if heads:
                    again = batch.take(pa.array(heads))
                    to = pa.array([handed[b][2] for b in bucket[heads].tolist()], pa.int64())
                    yield pa.RecordBatch.from_arrays([*again.columns, to, pa.array([True] * len(heads))], names=names)

    fields = ", ".join(f"{x.name} {x.dataType.simpleString()}" for x in plain.schema)
    return plain.mapInArrow(run, f"{fields}, bucket bigint, extra boolean")


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order of buckets: each row with what it needs of the row that follows it."""
    held = None
    for batch in batches:
        out: list[tuple] = []
        ids, texts, buckets, extras = (batch.column(x) for x in ("doc_id", "text", "bucket", "extra"))
        for i in range(len(batch)):
            text, bucket, extra = texts[i].as_py() or "", buckets[i].as_py(), extras[i].as_py()
            if extra and held is None:
                continue  # handed on twice, by rows that repeat
            own = fingerprint(text.encode())
            if held is not None and held[1] == bucket:
                out.append(_with_edit(held, text, own))
            held = None if extra else (ids[i].as_py(), bucket, text, own)
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        kinds = [ids.type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        columns = zip(*out) if out else [[] for _ in names]
        yield pa.RecordBatch.from_arrays([pa.array(list(x), kind) for x, kind in zip(columns, kinds)], names=names)


def _with_edit(held: tuple, following: str, after: np.ndarray) -> tuple:
    doc_id, _, text, own = held
    half = len(text) // 2
    edited = (text[: len(text) - half] + following[:half]).encode()
    other = fingerprint(edited)
    return doc_id, len(text), hashlib.sha256(edited).hexdigest(), _hex(own), _hex(other), likeness(own, other), likeness(own, after)


def edit_likeness(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's fingerprint with that of its edited text and the likeness to it and to the next one.

    Documents follow each other by descending id, null ids last, rows of equal id by a hash of their
    text; the first follows the last. Null texts are empty ones. One shuffle moves each text once, to its
    range of ids. Ids are whole numbers. Extra columns are ignored; an empty table gives no rows.
    """
    plain = pick(docs, {"doc_id": doc_id, "text": text}).withColumn("version", F.xxhash64("text"))
    n = plain.count()
    buckets = max(1, min(-(-n // BUCKET_ROWS), BUCKETS))
    shares = [i / buckets for i in range(1, buckets)]
    cuts = np.unique(np.array(plain.approxQuantile("doc_id", shares, 0.2 / buckets) if shares else [], np.float64)).astype(np.int64)
    first = F.struct(F.col("doc_id").isNull().alias("absent"), (-F.col("doc_id")).alias("down"), "version", "doc_id")
    found = _bucketed(plain.select("doc_id", "version"), cuts).groupBy("bucket").agg(F.min(first).alias("head")).orderBy("bucket").collect()
    handed = {r["bucket"]: (r["head"]["doc_id"], r["head"]["version"], found[i - 1]["bucket"]) for i, r in enumerate(found)}
    dealt = _bucketed(plain, cuts, handed).repartition("bucket")
    ordered = dealt.sortWithinPartitions("bucket", "extra", F.col("doc_id").desc_nulls_last(), "version")
    kind = plain.schema["doc_id"].dataType.simpleString()
    return ordered.mapInArrow(_edited, f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
