"""Benchmark decontamination by a broadcast hash set of normalised test n-grams.

Benchmark items become windows of ten words (an item with fewer words is one window). Their hashes
are broadcast, block by block of bounded size; every training document is scanned window by window,
hits of the hash set are verified word for word, and hit words, spans or documents can be removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulyst.llm.frames import bounded_batches, pick
from tabulyst.llm.textbytes import ALNUM, HashSet, chunks, split_words, utf8, windows

WINDOW = 10
#: Characters of benchmark text per broadcast block; more text means more blocks, each scanned in turn.
BLOCK_CHARS = 16_000_000


class WindowSet:
    """Windows of one block of items: hashes by length, and the items of each verified window."""

    def __init__(self, items: list[tuple[str | None, str]], window: int):
        self.items = sorted({name for name, _ in items if name is not None})
        number = {name: i for i, name in enumerate(self.items)}
        self.of: dict[bytes, tuple[int, ...]] = {}
        hashes: dict[int, set[int]] = {}
        for name, text in items:
            data = np.frombuffer(text.encode(), np.uint8)
            words = split_words(data, np.array([0, len(data)]), ALNUM)
            n = min(window, len(words.hashes))
            if not n:
                continue
            first, found = windows(words, n)
            hashes.setdefault(n, set()).update(found.tolist())
            for word in first:
                key = words.text(int(word), n)
                self.of.setdefault(key, ())
                if name is not None and number[name] not in self.of[key]:
                    self.of[key] += (number[name],)
        self.sets = {n: HashSet(np.array(sorted(x), np.uint64)) for n, x in sorted(hashes.items())}

    def hits(self, words) -> Iterator[tuple[int, int, tuple[int, ...]]]:
        """(first word, number of words, items) of every verified window."""
        for n, known in self.sets.items():
            first, found = windows(words, n)
            for word in first[known.contains(found)].tolist():
                items = self.of.get(words.text(word, n))
                if items is not None:
                    yield word, n, items


def _blocks(benchmark: DataFrame, window: int) -> Iterator[WindowSet]:
    size = benchmark.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-int(size) // BLOCK_CHARS))
    for i in range(n):
        block = benchmark if n == 1 else benchmark.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == i)
        yield WindowSet([(r["item"], r["text"]) for r in block.where("text IS NOT NULL").distinct().collect()], window)


def _scan(broadcast, text: str):
    """Pass over all texts for one block: adds its items and hit runs of words to what earlier blocks found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: WindowSet = broadcast.value
        for batch in batches:
            data, offsets = utf8(batch.column(text))
            n_words, items, runs, spans = [], [], [], []
            before_items, before_runs = (batch.column(x).to_pylist() for x in ("_items", "_runs"))
            for low, high in chunks(offsets):
                at = offsets[low]
                words = split_words(data[at : offsets[high]], offsets[low : high + 1] - at, ALNUM)
                found = [set(x or ()) for x in before_items[low:high]]
                edge = np.zeros(len(words.hashes) + 1, np.int32)
                for word, n, names in known.hits(words):
                    edge[word] += 1
                    edge[word + n] -= 1
                    row = int(np.searchsorted(words.rows, word, "right")) - 1
                    found[row].update(known.items[i] for i in names)
                covered = np.cumsum(edge[:-1]) > 0
                for row in range(high - low):
                    start, end = int(words.rows[row]), int(words.rows[row + 1])
                    own = covered[start:end]
                    for s, e in before_runs[low + row] or ():
                        own[s:e] = True
                    bounds = np.flatnonzero(np.diff(np.concatenate(([0], own.view(np.int8), [0])))).reshape(-1, 2) if own.any() else ()
                    runs.append([[int(s), int(e)] for s, e in bounds])
                    base = int(offsets[low + row] - at)
                    spans.append([[int(words.starts[start + s]) - base, int(words.ends[start + e - 1]) - base] for s, e in bounds])
                    n_words.append(end - start)
                items += [sorted(x) for x in found]
            pairs = pa.list_(pa.list_(pa.int64()))
            new = {"_items": pa.array(items, pa.list_(pa.string())), "_runs": pa.array(runs, pairs), "_n_words": pa.array(n_words, pa.int64()), "_spans": pa.array(spans, pairs)}
            names = batch.schema.names
            yield pa.RecordBatch.from_arrays([new.get(x, batch.column(i)) for i, x in enumerate(names)], names=names)

    return run


def _marked(docs: DataFrame, benchmark: DataFrame, text: str, item: str, item_text: str, window: int) -> DataFrame:
    """docs with columns c0.. by place, plus _items, _runs, _n_words and _spans (byte ranges)."""
    spark, place = docs.sparkSession, f"c{docs.columns.index(text)}"
    bounded_batches(spark)
    frame = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]).withColumns({
        "_items": F.lit(None).cast("array<string>"), "_runs": F.lit(None).cast("array<array<bigint>>"),
        "_n_words": F.lit(0).cast("bigint"), "_spans": F.lit(None).cast("array<array<bigint>>"),
    })
    tests = pick(benchmark, {"item": item, "text": item_text}).withColumn("item", F.col("item").cast("string"))
    for known in _blocks(tests, window):
        frame = frame.mapInArrow(_scan(spark.sparkContext.broadcast(known), place), frame.schema)
    return frame


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per document: words, words hit, benchmark items hit, spans as byte ranges of the text.

    A null or wordless text has no words and no hit; a null or wordless item has no window; an item
    with a null id marks words but is not counted. Repeated rows are each reported. Extra columns of
    either table are ignored, whatever their names.
    """
    frame = _marked(pick(docs, {"id": doc_id, "text": text}), benchmark, "text", item, item_text, window)
    return frame.select(
        F.col("c0").alias("doc_id"), F.col("_n_words").alias("n_words"),
        F.coalesce(F.aggregate("_runs", F.lit(0).cast("bigint"), lambda a, r: a + r[1] - r[0]), F.lit(0)).alias("n_hit"),
        F.col("_items").alias("items"), F.col("_spans").alias("spans"),
    )


def _without_hits(broadcast, text: str):
    """Pass over all texts for one block: rows without any of its windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: WindowSet = broadcast.value
        for batch in batches:
            data, offsets = utf8(batch.column(text))
            clean = np.ones(len(batch), bool)
            for low, high in chunks(offsets):
                at = offsets[low]
                words = split_words(data[at : offsets[high]], offsets[low : high + 1] - at, ALNUM)
                hit = [word for word, _, _ in known.hits(words)]
                clean[low + np.searchsorted(words.rows, np.array(hit, np.int64), "right") - 1] = False
            yield batch.filter(pa.array(clean))

    return run


def _cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
    out = []
    for value, ranges in zip(texts.to_pylist(), spans.to_pylist()):
        if ranges:
            raw, at, kept = value.encode(), 0, []
            for start, end in ranges:
                kept.append(raw[at:start])
                at = end
            value = b"".join([*kept, raw[at:]]).decode()
        out.append(value)
    return pa.array(out, texts.type)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW, remove: str = "documents") -> DataFrame:
    """docs, all columns, without contaminated documents (`documents`) or without the hit spans (`spans`).

    A document without a hit is returned unchanged, null texts too.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove is 'documents' or 'spans'")
    names, place = docs.columns, docs.columns.index(text)
    kept = [f"c{i}" for i in range(len(names))]
    if remove == "documents":
        frame, context = docs.toDF(*kept), docs.sparkSession.sparkContext
        bounded_batches(docs.sparkSession)
        for known in _blocks(pick(benchmark, {"item": item, "text": item_text}).withColumn("item", F.col("item").cast("string")), window):
            frame = frame.mapInArrow(_without_hits(context.broadcast(known), f"c{place}"), frame.schema)
        return frame.toDF(*names)
    marked = _marked(docs, benchmark, text, item, item_text, window)

    def run(batches):
        for batch in batches:
            columns = [batch.column(x) for x in kept]
            columns[place] = _cut(columns[place], batch.column("_spans"))
            yield pa.RecordBatch.from_arrays(columns, names=kept)

    return marked.select(*kept, "_spans").mapInArrow(run, marked.select(*kept).schema).toDF(*names)


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns from contamination()."""
    joined = F.array_join("items", ",")
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(joined.cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )
