"""Substring deduplication by sliding sentence spans.

Runs of several consecutive sentences are hashed: from each sentence on, and back from each sentence, the shortest
run of at least two sentences and twenty words; so every sentence of a repeated run lies in a run that is repeated
with it. Runs are joined over all documents; the first occurrence of a repeated run, by document and place, stays, and
what any other occurrence covers is removed, but for fewer than EDGE words of a sentence that goes on beyond it.

A passage repeats as far as its words go, not only as far as whole sentences: what is found is carried on to the
words where occurrences part. Places to look at are set by content: the least hash of twenty words in every fifty is an
anchor, so equal passages of fifty words share one. Per anchor the documents are asked, in one aggregate, whether all
of its occurrences go on alike up to the anchors before and behind. Where they do, one window of fifty words per anchor is
joined; only where they part are all windows around the anchor, which bring out the exact ends of the passage. The
result is that of joining every window of fifty words, from a row for every thirty words or so.

Scale. Runs and anchors seen once never leave the task that reads them, but for one count of their hash: a bit map, whose size
follows the number of repeated keys up to a bound, turns them away before occurrences are moved.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulyst.llm.frames import Stages, in_map, key_map, pick
from tabulyst.llm.textbytes import ALNUM, chunks, mix, run_hashes, split_words, utf8

SENTENCES, WORDS = 2, 20
#: Words of a window; a repeated passage of as many and more goes, whatever its sentences.
PASSAGE = 50
#: Fewer words of a sentence at an end of what is removed stay with the rest of their sentence.
EDGE = 4
#: Sentences of more words are split further.
LONG = 40
#: Occurrences of a batch that are held before the first of each key go on.
HELD = 1 << 20


def _is(data: np.ndarray, values: bytes) -> np.ndarray:
    known = np.zeros(256, bool)
    known[list(values)] = True
    return known[data]


def sentence_bounds(data: np.ndarray, words, cuts: bool = True) -> np.ndarray:
    """First word of every sentence that has a word, in order, and the number of words as last entry.

    A sentence ends at a line end, after . ! or ? before white space, after a CJK full stop, question
    or exclamation mark, and with its text. One of more than LONG words also ends at commas, colons and
    semicolons, and what is still longer before words whose hash says so: alike wherever its text lies. Without `cuts`
    long ones stay whole.
    """
    n = len(words.starts)
    if not n:
        return np.zeros(1, np.int64)
    blank = np.append(_is(data[1:], b" \t\n\v\f\r"), True)
    hard = _is(data, b".!?") & blank | _is(data, b"\n\r")
    for mark in ("。", "！", "？"):
        a, b, c = mark.encode()
        hard[2:] |= (data[:-2] == a) & (data[1:-1] == b) & (data[2:] == c)
    soft = _is(data, b",;:") & blank | hard
    new, finer = np.ones(n, bool), np.ones(n, bool)
    for marks, out in ((hard, new), (soft, finer)):
        passed = np.cumsum(marks)[words.starts]
        out[1:] = passed[1:] != passed[:-1]
    heads = words.rows[:-1]
    new[heads[heads < n]] = True
    cut = words.hashes & np.uint64(7) == 0
    for more in (finer, cut) if cuts else ():
        first = np.flatnonzero(new)
        lengths = np.diff(np.append(first, n))
        new |= more & np.repeat(lengths > LONG, lengths)
    return np.append(np.flatnonzero(new), n)


def _runs(words, bounds: np.ndarray, sentences: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, word after the last) of the runs from each sentence on and back from each, every run once."""
    first, ends = bounds[:-1], bounds[1:]
    if not len(first):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    per_row = np.searchsorted(first, words.rows)
    row = np.repeat(np.arange(len(per_row) - 1), np.diff(per_row))
    own = np.arange(len(first))
    last = np.maximum(np.searchsorted(ends, first + least), own + sentences - 1)
    on = np.flatnonzero(last < per_row[1:][row])
    head = np.minimum(np.searchsorted(first, ends - least, "right") - 1, own - sentences + 1)
    back = np.flatnonzero(head >= per_row[:-1][row])
    pairs = np.unique(np.concatenate([own[on] * len(first) + last[on], head[back] * len(first) + own[back]]))
    return first[pairs // len(first)], ends[pairs % len(first)]


def _sliding(values: np.ndarray, width: int, pick_of) -> np.ndarray:
    """pick_of (minimum or maximum) of every `width` values that follow each other."""
    size = 1
    while 2 * size <= width:
        values, size = pick_of(values[:-size], values[size:]), 2 * size
    return pick_of(values[: size - width], values[width - size :]) if size < width else values


def _anchors(words, passage: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first word, hash, context) of every anchor: the least hash of `least` words in some window of `passage` words of a row.

    Last comes the least hash in the window from each word on, whole or not.

    The context is equal for two occurrences only if the words up to the anchors before and behind them are, and the
    places of these; a row's bounds count as anchors that are like no other.
    """
    total = len(words.hashes)
    if total < passage:
        return np.empty(0, np.int64), *[np.empty(0, np.uint64)] * 3
    low, width = np.arange(total - least + 1), passage - least + 1
    hashes = run_hashes(words, low, low + least)
    found = _sliding(hashes, width, np.minimum)
    row = np.repeat(np.arange(len(words.rows) - 1), words.counts())
    whole = row[: len(found)] == row[passage - 1 :]
    beside = np.zeros(width - 1, np.uint64)
    greatest = _sliding(np.concatenate([beside, np.where(whole, found, np.uint64(0)), beside]), width, np.maximum)
    at = np.flatnonzero((greatest == hashes) & (row[: len(hashes)] == row[least - 1 :]))
    if not len(at):
        return at, *[np.empty(0, np.uint64)] * 3
    first = np.diff(row[at], prepend=-1) != 0
    last = np.append(first[1:], True)
    before = np.where(first, words.rows[row[at]], np.append(0, at[:-1]))
    behind = np.where(last, words.rows[row[at] + 1], np.append(at[1:], 0) + least)
    left = run_hashes(words, before, at + least) ^ np.where(first, np.uint64(0x5851F42D4C957F2D), np.uint64(0))
    right = run_hashes(words, at, behind) ^ np.where(last, np.uint64(0x14057B7EF767814F), np.uint64(0))
    return at, hashes[at], mix(left * np.uint64(3) + right), found


def _count(sentences: int, least: int, passage: int):
    """Keys of runs (no context) and of anchors, each occurrence a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for low, high in chunks(offsets):
                part, rows = data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
                words = split_words(part, rows, ALNUM)
                runs = run_hashes(words, *_runs(words, sentence_bounds(part, words), sentences, least))
                _, hashes, context, _ = _anchors(words, passage, min(least, passage))
                # Anchors are not runs: a run of as many words must not count for them.
                key = pa.array(np.concatenate([runs, ~hashes]).view(np.int64))
                yield pa.RecordBatch.from_arrays([key, pa.concat_arrays([pa.nulls(len(runs), pa.int64()), pa.array(context.view(np.int64))])], names=["key", "context"])

    return run


def _looked_at(words, passage: int, least: int, repeated: np.ndarray, parting: np.ndarray) -> np.ndarray:
    """First words of the windows of `passage` words that are joined.

    The least hash in such a window is repeated; it begins at an anchor, or holds one whose occurrences part, or lies at an
    end of its row.
    """
    at, hashes, _, found = _anchors(words, passage, least)
    if not len(at):
        return at
    keys = (~hashes).view(np.int64)
    parts = in_map(parting, keys)
    total, width = len(words.hashes), passage - least + 1
    window = np.arange(total - passage + 1)
    row = np.repeat(np.arange(len(words.rows) - 1), words.counts())
    whole = row[window] == row[window + passage - 1]

    begins, edge = np.zeros(total + 1, bool), np.zeros(total + 1, np.int64)
    begins[at] = True
    long = words.counts() >= passage
    begins[words.rows[:-1][long]] = begins[words.rows[1:][long] - passage] = True
    edge[at[parts] + 1] = 1
    edge = np.cumsum(edge)
    window = window[whole & (begins[window] | (edge[window + width] > edge[window]))]
    return window[in_map(repeated, (~found[window]).view(np.int64))]


def _joined(words, part: np.ndarray, maps, sentences: int, least: int, passage: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, first word, word after the last) of the runs and windows that are joined: those that may be repeated."""
    first, after = _runs(words, sentence_bounds(part, words), sentences, least)
    found = run_hashes(words, first, after)
    maybe = in_map(maps[0], found.view(np.int64))
    window = _looked_at(words, passage, min(least, passage), *maps)
    keys = np.concatenate([found[maybe], run_hashes(words, window, window + passage)])
    return keys.view(np.int64), np.concatenate([first[maybe], window]), np.concatenate([after[maybe], window + passage])


def _firsts(batch: pa.RecordBatch, order: np.ndarray, found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """The first occurrence of each key among (keys, rows of the batch, first words); `order` ranks the rows."""
    keys, row, start = (np.concatenate(x) for x in zip(*found))
    by = np.lexsort((start, order[row], keys))
    by = by[np.append(True, keys[by][1:] != keys[by][:-1])[: len(by)]]
    of = pa.array(row[by])
    return pa.RecordBatch.from_arrays(
        [pa.array(keys[by]), batch.column("doc_id").take(of), batch.column("version").take(of), pa.array(start[by])], names=["key", "doc_id", "version", "start"])


def _occurrences(broadcast, sentences: int, least: int, passage: int):
    """Of each batch, the first occurrence of every key that is joined."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sorted_rows = pc.sort_indices(batch.select(["doc_id", "version"]), sort_keys=[("doc_id", "ascending"), ("version", "ascending")], null_placement="at_start")
            order = np.empty(len(batch), np.int64)
            order[sorted_rows.to_numpy()] = np.arange(len(batch))
            data, offsets = utf8(batch.column("text"))
            found, held = [], 0
            for low, high in chunks(offsets):
                part, rows = data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
                words = split_words(part, rows, ALNUM)
                keys, first, _ = _joined(words, part, broadcast.value, sentences, least, passage)
                row = np.searchsorted(words.rows, first, "right") - 1
                found.append((keys, row + low, first - words.rows[row]))
                held += len(keys)
                if held > HELD:
                    yield _firsts(batch, order, found)
                    found, held = [], 0
            if held:
                yield _firsts(batch, order, found)

    return run


def _flat(column: pa.Array, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(row of each entry, entry) of rows low:high of a list column; null rows have none."""
    column = column.slice(low, high - low)
    return np.repeat(np.arange(high - low), column.value_lengths().fill_null(0).to_numpy()), column.flatten().to_numpy(zero_copy_only=False)


def _name(row: np.ndarray, start: np.ndarray, key: np.ndarray) -> np.ndarray:
    """64-bit name of an occurrence in its chunk."""
    return mix((row.astype(np.uint64) << np.uint64(40)) + start.astype(np.uint64)) ^ key.view(np.uint64)


def _merged(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of words, in order, those that touch or overlap as one."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order]) if len(ends) else ends
    new = np.flatnonzero(np.append(True, starts[1:] > ends[:-1]))[: len(starts)]
    return list(zip(starts[new].tolist(), ends[np.append(new[1:], len(starts)) - 1].tolist()))


def _trimmed(low: int, high: int, bounds: np.ndarray) -> tuple[int, int]:
    """Words low:high without fewer than EDGE words of a sentence that goes on before or behind them."""
    at = int(np.searchsorted(bounds, low, "right"))
    if bounds[at - 1] < low and bounds[at] < high and bounds[at] - low < EDGE:
        low = int(bounds[at])
    at = int(np.searchsorted(bounds, high))
    if bounds[at] > high and bounds[at - 1] > low and high - bounds[at - 1] < EDGE:
        high = int(bounds[at - 1])
    return low, high


def _remove(broadcast, sentences: int, least: int, passage: int):
    """Cut all but first occurrences out of each text; count all sentences and those that went whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            texts, counts, gone, spans = [], [], [], []
            for low, high in chunks(offsets):
                at = offsets[low]
                part, rows = data[at : offsets[high]], offsets[low : high + 1] - at
                words = split_words(part, rows, ALNUM)
                keys, start, end = _joined(words, part, broadcast.value, sentences, least, passage)
                row = np.searchsorted(words.rows, start, "right") - 1
                kept_row, kept_key = _flat(batch.column("keys"), low, high)
                stay = _name(kept_row, _flat(batch.column("starts"), low, high)[1], kept_key)
                later = ~np.isin(_name(row, start - words.rows[row], keys), stay)
                order = np.argsort(row[later], kind="stable")
                row, start, end = row[later][order], start[later][order], end[later][order]
                bounds = sentence_bounds(part, words)
                marked = sentence_bounds(part, words, cuts=False) if len(row) else bounds
                after = np.append(words.starts, len(part))
                counts += np.diff(np.searchsorted(words.starts[bounds[:-1]], rows)).tolist()
                per_row = np.searchsorted(row, np.arange(high - low + 1))
                for i in range(high - low):
                    own = slice(per_row[i], per_row[i + 1])
                    if own.start == own.stop:
                        texts.append(batch.column("text")[low + i].as_py())
                        gone.append(0)
                        spans.append([])
                        continue
                    ranges, kept, before, whole = [], [], 0, 0
                    for first, behind in _merged(start[own], end[own]):
                        first, behind = _trimmed(first, behind, marked)
                        ranges.append([int(words.starts[first] - rows[i]), int(min(after[behind], rows[i + 1]) - rows[i])])
                        whole += max(0, int(np.searchsorted(bounds, behind, "right")) - 1 - int(np.searchsorted(bounds, first)))
                    text = part[rows[i] : rows[i + 1]]
                    for first, behind in ranges:
                        kept.append(text[before:first].tobytes())
                        before = behind
                    texts.append(b"".join([*kept, text[before:].tobytes()]).decode())
                    gone.append(whole)
                    spans.append(ranges)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, batch.column("text").type), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.list_(pa.list_(pa.int64())))],
                names=["doc_id", "text", "n_sentences", "n_removed", "spans"])

    return run


def dedup_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sentences: int = SENTENCES, words: int = WORDS, passage: int = PASSAGE) -> DataFrame:
    """One row per document: doc_id, text without repeated spans, sentences, sentences removed whole, byte ranges removed.

    Documents count in the order of their ids (null first, then by a hash of their text), so the first
    occurrence of a run stays in the document of least id. Rows equal in id and text are one document and get
    equal results. Null texts stay null; texts without a run stay as they are. Extra columns are ignored.
    """
    stages, context = Stages(docs.sparkSession), docs.sparkSession.sparkContext
    plain = pick(docs, {"doc_id": doc_id, "text": text}).withColumn("version", F.xxhash64("text"))
    kind = plain.schema["doc_id"].dataType.simpleString()
    counted = plain.select("text").mapInArrow(_count(sentences, words, passage), "key bigint, context bigint")
    counted = counted.groupBy("key").agg(F.count("*").alias("n"), F.min("context").alias("least"), F.max("context").alias("most"))
    repeated = stages.keep(counted.where("n > 1").select("key", (F.col("least") != F.col("most")).alias("parting")), "repeated")
    maps = context.broadcast((key_map(repeated), key_map(repeated.where("parting"))))
    stages.release("repeated")
    found = plain.mapInArrow(_occurrences(maps, sentences, words, passage), f"key bigint, doc_id {kind}, version bigint, start bigint")
    # Every key has one first occurrence; each text is told its own, finds its occurrences again and loses the others.
    first = found.groupBy("key").agg(F.min(F.struct("doc_id", "version", "start")).alias("first"))
    first = stages.keep(first.select(F.col("first.doc_id").alias("d"), F.col("first.version").alias("v"), "key", "first.start"), "first")
    own = first.groupBy("d", "v").agg(F.collect_list(F.struct("key", "start")).alias("own"))
    own = own.select("d", "v", F.col("own.key").alias("keys"), F.col("own.start").alias("starts"))
    joined = plain.join(own, plain["doc_id"].eqNullSafe(own["d"]) & plain["version"].eqNullSafe(own["v"]), "left")
    return joined.select("doc_id", "text", "keys", "starts").mapInArrow(
        _remove(maps, sentences, words, passage), f"doc_id {kind}, text string, n_sentences bigint, n_removed bigint, spans array<array<bigint>>")
