"""Ranked lexical search as a dense blocked matrix product.

Queries are the rows, their terms the columns of a weight matrix; a document tile holds an integer impact for each of its
terms that any query has. Scores are the product of the two, by BLAS in float64: of each tile of queries only the
vocabulary those queries have is laid out, cut into tiles of columns for which no partial sum can reach 2^53, so every
float64 sum is an exact integer; tiles are added up in 64-bit integers.

Scale. Two scans of the documents, in which no text is moved: one counts, per task, documents, terms and, for the queries'
terms, the documents that hold them; the other scores tile by tile and leaves each task's best of each query, ties by
document. Only those meet in a shuffle, first by query and a salt. Queries are collected and broadcast block by block of
bounded size; another block is another scan.

Terms are compared by 64-bit hash and length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabulyst.llm.frames import pick
from tabulyst.llm.textbytes import ALNUM, chunks, split_words, utf8

BEST = 20
#: Characters of queries collected and broadcast at once.
BLOCK_CHARS = 16_000_000
#: Queries, terms and documents of a tile: 8 MB of float64 for each factor of the product.
QUERIES, TERMS, DOCUMENTS = 256, 2048, 512
#: Sums of float64 are exact integers below this.
EXACT = 1 << 53
#: No impact is greater: 1000000000 * tf div (1000 * tf + 12 * m) stays below a millionth of a billion times a thousand.
MOST_IMPACT = 1_000_000
#: Parts in which a query's best are cut first, so that no task meets those of all tasks.
SALTS = 64
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def _terms(data: np.ndarray, offsets: np.ndarray):
    """Words of the rows, and for each word a key of its hash and length."""
    words = split_words(data, offsets, ALNUM)
    return words, words.hashes ^ ((words.ends - words.starts).astype(np.uint64) * _SPREAD)


@dataclass
class Block:
    """Queries of one block: (item, rows equal to it), its distinct terms, and the entries of the weight matrix."""

    items: list
    rows: np.ndarray
    terms: np.ndarray  # sorted keys
    query: np.ndarray  # of each entry, ascending
    term: np.ndarray
    count: np.ndarray

    @classmethod
    def of(cls, rows: list) -> Block:
        texts = [(r["text"] or "").encode() for r in rows]
        offsets = np.concatenate(([0], np.cumsum([len(x) for x in texts]))).astype(np.int64)
        words, keys = _terms(np.frombuffer(b"".join(texts), np.uint8), offsets)
        terms, place = np.unique(keys, return_inverse=True)
        query = np.repeat(np.arange(len(rows), dtype=np.int64), words.counts())
        entries, count = np.unique(query * max(1, len(terms)) + place, return_counts=True)
        return cls([r["item"] for r in rows], np.array([r["n"] for r in rows], np.int64), terms, entries // max(1, len(terms)), entries % max(1, len(terms)), count.astype(np.int64))


def _blocks(queries: DataFrame) -> Iterator[Block]:
    equal = queries.groupBy("item", "text").agg(F.count("*").alias("n"))
    size = equal.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-int(size) // BLOCK_CHARS))
    for i in range(n):
        rows = equal if n == 1 else equal.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == i)
        block = Block.of(rows.where("text IS NOT NULL").collect())
        if len(block.terms):
            yield block


def _held(batch: pa.RecordBatch, known: np.ndarray) -> Iterator[tuple]:
    """Per chunk: first row, terms of each row, and of the known terms row, term and how often, by row and term."""
    data, offsets = utf8(batch.column("text"))
    for low, high in chunks(offsets):
        at = offsets[low]
        words, keys = _terms(data[at : offsets[high]], offsets[low : high + 1] - at)
        place = np.searchsorted(known, keys)
        place[place == len(known)] = 0
        hit = np.flatnonzero(known[place] == keys)
        row = np.searchsorted(words.rows, hit, "right") - 1
        pairs, often = np.unique(row * len(known) + place[hit], return_counts=True)
        yield low, words.counts(), pairs // len(known), pairs % len(known), often.astype(np.int64)


def _count(broadcast):
    """One row per term found in the task: documents that hold it. Terms -1 and -2: documents with terms, all their terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: np.ndarray = broadcast.value
        held, documents, total = np.zeros(len(known), np.int64), 0, 0
        for batch in batches:
            for _, counts, _, term, _ in _held(batch, known):
                held += np.bincount(term, minlength=len(known))
                documents += int(np.count_nonzero(counts))
                total += int(counts.sum())
        found = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([found, [-1, -2]])), pa.array(np.concatenate([held[found], [documents, total]]))], names=["term", "n"])

    return run


def weights(documents: int, held: np.ndarray) -> np.ndarray:
    """floor(1000 * ln((2N + 2) / (2df + 1))) of terms held by df of N documents, at least 0 as df is at most N."""
    return np.floor(1000 * np.log((2.0 * documents + 2) / (2.0 * held + 1))).astype(np.int64)


def impacts(often: np.ndarray, lengths: np.ndarray, documents: int, total: int) -> np.ndarray:
    """Impact of a term that stands `often` times in a document of `lengths` terms; whole numbers, divisions round down."""
    size = 75 + (25 * lengths * documents) // max(1, total)
    return (1_000_000_000 * often) // (1000 * often + 12 * size)


class Tiles:
    """The weight matrix of a block by tiles of queries, each cut into tiles of their own vocabulary."""

    def __init__(self, block: Block, weight: np.ndarray):
        self.tiles = []
        worth = weight[block.term] * block.count
        live = worth > 0
        for first in range(0, len(block.items), QUERIES):
            own = live & (block.query >= first) & (block.query < first + QUERIES)
            query, term, value = block.query[own] - first, block.term[own], worth[own]
            vocabulary, column = np.unique(term, return_inverse=True)
            n = min(QUERIES, len(block.items) - first)
            # Most that a column can add to any query; a tile ends before these could reach EXACT.
            most = np.zeros(len(vocabulary), np.int64)
            np.maximum.at(most, column, value)
            parts, heavy, start, sum_ = [], [], 0, 0
            for i, worth_ in enumerate((most * MOST_IMPACT).tolist()):
                if worth_ >= EXACT:  # alone too great for float64: multiplied as integers
                    heavy.append(i)
                    worth_ = 0
                if i - start >= TERMS or sum_ + worth_ >= EXACT:
                    parts.append((start, i))
                    start, sum_ = i, 0
                sum_ += worth_
            parts.append((start, len(vocabulary)))
            light = ~np.isin(column, heavy)
            dense = []
            for low, high in parts:
                inside = light & (column >= low) & (column < high)
                tile = np.zeros((high - low, n))
                tile[column[inside] - low, query[inside]] = value[inside]
                dense.append((vocabulary[low:high], tile))
            whole = [(int(vocabulary[i]), query[column == i], value[column == i]) for i in heavy]
            self.tiles.append((first, n, dense, whole))

    @staticmethod
    def scores(dense, whole, n: int, rows: int, row: np.ndarray, term: np.ndarray, impact: np.ndarray) -> np.ndarray:
        """Scores (documents by queries) of one tile of documents; entries are ordered by row and term."""
        out = np.zeros((rows, n), np.int64)
        for vocabulary, tile in dense:
            if not len(vocabulary):
                continue
            column = np.minimum(np.searchsorted(vocabulary, term), len(vocabulary) - 1)
            hit = vocabulary[column] == term
            used, column = np.unique(column[hit], return_inverse=True)
            left = np.zeros((rows, len(used)))
            left[row[hit], column] = impact[hit]
            out += (left @ tile[used]).astype(np.int64)
        for one, query, value in whole:
            hit = term == one
            out[np.ix_(row[hit], query)] += impact[hit][:, None] * value[None, :]
        return out


def _first_of_each(table: pa.Table, best: int) -> pa.Table:
    """The `best` rows of each query: score descending, then id, null first."""
    order = pc.sort_indices(table, sort_keys=[("query", "ascending"), ("score", "descending"), ("doc_id", "ascending")], null_placement="at_start")
    table = table.take(order)
    query = table.column("query").to_numpy()
    starts = np.searchsorted(query, query, "left")
    return table.filter(pa.array(np.arange(len(query)) - starts < best))


def _score(broadcast, best: int, kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, tiles, queries, documents, total = broadcast.value
        schema = pa.schema([("query", pa.int64()), ("score", pa.int64()), ("doc_id", kind)])
        kept, floor = schema.empty_table(), np.ones(queries, np.int64)  # floor: the least score that can still be among the best
        for batch in batches:
            ids = batch.column("doc_id")
            for low, counts, row, term, often in _held(batch, known):
                impact = impacts(often, counts[row], documents, total)
                new = [kept]
                for start in range(0, len(counts), DOCUMENTS):
                    rows = min(DOCUMENTS, len(counts) - start)
                    a, b = np.searchsorted(row, (start, start + rows))
                    for first, n, dense, whole in tiles.tiles:
                        scores = Tiles.scores(dense, whole, n, rows, row[a:b] - start, term[a:b], impact[a:b])
                        least = floor[first : first + n]
                        if rows > best:
                            least = np.maximum(least, np.partition(scores, rows - best, axis=0)[rows - best])
                        at, query = np.nonzero(scores >= least)
                        new.append(pa.table([pa.array(query + first), pa.array(scores[at, query]), ids.take(pa.array(at + start + low))], schema=schema))
                kept = _first_of_each(pa.concat_tables(new), best)
                query, score = kept.column("query").to_numpy(), kept.column("score").to_numpy()
                last = np.flatnonzero(np.diff(query, append=-1) != 0)
                full = last[np.bincount(query, minlength=queries)[query[last]] >= best]
                floor[query[full]] = score[full]
        yield from kept.combine_chunks().to_batches()

    return run


def search(docs: DataFrame, queries: DataFrame, doc_id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", best: int = BEST) -> DataFrame:
    """The `best` documents of each query: item_id, rank (from 1), doc_id, score above 0; equal scores by id, null first.

    A null or wordless text has no term, isn't counted among the documents and is never found; a null or wordless query
    finds nothing. Repeated documents are found each; repeated queries give their rows each. Whole texts count, however
    long. With no document or no query there is no row. Extra columns of either table are ignored, whatever their names.
    """
    spark = docs.sparkSession
    plain = pick(docs, {"doc_id": doc_id, "text": text})
    asked = pick(queries, {"item": item, "text": item_text})
    kind, of = plain.schema["doc_id"].dataType, asked.schema["item"].dataType
    found = None
    for block in _blocks(asked):
        counted = plain.select("text").mapInArrow(_count(spark.sparkContext.broadcast(block.terms)), "term bigint, n bigint")
        sums = counted.groupBy("term").agg(F.sum("n").alias("n")).toArrow()
        term, n = sums.column("term").to_numpy(), sums.column("n").to_numpy()
        documents, total = (int(n[term == x].sum()) for x in (-1, -2))
        held = np.zeros(len(block.terms), np.int64)
        held[term[term >= 0]] = n[term >= 0]
        known = spark.sparkContext.broadcast((block.terms, Tiles(block, weights(documents, held)), len(block.items), documents, total))
        rows = plain.mapInArrow(_score(known, best, _arrow(plain)), f"query bigint, score bigint, doc_id {kind.simpleString()}")
        order = [F.desc("score"), F.asc_nulls_first("doc_id")]
        for name, part in (("salted", ["query", "salt"]), ("rank", ["query"])):
            rows = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
            rows = rows.withColumn(name, F.row_number().over(Window.partitionBy(*part).orderBy(*order))).where(F.col(name) <= best)
        names = spark.createDataFrame([(i, x, int(k)) for i, (x, k) in enumerate(zip(block.items, block.rows))], f"query bigint, item_id {of.simpleString()}, k bigint")
        # As many rows as the block has queries, so bounded by its characters.
        named = rows.join(F.broadcast(names), "query")
        named = named.select("item_id", F.col("rank").cast("int"), "doc_id", "score", F.explode(F.sequence(F.lit(1).cast("bigint"), "k"))).drop("col")
        found = named if found is None else found.union(named)
    if found is None:
        return spark.createDataFrame([], f"item_id {of.simpleString()}, rank int, doc_id {kind.simpleString()}, score bigint")
    return found


def _arrow(plain: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(plain.schema["doc_id"].dataType)
