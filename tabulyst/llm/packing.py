"""Best-fit packing of token pieces into sequences by swap-based local search.

Documents become token ids and an end id; longer ones are cut into full sequences and one shorter
first piece, which needs no packing beyond that. The shorter pieces are dealt into blocks of bounded
size. In a block they are first placed by best fit; then, while there are more bins than the
block's tokens need, underfull bins are emptied by local search, the emptiest first: moves, one-for-one
exchanges and exchanges of two pieces for one, each of which makes a fuller bin fuller and so raises
the sum of squared fills. A bin that no step improves is set aside until another one changes what is possible; the search
ends when no underfull bin improves. What lies in a block's poorly filled bins is dealt to new blocks and packed again,
until one block is left or a turn saves less than one sequence a block.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulyst.llm.frames import Stages, bounded_batches, pick

SEQUENCE = 2048
END = 0
#: Bounds of a block: sequences' worth of tokens, and pieces.
BLOCK_SEQUENCES, BLOCK_PIECES = 4096, 200_000
#: Bins less full than this are packed again with those of other blocks.
WELL_FILLED = 0.97
TOKENIZER = "byte_bpe_50k"
SPECIAL = "<|endoftext|>"


@cache
def _encoder(name: str):
    """Token ids of a text. The same vocabulary and splitting in the faster library; texts that spell
    the special token, or that it can't split, go through the tokenizer file itself."""
    import base64

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    pattern = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
    fast = tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    exact = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
    # Possessive runs split alike, but a run of very many blanks overflows the other library's stack.
    blanks = re.compile(r"\s{5000}")

    def encode(text: str) -> list[int]:
        if SPECIAL in text or blanks.search(text):
            return exact.encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode


def token_pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sequence: int = SEQUENCE, tokenizer: str = TOKENIZER, keep_ids: bool = False) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32, key and, if asked for, ids) of every document.

    A null or empty text is one piece that holds the end id alone. `key` tells rows of equal doc_id apart.
    """
    bounded_batches(docs.sparkSession)
    plain = pick(docs, {"doc_id": doc_id, "text": text})
    kind = plain.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, key bigint" + ", ids array<bigint>" * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, key = _encoder(tokenizer), TaskContext.get().partitionId() << 33
        for batch in batches:
            rows, pieces, starts, lengths, sums, ids = [], [], [], [], [], []
            for row in range(len(batch)):
                tokens = array("I", encode(batch.column("text")[row].as_py() or ""))
                tokens.append(END)
                low, high, piece = 0, len(tokens) % sequence or min(sequence, len(tokens)), 0
                while low < len(tokens):
                    own = tokens[low:high]
                    rows.append(row)
                    pieces.append(piece)
                    starts.append(low)
                    lengths.append(len(own))
                    sums.append(zlib.crc32(own.tobytes()))
                    if keep_ids:
                        ids.append(list(own))
                    low, high, piece = high, high + sequence, piece + 1
            keys = np.arange(key, key + len(rows), dtype=np.int64)
            key += len(rows)
            columns = [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(pieces, pa.int32()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(sums, pa.int64()), pa.array(keys)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "key"]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(ids, pa.list_(pa.int64()))] * keep_ids, names=names + ["ids"] * keep_ids)

    return plain.mapInArrow(run, schema)


class Bins:
    """Bins of one block and their local search."""

    def __init__(self, sizes: np.ndarray, capacity: int):
        self.sizes, self.capacity = sizes.astype(np.int64), capacity
        self.bin = np.empty(len(sizes), np.int64)
        self.fill: list[int] = []
        self._best_fit()
        self.fill = np.array(self.fill, np.int64)

    def _best_fit(self) -> None:
        """Largest piece first, into the fullest bin that holds it; `spaces` has a bit for each free space."""
        free: list[list[int]] = [[] for _ in range(self.capacity + 1)]
        spaces = 0
        for item in np.argsort(-self.sizes, kind="stable").tolist():
            size = int(self.sizes[item])
            above = spaces >> size
            if above:
                space = size + (above & -above).bit_length() - 1
                number = free[space].pop()
                if not free[space]:
                    spaces &= ~(1 << space)
            else:
                space, number = self.capacity, len(self.fill)
                self.fill.append(0)
            self.fill[number] += size
            self.bin[item] = number
            if left := space - size:
                free[left].append(number)
                spaces |= 1 << left

    def _exchange(self, items: list[int], source: int) -> bool:
        """Put items of the source into the bin that they fill best, for none or one smaller piece of it."""
        out = int(self.sizes[items].sum())
        space = self.capacity - self.fill
        space[source] = -1
        fits = np.flatnonzero(space >= out)
        if len(fits):
            target = int(fits[np.argmin(space[fits])])
            if self.fill[target] + out > self.fill[source]:
                self._move(items, source, target)
                return True
        gain = out - self.sizes
        room = space[self.bin]
        able = np.flatnonzero((gain > 0) & (gain <= room) & (self.fill[self.bin] + gain > self.fill[source]))
        if not len(able):
            return False
        other = int(able[np.argmin(room[able] - gain[able])])
        target = int(self.bin[other])
        self._move(items, source, target)
        self._move([other], target, source)
        return True

    def _move(self, items: list[int], source: int, target: int) -> None:
        total = int(self.sizes[items].sum())
        self.bin[items] = target
        self.fill[source] -= total
        self.fill[target] += total

    def _improve(self, source: int) -> bool:
        """One exchange that takes tokens out of the source."""
        items = np.flatnonzero(self.bin == source)
        items = items[np.argsort(-self.sizes[items], kind="stable")]
        for item in items.tolist():
            if self._exchange([item], source):
                return True
        seen = set()
        for i, first in enumerate(items.tolist()):
            for second in items[i + 1 :].tolist():
                total = int(self.sizes[first] + self.sizes[second])
                if total in seen or total > self.capacity:
                    continue
                seen.add(total)
                if self._exchange([first, second], source):
                    return True
        return False

    def search(self) -> None:
        """Empty underfull bins, the emptiest first, while fewer bins could hold all; every step raises the squared fill.

        A bin without a step is set aside. Bins are tried again as long as a whole round of them empties one.
        """
        least = -(-int(self.sizes.sum()) // self.capacity)
        used = int((self.fill > 0).sum())
        while used > least:
            before, aside = used, self.fill >= WELL_FILLED * self.capacity
            while used > least:
                open_ = np.where((self.fill > 0) & ~aside, self.fill, self.capacity + 1)
                source = int(np.argmin(open_))
                if open_[source] > self.capacity:
                    break
                while self.fill[source] > 0 and self._improve(source):
                    pass
                aside[source] = True
                used = int((self.fill > 0).sum())
            if used == before:
                break


def _pack_block(sequence: int):
    def run(key: tuple, block: pa.Table) -> pa.Table:
        block = block.sort_by("key")
        sizes = block.column("length").to_numpy()
        bins = Bins(sizes, sequence)
        bins.search()
        order = np.argsort(bins.bin, kind="stable")
        ends = np.cumsum(sizes[order])
        numbers = bins.bin[order]
        first = np.concatenate(([True], numbers[1:] != numbers[:-1]))
        offsets = np.empty(len(sizes), np.int64)
        before = ends - sizes[order]
        offsets[order] = before - np.repeat(before[first], np.diff(np.append(np.flatnonzero(first), len(order))))
        names = [x for x in block.column_names if x not in ("block", "sequence_id", "offset", "filled")]
        more = {"block": block.column("block"), "sequence_id": pa.array(bins.bin), "offset": pa.array(offsets), "filled": pa.array(bins.fill[bins.bin])}
        return pa.table({**{x: block.column(x) for x in names}, **more})

    return run


def pack(pieces: DataFrame, sequence: int = SEQUENCE) -> DataFrame:
    """Pieces (length, key and more columns) with sequence_id and offset; no sequence exceeds `sequence` tokens.

    Equal lengths are told apart by `key`; an empty table gives an empty result. A piece as long as a
    sequence gets one of its own without a shuffle. Further columns go along, if their names aren't those of the result.
    """
    stages = Stages(pieces.sparkSession)
    pieces = stages.keep(pieces, "pieces")
    place = {"sequence_id": F.lit(0).cast("bigint"), "offset": F.lit(0).cast("bigint")}
    done = [pieces.where(F.col("length") >= sequence).withColumns(place | {"sequence_id": -F.col("key") - 1})]
    names = done[0].columns
    open_, turn, before = pieces.where(F.col("length") < sequence), 0, None
    while True:
        n, tokens = open_.agg(F.count("*"), F.sum("length")).first()
        blocks = max(1, -(-int(tokens or 0) // (sequence * BLOCK_SEQUENCES)), -(-n // BLOCK_PIECES))
        dealt = open_.withColumns(place | {"block": F.pmod(F.xxhash64("key", F.lit(turn)), F.lit(blocks)), "filled": F.lit(0).cast("bigint")})
        packed = dealt.groupBy("block").applyInArrow(_pack_block(sequence), dealt.select(*pieces.columns, "block", "sequence_id", "offset", "filled").schema)
        packed = stages.keep(packed, "packed").withColumn("sequence_id", F.col("sequence_id") + F.col("block") * (1 << 32) + F.lit(turn) * (1 << 56))
        well = F.col("filled") >= int(WELL_FILLED * sequence)
        # A piece at the start of its sequence stands for the sequence.
        used, left = packed.where("offset = 0").agg(F.count("*"), F.count(F.when(~well, 1))).first()
        if blocks == 1 or not left or before is not None and before - used < blocks:
            done.append(packed.select(*names))
            break
        done.append(packed.where(well).select(*names))
        open_, turn, before = packed.where(~well).select(*pieces.columns), turn + 1, left
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of pieces packed with their ids: at most one sequence's ids in a group."""
    placed = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(placed, lambda x: x["ids"])).alias("ids"))


def digest(packed: DataFrame) -> DataFrame:
    """The contract's columns from pack(token_pieces(docs))."""
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
