"""N-gram Jaccard join as a blocked sparse matrix product with size-derived bounds.

The incidence matrix A has a row per distinct shingle set and a column per shingle; an overlap is an
entry of A times its transpose. Two sets x, y with |x & y| / |x | y| >= t share at least
a = ceil(t * (|x| + |y|) / (1 + t)) shingles, so in one common order of all columns their first common
column lies among the first |x| - a + 1 of x and the first |y| - a + 1 of y. Only those leading entries
of A are kept and columns with one row go. The product over these leading columns gives each pair its first
overlap count; pairs for which that and all that lies behind can't reach a are dropped. The rest of the
product is counted for the pairs that are left, block of columns by block, until the bound fails.

Scale. Equal sets collapse to one row of A before anything is paired. Columns found often while
the texts are read go to the end of the order, so that they lead no set that has anything rarer. Pairs are
formed in rounds: each column first pairs its rows with a few pivots; rows already in one component
are never paired again. The last round pairs, per column, what is outside its main component with all other
components, so no link between two components is lost. There an entry stands for the sizes of sets it can link with: from
its own size to the greatest that its place allows. Two entries can only lead to a link if these ranges meet, so entries
are dealt to blocks of sizes and meet only there: a column that a thousand sets share late in their order makes no pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabulyst.llm.components import components
from tabulyst.llm.frames import Stages, bounded_batches, id_key, in_map, key_map, pick
from tabulyst.llm.textbytes import NONSPACE, HashSet, Words, chunks, mix, split_words, utf8, windows

SHINGLE = 4
#: Link if UNION_PART * intersection >= part * union; OVERLAP_PART is the part unless another is asked for.
OVERLAP_PART, UNION_PART = 85, 100
#: A column seen this often, and in more than a millionth of what was seen, is put last in the order.
#: It only orders columns; every order gives the same links. So at most a million hashes are broadcast.
FREQUENT = 48
FREQUENT_SHARE = 1_000_000
#: The last round begins when it would meet this many rows for each entry, or when a round links nothing.
REST_PAIRS = 20
#: Pivots of each column and size class in a round.
PIVOTS = 3
#: Blocks of sizes in the last round, for each size class.
SIZE_BLOCKS = 2
#: Bounds of the blocks of columns of the product.
BLOCKS = np.append(np.arange(8, dtype=np.uint64) << np.uint64(61), np.uint64(2**64 - 1))


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.concatenate(([True], values[1:] != values[:-1]))] if len(values) else values


def shingle_sets(words: Words, n: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each row; fewer than n words make one shingle, none makes none."""
    first, found = windows(words, n)
    bounds = np.searchsorted(first, words.rows)
    for row, count in enumerate(words.counts().tolist()):
        if count >= n:
            yield _distinct(found[bounds[row] : bounds[row + 1]])
        elif count:
            own = Words(words.raw, words.starts, words.ends, words.hashes[words.rows[row] : words.rows[row + 1]], np.array([0, count]))
            yield windows(own, count)[1]
        else:
            yield np.empty(0, np.uint64)


def set_hash(shingles: np.ndarray) -> int:
    """64-bit name of a set, as a signed integer."""
    total = np.add.reduce(mix(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5)), dtype=np.uint64)
    return int(mix(np.array([total ^ np.uint64(len(shingles))], np.uint64)).view(np.int64)[0])


def _sets_of(batch: pa.RecordBatch, n: int):
    """(low, high, list of sets) of each chunk of a batch."""
    data, offsets = utf8(batch.column("text"))
    for low, high in chunks(offsets):
        at = offsets[low]
        words = split_words(data[at : offsets[high]], offsets[low : high + 1] - at, NONSPACE)
        yield low, high, list(shingle_sets(words, n))


def _name_sets(n: int):
    """Per row: node and size (kind 0); per chunk: shingles of two sets or more, with their number (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ids = batch.column("key").to_numpy(), batch.column("doc_id")
            for low, high, sets in _sets_of(batch, n):
                nodes = np.array([set_hash(x) for x in sets], np.int64)
                sizes = np.array([len(x) for x in sets], np.int64)
                _, once = np.unique(nodes, return_index=True)
                values = np.sort(np.concatenate([sets[i] for i in once]))
                starts = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.empty(0, int)
                counts = np.diff(np.append(starts, len(values)))
                often = counts > 1
                rows, more = high - low, int(often.sum())
                yield pa.RecordBatch.from_arrays([
                    pa.concat_arrays([ids.slice(low, rows), pa.nulls(more, ids.type)]),
                    pa.array(np.repeat(np.array([0, 1], np.int8), [rows, more])),
                    pa.array(np.concatenate([keys[low:high], values[starts][often].view(np.int64)])),
                    pa.array(np.concatenate([nodes, np.zeros(more, np.int64)])),
                    pa.array(np.concatenate([sizes, counts[often]])),
                ], names=["doc_id", "kind", "key", "node", "n"])

    return run


def _needed(sizes: np.ndarray | int, part: int):
    """Entries of a row of A that can hold the first column common with a set that it links to."""
    return sizes - -(-part * sizes // UNION_PART) + 1


def _leading(broadcast, n: int, part: int):
    """Leading entries of each distinct set of the task: shingle, node, size, place, whether frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent: HashSet = broadcast.value
        seen: set[int] = set()
        for batch in batches:
            for _, _, sets in _sets_of(batch, n):
                out: list[tuple[np.ndarray, ...]] = []
                for own in sets:
                    node = set_hash(own)
                    if not len(own) or node in seen:
                        continue
                    seen.add(node)
                    last = frequent.contains(own)
                    ordered = np.concatenate([own[~last], own[last]]) if last.any() else own
                    m = int(_needed(len(own), part))
                    place = np.arange(m, dtype=np.int32)
                    out.append((ordered[:m].view(np.int64), np.full(m, node, np.int64), np.full(m, len(own), np.int32), place, place >= len(own) - int(last.sum())))
                if out:
                    columns = [np.concatenate(x) for x in zip(*out)]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["shingle", "node", "n", "place", "frequent"])

    return run


def _whole(broadcast, n: int):
    """(node, shingles) of rows whose key may be needed, each node once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            batch = batch.filter(pa.array(in_map(broadcast.value, batch.column("key").to_numpy())))
            for _, _, sets in _sets_of(batch, n) if len(batch) else ():
                out = {node: own for own in sets if len(own) and (node := set_hash(own)) not in seen}
                seen.update(out)
                yield pa.RecordBatch.from_arrays([pa.array(out.keys(), pa.int64()), pa.array([x.view(np.int64) for x in out.values()], pa.list_(pa.int64()))], names=["node", "shingles"])

    return run


def _least_overlap(n, m, part: int):
    """SQL expression: shingles that sets of n and m shingles must share to link."""
    return F.ceil((n + m) * part / F.lit(part + UNION_PART) - F.lit(1e-9))


def _bounded(pairs: DataFrame, part: int) -> DataFrame:
    """Pairs of entries of one column whose sizes and places still allow enough common shingles."""
    least = _least_overlap(F.col("n"), F.col("p.n"), part)
    return pairs.where(
        (F.col("node") != F.col("p.node")) & (F.least("n", "p.n") * UNION_PART >= F.greatest("n", "p.n") * part)
        & (F.col("place") + least <= F.col("n")) & (F.col("p.place") + least <= F.col("p.n"))
    )


def _common(x: np.ndarray, y: np.ndarray, part: int) -> int:
    """Overlap of two sorted sets, block of columns by block; 0 once the blocks left can't reach the bound."""
    if len(x) > len(y):
        x, y = y, x
    least = -(-part * (len(x) + len(y)) // (part + UNION_PART))
    xs, ys, common = np.searchsorted(x, BLOCKS), np.searchsorted(y, BLOCKS), 0
    for i in range(len(BLOCKS) - 1):
        if common + min(len(x) - xs[i], len(y) - ys[i]) < least:
            return 0
        own, other = x[xs[i] : xs[i + 1]], y[ys[i] : ys[i + 1]]
        if len(own) and len(other):
            at = np.searchsorted(other, own)
            at[at == len(other)] = 0
            common += int(np.count_nonzero(other[at] == own))
    return common


def _count_overlaps(part: int):
    """Rows (a, b, sets of both): those whose exact overlap makes a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            left, right = (batch.column(x) for x in ("xs", "ys"))
            lv, rv = (x.values.to_numpy().view(np.uint64) for x in (left, right))
            lo, ro = left.offsets.to_numpy(), right.offsets.to_numpy()
            for i in range(len(batch)):
                x, y = lv[lo[i] : lo[i + 1]], rv[ro[i] : ro[i + 1]]
                common = _common(x, y, part)
                if common and UNION_PART * common >= part * (len(x) + len(y) - common):
                    kept.append(i)
            yield batch.select(["a", "b"]).take(pa.array(kept, pa.int64()))

    return run


def _links(pairs: DataFrame, sets: DataFrame, part: int) -> DataFrame:
    """The pairs (a, b) that link, by the exact overlap of their whole sets; both joins share one exchange of the sets."""
    joined = (
        pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("xs")), "a")
        .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("ys")), "b")
    )
    return joined.select("a", "b", "xs", "ys").mapInArrow(_count_overlaps(part), "a bigint, b bigint")


def _size_class(column, part: int):
    """Sizes a link can join lie in the same or the next class."""
    return F.floor(F.log(column.cast("double")) / F.log(F.lit(UNION_PART / part)))


def _pivot_pairs(entries: DataFrame, turn: int, part: int) -> DataFrame:
    """Each entry with the pivots of its column and of the size class below: the least led in the
    first turn, and others picked by hash; only entries of different components."""
    def rank(i: int):
        return F.col("place").cast("bigint") if turn + i == 0 else F.xxhash64("node", F.lit(PIVOTS * turn + i))

    own = entries.withColumn("class", _size_class(F.col("n"), part))
    pivots = own.groupBy("shingle", "class").agg(*[F.min(F.struct(rank(i).alias("rank"), "node", "n", "place", "root")).alias(f"p{i}") for i in range(PIVOTS)])
    chosen = F.array_distinct(F.array(*[F.struct(*[F.col(f"p{i}.{x}").alias(x) for x in ("node", "n", "place", "root")]) for i in range(PIVOTS)]))
    reach = pivots.select("shingle", "class", F.explode(chosen).alias("p")).select("shingle", F.explode(F.array("class", F.col("class") + 1)).alias("class"), "p")
    return own.join(reach, ["shingle", "class"]).where("root <> p.root")


def _by_sizes(entries: DataFrame, part: int) -> DataFrame:
    """Entries dealt to the blocks of sizes in which they can meet a partner.

    An entry of a set of n shingles can only link with one of m if m is at most `most`, and the other way round. If
    most >= n, the entry spans the blocks of n to `most`, and meets in the greater one's block; else (`narrow`) a
    partner spans `most`, so its block is enough, and two narrow ones never link.
    """
    most = F.floor((F.col("n") - F.col("place")) * F.lit(part + UNION_PART) / part + F.lit(1e-9)) - F.col("n")
    block = lambda x: F.floor(F.log(x.cast("double")) * F.lit(SIZE_BLOCKS) / F.log(F.lit(UNION_PART / part)) + F.lit(1e-9))
    able = entries.withColumn("most", most).where("most >= 1").withColumn("narrow", F.col("most") < F.col("n"))
    blocks = F.when(F.col("narrow"), F.array(block(F.col("most")))).otherwise(F.sequence(block(F.col("n")), block(F.col("most"))))
    return able.withColumn("block", F.explode(blocks))


def _counted(dealt: DataFrame) -> DataFrame:
    """Per column and block: entries, wide ones, and those of the main component; only where components differ."""
    by_root = dealt.groupBy("shingle", "block", "root").agg(F.count("*").alias("m"), F.count(F.when(~F.col("narrow"), 1)).alias("w"))
    main = by_root.groupBy("shingle", "block").agg(F.sum("m").alias("m"), F.sum("w").alias("w"), F.count("*").alias("roots"), F.max(F.struct("w", "m", "root")).alias("main"))
    return main.where("roots > 1 and w > 0").select("shingle", "block", "m", "w", "main")


def _few_left(counted: DataFrame, entries: DataFrame) -> bool:
    """Whether the last round would meet no more than REST_PAIRS rows for each entry."""
    outside, outside_wide = F.col("m") - F.col("main.m"), F.col("w") - F.col("main.w")
    met = F.col("w").cast("double") * outside + outside_wide.cast("double") * (F.col("main.m") - F.col("main.w"))
    return (counted.agg(F.sum(met)).first()[0] or 0) <= REST_PAIRS * entries.count()


def _rest_pairs(dealt: DataFrame, counted: DataFrame, stages: Stages) -> DataFrame:
    """Per column and block of sizes, every entry outside its main component with every entry of another component."""
    live = dealt.join(counted.select("shingle", "block", F.col("main.root").alias("main")), ["shingle", "block"])
    live = stages.keep(live.select("shingle", "block", "node", "n", "place", "root", "narrow", "main"), "live")
    partner = F.struct("node", "n", "place", "root", "narrow").alias("p")
    columns = ["shingle", "block", "node", "n", "place", "root"]
    wide = live.where("not narrow").join(live.where("root <> main").select("shingle", "block", partner), ["shingle", "block"])
    wide = wide.where("root <> p.root and (root = main or p.narrow or node < p.node)")
    narrow = live.where("narrow and root = main").join(live.where("root <> main and not narrow").select("shingle", "block", partner), ["shingle", "block"])
    return wide.select(*columns, "p").union(narrow.select(*columns, "p"))


def _named(pairs: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b) of pairs of entries, a < b."""
    ends = F.array_sort(F.array(F.struct("node", "n"), F.struct("p.node", "p.n")))
    return pairs.select(ends.alias("e")).select(
        F.col("e")[0]["node"].alias("a"), F.col("e")[0]["n"].alias("n_a"), F.col("e")[1]["node"].alias("b"), F.col("e")[1]["n"].alias("n_b"))


def _plausible(counted: DataFrame, part: int) -> DataFrame:
    """Pairs whose number `c` of common leading entries still allows a link.

    In the set whose leading entries end first in the order, none but those c of them is in the other, so the
    overlap is at most c plus what lies behind the leading entries.
    """
    behind = [F.ceil(F.col(x) * part / F.lit(UNION_PART) - F.lit(1e-9)) - 1 for x in ("n_a", "n_b")]
    return counted.where(F.col("c") + F.greatest(*behind) >= _least_overlap(F.col("n_a"), F.col("n_b"), part)).select("a", "b")


def _candidates(joined: DataFrame, leading: DataFrame, stages: Stages, part: int) -> DataFrame:
    """Plausible pairs of the bounded ones, by the overlap of their leading columns."""
    pairs = stages.keep(_named(_bounded(joined, part)).distinct(), "bounded")
    both = pairs.join(leading.select(F.col("node").alias("a"), F.col("own").alias("xs")), "a")
    both = both.join(leading.select(F.col("node").alias("b"), F.col("own").alias("ys")), "b")
    return _plausible(both.withColumn("c", F.size(F.array_intersect("xs", "ys"))), part)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, part: int = OVERLAP_PART) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (least doc_id reachable by links).

    A null or wordless text has an empty set, no link and itself as component. Repeated rows share
    their set and so their component. A null doc_id is never the least one; a component of null ids
    only has a null component_id. Extra columns are ignored, whatever their names. Texts link whose sets of `shingle`
    words have a similarity of `part` hundredths or more; part is a whole number from 1 to 99.
    """
    if not 0 < part < UNION_PART:
        raise ValueError(f"part is a whole number from 1 to {UNION_PART - 1}; it was {part!r}")
    stages, context = Stages(docs.sparkSession), docs.sparkSession.sparkContext
    bounded_batches(docs.sparkSession)
    plain = pick(docs, {"doc_id": doc_id, "text": text}).withColumn("key", id_key("doc_id"))
    kind = plain.schema["doc_id"].dataType.simpleString()
    named = plain.mapInArrow(_name_sets(shingle), f"doc_id {kind}, kind tinyint, key bigint, node bigint, n bigint")
    read = stages.keep(named, "named")
    rows = read.where("kind = 0").select("doc_id", "key", "node", "n")
    # One row for each set, however many documents have it.
    nodes = stages.keep(rows.where("n > 0").groupBy("node").agg(F.min("key").alias("key"), F.min("doc_id").alias("least")), "nodes")

    entries = _entries(plain, read, shingle, stages, part)
    leading = stages.keep(entries.groupBy("node").agg(F.collect_set("shingle").alias("own")), "leading")
    roots = docs.sparkSession.createDataFrame([], "node bigint, root bigint")
    turn, last, linked = 0, False, True
    while not last:
        if turn:
            dealt = _by_sizes(entries, part)
            counted = stages.keep(_counted(dealt), "counted")
            last = not linked or _few_left(counted, entries)
        joined = _rest_pairs(dealt, counted, stages) if last else _pivot_pairs(entries, turn, part)
        pairs = stages.keep(_candidates(joined, leading, stages, part), "pairs")
        turn += 1
        found = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        wanted = key_map(nodes.join(found, "node").select("key"), 2 * pairs.count())
        sets = plain.select("key", "text").mapInArrow(_whole(context.broadcast(wanted), shingle), "node bigint, shingles array<bigint>")
        links = stages.keep(_links(pairs, sets.groupBy("node").agg(F.first("shingles").alias("shingles")), part), "links")
        linked = not links.isEmpty()
        if linked:
            roots = components(links.union(roots.where("node <> root").toDF("a", "b")), stages)
            if not last:
                placed = entries.drop("root").join(roots, "node", "left").select("shingle", "node", "n", "place", F.coalesce("root", "node").alias("root"))
                entries = stages.keep(placed, "entries")
        stages.release("bounded", "pairs", "links", "counted", "live")
        stages.release("entries", "roots", but_last=True)
    return _answer(rows, nodes, roots, stages)


def _entries(plain: DataFrame, read: DataFrame, shingle: int, stages: Stages, part: int) -> DataFrame:
    """Leading entries of A in columns of two rows or more."""
    seen = read.where("kind = 1").groupBy("key").agg(F.sum("n").alias("n"))
    total = read.where("kind = 1").agg(F.sum("n")).first()[0] or 0
    frequent = seen.where(F.col("n") > max(FREQUENT, total // FREQUENT_SHARE)).select("key").toArrow()
    order = plain.sparkSession.sparkContext.broadcast(HashSet(frequent.column("key").to_numpy().view(np.uint64)))
    led = plain.select("text").mapInArrow(_leading(order, shingle, part), "shingle bigint, node bigint, n int, place int, frequent boolean")
    # Frequent columns have many rows; they are dealt by node too, as they needn't be gathered to see it.
    marked = led.withColumn("salt", F.when(F.col("frequent"), F.col("node")))
    column = Window.partitionBy("shingle", "salt").orderBy("node")
    live = marked.withColumns({"before": F.lag("node").over(column), "after": F.lead("node").over(column)})
    live = live.where("before <> node or after <> node or (frequent and before is null)")
    return stages.keep(live.select("shingle", "node", "n", "place", F.col("node").alias("root")), "entries")


def _answer(rows: DataFrame, nodes: DataFrame, roots: DataFrame, stages: Stages) -> DataFrame:
    """Each document with its set's component; sets are joined with components before documents are with sets."""
    placed = nodes.join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    placed = stages.keep(placed, "placed")
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    of = stages.keep(placed.join(least, "root").select("node", "component_id"), "components")
    linked = rows.where("n > 0").join(of, "node").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return linked.union(rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, part: int = OVERLAP_PART) -> DataFrame:
    """docs, all columns, with the document of least id of each component; documents without words stay.

    Ids are taken to be unique; rows that repeat an id stay or go together.
    """
    found = near_duplicates(docs, doc_id, text, shingle, part)
    gone = found.where("doc_id <> component_id or component_id is null and doc_id is not null").select(F.col("doc_id").alias("gone")).distinct()
    names, place = docs.columns, f"c{docs.columns.index(doc_id)}"
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    return plain.join(gone, plain[place] == gone["gone"], "left_anti").toDF(*names)
