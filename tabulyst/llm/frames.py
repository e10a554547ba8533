"""Small Spark helpers of the corpus operators: picked columns, written stages, hashed keys."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulyst.scratch import hadoop_path, scratch_root


def pick(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Only the columns `names` (new name -> name in df, exact case), whatever else df holds.

    Columns are found by place, so further columns whose names differ in case only, or repeat,
    do no harm; of repeated exact names the first counts.
    """
    placed = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    chosen = []
    for new, old in names.items():
        if old not in df.columns:
            raise ValueError(f"column {old!r} is missing; there are {df.columns}")
        chosen.append(F.col(f"c{df.columns.index(old)}").alias(new))
    return placed.select(*chosen)


def replaced(df: DataFrame, name: str, make) -> DataFrame:
    """df with its column `name` made anew by make(f), where f gives the column of a name; by place, as pick()."""
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    column = lambda x: F.col(f"c{df.columns.index(x)}")
    kind = df.schema[df.columns.index(name)].dataType
    return plain.withColumn(f"c{df.columns.index(name)}", make(column).cast(kind)).toDF(*df.columns)


#: Bytes of rows that move to Python at a time, where the session doesn't say; Spark's own default is 64 MB or 10,000 rows.
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Let batches of whole texts end by bytes, so that memory beside the heap doesn't grow with texts and columns.

    Sets the session's `spark.sql.execution.arrow.maxBytesPerBatch` unless it is set; a longer text is a batch alone.
    """
    if "spark.sql.execution.arrow.maxBytesPerBatch" not in spark.conf.getAll:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


class Stages:
    """Written tables of one operator call, in the folder that the cluster shares."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{scratch_root(spark)}/llm-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
        self.paths: dict[str, list[str]] = {}

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """df, written and read back: cuts lineage and outlives lost executors."""
        path = f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path)
        system, place = hadoop_path(self.spark, path)
        system.deleteOnExit(place)
        self.paths.setdefault(name, []).append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self, *names: str, but_last: bool = False) -> None:
        """Delete the tables kept under these names; only once all that reads them is written itself."""
        for name in names:
            paths = self.paths.get(name, [])
            while len(paths) > but_last:
                system, place = hadoop_path(self.spark, paths.pop(0))
                system.delete(place, True)


def id_key(column: str):
    """64-bit key of an id of any type; null has a key too."""
    return F.xxhash64(F.col(column).cast("string"), F.col(column).isNull())


def crc_class(column: str, modulus: int):
    """crc32 of the id as text, modulo `modulus`; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


#: A key map has about this many bits for each key, within the bounds: from 8 KB to 64 MB. Beyond that it turns fewer rows
#: away, so it may only save less of the moving of rows that an exact join drops later.
MAP_SPARE, MAP_LEAST, MAP_MOST = 32, 16, 29


def key_map(keys: DataFrame, n: int | None = None) -> np.ndarray:
    """Bit map of all `key`s (64-bit hashes), summed up in Spark: a bit by the leading half of a key, one by the other half.

    n: the number of keys, if known.
    """
    n = keys.count() if n is None else n
    bits = min(MAP_MOST, max(MAP_LEAST, (MAP_SPARE * n).bit_length()))
    halves = F.array(F.shiftrightunsigned("key", 64 - bits), F.shiftrightunsigned(F.shiftleft("key", 32), 64 - bits))
    slots = keys.select(F.explode(halves).alias("slot"))
    words = slots.select(F.shiftrightunsigned("slot", 6).alias("word"), F.expr("shiftleft(1L, CAST(slot % 64 AS INT))").alias("bit"))
    out = np.zeros(1 << (bits - 6), np.int64)
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return out.view(np.uint8)


def in_map(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys may be in the map."""
    shift = np.uint64(64 - (8 * len(bits)).bit_length() + 1)
    out = np.ones(len(keys), bool)
    for half in (keys.view(np.uint64), keys.view(np.uint64) << np.uint64(32)):
        slot = half >> shift
        out &= ((bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)
    return out
