"""Bounded samples of labelled documents for the classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulyst.llm.frames import crc_class, pick


def sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held_out: int, bounds: dict[int, int], doc_id: str = "doc_id", text: str = "text", more: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, text, label, weight, draw, `more`) of labelled documents that may be learned from.

    Rows whose crc32 of the id as text modulo `modulus` is `held_out`, null labels and null ids are left out; of
    several labels of an id the greatest counts. About bounds[label] ids of each label are drawn by
    a hash of the id, all where there are fewer; `weight` undoes uneven draws; `draw` is uniform in 0 to 1
    and independent of the sample. The drawn ids, bounded so, are broadcast; texts are not moved.
    """
    known = pick(labels, {"id": doc_id, "label": label}).where("id IS NOT NULL AND label IS NOT NULL")
    known = known.where(crc_class("id", modulus) != held_out).groupBy("id").agg(F.max("label").cast("int").alias("label"))
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    drawn = None
    for value, n in counts.items():
        share = min(1.0, bounds.get(value, 0) / n)
        place = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("sample")), F.lit(1 << 30))
        part = known.where((F.col("label") == value) & (place < int(share * (1 << 30)))).withColumn("weight", F.lit(1 / share if share else 0.0))
        drawn = part if drawn is None else drawn.union(part)
    if drawn is None:
        drawn = known.withColumn("weight", F.lit(1.0))
    texts = pick(docs, {"doc_id": doc_id, "text": text} | {x: x for x in more})
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("part")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    return texts.join(F.broadcast(drawn), F.col("doc_id") == F.col("id")).select("doc_id", "text", "label", "weight", draw.alias("draw"), *more)
