"""Scoring of streamed rows: each micro-batch is the batch scorer with the same fitted state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import col
from ..operators.models import PriceModel


def score_stream(model: PriceModel, rows: DataFrame, output: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append (id, price) Parquet files; a batch replayed after a failure replaces its own files."""
    roles = model.roles

    def write(batch: DataFrame, batch_id: int) -> None:
        asked = batch.select(col(roles.id), *map(col, roles.features))
        scored = model.predict(asked, roles.label).select(col(roles.id), col(roles.label))
        scored.write.mode("overwrite").parquet(f"{output}/batch={batch_id}")

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()
