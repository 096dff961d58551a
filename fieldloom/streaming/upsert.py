"""Running measurements of detections that arrive tile by tile.

An extra: the batch jobs are complete without it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def running_lengths(rows: DataFrame) -> DataFrame:
    """Length and fragments per block of a stream of rows (tile, place, vineyard_id, length, seen_at); a fragment that is
    sent again within an hour counts once."""
    once = rows.withWatermark("seen_at", "1 hour").dropDuplicatesWithinWatermark(["tile", "place"])
    return once.groupBy("vineyard_id").agg(F.sum("length").alias("length"), F.count("*").alias("fragments"))


def keep_table(running: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write each state of the running table as a new version folder, so that readers never see half a table; a batch
    that is tried again replaces its own folder."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/version={number}")

    return running.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).foreachBatch(put).trigger(availableNow=True).start()
