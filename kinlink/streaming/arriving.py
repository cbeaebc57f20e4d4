"""Linkage of arriving S1 records against a standing pool, by Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalize
from ..operators import blocking


def candidates_of_stream(arriving: DataFrame, pool: DataFrame, path: str, checkpoint: str, **limits):
    """Starts a query that blocks each micro-batch of raw records against the normalised pool and writes its candidates as Parquet.

    A batch's folder is named by its number and overwritten when a batch runs again, so every record is written once. The ranked caps
    need a whole batch, which is why the plan runs in foreachBatch, unchanged from the batch one.
    """

    def block(batch: DataFrame, number: int) -> None:
        found = blocking.candidates(normalize(batch), pool, **limits)
        found.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return arriving.writeStream.foreachBatch(block).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
