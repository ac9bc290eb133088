"""Optional streaming front-ends.  The batch operators do the work; a stream only feeds them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from sonoloom.schemas import STAGING


def follow_staging(spark: SparkSession, path: str) -> DataFrame:
    """New staging files as they arrive."""
    return spark.readStream.schema(STAGING).parquet(path)


def each_increment(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """Run ``handle(rows, batch_id)`` over everything that has arrived, then stop."""
    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
