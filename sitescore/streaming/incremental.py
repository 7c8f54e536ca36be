"""Fencing sites as their files arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from sitescore.operators.geofence import geofence


def geofence_incremental(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    fabric: DataFrame,
    out: str,
    checkpoint: str,
    to_sites: Callable[[DataFrame], DataFrame],
    pattern: str = "*.parquet",
    files_per_batch: int = 100,
) -> StreamingQuery:
    """Fence every new site file of ``folder`` once and append the hits to ``out``.

    ``to_sites`` turns file rows into sites with a polygon. Every micro-batch is
    joined by the batch operator, dense cells included, and written to its own
    ``batch_id`` directory, named by the stream (which its checkpoint remembers)
    and the batch. A batch that is run again after a failure replaces that
    directory, so no hit is lost or doubled; another stream never does.
    """

    def fence(batch: DataFrame, batch_id: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        geofence(to_sites(batch), fabric).write.mode("overwrite").parquet(f"{out}/batch_id={stream}-{batch_id}")

    files = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )
    return files.writeStream.foreachBatch(fence).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
