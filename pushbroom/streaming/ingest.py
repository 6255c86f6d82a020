"""Streams, an extension: new pixels and events as they arrive, through the same column expressions as batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators import spectra as S


def stream_pixels(spark: SparkSession, folder: str, schema: StructType, files_per_trigger: int = 100) -> DataFrame:
    """Pixels of Parquet files as they appear in ``folder``."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def reflectance_stream(pixels: DataFrame, cos_inc: Column, flux: Column) -> DataFrame:
    """I/F of a stream of pixels: no state, so each batch is on its own."""
    return pixels.withColumn("spectrum", S.reflect(S.mask_bands(F.col("spectrum")), None, cos_inc, flux))


def windowed_means(events: DataFrame, width: str = "1 hour", late: str = "10 minutes", key: str = "event_type") -> DataFrame:
    """(start, end, key, n, mean) of ``value`` in tumbling windows of ``ts``, dropping events later than ``late``."""
    w = events.withWatermark("ts", late).groupBy(F.window("ts", width), key).agg(F.count("*").alias("n"), F.avg("value").alias("mean"))
    return w.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), key, "n", "mean")


def append_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Writes what a stream holds now to Parquet and stops; a restart goes on from ``checkpoint``."""
    return stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
