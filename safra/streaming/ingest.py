"""Incremental ingestion of scan listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ingest(spark: SparkSession, source: str, target: str, checkpoint: str, schema: str, key: str, time: str, late: str = "1 day", files_per_batch: int = 50) -> None:
    """Append the new rows of a folder of Parquet files to another, each key once within the watermark.

    Runs over what is there and ends; started again it goes on from its checkpoint.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    once = stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])
    query = once.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def windowed_counts(stream: DataFrame, time: str, by: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events per window and key; windows close when the watermark passes them."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), by).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), by, "n")
