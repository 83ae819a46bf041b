"""Windows over a stream of trace files: an extension, as batch tables are all that the domain asks for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def stream_events(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    return spark.readStream.schema(schema).parquet(folder)


def stage_windows(events: DataFrame, time: str, stage: str, value: str, width: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """start, stage, n, mean: tumbling windows with a watermark; works on streams and tables alike."""
    rows = events.withWatermark(time, late) if events.isStreaming else events
    sums = rows.groupBy(F.window(time, width).alias("w"), F.col(stage).alias("stage")).agg(F.count("*").alias("n"), F.avg(value).alias("mean"))
    return sums.select(F.col("w.start").alias("start"), "stage", "n", "mean")
