"""Streaming forms of resumption and exact deduplication over a growing folder of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def source(spark: SparkSession, folder: str, schema: str, kind: str = "parquet", files: int = 8) -> DataFrame:
    """New files of a folder as a stream, some at a time."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", str(files)).format(kind).load(folder)


def first_seen(stream: DataFrame, digest: str, time: str, window: str) -> DataFrame:
    """Rows whose digest was not seen within the watermark: state is bounded by the window."""
    return stream.withWatermark(time, window).dropDuplicatesWithinWatermark([digest])


def windowed_counts(stream: DataFrame, time: str, window: str, late: str, keys: list[str]) -> DataFrame:
    """Counts per event-time window; rows later than the watermark are dropped by the engine."""
    counted = stream.withWatermark(time, late).groupBy(F.window(time, window).alias("w"), *keys).agg(F.count("*").alias("n"))
    return counted.select(F.col("w.start").alias("start"), *keys, "n")


def commit_new(stream: DataFrame, target: str, key: str, checkpoint: str):
    """Appends rows whose key the target does not hold: an exact gate by anti-join in each micro-batch.

    A batch that is replayed after a failure finds its own rows in the target and appends nothing again."""

    def put(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        fresh = batch.dropDuplicates([key])
        try:
            done = spark.read.parquet(target).select(key)
        except Exception as problem:  # the target appears with the first batch
            if "PATH_NOT_FOUND" not in str(problem):
                raise
            done = None
        (fresh if done is None else fresh.join(done, key, "left_anti")).write.mode("append").parquet(target)

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
