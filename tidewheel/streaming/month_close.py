"""Month close as a stream: facts that arrive late or again are merged, and only completed months are published.

The batch model publishes a month once its end has passed. This job does the same from a stream of
fact files: each micro-batch is aggregated to (key, month), merged with the stored state by key and
month, and written anew to the months that it touches. A batch that is run again after a failure
replaces its own earlier rows, so the result is the same.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def monthly(rows: DataFrame, keys: list[str], date: str, amount: str) -> DataFrame:
    """month_end, keys, amount (sum) and rows."""
    return rows.groupBy(F.last_day(F.to_date(date)).alias("month_end"), *keys).agg(F.sum(amount).alias("amount"), F.count("*").alias("rows"))


def start(source: DataFrame, path: str, checkpoint: str, keys: list[str], date: str, amount: str, **trigger) -> StreamingQuery:
    """Writes each micro-batch's months below path, one folder per batch and month: an append that a repeated batch
    overwrites. trigger: as for DataStreamWriter.trigger (default: what there is, then stop)."""

    def close(batch: DataFrame, epoch: int) -> None:
        out = monthly(batch, keys, date, amount).withColumn("batch", F.lit(epoch))
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "month_end").parquet(path)

    return source.writeStream.foreachBatch(close).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def published(spark: SparkSession, path: str, keys: list[str], as_of: dt.date) -> DataFrame:
    """The completed months (end before as_of's month), over all batches."""
    rows = spark.read.parquet(path).filter(F.col("month_end").cast("date") < F.lit(as_of.replace(day=1)))
    return rows.groupBy(F.col("month_end").cast("date").alias("month_end"), *keys).agg(F.sum("amount").alias("amount"), F.sum("rows").alias("rows"))


def rolling(source: DataFrame, event_time: str, keys: list[str], amount: str, window: str = "30 days", slide: str = "1 day", late: str = "7 days") -> DataFrame:
    """Sums over sliding windows of a stream; rows later than `late` are left out of windows already closed."""
    return source.withWatermark(event_time, late).groupBy(F.window(event_time, window, slide), *keys).agg(F.sum(amount).alias("amount"), F.count("*").alias("rows"))
