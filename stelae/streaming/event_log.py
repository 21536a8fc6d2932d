"""The event log as a stream: hourly totals, written by micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stelae.runtime import new_shared_path


def hourly_totals(spark: SparkSession, path: str, schema, files_at_a_time: int | None = None) -> DataFrame:
    """Reads what is there as a stream (each file once) and totals events by hour and type.
    Each micro-batch writes totals of its own rows to a folder of its number, anew if it is
    run again after a failure; the sums over the batches are the result. No state is kept
    and no watermark is needed, so that rows count however late they come."""
    folder, _, name = path.rpartition("/")
    events = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet")
    if files_at_a_time:
        events = events.option("maxFilesPerTrigger", files_at_a_time)
    events = events.parquet(path if not name else f"{folder}/{name}*").withColumn("ts", F.col("ts").cast("timestamp"))
    out, marks = new_shared_path(spark, "hours"), new_shared_path(spark, "hours-checkpoint")

    def keep(batch: DataFrame, number: int) -> None:
        hour = F.date_trunc("hour", "ts").alias("hour")
        part = batch.groupBy("event_type", hour).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("usd"))
        part.write.mode("overwrite").parquet(f"{out}/batch={number}")

    running = events.writeStream.option("checkpointLocation", marks).trigger(availableNow=True).foreachBatch(keep).start()
    running.awaitTermination()
    parts = spark.read.parquet(out).groupBy("event_type", F.col("hour").cast("timestamp_ntz").alias("hour"))
    return parts.agg(F.sum("n").alias("n"), F.round(F.sum("usd"), 4).alias("usd"))
