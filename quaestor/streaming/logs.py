"""Streaming forms of the log summary, the expiring cache, hit counters and resumable ingest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def event_stream(spark: SparkSession, path: str, schema: str, per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", per_trigger) if per_trigger else reader).parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))


def windowed_summary(events: DataFrame, late: str = "1 day", width: str = "1 day") -> DataFrame:
    """Calls, failures and mean latency per window and type; rows later than ``late`` are dropped with their windows."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count(F.lit(1)).alias("calls"), F.count_if(F.col("event_type") == "error").alias("errors"), F.round(F.avg("value"), 6).alias("mean_ms")).select(F.col("window.start").cast("date").alias("day"), "event_type", "calls", "errors", "mean_ms")


def drained(stream: DataFrame, name: str, mode: str, checkpoint: str) -> DataFrame:
    """Run a stream over what has landed and return its result as a table, written beside the checkpoint.

    Each micro-batch overwrites its own folder, so that one that is repeated after a failure adds nothing; in complete mode the
    last is the result, in append mode all are.
    """
    spark, where = stream.sparkSession, f"{checkpoint}-{name}"
    done: list[int] = []

    def put(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{where}/batch={n}")
        done.append(n)

    stream.writeStream.outputMode(mode).foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    if not done:
        return spark.createDataFrame([], stream.schema)
    return spark.read.schema(stream.schema).parquet(*[f"{where}/batch={n}" for n in (done[-1:] if mode == "complete" else sorted(set(done)))])


def ingest_new(stream: DataFrame, target: str, keys: list[str], checkpoint: str) -> None:
    """Append rows whose key the target lacks; a batch that is repeated after a failure adds nothing."""

    def put(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        fresh = batch.dropDuplicates(keys)
        try:
            fresh = fresh.join(spark.read.parquet(target).select(*keys), keys, "left_anti")
        except Exception as e:  # the first batch: no target yet
            if "PATH_NOT_FOUND" not in str(e):
                raise
        fresh.write.mode("append").parquet(target)

    stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def live(cache: DataFrame, now: Column | int) -> DataFrame:
    """Rows of a cache whose time to live hasn't passed."""
    return cache.where(F.col("fetched_at") + F.col("ttl_s") >= now)
