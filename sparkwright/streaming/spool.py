"""Directory streams: files dropped into a folder flow to file sinks.

A stream is a file-source ``readStream`` with a checkpoint in the shared
folder, so progress is durable and a restarted query resumes where it
stopped.  ``availableNow`` processes everything present and stops, which
is how batch-style ingestion runs (and how tests run a stream to the end).
File sinks commit through their ``_spark_metadata`` log: files of an
unfinished batch are never visible to readers of the sink.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def spool_source(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Lines of files dropped into ``folder`` (value, plus source file)."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(folder).withColumn("source_file", F.col("_metadata.file_path"))


def with_arrival_time(df: DataFrame) -> DataFrame:
    """Stamp events with their processing time and year/month/day columns."""
    now = F.current_timestamp()
    return (df.withColumn("arrived_at", now)
            .withColumn("year", F.date_format(now, "yyyy"))
            .withColumn("month", F.date_format(now, "MM"))
            .withColumn("day", F.date_format(now, "dd")))


def envelope(df: DataFrame, body: str = "value", headers: dict[str, Column] | None = None) -> DataFrame:
    """Events as {headers: map<string,string>, body: string} records."""
    hs = headers or {"file": F.col("source_file"), "timestamp": F.current_timestamp().cast("string")}
    kv = [x for k, v in hs.items() for x in (F.lit(k), v.cast("string"))]
    return df.select(F.create_map(*kv).alias("headers"), F.col(body).alias("body"))


def run_to_files(df: DataFrame, out: str, fmt: str = "text", checkpoint: str | None = None,
                 partition_by: list[str] | None = None, options: dict | None = None) -> str:
    """Run a streaming frame into a file sink until the input is drained."""
    spark = df.sparkSession
    ckpt = checkpoint or scratch_path(spark, "stream-ckpt")
    w = (df.writeStream.format(fmt).option("checkpointLocation", ckpt).outputMode("append")
         .trigger(availableNow=True))
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.start(out).awaitTermination()      # ends when all is read; raises what failed
    return out


def run_fanout(df: DataFrame, required: Callable[[DataFrame, int], None],
               optional: list[Callable[[DataFrame, int], None]], checkpoint: str | None = None) -> list[str]:
    """Replicate each micro-batch to several sinks.

    The required sink's failure fails the batch (and the query, which
    then resumes from its checkpoint); an optional sink's failure is
    recorded and ignored.  Returns the messages of ignored failures.
    """
    spark = df.sparkSession
    ckpt = checkpoint or scratch_path(spark, "fanout-ckpt")
    ignored: list[str] = []

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            required(batch, batch_id)
            for sink in optional:
                try:
                    sink(batch, batch_id)
                except Exception as e:  # best effort
                    ignored.append(f"batch {batch_id}: {type(e).__name__}")
        finally:
            batch.unpersist()

    (df.writeStream.foreachBatch(each).option("checkpointLocation", ckpt)
     .trigger(availableNow=True).start().awaitTermination())
    return ignored
