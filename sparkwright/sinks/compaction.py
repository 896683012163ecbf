"""Small files packed into few files of about a wanted size.

Only names and sizes are looked at to plan.  A file above the target goes alone.
A file above a fifth of it shares its output with as many files of its size as fit
(sizes between target/(m+1) and target/m go m to an output).  The small ones are
laid end to end, and the running sum of their sizes, divided by the target, is
their output: such an output holds at most 1.2 times the target.

The running sums are taken in groups of about ``GROUP`` outputs, so no task orders
all names.  Empty files have no record, as Spark's file sources do not list them.
Contents are read in waves of a bounded number of files, and each goes
straight to the task that writes its output; nothing is dealt by a hash of its name.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

GROUP = 64
WAVE_FILES = 50_000
#: Files above target / SMALL share by their number, smaller ones by their bytes.
SMALL = 5


def plan(files: DataFrame, target: int) -> DataFrame:
    """``(path, length, output)`` for (path, length): outputs are numbered from 0 without gaps."""
    spark = files.sparkSession
    share = F.greatest(F.lit(0), F.least(F.lit(SMALL), F.floor(F.lit(target) / F.greatest(F.col("length"), F.lit(1)))))
    path = scratch_path(spark, "file-sizes")
    files.select("path", "length", share.cast("int").alias("share")).write.parquet(path)
    sized = spark.read.parquet(path)
    total = sized.agg(F.sum("length")).first()[0] or 0
    groups = max(1, total // (GROUP * target))
    grouped = sized.withColumn("group", F.pmod(F.xxhash64("path"), F.lit(groups)))
    before = Window.partitionBy("share", "group").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    # small files: bytes before; others: files before, ``share`` of them an output (alone if none fits)
    place = F.when(F.col("share") == SMALL, F.floor(F.coalesce(F.sum("length").over(before), F.lit(0)) / target)).otherwise(
        F.floor(F.count(F.lit(1)).over(before) / F.greatest(F.col("share"), F.lit(1))))
    path = scratch_path(spark, "outputs")
    grouped.withColumn("local", place.cast("long")).write.parquet(path)
    local = spark.read.parquet(path)
    # one row for each class of size and group
    first, seen = [], 0
    for r in local.groupBy("share", "group").agg(F.max("local").alias("last")).orderBy("share", "group").collect():
        first.append((r.share, r.group, seen))
        seen += r.last + 1
    starts = spark.createDataFrame(first, "share int, group long, start long")
    return local.join(F.broadcast(starts), ["share", "group"]).select(
        "path", "length", (F.col("start") + F.col("local")).cast("int").alias("output"))


def compact_by_size(spark: SparkSession, source: str, path: str, target: int = 128 << 20) -> int:
    """Write (file, content) of all files of ``source`` (a path or glob) into files of about ``target`` bytes; returns their number."""
    listed = spark.read.format("binaryFile").load(source).select("path", "length")
    planned = scratch_path(spark, "compaction-plan")
    plan(listed, target).write.parquet(planned)
    outputs = spark.read.parquet(planned)
    n = outputs.agg(F.max("output"), F.count(F.lit(1))).first()
    if n[0] is None:
        spark.createDataFrame([], "file string, content binary").write.parquet(path)
        return 0
    per_wave = max(1, (n[0] + 1) * WAVE_FILES // n[1])
    for first in range(0, n[0] + 1, per_wave):
        last = min(first + per_wave - 1, n[0])
        own = outputs.where(F.col("output").between(first, last))
        # about WAVE_FILES names; none of their characters is a wildcard
        names = [re.sub(r"([\[\]{}*?\\])", r"\\\1", r.path) for r in own.select("path").collect()]
        where = own.select("path", (F.col("output") - first).alias("output"))
        (spark.read.format("binaryFile").load(names).select("path", "content")
         .join(F.broadcast(where), "path").repartitionById(last - first + 1, F.col("output"))
         .select(F.col("path").alias("file"), "content").write.mode("append").parquet(path))
    return n[0] + 1
