"""Row numbers that stay the same each time a table is read."""

from __future__ import annotations

import gc
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwright.session import scratch_path


#: Lines of a plan that reads files and changes rows one by one, and expressions that differ each time.
PLAIN = r"[ +:*()\d-]*(AdaptiveSparkPlan|Project|Filter|ColumnarToRow|FileScan|LocalTableScan|Range)\b"
RANDOM = r"\b(rand|randn|uuid|shuffle|randstr|uniform|monotonically_increasing_id)\("


def numbered(documents: DataFrame, *columns) -> DataFrame:
    """``row`` (a long, unique) and the given columns.

    Operators read their input more than once.  A scan of files deals its rows the
    same way each time, so a number by place is stable.  Behind anything but
    projections and filters of such a scan (a shuffle, an RDD, a sample, random
    values) it may not be: then the rows are written once to the shared folder and
    read from there.
    """
    out = documents.select(F.monotonically_increasing_id().alias("row"), *columns)
    plan = documents._jdf.queryExecution().executedPlan().toString()
    if not all(re.match(PLAIN, line) for line in plan.splitlines() if line.strip()) or re.search(RANDOM, plan):
        path = scratch_path(documents.sparkSession, "rows")
        out.write.parquet(path)
        out = documents.sparkSession.read.parquet(path)
    return out


def saved(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder (compressed) and read from there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a table that ``saved`` has written and nothing reads any more."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI.create(folder))
        path.getFileSystem(conf).delete(path, True)


def small(df: DataFrame, size: str, most: int = 32 << 20) -> DataFrame:
    """With a broadcast hint if the measured bytes (the sum of the expression ``size``) allow it."""
    total = df.agg(F.sum(F.expr(size))).first()[0] or 0
    return F.broadcast(df) if total <= most else df


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of jobs whose results are checkpointed or written.

    Its cleaner waits for the driver's garbage collection, which may not come
    before the next large shuffle does.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
