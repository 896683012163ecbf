"""A stream's output that readers see batch by batch, whole or not at all.

Each micro-batch is written to a folder of its own (``batch=7/``) and then committed by
a manifest with its number.  Readers list the manifests and open only the folders
these name: a folder that is being written, or that a failed batch has left, is
not seen.  A batch that is run again overwrites its folder if it is not committed,
and is skipped if it is, so every row is seen once.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import scratch_path
from ..sinks import manifest


def run_committed(df: DataFrame, out: str, checkpoint: str | None = None,
                  before_commit: Callable[[int], None] | None = None) -> int:
    """Run a streaming frame until its input is drained; returns the number of committed batches.

    ``before_commit`` is called with the batch's number between write and commit;
    if it raises, the batch stays unseen and the query fails.
    """
    spark = df.sparkSession

    def each(batch: DataFrame, number: int) -> None:
        if number in manifest.versions(spark, out):
            return
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")
        if before_commit:
            before_commit(number)
        manifest.commit(spark, out, number, {"schema": batch.schema.json()})

    (df.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint or scratch_path(spark, "committed-ckpt"))
     .trigger(availableNow=True).start().awaitTermination())
    return len(manifest.versions(spark, out))


def read_committed(spark: SparkSession, out: str) -> DataFrame:
    """Rows of the committed batches with the batch's number; FileNotFoundError before the first commit."""
    import json
    last, newest = manifest.latest(spark, out)
    schema = T.StructType.fromJson(json.loads(newest["schema"])).add("batch", T.LongType())
    paths = [f"{out}/batch={n}" for n in manifest.versions(spark, out) if n <= last]
    return spark.read.schema(schema).option("basePath", out).parquet(*paths)
