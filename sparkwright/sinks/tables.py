"""Writers: text, delimited, compressed, partitioned, bucketed, checkpointed.

Every writer targets a path given by the caller; jobs that need an
intermediate use :func:`sparkwright.session.scratch_path`, which lives in
the cluster's shared checkpoint folder, so a lost executor never takes a
written table with it.
"""

from __future__ import annotations

import uuid
from typing import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ..session import scratch_path


def kv_text(df: DataFrame, key: str, value: str | list[str], path: str,
            sep: str = "\t", mode: str = "errorifexists", compression: str | None = None) -> None:
    """Key<TAB>value text lines (the default job output)."""
    values = [value] if isinstance(value, str) else value
    line = F.concat_ws(sep, *[F.col(c).cast("string") for c in [key, *values]])
    w = df.select(line.alias("value")).write.mode(mode)
    if compression:
        w = w.option("compression", compression)
    w.text(path)


def delimited(df: DataFrame, path: str, sep: str = ",", mode: str = "errorifexists",
              compression: str | None = None) -> None:
    """Store with a chosen delimiter and no quoting; nulls become empty fields."""
    line = F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns])
    w = df.select(line.alias("value")).write.mode(mode)
    if compression:
        w = w.option("compression", compression)
    w.text(path)


def parquet(df: DataFrame, path: str, mode: str = "errorifexists",
            partition_by: list[str] | None = None, compression: str = "snappy") -> None:
    w = df.write.mode(mode).option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def json_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Records to text lines, one JSON object per row."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode(mode).text(path)


def sequence_file(df: DataFrame, key: str, value: str, path: str,
                  codec: str | None = "org.apache.hadoop.io.compress.DefaultCodec") -> None:
    """(key, value) pairs as a block-compressed SequenceFile."""
    rdd = df.select(key, value).rdd.map(lambda r: (r[0], r[1]))
    rdd.saveAsSequenceFile(path, compressionCodecClass=codec)


def by_key(df: DataFrame, path: str, keys: list[str], fmt: str = "parquet",
           mode: str = "errorifexists") -> None:
    """One output directory per key value (``key=value/``).

    Rows are rebalanced on the keys: small keys share a task, and AQE splits
    a hot key by its size, so its directory is written by as many tasks as it
    needs.
    """
    out = df.hint("rebalance", *[F.col(k) for k in keys])
    out.write.mode(mode).partitionBy(*keys).format(fmt).save(path)


def bucketed_table(df: DataFrame, name: str, buckets: int, by: str,
                   sort_by: str | None = None, mode: str = "overwrite",
                   path: str | None = None) -> DataFrame:
    """Bucketed (and sorted) table; joins/aggs on ``by`` then skip a shuffle."""
    w = df.write.mode(mode).bucketBy(buckets, by)
    if sort_by:
        w = w.sortBy(sort_by)
    if path:
        w = w.option("path", path)
    w.format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def static_partition(df: DataFrame, path: str, values: Mapping[str, str],
                     mode: str = "append") -> None:
    """Load rows into one literal partition (LOAD ... PARTITION (k=v))."""
    sub = "/".join(f"{k}={v}" for k, v in values.items())
    df.write.mode(mode).parquet(f"{path.rstrip('/')}/{sub}")


def list_partitions(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """SHOW PARTITIONS of a partitioned dataset: folders are listed, no data is read."""
    name = f"partitions_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
    try:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        found = [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]   # one row for each folder
    finally:
        spark.sql(f"DROP TABLE {name}")
    return spark.createDataFrame([(p,) for p in found], "partition string")


def compact(spark: SparkSession, src_glob: str, path: str,
            target_bytes: int = 128 * 1024 * 1024, files: int | None = None) -> int:
    """Small-file compaction: (file name, bytes) records into few files.

    The output file count is total input bytes / ``target_bytes`` (read from
    file metadata, no content scanned) unless ``files`` is given.  Returns
    the number of output files asked for.
    """
    src = spark.read.format("binaryFile").load(src_glob)
    if files is None:
        total = src.agg(F.sum("length")).first()[0] or 0
        files = max(1, -(-total // target_bytes))
    (src.select(F.col("path").alias("file"), F.col("content"))
     .repartition(files, "file").write.parquet(path))
    return files


def sorted_lookup_file(df: DataFrame, key: str, path: str, buckets: int | None = None) -> None:
    """Key-hashed, key-sorted files: a point lookup reads one bucket's row groups."""
    out = df.repartition(buckets, key) if buckets else df.repartition(key)
    (out.sortWithinPartitions(key)
     .write.option("parquet.block.size", 8 * 1024 * 1024).parquet(path))


def latest_cells(df: DataFrame, key_cols: list[str], time: str) -> DataFrame:
    """Of the rows with one key the newest; the aggregate combines before the shuffle."""
    others = [c for c in df.columns if c not in key_cols and c != time]
    newest = df.groupBy(*key_cols).agg(F.max_by(F.struct(*others), time).alias("_cell"))
    return newest.select(*key_cols, "_cell.*")


def keyed_table(df: DataFrame, key_cols: list[str], path: str,
                partitions: int | None = None) -> None:
    """Range-partitioned, key-sorted table (wide-column store layout)."""
    out = (df.repartitionByRange(partitions, *key_cols) if partitions
           else df.repartitionByRange(*key_cols))
    out.sortWithinPartitions(*key_cols).write.parquet(path)


def multi_insert(per_key: DataFrame, outputs: Mapping[str, tuple],
                 fmt: str = "parquet") -> dict[str, DataFrame]:
    """Several outputs from one scan: ``outputs`` maps a name to (columns, condition or None).

    The source is computed and written once; each output is then written
    from that copy, so the scan below runs once whatever the number of outputs.
    """
    spark = per_key.sparkSession
    whole = scratch_path(spark, "insert-all")
    per_key.write.format(fmt).save(whole)
    src, result = spark.read.format(fmt).load(whole), {}
    for name, (cols, condition) in outputs.items():
        p = scratch_path(spark, f"insert-{name}")
        (src.where(condition) if condition is not None else src).select(*cols).write.format(fmt).save(p)
        result[name] = spark.read.format(fmt).load(p)
    return result


def write_mode(df: DataFrame, path: str, mode: str) -> DataFrame:
    """Write with a mode ('errorifexists' default, 'overwrite', 'append',
    'ignore') and return what the path holds afterwards."""
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.parquet(path)


def _newest_mtime(spark: SparkSession, path: str) -> int | None:
    """Latest modification time (ms) of the files under ``path``, None if there is no such path."""
    try:
        row = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
               .agg(F.unix_millis(F.max("modificationTime"))).first())
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return row[0]


def _finished_at(spark: SparkSession, path: str) -> int | None:
    """When the writer of ``path`` left its success marker (ms), None if it has not."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/_SUCCESS")
    fs = marker.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getFileStatus(marker).getModificationTime() if fs.exists(marker) else None


def checkpointed(df: DataFrame, path: str, inputs: list[str] | None = None) -> DataFrame:
    """Materialise ``df`` at ``path`` unless a whole copy newer than its inputs exists.

    A copy is whole when its writer has left ``_SUCCESS``; what a broken run
    has written is written anew.  Staleness compares file modification times
    (metadata only).  An input that is missing or cannot be read is an error.
    """
    spark = df.sparkSession
    done = _finished_at(spark, path)
    times = [_newest_mtime(spark, p) for p in inputs or []]
    if any(t is None for t in times):
        raise FileNotFoundError(f"an input of {path} is missing: {inputs}")
    if done is None or any(t > done for t in times):
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
