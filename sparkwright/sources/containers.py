"""Container formats and external tables: Avro, JDBC, in-memory values.

Avro needs the external ``spark-avro`` module on the classpath; these
helpers check for it and raise a clear error otherwise.  JDBC reads are
partitioned on a numeric column so the import runs as many parallel
range queries instead of one.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import DataFrame, SparkSession


class FormatUnavailable(RuntimeError):
    pass


def avro_available(spark: SparkSession) -> bool:
    """True when the 'avro' data source resolves (probe on a missing path)."""
    try:
        spark.read.format("avro").load("/nonexistent/sparkwright-avro-probe")
    except Exception as e:  # path-not-found means the source itself exists
        msg = str(e)
        return "DATA_SOURCE_NOT_FOUND" not in msg and "Failed to find data source" not in msg
    return True


def read_avro(spark: SparkSession, path: str, reader_schema_json: str | None = None) -> DataFrame:
    """Avro container files; an optional reader schema applies evolution rules."""
    if not avro_available(spark):
        raise FormatUnavailable("spark-avro is not on the classpath")
    r = spark.read.format("avro")
    if reader_schema_json:
        r = r.option("avroSchema", reader_schema_json)
    return r.load(path)


def write_avro(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    if not avro_available(df.sparkSession):
        raise FormatUnavailable("spark-avro is not on the classpath")
    df.write.mode(mode).format("avro").save(path)


def read_jdbc(spark: SparkSession, url: str, table: str, column: str, lower: int, upper: int,
              partitions: int, properties: dict | None = None) -> DataFrame:
    """Relational table import split into ``partitions`` range queries."""
    return spark.read.jdbc(url, table, column=column, lowerBound=lower, upperBound=upper,
                           numPartitions=partitions, properties=properties or {})


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
               properties: dict | None = None, batch_size: int = 10_000) -> None:
    """Export rows to a relational table (one connection per task)."""
    props = {"batchsize": str(batch_size), **(properties or {})}
    df.write.jdbc(url, table, mode=mode, properties=props)


def from_values(spark: SparkSession, values: Iterable, schema: str) -> DataFrame:
    """A small in-memory collection as a DataFrame (driver-side data)."""
    return spark.createDataFrame(list(values), schema)
