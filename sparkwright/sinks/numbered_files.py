"""Tables whose file is known from the key: one-file lookups and bucket samples.

Rows are dealt into numbered folders by a rule that is stored with the table.
A reader works out the number first and lists that folder alone.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import manifest

#: Row groups of lookup files, so that a lookup reads a small part of its file.
ROW_GROUP_BYTES = 1 << 20


def _write(df: DataFrame, number: Column, sort: str, path: str, content: dict) -> None:
    """Folders ``file=i``; a hot number is split into files by its size."""
    if "file" in df.columns:
        raise ValueError("the column name file is taken")
    (df.withColumn("file", number).hint("rebalance", F.col("file")).sortWithinPartitions("file", sort)
     .write.option("parquet.block.size", ROW_GROUP_BYTES).partitionBy("file").parquet(path))
    manifest.commit(df.sparkSession, path, 0, content | {"schema": df.schema.json()})


class LookupFile:
    """Rows by key: the stored partitioner gives the file, its sorted row groups the rows."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        state = manifest.latest(spark, path)[1]
        self.key, self.files = state["key"], state["files"]
        self.schema = T.StructType.fromJson(json.loads(state["schema"]))

    @classmethod
    def write(cls, df: DataFrame, key: str, path: str, files: int) -> "LookupFile":
        """Deal the rows into ``files`` folders by a hash of the key, sorted by the key."""
        _write(df, cls._number(F.col(key), files), key, path, {"key": key, "files": files})
        return cls(df.sparkSession, path)

    @staticmethod
    def _number(key: Column, files: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(files)).cast("int")

    def number(self, value: Any) -> int:
        """The folder of a key, by the expression that wrote it (evaluated by the optimizer, without a job)."""
        typed = F.lit(value).cast(self.schema[self.key].dataType)
        return self.spark.sql("SELECT 1").select(self._number(typed, self.files)).first()[0]

    def _read(self, numbers: list[int]) -> DataFrame:
        paths = manifest.existing(self.spark, [f"{self.path}/file={n}" for n in numbers])
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def get(self, value: Any) -> DataFrame:
        """All rows of one key (none if it is absent or null)."""
        if value is None:
            return self.spark.createDataFrame([], self.schema)
        return self._read([self.number(value)]).where(F.col(self.key) == F.lit(value))

    def get_all(self, keys: DataFrame) -> DataFrame:
        """All rows whose key is in the column of that name; only folders that can hold one are listed."""
        kind = self.schema[self.key].dataType
        wanted = keys.select(F.col(self.key).cast(kind).alias(self.key)).where(F.col(self.key).isNotNull()).distinct()
        numbers = [r[0] for r in wanted.select(self._number(F.col(self.key), self.files)).distinct().collect()]
        return self._read(sorted(numbers)).join(wanted, self.key, "left_semi")


def _bucket_value(column: str, kind: T.DataType) -> Column:
    """The sample's rule: whole numbers by their value, other types by their hash."""
    return F.col(column) if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)) else F.hash(column)


class BucketFolders:
    """A table in numbered buckets of one column, so that a bucket sample reads its share only."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        state = manifest.latest(spark, path)[1]
        self.column, self.buckets = state["key"], state["files"]
        self.schema = T.StructType.fromJson(json.loads(state["schema"]))

    @classmethod
    def write(cls, df: DataFrame, column: str, path: str, buckets: int) -> "BucketFolders":
        """Folders by the rule; null values are in bucket 0 with whole numbers, by their hash otherwise."""
        number = F.coalesce(F.pmod(_bucket_value(column, df.schema[column].dataType), F.lit(buckets)), F.lit(0)).cast("int")
        _write(df, number, column, path, {"key": column, "files": buckets})
        return cls(df.sparkSession, path)

    def sample(self, bucket: int, of: int) -> DataFrame:
        """TABLESAMPLE(BUCKET bucket OUT OF of ON column): the rows with value mod ``of`` equal to bucket - 1.

        With ``of`` a divisor of the number of buckets whole folders are the
        sample; with a multiple it is part of one folder; otherwise all are read.
        """
        if not 1 <= bucket <= of:
            raise ValueError("bucket must be in 1..of")
        numbers = [n for n in range(self.buckets)
                   if (n % of == bucket - 1 if self.buckets % of == 0 else
                       (bucket - 1) % self.buckets == n if of % self.buckets == 0 else True)]
        paths = manifest.existing(self.spark, [f"{self.path}/file={n}" for n in numbers])
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        value = _bucket_value(self.column, self.schema[self.column].dataType)
        return self.spark.read.schema(self.schema).parquet(*paths).where(F.pmod(value, F.lit(of)) == bucket - 1)
