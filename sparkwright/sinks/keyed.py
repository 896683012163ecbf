"""A keyed table that takes load upon load: sorted runs, merged on read, compacted by key range.

A cell is a row with a key and a version; of the cells with one key the newest
counts (of equal versions the one loaded last).  The key space is cut into
regions.  Every load writes a run of its own (``run=3/region=7/``) and then commits
a manifest that names it, so a load that fails leaves nothing to be seen.

Loads differ in what they cost and leave behind, not in what the table holds:

* ``load_rows``: rows as they come, a folder a region, neither dealt nor sorted;
* ``load_direct``: no shuffle, each task sorts what it has;
* ``load_bulk``: dealt by region, each region's files sorted by key; AQE splits
  a region that is large.

A read takes the runs of the regions it needs and keeps the newest cell of each
key; a region that has been compacted since its last load is read as it is.
``compact`` merges the runs of some regions, or all, into one.  Versions and keys
must not be null.
"""

from __future__ import annotations

from typing import Any, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.boundaries import partition_number, range_cuts
from . import manifest

RESERVED = ("run", "region")


class KeyedTable:
    """A handle; what the table holds is read from its manifest each time."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    @classmethod
    def create(cls, spark: SparkSession, path: str, schema: T.StructType, key: str, version: str,
               cuts: Sequence[Any] = ()) -> "KeyedTable":
        """An empty table; region i holds the keys up to cut i."""
        clash = [c for c in schema.names if c in RESERVED]
        if clash or key not in schema.names or version not in schema.names:
            raise ValueError(f"the schema needs {key} and {version} and must not have {RESERVED}")
        manifest.commit(spark, path, 0, {"schema": schema.json(), "key": key, "version": version,
                                         "cuts": list(cuts), "live": [[] for _ in range(len(cuts) + 1)], "single": []})
        return cls(spark, path)

    # -- state -----------------------------------------------------------------

    def _state(self) -> tuple[int, dict]:
        return manifest.latest(self.spark, self.path)

    @property
    def schema(self) -> T.StructType:
        import json
        return T.StructType.fromJson(json.loads(self._state()[1]["schema"]))

    def runs(self) -> list[list[int]]:
        """For each region the runs that count, oldest first."""
        return self._state()[1]["live"]

    # -- loads -----------------------------------------------------------------

    def _load(self, df: DataFrame, prepare) -> int:
        version, state = self._state()
        run, key, names = version + 1, state["key"], self.schema.names
        rows = (df.select(*(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema.fields))
                .withColumn("region", partition_number(key, state["cuts"])))
        good = F.col(key).isNotNull() & F.col(state["version"]).isNotNull()
        rows = rows.where(F.when(good, True).otherwise(F.raise_error(F.lit("null key or version in a load")).cast("boolean")))
        prepare(rows, key).select(*names, "region").write.mode("overwrite").partitionBy("region").parquet(f"{self.path}/run={run}")
        state["live"] = [[*own, run] for own in state["live"]]
        state["single"] = []
        manifest.commit(self.spark, self.path, run, state)
        return run

    def load_rows(self, rows: DataFrame | Iterable[tuple]) -> int:
        """Append rows as they come; returns the number of the run."""
        if not isinstance(rows, DataFrame):
            rows = self.spark.createDataFrame(list(rows), self.schema)
        return self._load(rows, lambda df, key: df)

    def load_direct(self, df: DataFrame) -> int:
        """Each task sorts its own rows; nothing is shuffled."""
        return self._load(df, lambda rows, key: rows.sortWithinPartitions("region", key))

    def load_bulk(self, df: DataFrame) -> int:
        """Rows are dealt by region and sorted; the files of a region are its own."""
        return self._load(df, lambda rows, key: rows.hint("rebalance", F.col("region")).sortWithinPartitions("region", key))

    # -- reads -----------------------------------------------------------------

    def _cells(self, state: dict, regions: Sequence[int]) -> DataFrame:
        """All cells of the regions with their run and region."""
        paths = manifest.existing(self.spark, [
            f"{self.path}/run={run}/region={r}" for r in regions for run in state["live"][r]])
        schema = T.StructType([*self.schema.fields, T.StructField("run", T.LongType()), T.StructField("region", T.IntegerType())])
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(*paths)

    def _newest(self, cells: DataFrame, state: dict) -> DataFrame:
        key, names = state["key"], self.schema.names
        others = [c for c in names if c != key]
        newest = F.max_by(F.struct(*others), F.struct(state["version"], "run")).alias("_cell")
        return cells.groupBy("region", key).agg(newest).select("region", key, "_cell.*").select(*names, "region")

    def _regions(self, state: dict, low: Any, high: Any) -> list[int]:
        """Regions that may hold keys in [low, high]."""
        cuts, last = state["cuts"], len(state["cuts"])
        first = sum(c < low for c in cuts) if low is not None else 0
        end = sum(c < high for c in cuts) if high is not None else last
        return list(range(first, end + 1))

    def read(self, low: Any = None, high: Any = None) -> DataFrame:
        """The newest cell of every key in [low, high]; other regions are not opened."""
        _, state = self._state()
        single = set(state["single"])
        regions = self._regions(state, low, high)
        plain = [r for r in regions if r in single]
        mixed = [r for r in regions if r not in single]
        within: Column = F.lit(True)
        if low is not None:
            within = within & (F.col(state["key"]) >= F.lit(low))
        if high is not None:
            within = within & (F.col(state["key"]) <= F.lit(high))
        names, out = self.schema.names, []
        if plain:
            out.append(self._cells(state, plain).where(within).select(*names))
        if mixed or not plain:
            out.append(self._newest(self._cells(state, mixed).where(within), state).select(*names))
        return out[0] if len(out) == 1 else out[0].unionByName(out[1])

    def get(self, key: Any) -> DataFrame:
        """The cell of one key, from its region alone."""
        return self.read(key, key)

    # -- upkeep ----------------------------------------------------------------

    def compact(self, regions: Sequence[int] | None = None) -> int:
        """Merge the runs of the regions (default all) into one sorted run; returns its number."""
        version, state = self._state()
        own = sorted(set(range(len(state["live"])) if regions is None else regions))
        run, key = version + 1, state["key"]
        merged = self._newest(self._cells(state, own), state)
        (merged.hint("rebalance", F.col("region")).sortWithinPartitions("region", key)
         .write.mode("overwrite").partitionBy("region").parquet(f"{self.path}/run={run}"))
        for r in own:
            state["live"][r] = [run]
        state["single"] = sorted({*state["single"], *own})
        manifest.commit(self.spark, self.path, run, state)
        return run

    def recut(self, regions: int) -> int:
        """Compact everything into regions of about equal size, by a sketch of the keys."""
        version, state = self._state()
        run, key = version + 1, state["key"]
        whole = self.read()
        cuts = range_cuts(whole, key, regions)
        (whole.withColumn("region", partition_number(key, cuts)).hint("rebalance", F.col("region"))
         .sortWithinPartitions("region", key).write.mode("overwrite").partitionBy("region").parquet(f"{self.path}/run={run}"))
        state |= {"cuts": cuts, "live": [[run] for _ in range(len(cuts) + 1)], "single": list(range(len(cuts) + 1))}
        manifest.commit(self.spark, self.path, run, state)
        return run

    def vacuum(self) -> list[int]:
        """Delete the runs that the newest manifest does not name; returns their numbers.

        For times when no reader of an older manifest is at work.
        """
        version, state = self._state()
        used = {run for own in state["live"] for run in own}
        gone = [r for r in range(1, version + 1) if r not in used
                and manifest.existing(self.spark, [f"{self.path}/run={r}"])]
        for r in gone:
            manifest.delete(self.spark, f"{self.path}/run={r}")
        return gone
