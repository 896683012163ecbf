"""Session settings and shared-storage helpers.

Every job in the package takes a ``SparkSession`` from the caller.  The
helpers here only fill in settings that are still unset (local runs and
tests); on a cluster the operator's configuration wins.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings this package relies on.  Applied with ``setdefault`` semantics.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Folders of a table are listed in so many tasks; the default is a task for each of up to 10,000 folders.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    # Parquet files written by jobs stay splittable and compressed.
    "spark.sql.parquet.compression.codec": "snappy",
}


def build_session(master: str = "local[*]", app: str = "sparkwright",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local session used by tests and the bench; clusters bring their own."""
    builder = (SparkSession.builder.master(master).appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "16g"))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set package defaults on an existing session where unset."""
    for k, v in DEFAULT_CONF.items():
        if spark.conf.get(k, None) in (None, ""):
            spark.conf.set(k, v)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` (the cluster-wide setting).  A local
    session without one gets a temporary folder; on a cluster that would be
    each machine's own disk, so there it is an error.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not is_local(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="sparkwright-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once for a context.

    Functions that run in Python workers are imported there by name.  The
    package's files go as one archive through Spark's own file distribution.
    """
    sc, root = spark.sparkContext, os.path.dirname(os.path.abspath(__file__))
    if getattr(sc, "_sparkwright_shipped", False) or not os.path.isdir(root):
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="sparkwright-code-"), f"{os.path.basename(root)}.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if not name.endswith(".pyc"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(archive)
    sc._sparkwright_shipped = True


def is_local(master: str) -> bool:
    """One machine, one process: ``local``, ``local[4]``, but not ``local-cluster``."""
    return master == "local" or master.startswith("local[")


_made: list[str] = []
_tables: list[str] = []


def table_name(base: str) -> str:
    """A new catalog name for an intermediate table; ``cleanup`` drops it."""
    _tables.append(f"{base}_{uuid.uuid4().hex[:12]}")
    return _tables[-1]


def cleanup(spark: SparkSession) -> int:
    """Drop the tables and delete the intermediates this process has made, at the end of a run; returns how many paths."""
    n = 0
    while _tables:
        spark.sql(f"DROP TABLE IF EXISTS {_tables.pop()}")
    while _made:
        path = spark._jvm.org.apache.hadoop.fs.Path(_made.pop())
        n += bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))
    return n


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared folder (never reused)."""
    base = shared_dir(spark).rstrip("/")
    # the checkpoint dir Spark reports has its own uuid child; stay beside it
    _made.append(f"{base}/sw-{name}-{uuid.uuid4().hex[:12]}")
    return _made[-1]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table as a DataFrame (lazy; pruning reaches the scan)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
