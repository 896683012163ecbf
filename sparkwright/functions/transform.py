"""Row streams through external programs (script transforms).

Spark's ``TRANSFORM ... USING`` feeds each task's rows to a child process as
tab-separated text and reads its output back as typed columns.  Scripts
ship with the job.
"""

from __future__ import annotations

import os
import shlex
import sys

from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession

from ..session import is_local

SCRIPT_DIR = os.path.join(os.path.dirname(os.path.abspath(__file__)), "scripts")


def script_command(spark: SparkSession, name: str) -> str:
    """Shell command that runs a packaged script.

    The script is shipped with the job (``addFile``): executors find it by
    its name in their working folder.  A local session runs in the driver's
    folder, so there the fetched copy is named.
    """
    sc = spark.sparkContext
    sc.addFile(os.path.join(SCRIPT_DIR, name))
    python, script = "${PYSPARK_PYTHON:-python3}", shlex.quote(name)
    if is_local(sc.master):
        python = shlex.quote(os.environ.get("PYSPARK_PYTHON") or os.path.realpath(sys.executable))
        script = shlex.quote(SparkFiles.get(name))
    return f"{python} -u {script}"


def _sql_str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def transform(df: DataFrame, cols: list[str], command: str, out_schema: str,
              distribute_by: list[str] | None = None,
              sort_by: list[str] | None = None) -> DataFrame:
    """Stream ``cols`` of ``df`` through ``command``; parse ``out_schema``.

    With ``distribute_by`` the rows are hash-partitioned on those columns
    first, with ``sort_by`` sorted inside each partition (a reducer's
    clustered input).  Without them the command sees each input partition
    as it is (a mapper or a per-partition combiner).
    """
    spark = df.sparkSession
    src = df
    if distribute_by:
        src = src.repartition(*distribute_by)
    if sort_by:
        src = src.sortWithinPartitions(*sort_by)
    tab = "ROW FORMAT DELIMITED FIELDS TERMINATED BY '\\t'"
    text = (f"SELECT TRANSFORM({', '.join(cols)}) {tab} USING {_sql_str(command)} "
            f"AS ({out_schema}) {tab} FROM ")
    return spark.sql(text.replace("{", "{{").replace("}", "}}") + "{src}", src=src)


def map_combine_reduce(df: DataFrame, key: str, value: str, quality: str,
                       mapper: str, reducer: str, out_value: str,
                       value_type: str = "DOUBLE") -> DataFrame:
    """Streaming job with a combiner: map -> per-task reduce -> shuffle -> reduce.

    The reducer also runs as the combiner on each task's sorted output, so
    a hot key crosses the shuffle as one line per task, not all its rows.
    """
    mapped = transform(df, [key, value, quality], mapper,
                       f"{key} STRING, {value} {value_type}")
    combined = transform(mapped, [key, value], reducer,
                         f"{key} STRING, {value} {value_type}", sort_by=[key])
    return transform(combined, [key, value], reducer,
                     f"{key} STRING, {out_value} {value_type}",
                     distribute_by=[key], sort_by=[key])
