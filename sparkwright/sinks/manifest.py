"""Versioned manifests: small JSON files that say which data of a table counts.

A writer first writes its data under new names and then commits a manifest; a
reader goes by the newest manifest, so it sees a table before or after a write
and never in between.  A manifest appears under its name by a rename, whole.
There is one writer at a time; a second one for the same version is refused.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import SparkSession

FOLDER = "_manifest"


def filesystem(spark: SparkSession, path: str):
    """(file system, path) of the Hadoop API, for any storage that Spark writes to."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _name(version: int) -> str:
    return f"{version:010d}.json"


def commit(spark: SparkSession, path: str, version: int, content: dict[str, Any]) -> None:
    """Make ``content`` the manifest with this number; FileExistsError if there is one."""
    folder = f"{path.rstrip('/')}/{FOLDER}"
    fs, target = filesystem(spark, f"{folder}/{_name(version)}")
    fs.mkdirs(target.getParent())
    if fs.exists(target):
        raise FileExistsError(f"version {version} of {path} is committed")
    _, unfinished = filesystem(spark, f"{folder}/.{_name(version)}.tmp")
    out = fs.create(unfinished, True)
    try:
        out.write(bytearray(json.dumps(content).encode()))
    finally:
        out.close()
    if not fs.rename(unfinished, target):
        raise FileExistsError(f"version {version} of {path} is committed")


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the committed manifests, ascending."""
    fs, folder = filesystem(spark, f"{path.rstrip('/')}/{FOLDER}")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith("."))


def read(spark: SparkSession, path: str, version: int) -> dict[str, Any]:
    fs, file = filesystem(spark, f"{path.rstrip('/')}/{FOLDER}/{_name(version)}")
    stream = fs.open(file)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def latest(spark: SparkSession, path: str) -> tuple[int, dict[str, Any]]:
    """(number, content) of the newest manifest; FileNotFoundError if there is none."""
    found = versions(spark, path)
    if not found:
        raise FileNotFoundError(f"{path} has no manifest")
    return found[-1], read(spark, path, found[-1])


def existing(spark: SparkSession, paths: list[str]) -> list[str]:
    """Those of the paths that exist."""
    out = []
    for path in paths:
        fs, p = filesystem(spark, path)
        if fs.exists(p):
            out.append(path)
    return out


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = filesystem(spark, path)
    return fs.delete(p, True)
