"""Folders of a table, through the file system Spark reads them with."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def existing(spark: SparkSession, paths: list[str]) -> list[str]:
    """Those of the paths that exist."""
    found = []
    for path in paths:
        place, system = _at(spark, path)
        if system.exists(place):
            found.append(path)
    return found


def remove_folders(spark: SparkSession, base: str, folders: list[str]) -> None:
    """Delete folders below ``base``; those that are not there are no matter."""
    for folder in folders:
        place, system = _at(spark, f"{base}/{folder}")
        system.delete(place, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where there is no such folder."""
    place, system = _at(spark, path)
    return sorted(status.getPath().getName() for status in system.listStatus(place)) if system.exists(place) else []


def older_folders(spark: SparkSession, path: str, column: str, limit: str, below: str = "") -> list[str]:
    """Folders ``column=value`` below ``path``, at any depth, whose value sorts before ``limit``."""
    found = []
    for name in children(spark, f"{path}/{below}" if below else path):
        here = f"{below}/{name}" if below else name
        if name.startswith(f"{column}="):
            value = name[len(column) + 1 :]
            found += [here] if value < limit and value[:1].isdigit() else []
        elif "=" in name:
            found += older_folders(spark, path, column, limit, here)
    return found
