"""Folders of a file system that Spark reaches: names only, no file is opened."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern, sorted."""
    path, system = _path(spark, pattern)
    return sorted(s.getPath().toString() for s in system.globStatus(path) or [])


def stored_commits(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the complete ``commit=`` folders below, ascending. A write that broke off has no success mark."""
    found = folders(spark, f"{folder}/commit=*/_SUCCESS")
    return sorted(int(f.rsplit("/", 2)[-2].removeprefix("commit=")) for f in found)


def remove_folder(spark: SparkSession, name: str) -> None:
    path, system = _path(spark, name)
    system.delete(path, True)


def rename_folder(spark: SparkSession, name: str, target: str) -> None:
    """Moves a folder to a name that is free, in one step where the file system has one."""
    path, system = _path(spark, name)
    goal, _ = _path(spark, target)
    system.mkdirs(goal.getParent())
    if not system.rename(path, goal):
        raise OSError(f"can't rename {name} to {target}")
