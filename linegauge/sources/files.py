"""Folders of a shared file system, through the file systems Spark itself is set up for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _place(spark, path)
    return files.exists(place)


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder to a name that is free, in one step of the file system."""
    files, place = _place(spark, source)
    _, goal = _place(spark, target)
    files.mkdirs(goal.getParent())
    if files.exists(goal) or not files.rename(place, goal):
        raise OSError(f"{source} could not be moved to {target}")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder; none is no error."""
    files, place = _place(spark, path)
    files.delete(place, True)
