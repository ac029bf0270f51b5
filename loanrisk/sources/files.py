"""Folders on any file system Spark can reach. The only module that uses the session's Java side."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder; any failure to find out is raised."""
    system, place = _at(spark, path)
    return system.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    system, place = _at(spark, path)
    system.delete(place, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder; raises if the file system refuses."""
    system, place = _at(spark, path)
    if not system.rename(place, _at(spark, to)[1]):
        raise OSError(f"cannot move {path} to {to}")


def matching(spark: SparkSession, folder: str, pattern: str) -> list[str]:
    """Names in a folder that match a glob pattern; none if there is no such folder."""
    system, place = _at(spark, folder)
    found = system.globStatus(spark._jvm.org.apache.hadoop.fs.Path(place, pattern))
    return sorted(status.getPath().getName() for status in found or [])
