"""Folders of any file system that Spark writes to."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _open(spark, path)
    return system.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder and all in it; one that is not there is no error."""
    system, place = _open(spark, path)
    system.delete(place, True)


def extent(spark: SparkSession, path: str) -> dict[str, int]:
    """Number and bytes of the files under a path, which may be a pattern."""
    system, place = _open(spark, path)
    found = [system.getContentSummary(s.getPath()) for s in system.globStatus(place) or ()]
    return {
        "files": sum(s.getFileCount() for s in found),
        "bytes": sum(s.getLength() for s in found),
    }
