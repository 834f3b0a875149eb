"""Moving files in whatever store they are in."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, system = _place(spark, path)
    return system.exists(place)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    place, system = _place(spark, folder)
    if not system.exists(place):
        return []
    return [status.getPath().getName() for status in system.listStatus(place)]


def uri(spark: SparkSession, path: str) -> str:
    """A path as ``_metadata.file_path`` shows it."""
    return _place(spark, path)[0].toUri().toString()


def move_into(spark: SparkSession, path: str, folder: str) -> None:
    """Move a file, if it is still there, into a folder."""
    place, system = _place(spark, path)
    target, _ = _place(spark, f"{folder}/{place.getName()}")
    if system.exists(place):
        system.mkdirs(target.getParent())
        if not system.rename(place, target):
            raise OSError(f"cannot move {path} to {folder}")
