"""Small text files in the file systems Spark reaches, for lists of what a table consists of."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    """(path, file system) as the cluster sees them."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, system = _at(spark, path)
    return system.exists(place)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none where there is no such folder."""
    place, system = _at(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(place)) if system.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    place, system = _at(spark, path)
    system.delete(place, True)


def read_text(spark: SparkSession, path: str) -> str:
    place, system = _at(spark, path)
    stream = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_new(spark: SparkSession, path: str, text: str) -> None:
    """Write a file that is not there yet; readers see all of it or nothing."""
    place, system = _at(spark, path)
    if system.exists(place):
        raise FileExistsError(path)
    part = spark._jvm.org.apache.hadoop.fs.Path(place.getParent(), f"_{place.getName()}.part")
    stream = system.create(part, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not system.rename(part, place):
        raise FileExistsError(path)
