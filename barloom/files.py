"""Small files and folder listings through Spark's own file systems, so that any store Spark can read will do."""
from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _at(spark, path)
    return fs.exists(place)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the entries of a folder, sorted; none where there is no folder."""
    fs, place = _at(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, place = _at(spark, path)
    fs.delete(place, True)


def rename(spark: SparkSession, path: str, new: str) -> None:
    fs, place = _at(spark, path)
    if not fs.rename(place, spark._jvm.org.apache.hadoop.fs.Path(new)):
        raise OSError(f"{path} was not renamed to {new}")


def read_text(spark: SparkSession, path: str) -> str:
    fs, place = _at(spark, path)
    stream = fs.open(place)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Put a whole file in place at once; False, changing nothing, where there is one."""
    fs, place = _at(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.draft")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    if not fs.exists(place) and fs.rename(draft, place):
        return True
    fs.delete(draft, False)
    return False
