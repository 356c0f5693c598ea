"""Path checks through the Hadoop file system of the path itself, so that ``file:``,
HDFS and object-store addresses behave alike."""

from __future__ import annotations

from pyspark.sql import SparkSession


def hadoop(spark: SparkSession, path: str):
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(conf), place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = hadoop(spark, path)
    return fs.exists(place)


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, place = hadoop(spark, path)
    return fs.exists(place) and fs.getFileStatus(place).isDirectory()
