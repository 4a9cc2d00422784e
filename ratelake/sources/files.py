"""File-system questions asked through Hadoop, so they work on any store Spark can read."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; empty if it does not exist."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p))


def matches(spark: SparkSession, pattern: str) -> bool:
    """True if the glob matches at least one path."""
    fs, p = _fs(spark, pattern)
    found = fs.globStatus(p)
    return found is not None and len(found) > 0


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, in place of one of that name."""
    fs, p = _fs(spark, path)
    stream = fs.create(p, True)
    stream.write(bytearray(text.encode()))
    stream.close()


def delete(spark: SparkSession, path: str) -> None:
    """A folder and all below it."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)
