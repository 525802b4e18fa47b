"""Small file-system helpers; every path goes through its Hadoop file system
(a path without a scheme belongs to the cluster's default one)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath, hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    hpath, fs = _hadoop_fs(spark, path)
    return fs.exists(hpath)


def is_dir(spark: SparkSession, path: str) -> bool:
    hpath, fs = _hadoop_fs(spark, path)
    return fs.exists(hpath) and fs.getFileStatus(hpath).isDirectory()


def mkdirs(spark: SparkSession, path: str) -> None:
    hpath, fs = _hadoop_fs(spark, path)
    fs.mkdirs(hpath)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    hpath, fs = _hadoop_fs(spark, path)
    if not fs.exists(hpath):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(hpath))


def rename(spark: SparkSession, path: str, to: str) -> None:
    hpath, fs = _hadoop_fs(spark, path)
    if not fs.rename(hpath, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"cannot rename {path} to {to}")


def modified(spark: SparkSession, path: str) -> dict[str, int]:
    """Modification times (ms) of the data files in a folder."""
    hpath, fs = _hadoop_fs(spark, path)
    return {s.getPath().getName(): s.getModificationTime() for s in fs.listStatus(hpath)
            if s.getPath().getName()[0] not in "._"}


def set_modified(spark: SparkSession, path: str, ms: int) -> None:
    hpath, fs = _hadoop_fs(spark, path)
    fs.setTimes(hpath, ms, -1)


def read_text(spark: SparkSession, path: str) -> str:
    hpath, fs = _hadoop_fs(spark, path)
    stream = fs.open(hpath)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    hpath, fs = _hadoop_fs(spark, path)
    stream = fs.create(hpath, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
