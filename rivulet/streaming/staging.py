"""Bounded input staged once in order, then admitted to a stream (S3, T4).

``stage_in_order`` range-partitions a table by its order and writes it once:
each file holds one range, sorted, and rows of equal order share a file.
``admit`` moves files into a stream's landing folder with rising modification
times. A file stream takes the files of its folder by modification time, so
one stream with a byte limit reads them in range order, whatever their number;
the table is not read again. Both can be repeated after a kill.
"""

from __future__ import annotations

import re
import time

from pyspark.sql import Column, DataFrame, SparkSession

from rivulet.sources.fs import mkdirs, modified, names, rename, set_modified

ROWS_PER_FILE = 5_000_000
STEP_MS = 10  # between modification times of admitted files
_PART = re.compile(r"part-(\d+)-.*?(?:-c(\d+))?\..*parquet")


def stage_in_order(df: DataFrame, order: Column | str, path: str,
                   rows_per_file: int = ROWS_PER_FILE) -> list[str]:
    """Write ``df`` to ``path`` in ranges of ``order`` (nulls first) of about
    ``rows_per_file`` rows; the files in range order. Reads ``df`` for its
    row count (from metadata where its source has one), for a sample of the
    order and for the write."""
    files = max(1, -(-df.count() // int(rows_per_file)))
    column = order if isinstance(order, Column) else df[order]
    (df.withColumn("__order", column).repartitionByRange(files, "__order")
     .sortWithinPartitions("__order").drop("__order").write.mode("overwrite").parquet(path))
    return staged(df.sparkSession, path)


def staged(spark: SparkSession, path: str) -> list[str]:
    """The staged files that are not admitted yet, in range order."""
    parts = [(m, n) for n in names(spark, path) if (m := _PART.fullmatch(n))]
    parts.sort(key=lambda p: (int(p[0][1]), int(p[0][2] or 0)))
    return [f"{path}/{n}" for _, n in parts]


def admit(spark: SparkSession, files: list[str], landing: str) -> None:
    """Move ``files`` into ``landing``, to be streamed in this order and after
    what is there. Raises where the file system does not keep the times."""
    mkdirs(spark, landing)
    there = max(modified(spark, landing).values(), default=0)
    at = max(there + STEP_MS, int(time.time() * 1000))
    for k, f in enumerate(files):
        set_modified(spark, f, at + k * STEP_MS)
        rename(spark, f, f"{landing}/{f.rsplit('/', 1)[1]}")
    times = modified(spark, landing)
    kept = [times[f.rsplit("/", 1)[1]] for f in files]
    if any(b <= a for a, b in zip([there, *kept], kept)):
        raise OSError(f"{landing} keeps no modification times: its files would be streamed out of "
                      "order. Admit one file at a time and run the query after each")
