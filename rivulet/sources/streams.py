"""Replayable file streams of raw records and enrichments (S3).

The reference's sources keep no position and start over after a failure.
A file stream keeps its offsets in the query checkpoint, so a restarted
query resumes where it stopped. ``max_files_per_trigger`` or
``max_bytes_per_trigger`` bounds the size of a micro-batch; files are taken
oldest first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rivulet.schemas import ENRICHMENT, RAW


BYTES_PER_TRIGGER = 2 * 1024 ** 3


def byte_limit(args) -> int | None:
    """A job's bytes per micro-batch: as asked for, else a default, so that a
    first start never takes its whole backlog as one batch."""
    if args.max_files_per_trigger:
        return args.max_bytes_per_trigger
    return args.max_bytes_per_trigger or BYTES_PER_TRIGGER


def batch_limit(reader, max_files_per_trigger: int | None = None,
                max_bytes_per_trigger: int | None = None):
    """Bound a file stream's micro-batch by files or by bytes (Spark allows
    one of the two; bytes are the better bound for per-batch memory)."""
    if max_files_per_trigger and max_bytes_per_trigger:
        raise ValueError("give max_files_per_trigger or max_bytes_per_trigger, not both")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", int(max_bytes_per_trigger))
    return reader


def _file_stream(spark: SparkSession, path: str, schema: T.StructType,
                 max_files_per_trigger: int | None, fmt: str,
                 path_glob: str | None, max_bytes_per_trigger: int | None = None) -> DataFrame:
    reader = batch_limit(spark.readStream.schema(schema).format(fmt),
                         max_files_per_trigger, max_bytes_per_trigger)
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    return reader.load(path)


def raw_stream(spark: SparkSession, path: str, schema: T.StructType = RAW,
               max_files_per_trigger: int | None = None, fmt: str = "parquet",
               path_glob: str | None = None,
               max_bytes_per_trigger: int | None = None) -> DataFrame:
    return _file_stream(spark, path, schema, max_files_per_trigger, fmt, path_glob,
                        max_bytes_per_trigger)


def enrichment_stream(spark: SparkSession, path: str, schema: T.StructType = ENRICHMENT,
                      max_files_per_trigger: int | None = None, fmt: str = "parquet",
                      path_glob: str | None = None,
                      max_bytes_per_trigger: int | None = None) -> DataFrame:
    return _file_stream(spark, path, schema, max_files_per_trigger, fmt, path_glob,
                        max_bytes_per_trigger)
