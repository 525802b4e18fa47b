"""Adapters from the driver's tables to the record schemas.

``events`` plays two parts: as raw records (``event_time`` = epoch ms of
``ts``, ``data`` = ``user_id``) and as a stream of enrichment updates for
key ``user_id`` (value ``event_type``, arrival order ``event_id``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.functions.time import epoch_ms_from_ntz
from rivulet.sources.fs import is_dir
from rivulet.sources.streams import batch_limit


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str,
                 max_files_per_trigger: int | None = None,
                 max_bytes_per_trigger: int | None = None) -> DataFrame:
    """A driver table as a file stream (schema from its footer).

    A stream source must be a folder: ``<name>.parquet`` itself when it is
    one, else its parent folder filtered to that one file name.
    """
    base = sf_dir.rstrip("/")
    path = f"{base}/{name}.parquet"
    reader = batch_limit(spark.readStream.schema(spark.read.parquet(path).schema),
                         max_files_per_trigger, max_bytes_per_trigger)
    if is_dir(spark, path):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(base)


def events_as_raw(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """events -> RAW (event_time, data), plus any ``keep`` columns."""
    return events.select(
        epoch_ms_from_ntz("ts").alias("event_time"),
        F.col("user_id").cast("int").alias("data"),
        *keep,
    )


def enrichment_updates(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """events -> ENRICHMENT (timestamp, key, enrichment) plus ``keep``."""
    return events.select(
        epoch_ms_from_ntz("ts").alias("timestamp"),
        F.col("user_id").cast("int").alias("key"),
        F.col("event_type").alias("enrichment"),
        *keep,
    )
