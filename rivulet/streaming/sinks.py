"""Sinks (K1-K10). A sink is a callable ``DataFrame -> StreamingQuery`` so
the writer is independent of where the rows go (K8).

``append_sink`` appends ENRICHED rows to a partitioned Parquet table with
the streaming file sink: insert only, no index, no dedup (K1, K10). Each
micro-batch's files are committed to ``<table>/_spark_metadata`` under the
batch id, after the offsets are logged in the checkpoint. On restart a batch
already in that log is skipped, and files of a failed attempt are never
listed in it, so readers that follow the log see each row once after any
executor or driver loss (K3). ``availableNow`` processes
everything present, commits and stops (K4).
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rivulet.fixed import DEFAULT_PARTITION_NAME, PARTITION_COLUMN
from rivulet.session import session_conf
from rivulet.sources.fs import exists, names, read_text, write_text


Sink = Callable[[DataFrame], StreamingQuery]


def trigger_options(trigger: str | dict | None) -> dict:
    """``"once"``/``"available_now"`` -> availableNow; ``"10 seconds"`` ->
    processingTime; a dict is passed through to ``DataStreamWriter.trigger``."""
    if trigger is None:
        return {}
    if isinstance(trigger, dict):
        return trigger
    if trigger in ("once", "available_now", "availableNow"):
        return {"availableNow": True}
    return {"processingTime": trigger}


def table_checkpoint(path: str) -> str:
    """The checkpoint that belongs to a table: beside it, so that every run
    into the table continues its batch numbers."""
    return f"{path.rstrip('/')}.checkpoint"


def owner_path(path: str) -> str:
    """Where a table's checkpoint is named: beside it, so the table's folder
    holds nothing but its files."""
    return f"{path.rstrip('/')}.owner"


def query_id(spark: SparkSession, checkpoint: str) -> str | None:
    """The id that a query keeps in its checkpoint from its first start on."""
    kept = f"{checkpoint.rstrip('/')}/metadata"
    return json.loads(read_text(spark, kept))["id"] if exists(spark, kept) else None


def check_append(spark: SparkSession, path: str, checkpoint: str) -> None:
    """Refuse a checkpoint that is not the table's own: its batch ids are not
    those of the table's commits, and the sink skips ids it has committed.

    A table's first run writes its query's id beside it (``bind``). A table
    without one (an older one, or one whose first run was killed before it
    wrote the id) takes a checkpoint that has run at least."""
    if not names(spark, f"{path}/_spark_metadata"):
        return
    own, known = query_id(spark, checkpoint), exists(spark, owner_path(path))
    if known and read_text(spark, owner_path(path)) != own or not names(spark, f"{checkpoint}/offsets"):
        raise ValueError(
            f"{path} has commits of another checkpoint; batches of this checkpoint ({checkpoint}) "
            f"would be skipped. Use the table's own (by default {table_checkpoint(path)})")


def bind(query: StreamingQuery, spark: SparkSession, path: str) -> StreamingQuery:
    """Name the query's checkpoint as the table's own."""
    if not exists(spark, owner_path(path)) or not names(spark, f"{path}/_spark_metadata"):
        write_text(spark, owner_path(path), str(query.id))
    return query


def _rebalanced(spark: SparkSession, bytes_per_file: int | None) -> dict:
    """Settings of a query whose micro-batches are rebalanced. A small batch
    still has a task for each core: a partition value stays in one of them,
    so that makes no more files."""
    if not bytes_per_file:
        return {}
    return {"spark.sql.adaptive.advisoryPartitionSizeInBytes": int(bytes_per_file),
            "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
            "spark.sql.adaptive.coalescePartitions.minPartitionNum": spark.sparkContext.defaultParallelism}


def append_sink(path: str, checkpoint: str | None = None, trigger: str | dict | None = "available_now",
                partition_col: str = PARTITION_COLUMN,
                max_records_per_file: int | None = None,
                parquet_block_size: int | None = None,
                parquet_page_size: int | None = None,
                cluster_by_partition: bool = False,
                files_per_partition: int = 4,
                write_parallelism: int | None = None,
                bytes_per_file: int | None = None,
                fill_missing_partition: bool = True,
                query_name: str | None = None,
                compression: str | None = None) -> Sink:
    """Append to a partitioned Parquet table through the file sink.

    * No shuffle and no sort before the write by default (K6): each task
      writes the partitions it holds.
    * ``cluster_by_partition`` shuffles rows by ``(partition, salt)`` so a
      time bucket is written by at most ``files_per_partition`` tasks:
      fewer, larger files, and a hot bucket is still split.
    * ``fill_missing_partition`` writes a row without a bucket under the
      default partition's name (S8).
    * ``write_parallelism`` shuffles rows evenly to that many writing tasks
      (K7); the scan and the join before it keep their own.
    * ``bytes_per_file`` (K5) has each micro-batch rebalanced by partition:
      Spark's adaptive execution joins small partitions and splits large ones
      until each writing task has about that many bytes of shuffled rows.
    * ``max_records_per_file`` / Parquet block and page size (K5); Spark caps
      rows per file, not bytes: ``rows_per_file`` turns a size in bytes into
      rows. ``compression``: Parquet codec (e.g. zstd).
    * ``checkpoint`` is the table's own by default (``table_checkpoint``); a
      checkpoint other than that of the table's commits is refused.
    """
    checkpoint = checkpoint or table_checkpoint(path)

    def start(df: DataFrame) -> StreamingQuery:
        check_append(df.sparkSession, path, checkpoint)
        out = df
        if fill_missing_partition:
            out = out.withColumn(partition_col,
                                 F.coalesce(F.col(partition_col), F.lit(DEFAULT_PARTITION_NAME)))
        if bytes_per_file:
            out = out.hint("rebalance", F.col(partition_col))
        elif cluster_by_partition:
            spread = F.pmod(F.xxhash64(*[F.col(c) for c in out.columns]),
                            F.lit(int(files_per_partition)))
            out = out.repartition(F.col(partition_col), spread)
        elif write_parallelism:
            out = out.repartition(int(write_parallelism))
        writer = (out.writeStream.format("parquet").outputMode("append")
                  .partitionBy(partition_col)
                  .option("path", path)
                  .option("checkpointLocation", checkpoint))
        if max_records_per_file:
            writer = writer.option("maxRecordsPerFile", int(max_records_per_file))
        if parquet_block_size:
            writer = writer.option("parquet.block.size", int(parquet_block_size))
        if parquet_page_size:
            writer = writer.option("parquet.page.size", int(parquet_page_size))
        if compression:
            writer = writer.option("compression", compression)
        if query_name:
            writer = writer.queryName(query_name)
        opts = trigger_options(trigger)
        if opts:
            writer = writer.trigger(**opts)
        with session_conf(df.sparkSession, _rebalanced(df.sparkSession, bytes_per_file)):  # the query keeps what it started with
            return bind(writer.start(), df.sparkSession, path)

    return start


def rows_per_file(spark: SparkSession, path: str, max_bytes: int) -> int:
    """Rows that fill ``max_bytes`` of Parquet, by the mean width of the rows
    that the table's files hold now (K5)."""
    files = spark.read.parquet(path).select("_metadata.file_path", "_metadata.file_size")
    per_file = files.groupBy("file_path").agg(F.count(F.lit(1)).alias("n"),
                                              F.max("file_size").alias("bytes"))
    seen = per_file.agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes")).first()
    return max(1, int(max_bytes * (seen["n"] or 1) / (seen["bytes"] or max_bytes)))


def discard_sink(checkpoint: str, trigger: str | dict | None = None,
                 query_name: str | None = None) -> Sink:
    """Drop every row (K9); the rows are still computed and counted."""

    def start(df: DataFrame) -> StreamingQuery:
        writer = df.writeStream.format("noop").option("checkpointLocation", checkpoint)
        if query_name:
            writer = writer.queryName(query_name)
        opts = trigger_options(trigger)
        if opts:
            writer = writer.trigger(**opts)
        return writer.start()

    return start
