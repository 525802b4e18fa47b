"""Reading the enriched table: full snapshot (S4) or unbounded stream.

The table is a partitioned Parquet directory written by the streaming file
sink. Its ``_spark_metadata`` log lists committed files only, and both
readers below follow it, so uncommitted files of a running writer are never
seen. The schema is always passed: a day-grain partition value such as
``20240101`` would otherwise be inferred as an int.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.fixed import DEFAULT_PARTITION_NAME, PARTITION_COLUMN
from rivulet.schemas import ENRICHED, conform
from rivulet.sources.fs import mkdirs
from rivulet.sources.streams import batch_limit


def make_table_dir(spark: SparkSession, path: str) -> None:
    """Create an empty table directory (T6), on any Hadoop file system.

    It must stay empty: a stray file would make a file stream reader decide
    the directory has no commit log and list files directly for good.
    """
    mkdirs(spark, path)


def _named(rows: DataFrame) -> DataFrame:
    """A null partition value reads as the default partition's name (S8). The
    sink writes that name itself; for tables of other writers only, since a
    filter on the replaced column cannot prune partitions: give the filter to
    the reader instead (``where``)."""
    return rows.fillna(DEFAULT_PARTITION_NAME, [PARTITION_COLUMN])


def _in_partitions(rows: DataFrame, where: Callable[[Column], Column] | None) -> DataFrame:
    """Rows whose partition, by its name, ``where`` holds for. The condition is
    put to the raw column, and to the default name for a null one, so it
    prunes folders, the null folder too where the name is not asked for."""
    if where is None:
        return rows
    raw, name = F.col(PARTITION_COLUMN), F.lit(DEFAULT_PARTITION_NAME)
    return rows.filter(where(raw) | (raw.isNull() & where(name)))


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType = ENRICHED,
                  require: bool = False, name_missing: bool = False,
                  where: Callable[[Column], Column] | None = None) -> DataFrame:
    """All committed rows (S4). Partition pruning works on ``partition``
    filters, and on ``where`` (a condition on the partition's name) also with
    ``name_missing``; read tasks follow ``read_parallelism`` (S9)."""
    rows = _in_partitions(spark.read.schema(schema).parquet(path), where)
    return conform(_named(rows) if name_missing else rows, schema, require=require)


def read_incremental(spark: SparkSession, path: str, schema: T.StructType = ENRICHED,
                     create: bool = False, max_files_per_trigger: int | None = None,
                     require: bool = False,
                     max_bytes_per_trigger: int | None = None,
                     name_missing: bool = False,
                     where: Callable[[Column], Column] | None = None) -> DataFrame:
    """Unbounded read of newly committed files, earliest first.

    A fresh checkpoint starts at the first commit; a restarted query resumes
    from its checkpoint. ``create=True`` makes the (empty) directory so the
    reader can start before the writer (T6); the reader then waits.
    """
    if create:
        make_table_dir(spark, path)
    reader = batch_limit(spark.readStream.schema(schema), max_files_per_trigger,
                         max_bytes_per_trigger)
    rows = _in_partitions(reader.parquet(path), where)
    return conform(_named(rows) if name_missing else rows, schema, require=require)


def read_parallelism(tasks: int) -> dict[str, str]:
    """Settings (for ``session_conf``) that split a scan into at least about
    ``tasks`` read tasks (S9), small files too: Spark counts an open cost for
    each file, which would pack several into one task."""
    return {"spark.sql.files.minPartitionNum": str(int(tasks)),
            "spark.sql.files.openCostInBytes": "0"}
