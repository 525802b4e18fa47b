"""Arrival-ordered enrichment of a table as a segmented scan.

Same answer as ``arrival_bounded`` (each raw row gets the latest enrichment of
its key that arrived before it), from one range-partitioned pass:

1. raw rows and enrichments, tagged, are range-partitioned and sorted by
   ``(key, arrival, tie, value, salt)``. Spark draws the bounds from a sample,
   so partitions are even whatever the keys: a hot key, rows that arrive
   together and rows without an arrival are cut anywhere.
2. each partition is scanned once for the last enrichment before each raw
   row (Arrow batches, vectorised). Raw rows of its first key that have none
   before them stay open. The result is written with one edge row for each
   partition: its first and last key, and the last enrichment of the last key.
3. the edges, one row for each partition, give every partition the value
   carried into its first key. They are joined by partition number: by
   broadcast, after a check of their size, so raw rows are shuffled once.

The written result also cuts lineage: the carried values and the rows they go
to come from the same files, whatever executor is lost meanwhile.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.operators.enrich import broadcast_size_ok
from rivulet.session import scratch_path

# The scan runs in Python workers, which may not have this package on their
# path: ship this module's code inside the pickled function.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_EARLIEST = -(2 ** 63)
_NO_KEY = -(2 ** 63)  # in the scan, a raw row's null key; no enrichment has it
_EDGE = pa.struct([("first", pa.int32()), ("last", pa.int32()), ("has", pa.bool_()),
                   ("value", pa.string())])
_OUT = ("event_time bigint, data int, enrichment string, segment int, open boolean,"
        " edge struct<first:int,last:int,has:boolean,value:string>")


def enrich_arrival_scan(raw: DataFrame, enrichments: DataFrame, arrival_col: str,
                        enrichment_first_on_tie: bool = True,
                        segments: int | None = None) -> DataFrame:
    """RAW + ENRICHMENT tables (both with ``arrival_col``) ->
    (event_time, data, enrichment). ``segments``: range partitions, by default
    ``spark.sql.shuffle.partitions``."""
    arrival = F.coalesce(F.col(arrival_col).cast("bigint"), F.lit(_EARLIEST))
    rows = raw.select(
        F.col("data").cast("int").alias("k"), arrival.alias("arrival"), F.lit(False).alias("is_enr"),
        F.lit(None).cast("string").alias("value"),
        F.col("event_time").cast("bigint").alias("event_time"),
    ).unionByName(enrichments.filter(F.col("key").isNotNull()).select(
        F.col("key").cast("int").alias("k"), arrival.alias("arrival"), F.lit(True).alias("is_enr"),
        F.col("enrichment").cast("string").alias("value"),
        F.lit(None).cast("bigint").alias("event_time")))
    return _scanned(rows, enrichment_first_on_tie, segments)


def enrich_table_scan(table: DataFrame, raw: dict[str, Column], enrichment: dict[str, Column],
                      arrival_col: str, enrichment_first_on_tie: bool = True,
                      segments: int | None = None) -> DataFrame:
    """The same for a table whose rows are both: ``raw`` gives their
    ``event_time`` and ``data``, ``enrichment`` their ``key`` and
    ``enrichment``. Each row is read once and becomes two."""
    arrival = F.coalesce(F.col(arrival_col).cast("bigint"), F.lit(_EARLIEST))

    def part(k: Column, is_enr: bool, value: Column, event_time: Column) -> Column:
        return F.struct(k.cast("int").alias("k"), F.lit(is_enr).alias("is_enr"),
                        value.cast("string").alias("value"),
                        event_time.cast("bigint").alias("event_time"))

    parts = F.array(part(raw["data"], False, F.lit(None), raw["event_time"]),
                    part(enrichment["key"], True, enrichment["enrichment"], F.lit(None)))
    rows = (table.select(arrival.alias("arrival"), F.explode(parts).alias("p"))
            .select("arrival", "p.*").filter("NOT is_enr OR k IS NOT NULL"))
    return _scanned(rows, enrichment_first_on_tie, segments)


def _scanned(rows: DataFrame, enrichment_first_on_tie: bool, segments: int | None) -> DataFrame:
    spark = rows.sparkSession
    # Raw rows alike in all else are cut by a hash of their place.
    salt = F.xxhash64("event_time", F.monotonically_increasing_id())
    tie = F.col("is_enr") != F.lit(enrichment_first_on_tie)
    order = ["k", "arrival", "tie", "value", "salt"]
    keyed = rows.withColumn("tie", tie).withColumn("salt", salt)
    n = segments or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = keyed.repartitionByRange(n, *order).sortWithinPartitions(*order)
    path = scratch_path(spark, "arrival-scan")
    cut.select("k", "is_enr", "value", "event_time").mapInArrow(_scan, _OUT).write.parquet(path)
    scanned = spark.read.parquet(path)

    carry = _carried(scanned.filter("edge IS NOT NULL").select("segment", "edge.*"))
    if broadcast_size_ok(carry, ["carried"]):
        carry = F.broadcast(carry)
    found = F.when(F.col("open"), F.col("carried")).otherwise(F.col("enrichment"))
    return (scanned.filter("edge IS NULL").select("event_time", "data", "enrichment", "segment", "open")
            .join(carry, "segment", "left").select("event_time", "data", found.alias("enrichment")))


def _carried(edges: DataFrame) -> DataFrame:
    """(segment, carried): the last enrichment, in earlier segments, of each
    segment's first key. A window holds the edges of one key."""
    ends = F.array(
        F.struct(F.col("first").alias("k"), F.lit(0).alias("side"),
                 F.lit(None).cast("struct<v:string>").alias("enr")),
        F.struct(F.col("last").alias("k"), F.lit(1).alias("side"),
                 F.when(F.col("has"), F.struct(F.col("value").alias("v"))).alias("enr")))
    before = (Window.partitionBy("k").orderBy("segment", "side")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (edges.select("segment", F.explode(ends).alias("e")).select("segment", "e.*")
            .withColumn("enr", F.last("enr", ignorenulls=True).over(before))
            .filter("side = 0 AND enr IS NOT NULL").select("segment", F.col("enr.v").alias("carried")))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last enrichment before each raw row of a sorted partition."""
    segment = TaskContext.get().partitionId()
    first = last = None  # the partition's first key and the last one so far
    seen, held = False, pa.scalar(None, pa.string())  # the last key's enrichment

    def plain(key: int) -> int | None:
        return None if key == _NO_KEY else key

    def out(event_time, data, value, is_open, edge) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [event_time, data, value, pa.array(np.full(len(data), segment, np.int32)), is_open, edge],
            ["event_time", "data", "enrichment", "segment", "open", "edge"])

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        keys = pc.fill_null(batch.column(0).cast(pa.int64()), _NO_KEY).to_numpy()
        is_enr = batch.column(1).to_numpy(zero_copy_only=False)
        if first is None:
            first = int(keys[0])
        continues = last is not None and last == int(keys[0])
        # Row 0 of the values stands for what the batches before left of its key.
        values = pa.concat_arrays([pa.array([held.as_py() if continues else None], pa.string()),
                                   batch.column(2)])
        at = np.arange(1, n + 1)
        starts = np.r_[not continues, keys[1:] != keys[:-1]]
        run = np.maximum.accumulate(np.where(starts, at, 0))
        best = np.maximum.accumulate(np.where(is_enr, at, 0))
        inherits = (run == 0) & (best == 0) & (continues and seen)
        some = (best >= np.maximum(run, 1)) | inherits
        raw = np.flatnonzero(~is_enr)
        index = pa.array(np.where(some, best, 0)[raw], mask=~some[raw])
        is_open = ~some[raw] & (keys[raw] == first)
        picked = batch.take(pa.array(raw))
        yield out(picked.column(3), picked.column(0), values.take(index), pa.array(is_open),
                  pa.nulls(len(raw), _EDGE))
        last, seen = int(keys[-1]), bool(some[-1])
        held = values[int(best[-1])] if seen else pa.scalar(None, pa.string())
    if first is not None:
        edge = {"first": plain(first), "last": plain(last), "has": seen, "value": held.as_py()}
        yield out(pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.string()),
                  pa.array([False]), pa.array([edge], _EDGE))
