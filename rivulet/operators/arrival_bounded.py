"""Arrival-ordered enrichment of bounded input (J3 on a table, T4).

Same answer as ``streaming.arrival.enrich_stateful`` with an arrival column:
each raw row gets the latest enrichment of its key that arrived before it
(ties by ``enrichment_first_on_tie``), or null. On a table the whole history
is present, so this is built from Catalyst operators only; no Python.

Plan, with ``block = floor(arrival / block_width)``:

1. in-block: one window partitioned by ``(key, block)`` and ordered by
   arrival carries the last enrichment seen so far inside the block;
2. carry-in: one row per ``(key, block)`` (the block's last enrichment, if
   any), and a window over those rows per key gives each block the last
   enrichment of the blocks before it;
3. the raw rows take the in-block value, else the carry-in.

A hot key is cut by arrival range into blocks, so no window partition holds
more than ``block_width`` different arrivals of one key (rows that arrive
together, such as null arrivals, stay together); the per-key window of step 2
holds one row per block, not per event.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BLOCK_WIDTH = 1 << 20


def enrich_arrival_bounded(raw: DataFrame, enrichments: DataFrame, arrival_col: str,
                           enrichment_first_on_tie: bool = True,
                           block_width: int = DEFAULT_BLOCK_WIDTH) -> DataFrame:
    """RAW + ENRICHMENT tables (both with ``arrival_col``) ->
    (event_time, data, enrichment)."""
    enr_tie, raw_tie = (0, 1) if enrichment_first_on_tie else (1, 0)
    # A null arrival counts as the earliest, as in the streaming form.
    arrival = F.coalesce(F.col(arrival_col).cast("bigint"), F.lit(-(2 ** 63)))
    rows = raw.select(
        F.col("data").cast("int").alias("k"), arrival.alias("arrival"),
        F.lit(raw_tie).alias("tie"), F.lit(None).cast("struct<v:string>").alias("enr"),
        F.col("event_time").cast("bigint").alias("event_time"),
    ).unionByName(enrichments.filter(F.col("key").isNotNull()).select(
        F.col("key").cast("int").alias("k"), arrival.alias("arrival"),
        F.lit(enr_tie).alias("tie"),
        # A struct marks presence, so a null enrichment value still counts.
        F.struct(F.col("enrichment").cast("string").alias("v")).alias("enr"),
        F.lit(None).cast("bigint").alias("event_time"),
    ))
    return _lookup_in_order(rows, block_width)


def enrich_table_bounded(table: DataFrame, raw: dict[str, Column], enrichment: dict[str, Column],
                         arrival_col: str, enrichment_first_on_tie: bool = True,
                         block_width: int = DEFAULT_BLOCK_WIDTH) -> DataFrame:
    """The same for a table whose rows are both: ``raw`` gives their
    ``event_time`` and ``data``, ``enrichment`` their ``key`` and
    ``enrichment``. Each row is read once and becomes two."""
    enr_tie, raw_tie = (0, 1) if enrichment_first_on_tie else (1, 0)
    arrival = F.coalesce(F.col(arrival_col).cast("bigint"), F.lit(-(2 ** 63)))

    def part(k, tie, enr, event_time):
        return F.struct(k.cast("int").alias("k"), F.lit(tie).alias("tie"), enr.alias("enr"),
                        event_time.cast("bigint").alias("event_time"))

    value = F.struct(enrichment["enrichment"].cast("string").alias("v"))
    parts = F.array(part(raw["data"], raw_tie, F.lit(None).cast("struct<v:string>"),
                         raw["event_time"]),
                    part(enrichment["key"], enr_tie, value, F.lit(None)))
    rows = (table.select(arrival.alias("arrival"), F.explode(parts).alias("p"))
            .select("arrival", "p.*").filter(F.col("enr").isNull() | F.col("k").isNotNull()))
    return _lookup_in_order(rows, block_width)


def _lookup_in_order(rows: DataFrame, block_width: int) -> DataFrame:
    """Tagged rows (k, arrival, tie, enr, event_time) -> the raw rows with the
    last enrichment before each. Of enrichments that arrive together the
    greatest value counts as last, in the window and in the summary alike."""
    rows = rows.withColumn(
        "block", F.floor(F.col("arrival") / F.lit(int(block_width))).cast("bigint"))
    order = [F.col("arrival"), F.col("tie"), F.col("enr")]
    in_block = Window.partitionBy("k", "block").orderBy(*order) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = rows.withColumn("in_block", F.last("enr", ignorenulls=True).over(in_block))

    # Last enrichment of each (key, block) that has one, then per key the
    # last one of all earlier blocks. Both summaries aggregate map-side
    # before their (small) shuffles: one row per (key, block), not per event.
    block_last = (rows.filter(F.col("enr").isNotNull()).groupBy("k", "block")
                  .agg(F.max_by("enr", F.struct(*order)).alias("last")))
    blocks = rows.filter(F.col("enr").isNull()).select("k", "block").distinct() \
        .unionByName(block_last.select("k", "block")).distinct()
    earlier = Window.partitionBy("k").orderBy("block") \
        .rowsBetween(Window.unboundedPreceding, -1)
    carry = (blocks.join(block_last, ["k", "block"], "left")
             .withColumn("carry", F.last("last", ignorenulls=True).over(earlier))
             .select("k", "block", "carry"))

    out = (seen.filter(F.col("enr").isNull())
           .join(carry, ["k", "block"], "left")
           .select(F.col("event_time"), F.col("k").alias("data"),
                   F.coalesce(F.col("in_block"), F.col("carry")).getField("v").alias("enrichment")))
    return out
