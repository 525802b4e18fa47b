"""Arrival-ordered enrichment by a broadcast of versions.

The reference broadcasts enrichments to where the raw records are. Here the
enrichments of a bounded stretch of arrival, with the latest value of every
key before it, are one small table: for each key its ``(arrival, value)``
versions as sorted arrays. The table is broadcast after a check of its rows
and bytes, and each raw row finds the last version before its own arrival by
a binary search written as array expressions. Raw rows are never shuffled
and never leave the JVM, in a batch as in a stream's micro-batch.

``Versions`` keeps the table of a stretch and the state it leaves to the next
one as files beside the checkpoint, written before the stretch is read: a
restarted run finds the same table and gives the same values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.operators.enrich import DEFAULT_MAX_BROADCAST_ROWS, broadcast_size_ok, latest_by_key
from rivulet.sources.fs import exists

MAX_BYTES = 64 * 1024 * 1024
_EARLIEST = -(2 ** 63)
_STEPS = 31  # halvings that find a place among 2^31 versions


def arrival_of(col: str) -> Column:
    return F.coalesce(F.col(col).cast("bigint"), F.lit(_EARLIEST))


def fits_broadcast(enrichments: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                   max_bytes: int = MAX_BYTES) -> bool:
    """Whether all versions may be broadcast; nothing is collected to tell."""
    return broadcast_size_ok(enrichments, ["enrichment"], max_rows, max_bytes)


def version_table(enrichments: DataFrame, arrival_col: str = "arrival") -> DataFrame:
    """(version_key, arrivals, values): each key's versions in order. Of those
    that arrive together the greatest value is the last. Only for enrichments
    that ``fits_broadcast`` allows: their number bounds the arrays."""
    one = F.struct(arrival_of(arrival_col).alias("a"), F.col("enrichment").cast("string").alias("v"))
    return (enrichments.filter(F.col("key").isNotNull()).groupBy(F.col("key").cast("int").alias("version_key"))
            .agg(F.sort_array(F.collect_list(one)).alias("all"))
            .select("version_key", F.col("all.a").alias("arrivals"), F.col("all.v").alias("values")))


def versions_before(arrivals: Column, at: Column, or_same: bool) -> Column:
    """How many of the sorted ``arrivals`` come before ``at``."""
    def halve(range_: Column, _: Column) -> Column:
        low, high = range_["low"], range_["high"]
        middle = F.shiftright(low + high, 1)
        there = F.get(arrivals, middle)
        before = (there <= at) if or_same else (there < at)
        done = low >= high
        return F.struct(F.when(done | ~before, low).otherwise(middle + 1).alias("low"),
                        F.when(done | before, high).otherwise(middle).alias("high"))

    steps = F.least(F.ceil(F.log2(F.size(arrivals) + 1)).cast("int"), F.lit(_STEPS))
    found = F.aggregate(F.sequence(F.lit(0), steps),
                        F.struct(F.lit(0).alias("low"), F.size(arrivals).alias("high")), halve)
    return found["low"]


def enrich_versions(raw: DataFrame, table: DataFrame, arrival_col: str = "arrival",
                    enrichment_first_on_tie: bool = True) -> DataFrame:
    """RAW rows with ``arrival_col``, batch or stream, and a ``version_table``
    -> (event_time, data, enrichment)."""
    joined = raw.select(F.col("event_time").cast("bigint").alias("event_time"),
                        F.col("data").cast("int").alias("data"), arrival_of(arrival_col).alias("at")) \
        .join(F.broadcast(table), F.col("data") == F.col("version_key"), "left")
    n = versions_before(F.col("arrivals"), F.col("at"), enrichment_first_on_tie)
    # No version before: place -1, which an array does not have.
    return joined.select("event_time", "data", F.get("values", n - 1).alias("enrichment"))


class Versions:
    """The version tables of consecutive stretches of a checkpoint's input.

    ``table(n, enrichments)`` is the table of stretch ``n``: its enrichments
    and the latest ones before, made once and found again after a restart;
    None if they are too many to broadcast."""

    def __init__(self, spark: SparkSession, checkpoint: str, arrival_col: str = "arrival",
                 max_rows: int = DEFAULT_MAX_BROADCAST_ROWS, max_bytes: int = MAX_BYTES):
        self.spark, self.arrival_col = spark, arrival_col
        self.path = f"{checkpoint.rstrip('/')}.versions"
        self.max_rows, self.max_bytes = max_rows, max_bytes

    def _kept(self, name: str, rows: DataFrame) -> DataFrame:
        path = f"{self.path}/{name}"
        if not exists(self.spark, f"{path}/_SUCCESS"):
            rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def table(self, n: int, enrichments: DataFrame,
              columns: Sequence[str] = ("key", "enrichment")) -> DataFrame | None:
        own = enrichments.select(*columns, arrival_of(self.arrival_col).alias("arrival"))
        rows = own
        if n:
            state = self.spark.read.schema(own.schema).parquet(f"{self.path}/state-{n - 1}")
            rows = rows.unionByName(state)
        rows = self._kept(f"rows-{n}", rows)
        self._kept(f"state-{n}", latest_by_key(rows, order=("arrival",)).select(*own.columns))
        if not fits_broadcast(rows, self.max_rows, self.max_bytes):
            return None
        return version_table(rows, "arrival")
