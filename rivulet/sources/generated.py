"""Generated inputs (S1, S2), as distributed ``spark.range`` tables.

The reference's sources stamp records with the wall clock; here the clock is
a parameter ``t0_ms`` so that runs are repeatable and testable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.fixed import ENRICHMENT_PREFIX, NUM_ENRICHMENTS, RAW_TIME_STEP_MS, RAW_TIME_STEPS
from rivulet.schemas import ENRICHMENT, RAW, conform


INT_IDS = 2 ** 31
DEFAULT_T0_MS = 1_700_000_000_000


def raw_from_ids(ids: DataFrame, id_col: str = "id", parallelism: int = 2,
                 t0_ms: int = DEFAULT_T0_MS) -> DataFrame:
    """S1 over an existing id column: ``data`` = id, ``event_time`` =
    ``t0 - ((id div P) mod 5)`` minutes.

    ``data`` is an int: an id past 2^31 - 1 counts on from 0 again (its
    remainder by 2^31), as does nothing else of the record.

    In the reference, subtask ``s`` of ``P`` emits ``s, s+P, s+2P, ...`` and
    backs the n-th record off by ``n mod 5`` minutes; n is ``data div P``.
    """
    i = F.col(id_col).cast("bigint")
    seq = F.floor(i / F.lit(parallelism)).cast("bigint")
    back = F.pmod(seq, F.lit(RAW_TIME_STEPS)) * F.lit(RAW_TIME_STEP_MS)
    out = ids.select((F.lit(t0_ms).cast("bigint") - back).alias("event_time"),
                     F.pmod(i, F.lit(INT_IDS)).cast("int").alias("data"))
    return conform(out, RAW)


ROWS_PER_GENERATED_PARTITION = 10_000_000


def raw_events(spark: SparkSession, n: int, parallelism: int = 2,
               t0_ms: int = DEFAULT_T0_MS, num_partitions: int | None = None) -> DataFrame:
    """``n`` raw records, ``data`` = 0..n-1 each once.

    ``parallelism`` is the reference's P and only enters the event-time
    formula; the Spark partition count is separate, at least the cluster's
    default parallelism and about 10 M rows per partition, so a large ``n``
    is generated by many tasks.
    """
    if num_partitions is None:
        num_partitions = max(parallelism, spark.sparkContext.defaultParallelism,
                             -(-n // ROWS_PER_GENERATED_PARTITION))
    return raw_from_ids(spark.range(0, n, 1, int(num_partitions)), "id", parallelism, t0_ms)


def enrichment_record(key: Column, t0_ms: int, n: int) -> list[Column]:
    """Columns of S2 for a key column: timestamp ``t0 - n + key``."""
    return [
        (F.lit(t0_ms - n).cast("bigint") + key.cast("bigint")).alias("timestamp"),
        key.cast("int").alias("key"),
        F.concat(F.lit(ENRICHMENT_PREFIX), key.cast("string")).alias("enrichment"),
    ]


def enrichments(spark: SparkSession, n: int = NUM_ENRICHMENTS,
                t0_ms: int = DEFAULT_T0_MS) -> DataFrame:
    """``n`` enrichment records, keys 0..n-1 (bounded, size known); one
    partition per ~10 M records (one for the reference's 100)."""
    parts = max(1, -(-n // ROWS_PER_GENERATED_PARTITION))
    return conform(spark.range(0, n, 1, parts).select(*enrichment_record(F.col("id"), t0_ms, n)),
                   ENRICHMENT)
