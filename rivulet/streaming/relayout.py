"""Change of the layout of keyed state.

Salts, key groups and state partitions of ``enrich_stateful`` are fixed for a
checkpoint. To change them, the state of a stopped query is read through
Spark's state data source, one row for each key, and written as the seed of a
new checkpoint: enrichments that arrived before all that follows. The next
query takes the seed in its first micro-batch, before any raw row, and hashes
it into its own groups, salts and partitions.

A file-sink table belongs to one checkpoint, so the next query appends to a
table folder of its own; ``read_generations`` reads them as one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.sources.fs import exists
from rivulet.sources.lake import read_snapshot
from rivulet.streaming.arrival import StateLayout, keep_layout

SEED = "timestamp bigint, key int, enrichment string, arrival bigint"


def read_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(key, enrichment, arrival): the latest enrichment of every key in the
    state of a stopped query. The groups of a salted key hold the same; of
    entries of one key the last to arrive counts."""
    state = spark.read.format("statestore").load(checkpoint)
    one = F.arrays_zip(*[F.col(f"value.groupState.{c}").alias(c) for c in ("keys", "enrichments", "arrivals")])
    entries = state.select(F.explode(one).alias("e")).select(
        F.col("e.keys").alias("key"), F.col("e.enrichments").alias("enrichment"),
        F.col("e.arrivals").alias("arrival"))
    last = F.max_by(F.struct("enrichment", "arrival"), F.struct("arrival", "enrichment")).alias("last")
    return entries.groupBy("key").agg(last).select("key", "last.*")


def seed_path(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}.seed"


def relayout(spark: SparkSession, old: str, new: str, layout: StateLayout) -> None:
    """Make the checkpoint ``new`` ready to go on from the state of ``old``
    (a stopped query's) with another layout. Can be repeated after a kill."""
    path = seed_path(new)
    if not exists(spark, f"{path}/_SUCCESS"):
        (read_state(spark, old).select(F.lit(0).cast("bigint").alias("timestamp"), "key", "enrichment",
                                       "arrival")
         .write.mode("overwrite").parquet(path))
    keep_layout(spark, new, layout)


def seeded(enrichments: DataFrame, checkpoint: str, arrival_col: str) -> DataFrame:
    """The enrichment stream of a checkpoint that ``relayout`` made: its seed,
    taken whole in the first micro-batch, and what arrives."""
    spark = enrichments.sparkSession
    seed = spark.readStream.schema(SEED).parquet(seed_path(checkpoint))
    columns = ["timestamp", "key", "enrichment", arrival_col]
    return seed.withColumnRenamed("arrival", arrival_col).select(*columns).unionByName(
        enrichments.select(*columns))


def read_generations(spark: SparkSession, tables: list[str], **options) -> DataFrame:
    """The table folders that consecutive layouts appended to, as one."""
    return reduce(DataFrame.unionByName, [read_snapshot(spark, t, **options) for t in tables])
