"""rivulet: stream enrichment into a partitioned Parquet table, on Spark.

Raw events are enriched from a small, changing dimension (broadcast lookup,
or keyed state when arrival order matters), given a record key and a UTC
time-bucket partition, counted, and appended exactly-once to a partitioned
Parquet table that can be read back as a snapshot or as an unbounded stream.
Every transform takes and returns a DataFrame, so the same code runs on
``spark.read`` and ``spark.readStream`` input.
"""

from rivulet.functions import record_key, utc_bucket
from rivulet.operators import (
    attach_enrichment,
    enrich,
    enrich_arrival_bounded,
    latest_by_key,
    to_enriched,
)
from rivulet.plans import build_reader, build_stateful_writer, build_writer
from rivulet.schemas import ENRICHED, ENRICHMENT, RAW, conform
from rivulet.sources import read_incremental, read_snapshot
from rivulet.streaming import append_sink, discard_sink
from rivulet.streaming.arrival import enrich_stateful, plan_state_layout

__all__ = [
    "RAW", "ENRICHMENT", "ENRICHED", "conform",
    "record_key", "utc_bucket",
    "attach_enrichment", "enrich", "enrich_arrival_bounded", "latest_by_key", "to_enriched",
    "enrich_stateful", "plan_state_layout",
    "append_sink", "discard_sink", "read_snapshot", "read_incremental",
    "build_writer", "build_stateful_writer", "build_reader",
]
