"""Writer workflow (E2): raw -> enrich -> count -> sink.

``build_writer`` is the reference's builder (input, enrichments, output,
build) as function composition. The sink is any ``DataFrame ->
StreamingQuery`` callable (K8); the counter is an observed metric (A1).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from rivulet.operators.enrich import enrich, to_enriched
from rivulet.operators.metrics import WRITTEN_COUNTER, RecordCounter
from rivulet.streaming.arrival import enrich_stateful
from rivulet.streaming.sinks import Sink


def build_writer(raw: DataFrame, enrichments: DataFrame, sink: Sink, grain: str = "minute",
                 counter_name: str = WRITTEN_COUNTER, **lookup_opts) -> StreamingQuery:
    """Start the writer. ``raw`` is a stream; ``enrichments`` a static
    dimension, broadcast when its size is known or checked to be small
    (see ``operators.enrich``)."""
    enriched = enrich(raw, enrichments, grain=grain, **lookup_opts)
    return sink(RecordCounter(counter_name).wrap(enriched))


def build_stateful_writer(raw: DataFrame, enrichment_stream: DataFrame, sink: Sink,
                          grain: str = "minute", counter_name: str = WRITTEN_COUNTER,
                          **state_opts) -> StreamingQuery:
    """Start the writer with the reference's arrival-order semantics: the
    enrichments are a second stream, held in keyed state (J3)."""
    enriched = to_enriched(enrich_stateful(raw, enrichment_stream, **state_opts), grain=grain)
    return sink(RecordCounter(counter_name).wrap(enriched))


def stage_bounded(spark: SparkSession, df: DataFrame, landing: str,
                  max_records_per_file: int | None = None) -> DataFrame:
    """Bounded input (T4): land it once as Parquet files and open the folder
    as a stream, so it goes through the same exactly-once file sink as
    unbounded input. Returns the streaming DataFrame."""
    writer = df.write.mode("append")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", int(max_records_per_file))
    writer.parquet(landing)
    return spark.readStream.schema(df.schema).parquet(landing)
