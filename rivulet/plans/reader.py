"""Reader workflow (E3): table (incremental) -> count -> sink (discard)."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from rivulet.operators.metrics import READ_COUNTER, RecordCounter
from rivulet.sources.lake import read_incremental
from rivulet.streaming.sinks import Sink


def build_reader(spark: SparkSession, table: str, sink: Sink,
                 counter_name: str = READ_COUNTER, create: bool = True,
                 max_files_per_trigger: int | None = None,
                 require: bool = True,
                 max_bytes_per_trigger: int | None = None) -> StreamingQuery:
    """Start the reader. ``create=True`` lets it start before the table
    exists (T6); it then waits for the first commit."""
    rows = read_incremental(spark, table, create=create,
                            max_files_per_trigger=max_files_per_trigger, require=require,
                            max_bytes_per_trigger=max_bytes_per_trigger)
    return sink(RecordCounter(counter_name).wrap(rows))
