"""Inputs: generated records, driver tables, file streams, the table itself."""

from rivulet.sources.generated import enrichments, raw_events, raw_from_ids  # noqa: F401
from rivulet.sources.lake import read_incremental, read_snapshot  # noqa: F401
from rivulet.sources.streams import enrichment_stream, raw_stream  # noqa: F401
from rivulet.sources.tables import (  # noqa: F401
    enrichment_updates,
    events_as_raw,
    load_table,
    table_stream,
)
