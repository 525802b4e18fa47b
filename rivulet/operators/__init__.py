"""Batch-and-stream operators: lookup enrichment, last-write-wins, counting."""

from rivulet.operators.arrival_bounded import enrich_arrival_bounded  # noqa: F401
from rivulet.operators.enrich import (  # noqa: F401
    attach_enrichment,
    broadcast_size_ok,
    enrich,
    latest_by_key,
    to_enriched,
)
from rivulet.operators.metrics import ProgressCounter, RecordCounter, counted  # noqa: F401
