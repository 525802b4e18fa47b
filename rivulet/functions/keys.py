"""Composite record key (P2): ``"<event_time>|<data>"`` in decimal digits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rivulet.fixed import RECORD_KEY_SEPARATOR


def record_key(event_time: Column | str = "event_time", data: Column | str = "data") -> Column:
    """Same text as ``String.format("%d|%d", event_time, data)``.

    ``concat`` of the integer casts is used instead of ``format_string``: it
    is a plain codegen'd string build with no per-row formatter.
    """
    et = F.col(event_time) if isinstance(event_time, str) else event_time
    d = F.col(data) if isinstance(data, str) else data
    return F.concat(et.cast("bigint").cast("string"), F.lit(RECORD_KEY_SEPARATOR),
                    d.cast("int").cast("string"))
