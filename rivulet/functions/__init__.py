"""Column expressions: time conversion, UTC buckets, record keys."""

from rivulet.functions.keys import record_key  # noqa: F401
from rivulet.functions.time import (  # noqa: F401
    GRAIN_FORMATS,
    epoch_ms_from_ntz,
    epoch_ms_to_timestamp,
    partition_key,
    utc_bucket,
)
