"""Values that must equal the reference's for equal results.

Fixed values, in the order a record meets them.
"""

# Raw source: the n-th record of a subtask has its event time backed off by
# (n mod 5) minutes.
RAW_TIME_STEPS = 5
RAW_TIME_STEP_MS = 60_000

# Enrichment source: 100 records; key i has the value "Enrichment-<i>".
NUM_ENRICHMENTS = 100
ENRICHMENT_PREFIX = "Enrichment-"

# Table record: the record key column is "key", "<event_time>|<data>"; the
# partition column is "partition", the event time in UTC as yyyyMMdd-HHmm;
# a missing partition value is written as "no_partition".
RECORD_KEY_COLUMN = "key"
RECORD_KEY_SEPARATOR = "|"
PARTITION_COLUMN = "partition"
PARTITION_FORMAT = "yyyyMMdd-HHmm"
DEFAULT_PARTITION_NAME = "no_partition"

# Counter names of the writer and the reader.
WRITTEN_COUNTER = "enriched-record-written-counter"
READ_COUNTER = "enriched-record-read-counter"
