"""Record counters (A1, A2) as pass-through observed metrics (F1, F2).

The reference counts with an always-true filter. Here the rows pass through
``DataFrame.observe``: the count is computed inside the same tasks, with no
extra job. Batch queries report through an ``Observation``; streaming
queries report one value per micro-batch in their progress events, which
``ProgressCounter`` sums.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rivulet.fixed import READ_COUNTER, WRITTEN_COUNTER  # noqa: F401  (re-exported)
from rivulet.sources.fs import names


class RecordCounter:
    """Count rows that flow through a DataFrame, batch or stream."""

    def __init__(self, name: str):
        self.name = name
        self._observation: Observation | None = None

    def wrap(self, df: DataFrame) -> DataFrame:
        metric = F.count(F.lit(1)).alias("n")
        if df.isStreaming:
            return df.observe(self.name, metric)
        self._observation = Observation(self.name)
        return df.observe(self._observation, metric)

    def batch_count(self) -> int:
        """Count of the batch query, available after its action ran."""
        if self._observation is None:
            raise RuntimeError("wrap() a batch DataFrame and run an action first")
        return int(self._observation.get["n"])


def counted(df: DataFrame, name: str) -> DataFrame:
    """Pass ``df`` through a counter named ``name`` (F1, F2): a stream
    reports per micro-batch (sum with ``ProgressCounter``); for a batch use
    ``RecordCounter`` to read the count back."""
    return RecordCounter(name).wrap(df)


class ProgressCounter:
    """Sums the observed ``n`` of a metric over a streaming query's batches.

    Reads ``query.recentProgress`` and keeps a running total keyed by batch
    id, so a batch is counted once however often it is polled. A query keeps
    only its last progress events
    (``spark.sql.streaming.numRecentProgressUpdates``, default 100): poll
    while it runs (``follow``). A batch that slipped by leaves a gap in the
    ids, and ``complete_total`` raises rather than return too little.
    No listener callback (and so no callback server) is involved.
    """

    def __init__(self, name: str):
        self.name = name
        self._per_batch: dict[int, int] = {}
        self._lock = threading.Lock()

    def poll(self, query) -> int:
        for p in query.recentProgress:
            row = (p.observedMetrics or {}).get(self.name)
            if row is not None:
                with self._lock:
                    self._per_batch[int(p.batchId)] = int(row["n"])
        return self.total

    def follow(self, query, every: float = 0.2) -> int:
        """Poll until the query ends; its rows. Raises what the query raised."""
        while not query.awaitTermination(every):
            self.poll(query)
        self.poll(query)
        return self.complete_total()

    def complete_total(self) -> int:
        """The total, if no batch between the first and the last is missing."""
        with self._lock:
            ids = sorted(self._per_batch)
            if ids and len(ids) != ids[-1] - ids[0] + 1:
                raise RuntimeError(
                    f"progress of {ids[-1] - ids[0] + 1 - len(ids)} batches was not seen; poll "
                    "more often or raise spark.sql.streaming.numRecentProgressUpdates")
            return sum(self._per_batch.values())

    @property
    def total(self) -> int:
        with self._lock:
            return sum(self._per_batch.values())

    @property
    def batches(self) -> int:
        with self._lock:
            return len(self._per_batch)


def committed_rows(spark: SparkSession, table: str) -> int:
    """Rows in the committed files of a table's log (A1). Read off the files'
    footers: nothing a query reports is needed, so a slow driver, a restart or
    a short progress history changes nothing."""
    if not names(spark, f"{table}/_spark_metadata"):
        return 0
    return spark.read.schema("event_time bigint").parquet(table).count()


class WrittenCounter:
    """Rows that a run commits to a table (A1): those after it less those
    before it."""

    def __init__(self, spark: SparkSession, table: str):
        self.spark, self.table = spark, table
        self.before = committed_rows(spark, table)

    @property
    def total(self) -> int:
        return committed_rows(self.spark, self.table) - self.before


def rows_read(spark: SparkSession, checkpoint: str, table: str, after: int = -1) -> int:
    """Rows of ``table`` that the batches of a reader's checkpoint have read
    and committed, those with an id over ``after`` (A2).

    The source's log names each file with its batch (also where the log was
    compacted); rows come from the files' footers."""
    last = last_batch(spark, checkpoint)
    logs = f"{checkpoint.rstrip('/')}/sources/0"
    if last is None or not names(spark, logs):
        return 0
    entry = F.from_json("value", "path string, batchId bigint")
    files = (spark.read.text(logs).filter("value LIKE '{%'").select(entry.alias("e"))
             .filter((F.col("e.batchId") > after) & (F.col("e.batchId") <= last))
             .select(F.substring_index("e.path", "/", -1).alias("name")).distinct())
    counts = (spark.read.schema("event_time bigint").parquet(table)
              .groupBy(F.col("_metadata.file_name").alias("name")).agg(F.count(F.lit(1)).alias("n")))
    return counts.join(files, "name", "left_semi").agg(F.sum("n")).first()[0] or 0


def last_batch(spark: SparkSession, checkpoint: str) -> int | None:
    """The last committed batch of a checkpoint."""
    ids = [int(n) for n in names(spark, f"{checkpoint.rstrip('/')}/commits") if n.isdigit()]
    return max(ids, default=None)
