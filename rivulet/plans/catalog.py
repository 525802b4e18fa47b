"""Registered queries over the driver's tables, and their DuckDB oracles.

Every query reads the whole ``events`` table (or a stream of it) so its work
grows with the data. ``events`` is used as raw records (``event_time`` =
epoch ms of ``ts``, ``data`` = ``user_id``) and as enrichment updates (key
``user_id``, value ``event_type``, arrival order ``event_id``).

Streaming queries run to completion with ``availableNow`` into folders under
the shared checkpoint folder and return a batch read of their result table,
so their values can be compared.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rivulet.fixed import NUM_ENRICHMENTS
from rivulet.functions.keys import record_key
from rivulet.functions.time import epoch_ms_from_ntz, utc_bucket
from rivulet.operators.arrival_bounded import enrich_table_bounded
from rivulet.operators.arrival_scan import enrich_table_scan
from rivulet.operators.enrich import enrich, latest_by_key, to_enriched
from rivulet.operators.metrics import READ_COUNTER, WRITTEN_COUNTER, ProgressCounter
from rivulet.operators.versions import Versions, enrich_versions, fits_broadcast
from rivulet.plans.reader import build_reader
from rivulet.plans.writer import build_writer
from rivulet.session import scratch_path, session_conf, state_partitions
from rivulet.sources.generated import (
    DEFAULT_T0_MS,
    enrichment_record,
    enrichments,
    raw_from_ids,
)
from rivulet.sources.lake import read_snapshot
from rivulet.sources.streams import batch_limit
from rivulet.sources.tables import enrichment_updates, events_as_raw, load_table, table_stream
from rivulet.streaming.arrival import StateLayout, enrich_stateful, keep_layout, plan_state_layout
from rivulet.streaming.relayout import read_generations, relayout, seeded
from rivulet.streaming.sinks import append_sink, discard_sink, table_checkpoint
from rivulet.streaming.staging import ROWS_PER_FILE, admit, stage_in_order
from rivulet.streaming.watermark import EVENT_TIME_COLUMN, with_enrichment_watermark

RAW_PARALLELISM = 2
TABLE_GRAIN = "day"  # minute grain on driver data = one folder per event
RELAYOUT = (4, 7)  # state partitions before and after the change of layout
VERSIONS_PER_STRETCH = 500_000  # events whose values are broadcast at a time
VERSION_BYTES = 64 * 1024 * 1024
BYTES_PER_FILE = 128 * 1024 * 1024  # shuffled bytes of a file of the hourly table
LEAST_STRETCHES = 3  # so that a small table has stretches that start from state
KEYS_PER_GROUP = 64  # users per key group of the arrival-order state
# Bounded micro-batches when ``events`` is a folder of many files: a failed
# batch re-runs only its share, and a keyed-state group holds at most its
# share of one batch. Queries that need arrival order stage their input in it.
BYTES_PER_TRIGGER = 2 * 1024 ** 3


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_table(spark, sf_dir, "events")


def _events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_stream(spark, sf_dir, "events", max_bytes_per_trigger=BYTES_PER_TRIGGER)


def _await(query: StreamingQuery) -> StreamingQuery:
    query.awaitTermination()
    err = query.exception()
    if err is not None:
        raise RuntimeError(f"streaming query failed: {err}")
    return query


# ---------------------------------------------------------------- batch ---

def q_events_as_raw(spark, sf_dir):
    """events as raw records (S3 adapter, P1, P7): event_time, data."""
    return events_as_raw(_events(spark, sf_dir))


def q_raw_source(spark, sf_dir):
    """S1 generator formula over events.event_id (P = 2, fixed clock)."""
    return raw_from_ids(_events(spark, sf_dir), "event_id", RAW_PARALLELISM, DEFAULT_T0_MS)


def q_enrichment_source(spark, sf_dir):
    """S2 record formula over the distinct users of events: "Enrichment-<key>"."""
    keys = _events(spark, sf_dir).select(F.col("user_id").cast("int").alias("key")).distinct()
    return keys.select(*enrichment_record(F.col("key"), DEFAULT_T0_MS, NUM_ENRICHMENTS))


def q_record_key(spark, sf_dir):
    """Record key "<event_time>|<data>" (P2)."""
    raw = events_as_raw(_events(spark, sf_dir))
    return raw.select("event_time", "data", record_key().alias("key"))


def q_partition_key(spark, sf_dir):
    """UTC time buckets at minute, hour and day grain."""
    raw = events_as_raw(_events(spark, sf_dir))
    return raw.select(
        "event_time",
        utc_bucket("event_time", "minute").alias("partition_minute"),
        utc_bucket("event_time", "hour").alias("partition_hour"),
        utc_bucket("event_time", "day").alias("partition_day"),
    )


def q_enrich_lookup(spark, sf_dir):
    """Flagship: raw events left-joined to the reference's 100 enrichments."""
    raw = events_as_raw(_events(spark, sf_dir))
    return enrich(raw, enrichments(spark, NUM_ENRICHMENTS, DEFAULT_T0_MS), grain="minute",
                  dim_rows_bound=NUM_ENRICHMENTS)


def _updates(spark, sf_dir):
    return enrichment_updates(_events(spark, sf_dir), keep=("event_id",))


def q_latest_enrichment(spark, sf_dir):
    """Last write wins per user over event-type updates."""
    return latest_by_key(_updates(spark, sf_dir), order=("timestamp", "event_id")).select(
        "key", "timestamp", "enrichment")


def q_enrich_latest(spark, sf_dir):
    """Events enriched from the last-write-wins dimension (J2 + J1)."""
    raw = events_as_raw(_events(spark, sf_dir))
    return enrich(raw, _updates(spark, sf_dir), grain="minute", order=("timestamp", "event_id"))


# ------------------------------------------------------------ streaming ---

def write_table(spark: SparkSession, sf_dir: str, table: str | None = None,
                grain: str = TABLE_GRAIN, bytes_per_file: int | None = None) -> tuple[str, int]:
    """Writer job over a stream of ``events``: enrich with the 100
    enrichments, count, append to a partitioned table. Returns (path, n)."""
    table = table or scratch_path(spark, "table")
    sink = append_sink(table, scratch_path(spark, "writer-ckpt"), trigger="available_now",
                       bytes_per_file=bytes_per_file)
    raw = events_as_raw(_events_stream(spark, sf_dir))
    q = build_writer(raw, enrichments(spark, NUM_ENRICHMENTS, DEFAULT_T0_MS), sink,
                     grain=grain, dim_rows_bound=NUM_ENRICHMENTS)
    return table, ProgressCounter(WRITTEN_COUNTER).follow(q)


def run_in_order(spark: SparkSession, df: DataFrame, order: Column | str,
                 start: Callable[[DataFrame, int], StreamingQuery], runs: int = 1,
                 rows_per_file: int = ROWS_PER_FILE) -> None:
    """Stage ``df`` once in order, and run a query over a stream of its files
    to the end, in ``runs`` runs on the same checkpoint: each is admitted the
    next share of the files, and every start but the first resumes. The table
    is read for the staging only, whatever the number of files."""
    staging, landing = scratch_path(spark, "staged"), scratch_path(spark, "ordered")
    rows = min(rows_per_file, -(-df.count() // runs) or 1)
    files = stage_in_order(df, order, staging, rows)
    for run in range(runs):
        share = files[len(files) * run // runs:len(files) * (run + 1) // runs]
        admit(spark, share, landing)
        stream = batch_limit(spark.readStream.schema(df.schema), None, BYTES_PER_TRIGGER)
        _await(start(stream.parquet(landing), run))


def q_append_snapshot(spark, sf_dir):
    """Writer stream into the partitioned table, read back as a snapshot."""
    table, _ = write_table(spark, sf_dir)
    return read_snapshot(spark, table, require=True)


def copy_incremental(spark: SparkSession, table: str) -> tuple[str, int]:
    """Reader job: incremental read of ``table``, counted, appended to a
    second table (a discard sink would leave nothing to compare)."""
    copy = scratch_path(spark, "copy")
    sink = append_sink(copy, scratch_path(spark, "reader-ckpt"), trigger="available_now")
    q = build_reader(spark, table, sink, create=True, max_bytes_per_trigger=BYTES_PER_TRIGGER)
    return copy, ProgressCounter(READ_COUNTER).follow(q)


def q_append_incremental(spark, sf_dir):
    """Incremental read of the written table into a second table."""
    table, _ = write_table(spark, sf_dir)
    copy, _ = copy_incremental(spark, table)
    return read_snapshot(spark, copy, require=True)


def q_count_written(spark, sf_dir):
    """Records-written counter of the writer job (A1, F1)."""
    _, n = write_table(spark, sf_dir)
    return spark.createDataFrame([(n,)], "n bigint")


def q_count_read(spark, sf_dir):
    """Records-read counter of the reader job over a discard sink (A2, F2, K9)."""
    table, _ = write_table(spark, sf_dir)
    sink = discard_sink(scratch_path(spark, "count-ckpt"), trigger="available_now")
    q = build_reader(spark, table, sink, create=True, max_bytes_per_trigger=BYTES_PER_TRIGGER)
    return spark.createDataFrame([(ProgressCounter(READ_COUNTER).follow(q),)], "n bigint")


def q_append_hourly(spark, sf_dir):
    """The writer's table at hour grain (K2, P3), its files sized in bytes: each
    micro-batch is rebalanced by hour (K5)."""
    table, _ = write_table(spark, sf_dir, grain="hour", bytes_per_file=BYTES_PER_FILE)
    return read_snapshot(spark, table, require=True)


def q_append_two_runs(spark, sf_dir):
    """Two runs of the writer into one table, on its own checkpoint (K1, K3)."""
    table = scratch_path(spark, "table")
    dim = enrichments(spark, NUM_ENRICHMENTS, DEFAULT_T0_MS)
    run_in_order(spark, _events(spark, sf_dir), "event_id", lambda stream, run: build_writer(
        events_as_raw(stream), dim, append_sink(table), grain=TABLE_GRAIN,
        dim_rows_bound=NUM_ENRICHMENTS), runs=2)
    return read_snapshot(spark, table, require=True)


def q_read_while_writing(spark, sf_dir):
    """A reader started before its table exists, running while the writer
    writes it, into a copy (S7, T5, T6)."""
    table, copy = scratch_path(spark, "table"), scratch_path(spark, "copy")
    reader = build_reader(spark, table, append_sink(copy, trigger="500 milliseconds"), create=True,
                          max_bytes_per_trigger=BYTES_PER_TRIGGER)
    write_table(spark, sf_dir, table)
    reader.processAllAvailable()
    reader.stop()
    return read_snapshot(spark, copy, require=True)


def enrich_in_arrival_order(spark: SparkSession, sf_dir: str, runs: int) -> DataFrame:
    """Stream J3 over ``events`` in arrival order, in a number of runs.

    One per-user count of the table first gives the state layout: users
    holding more than half a state partition of the events are salted by
    their share, and users are hashed into key groups of about
    ``KEYS_PER_GROUP``. The layout is kept beside the checkpoint."""
    events, partitions = _events(spark, sf_dir), state_partitions(spark)
    hot, groups = plan_state_layout(events_as_raw(events), "data", 1 / (2 * partitions),
                                    KEYS_PER_GROUP, 2 * partitions)
    table = scratch_path(spark, "arrival")
    checkpoint = f"{table}.checkpoint"
    layout = keep_layout(spark, checkpoint, StateLayout(hot_keys=hot, key_groups=groups,
                                                        partitions=partitions))

    def start(stream: DataFrame, run: int) -> StreamingQuery:
        out = enrich_stateful(events_as_raw(stream, keep=("event_id",)),
                              enrichment_updates(stream, keep=("event_id",)),
                              arrival_col="event_id", enrichment_first_on_tie=False,
                              hot_keys=layout.hot_keys, key_groups=layout.key_groups)
        return append_sink(table, checkpoint)(to_enriched(out, grain=TABLE_GRAIN))

    with session_conf(spark, {"spark.sql.shuffle.partitions": layout.partitions}):
        run_in_order(spark, events, "event_id", start, runs)
    return read_snapshot(spark, table, require=True)


def q_enrich_arrival_order(spark, sf_dir):
    """Stream J3: each event gets its user's previous event type (arrival order)."""
    return enrich_in_arrival_order(spark, sf_dir, 1)


def q_enrich_arrival_resume(spark, sf_dir):
    """Stream J3, stopped and resumed twice on its checkpoint."""
    return enrich_in_arrival_order(spark, sf_dir, 3)


def q_enrich_arrival_relayout(spark, sf_dir):
    """Stream J3 whose state changes its layout between two runs (J4): other
    key groups, salts and state partitions, from the state read back."""
    events, rows = _events(spark, sf_dir), _events(spark, sf_dir).count()
    files = stage_in_order(events, "event_id", scratch_path(spark, "staged"),
                           min(ROWS_PER_FILE, -(-rows // 2) or 1))
    hot, groups = plan_state_layout(events_as_raw(events), "data", 1 / (2 * RELAYOUT[0]), KEYS_PER_GROUP)
    layouts = [StateLayout(hot_keys={}, key_groups=groups, partitions=RELAYOUT[0]),
               StateLayout(hot_keys=hot, key_groups=2 * groups + 1, partitions=RELAYOUT[1])]
    tables: list[str] = []
    for run, layout in enumerate(layouts):
        table, landing = scratch_path(spark, "layout"), scratch_path(spark, "ordered")
        checkpoint = table_checkpoint(table)
        admit(spark, files[len(files) * run // 2:len(files) * (run + 1) // 2], landing)
        stream = batch_limit(spark.readStream.schema(events.schema), None, BYTES_PER_TRIGGER).parquet(landing)
        updates = enrichment_updates(stream, keep=("event_id",))
        if run:
            relayout(spark, table_checkpoint(tables[-1]), checkpoint, layout)
            updates = seeded(updates, checkpoint, "event_id")
        else:
            keep_layout(spark, checkpoint, layout)
        out = enrich_stateful(events_as_raw(stream, keep=("event_id",)), updates, arrival_col="event_id",
                              enrichment_first_on_tie=False, hot_keys=layout.hot_keys,
                              key_groups=layout.key_groups)
        with session_conf(spark, {"spark.sql.shuffle.partitions": layout.partitions}):
            _await(append_sink(table)(to_enriched(out, grain=TABLE_GRAIN)))
        tables.append(table)
    return read_generations(spark, tables, require=True)


def q_enrich_arrival_order_bounded(spark, sf_dir):
    """Table J3 (T4): same result as enrich_arrival_order, Catalyst windows only."""
    ms = epoch_ms_from_ntz("ts")
    out = enrich_table_bounded(
        _events(spark, sf_dir), {"event_time": ms, "data": F.col("user_id")},
        {"key": F.col("user_id"), "enrichment": F.col("event_type")},
        "event_id", enrichment_first_on_tie=False)
    return to_enriched(out, grain="minute")


def q_enrich_arrival_order_scan(spark, sf_dir):
    """Table J3 (T4) as a segmented scan: raw rows are shuffled once."""
    out = enrich_table_scan(
        _events(spark, sf_dir), {"event_time": epoch_ms_from_ntz("ts"), "data": F.col("user_id")},
        {"key": F.col("user_id"), "enrichment": F.col("event_type")},
        "event_id", enrichment_first_on_tie=False)
    return to_enriched(out, grain="minute")


def q_enrich_arrival_versions(spark, sf_dir):
    """Stream J3 without a shuffle of raw rows: consecutive stretches of
    ``events``, each looked up in a broadcast table of the versions that its
    users' values have in it, searched by array expressions.

    Stretches are cut so that their versions may be broadcast; where the
    latest values of all users alone are too many, keyed state takes over."""
    events = _events(spark, sf_dir)
    state = latest_by_key(enrichment_updates(events, keep=("event_id",)), order=("event_id",))
    if not fits_broadcast(state, VERSIONS_PER_STRETCH, VERSION_BYTES // 2):
        return enrich_in_arrival_order(spark, sf_dir, 1)
    table, staging = scratch_path(spark, "versions"), scratch_path(spark, "stretches")
    versions = Versions(spark, table_checkpoint(table), "event_id",
                        max_rows=2 * VERSIONS_PER_STRETCH, max_bytes=VERSION_BYTES)
    rows = min(VERSIONS_PER_STRETCH, -(-events.count() // LEAST_STRETCHES) or 1)
    landing = scratch_path(spark, "ordered")
    for n, file in enumerate(stage_in_order(events, "event_id", staging, rows)):
        stretch = spark.read.schema(events.schema).parquet(file)
        lookup = versions.table(n, enrichment_updates(stretch, keep=("event_id",)))
        admit(spark, [file], landing)
        raw = events_as_raw(spark.readStream.schema(events.schema).parquet(landing), keep=("event_id",))
        out = enrich_versions(raw, lookup, "event_id", enrichment_first_on_tie=False)
        _await(append_sink(table)(to_enriched(out, grain=TABLE_GRAIN)))
    return read_snapshot(spark, table, require=True)


def q_enrichment_watermark(spark, sf_dir):
    """Updates per hour, each hour given out once the watermark on the
    enrichment time has passed it (T2): the last hour never is. Updates come
    in order of time, so none is late."""
    path = scratch_path(spark, "watermarked")

    def start(stream: DataFrame, run: int) -> StreamingQuery:
        hours = (with_enrichment_watermark(enrichment_updates(stream))
                 .groupBy(F.window(EVENT_TIME_COLUMN, "1 hour").alias("hour"))
                 .agg(F.count(F.lit(1)).alias("n"))
                 .select(F.unix_millis("hour.start").alias("hour_ms"), "n"))
        return (hours.writeStream.format("parquet").outputMode("append").option("path", path)
                .option("checkpointLocation", f"{path}.checkpoint")
                .trigger(availableNow=True).start())

    run_in_order(spark, _events(spark, sf_dir), epoch_ms_from_ntz("ts"), start)
    return spark.read.schema("hour_ms bigint, n bigint").parquet(path)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "events_as_raw": q_events_as_raw,
    "raw_source": q_raw_source,
    "enrichment_source": q_enrichment_source,
    "record_key": q_record_key,
    "partition_key": q_partition_key,
    "enrich_lookup": q_enrich_lookup,
    "latest_enrichment": q_latest_enrichment,
    "enrich_latest": q_enrich_latest,
    "append_snapshot": q_append_snapshot,
    "append_incremental": q_append_incremental,
    "count_written": q_count_written,
    "count_read": q_count_read,
    "append_hourly": q_append_hourly,
    "append_two_runs": q_append_two_runs,
    "read_while_writing": q_read_while_writing,
    "enrich_arrival_order": q_enrich_arrival_order,
    "enrich_arrival_resume": q_enrich_arrival_resume,
    "enrich_arrival_relayout": q_enrich_arrival_relayout,
    "enrich_arrival_order_bounded": q_enrich_arrival_order_bounded,
    "enrich_arrival_order_scan": q_enrich_arrival_order_scan,
    "enrich_arrival_versions": q_enrich_arrival_versions,
    "enrichment_watermark": q_enrichment_watermark,
}


# ------------------------------------------------------------- oracles ---

_RAW_SQL = ("SELECT epoch_us(ts) // 1000 AS event_time, CAST(user_id AS INTEGER) AS data"
            " FROM events")
_KEY_SQL = "CAST(event_time AS VARCHAR) || '|' || CAST(data AS VARCHAR)"


def _bucket_sql(fmt: str) -> str:
    return f"strftime(make_timestamp(event_time * 1000), '{fmt}')"


_MINUTE = _bucket_sql("%Y%m%d-%H%M")
_HOUR = _bucket_sql("%Y%m%d-%H")
_DAY = _bucket_sql("%Y%m%d")

_DIM_100_SQL = (f"SELECT CAST(range AS INTEGER) AS k, 'Enrichment-' || CAST(range AS VARCHAR)"
                f" AS enrichment FROM range({NUM_ENRICHMENTS})")


def _enriched_sql(dim_sql: str, partition_sql: str) -> str:
    return (f"WITH raw AS ({_RAW_SQL}), dim AS ({dim_sql}) "
            f"SELECT raw.event_time, raw.data, dim.enrichment, "
            f"CAST(raw.event_time AS VARCHAR) || '|' || CAST(raw.data AS VARCHAR) AS key, "
            f"strftime(make_timestamp(raw.event_time * 1000), "
            f"'{partition_sql}') AS partition "
            f"FROM raw LEFT JOIN dim ON raw.data = dim.k")


_LATEST_SQL = ("SELECT CAST(user_id AS INTEGER) AS key, epoch_us(ts) // 1000 AS timestamp,"
               " event_type AS enrichment FROM (SELECT *, row_number() OVER"
               " (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)"
               " WHERE rn = 1")

ORACLE_SQL: dict[str, str] = {
    "events_as_raw": _RAW_SQL,
    "raw_source": (f"SELECT CAST({DEFAULT_T0_MS} - ((event_id // {RAW_PARALLELISM}) % 5) * 60000"
                   f" AS BIGINT) AS event_time, CAST(event_id % 2147483648 AS INTEGER) AS data FROM events"),
    "enrichment_source": (f"SELECT CAST({DEFAULT_T0_MS - NUM_ENRICHMENTS} + CAST(user_id AS INTEGER)"
                          f" AS BIGINT) AS timestamp, CAST(user_id AS INTEGER) AS key,"
                          f" 'Enrichment-' || CAST(CAST(user_id AS INTEGER) AS VARCHAR) AS enrichment"
                          f" FROM (SELECT DISTINCT user_id FROM events)"),
    "record_key": f"SELECT event_time, data, {_KEY_SQL} AS key FROM ({_RAW_SQL})",
    "partition_key": (f"SELECT event_time, {_MINUTE} AS partition_minute, {_HOUR} AS"
                      f" partition_hour, {_DAY} AS partition_day FROM ({_RAW_SQL})"),
    "enrich_lookup": _enriched_sql(_DIM_100_SQL, "%Y%m%d-%H%M"),
    "latest_enrichment": _LATEST_SQL,
    "enrich_latest": _enriched_sql(
        "SELECT key AS k, enrichment FROM (" + _LATEST_SQL + ")", "%Y%m%d-%H%M"),
    "append_snapshot": _enriched_sql(_DIM_100_SQL, "%Y%m%d"),
    "append_incremental": _enriched_sql(_DIM_100_SQL, "%Y%m%d"),
    "append_hourly": _enriched_sql(_DIM_100_SQL, "%Y%m%d-%H"),
    "append_two_runs": _enriched_sql(_DIM_100_SQL, "%Y%m%d"),
    "read_while_writing": _enriched_sql(_DIM_100_SQL, "%Y%m%d"),
    "count_written": "SELECT COUNT(*) AS n FROM events",
    "count_read": "SELECT COUNT(*) AS n FROM events",
    "enrich_arrival_order": (
        "SELECT epoch_us(ts) // 1000 AS event_time, CAST(user_id AS INTEGER) AS data,"
        " lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS enrichment,"
        " CAST(epoch_us(ts) // 1000 AS VARCHAR) || '|' || CAST(CAST(user_id AS INTEGER) AS VARCHAR)"
        " AS key, strftime(make_timestamp((epoch_us(ts) // 1000) * 1000), '%Y%m%d')"
        " AS partition FROM events"),
    "enrich_arrival_resume": (
        "SELECT epoch_us(ts) // 1000 AS event_time, CAST(user_id AS INTEGER) AS data,"
        " lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS enrichment,"
        " CAST(epoch_us(ts) // 1000 AS VARCHAR) || '|' || CAST(CAST(user_id AS INTEGER) AS VARCHAR)"
        " AS key, strftime(make_timestamp((epoch_us(ts) // 1000) * 1000), '%Y%m%d')"
        " AS partition FROM events"),
    "enrich_arrival_relayout": (
        "SELECT epoch_us(ts) // 1000 AS event_time, CAST(user_id AS INTEGER) AS data,"
        " lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS enrichment,"
        " CAST(epoch_us(ts) // 1000 AS VARCHAR) || '|' || CAST(CAST(user_id AS INTEGER) AS VARCHAR)"
        " AS key, strftime(make_timestamp((epoch_us(ts) // 1000) * 1000), '%Y%m%d')"
        " AS partition FROM events"),
    "enrich_arrival_order_bounded": (
        "SELECT epoch_us(ts) // 1000 AS event_time, CAST(user_id AS INTEGER) AS data,"
        " lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS enrichment,"
        " CAST(epoch_us(ts) // 1000 AS VARCHAR) || '|' || CAST(CAST(user_id AS INTEGER) AS VARCHAR)"
        " AS key, strftime(make_timestamp((epoch_us(ts) // 1000) * 1000), '%Y%m%d-%H%M')"
        " AS partition FROM events"),
    "enrich_arrival_order_scan": (
        "SELECT epoch_us(ts) // 1000 AS event_time, CAST(user_id AS INTEGER) AS data,"
        " lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS enrichment,"
        " CAST(epoch_us(ts) // 1000 AS VARCHAR) || '|' || CAST(CAST(user_id AS INTEGER) AS VARCHAR)"
        " AS key, strftime(make_timestamp((epoch_us(ts) // 1000) * 1000), '%Y%m%d-%H%M')"
        " AS partition FROM events"),
    "enrich_arrival_versions": (
        "SELECT epoch_us(ts) // 1000 AS event_time, CAST(user_id AS INTEGER) AS data,"
        " lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS enrichment,"
        " CAST(epoch_us(ts) // 1000 AS VARCHAR) || '|' || CAST(CAST(user_id AS INTEGER) AS VARCHAR)"
        " AS key, strftime(make_timestamp((epoch_us(ts) // 1000) * 1000), '%Y%m%d')"
        " AS partition FROM events"),
    "enrichment_watermark": (
        "WITH u AS (SELECT epoch_us(ts) // 1000 AS ms FROM events)"
        " SELECT ms // 3600000 * 3600000 AS hour_ms, count(*) AS n FROM u GROUP BY 1"
        " HAVING ms // 3600000 * 3600000 + 3600000 <= (SELECT max(ms) FROM u)"),
}
