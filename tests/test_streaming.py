"""Table write and read, batch and stream."""

import os
import time

from conftest import T0

from rivulet.operators import ProgressCounter
from rivulet.operators.metrics import READ_COUNTER, WRITTEN_COUNTER, RecordCounter
from rivulet.plans import build_reader, build_writer, stage_bounded
from rivulet.sources import enrichments, raw_events, read_incremental, read_snapshot
from rivulet.streaming import append_sink, discard_sink


def _write(spark, tmp, n=1000, files=1, per_trigger=None, grain="minute", **sink_opts):
    per_file = max(1, n // files)
    raw = stage_bounded(spark, raw_events(spark, n, 2, T0).coalesce(1), f"{tmp}/landing",
                        max_records_per_file=per_file)
    if per_trigger:
        raw = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", per_trigger) \
            .parquet(f"{tmp}/landing")
    sink = append_sink(f"{tmp}/table", f"{tmp}/wck", **sink_opts)
    q = build_writer(raw, enrichments(spark, 100, T0), sink, grain=grain)
    return q


def test_round_trip_snapshot(spark, tmp):
    q = _write(spark, tmp)
    q.awaitTermination()
    assert ProgressCounter(WRITTEN_COUNTER).poll(q) == 1000
    df = read_snapshot(spark, f"{tmp}/table", require=True)
    rows = df.collect()
    assert len(rows) == 1000
    assert sum(r.enrichment is None for r in rows) == 900
    assert len({r.partition for r in rows}) == 5
    assert len({r.key for r in rows}) == 1000  # the record key is unique for S1 data
    parts = [d for d in os.listdir(f"{tmp}/table") if d.startswith("partition=")]
    assert len(parts) == 5
    assert os.path.isdir(f"{tmp}/table/_spark_metadata")


def test_partition_pruning(spark, tmp):
    _write(spark, tmp).awaitTermination()
    df = read_snapshot(spark, f"{tmp}/table")
    one = df.select("partition").first().partition
    pruned = df.filter(df.partition == one)
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(partition" in plan
    assert pruned.count() == 200


def test_batch_counter(spark):
    c = RecordCounter("n-batch")
    df = c.wrap(raw_events(spark, 500, 2, T0))
    df.write.format("noop").mode("overwrite").save()
    assert c.batch_count() == 500


def test_reader_starts_first_and_reads_everything(spark, tmp):
    # T6 + T5: reader on a missing table, then a writer in 5 micro-batches.
    table = f"{tmp}/table"
    rq = build_reader(spark, table, discard_sink(f"{tmp}/rck", trigger="1 second"), create=True)
    time.sleep(2)
    assert rq.isActive and rq.exception() is None
    wq = _write(spark, tmp, n=1000, files=10, per_trigger=2)
    wq.awaitTermination()
    assert ProgressCounter(WRITTEN_COUNTER).poll(wq) == 1000
    counter = ProgressCounter(READ_COUNTER)
    deadline = time.time() + 60
    while counter.poll(rq) < 1000 and time.time() < deadline:
        time.sleep(0.5)
    rq.stop()
    assert counter.total == 1000
    assert len([p for p in wq.recentProgress if p.numInputRows > 0]) == 5


def test_incremental_read_into_second_table(spark, tmp):
    _write(spark, tmp).awaitTermination()
    sink = append_sink(f"{tmp}/copy", f"{tmp}/cck")
    q = build_reader(spark, f"{tmp}/table", sink)
    q.awaitTermination()
    a = read_snapshot(spark, f"{tmp}/table")
    b = read_snapshot(spark, f"{tmp}/copy")
    assert b.count() == 1000 and a.exceptAll(b).count() == 0


def test_replay_after_lost_commit_is_exactly_once(spark, tmp):
    # FIXTURES replay: drop the last commit marker, re-run: still 100 rows.
    q = _write(spark, tmp, n=100)
    q.awaitTermination()
    last = sorted(c for c in os.listdir(f"{tmp}/wck/commits") if not c.startswith("."))[-1]
    os.remove(f"{tmp}/wck/commits/{last}")
    os.remove(f"{tmp}/wck/commits/.{last}.crc")
    q2 = _write_again(spark, tmp)
    q2.awaitTermination()
    assert q2.exception() is None
    assert read_snapshot(spark, f"{tmp}/table").count() == 100


def _write_again(spark, tmp):
    raw = spark.readStream.schema("event_time bigint, data int").parquet(f"{tmp}/landing")
    sink = append_sink(f"{tmp}/table", f"{tmp}/wck")
    return build_writer(raw, enrichments(spark, 100, T0), sink)


def test_cluster_by_partition_bounds_files(spark, tmp):
    q = _write(spark, tmp, n=1000, cluster_by_partition=True, files_per_partition=2)
    q.awaitTermination()
    table = f"{tmp}/table"
    for d in os.listdir(table):
        if d.startswith("partition="):
            files = [f for f in os.listdir(f"{table}/{d}") if f.endswith(".parquet")]
            assert 1 <= len(files) <= 2
    assert read_snapshot(spark, table).count() == 1000


def test_missing_partition_value(spark, tmp):
    rows = [(1, 1, None, "1|1", None), (2, 2, "x", "2|2", "20240101")]
    df = spark.createDataFrame(rows, "event_time bigint, data int, enrichment string,"
                                     " key string, partition string")
    df.write.parquet(f"{tmp}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{tmp}/in")
    append_sink(f"{tmp}/t", f"{tmp}/ck", fill_missing_partition=True)(stream).awaitTermination()
    got = {r.key: r.partition for r in read_snapshot(spark, f"{tmp}/t").collect()}
    assert got == {"1|1": "no_partition", "2|2": "20240101"}


def test_incremental_schema_keeps_day_partition_string(spark, tmp):
    _write(spark, tmp, grain="day").awaitTermination()
    df = read_snapshot(spark, f"{tmp}/table")
    assert dict(df.dtypes)["partition"] == "string"
    s = read_incremental(spark, f"{tmp}/table")
    assert s.isStreaming and dict(s.dtypes)["partition"] == "string"


def test_task_failure_mid_write_then_restart_is_exactly_once(spark, tmp):
    from pyspark.errors import StreamingQueryException

    from faults import failing_once

    raw_events(spark, 1000, 2, T0).repartition(4).write.parquet(f"{tmp}/landing")
    boom = failing_once(f"{tmp}/marker", fail_on=999)

    def start():
        raw = spark.readStream.schema("event_time bigint, data int").parquet(f"{tmp}/landing")
        raw = raw.withColumn("data", boom("data"))
        return build_writer(raw, enrichments(spark, 100, T0),
                            append_sink(f"{tmp}/table", f"{tmp}/wck"))

    q = start()
    try:
        q.awaitTermination()
        failed = False
    except StreamingQueryException:
        failed = True
    assert failed and os.path.exists(f"{tmp}/marker")
    q2 = start()  # same checkpoint: batch 0 runs again
    q2.awaitTermination()
    df = read_snapshot(spark, f"{tmp}/table", require=True)
    assert df.count() == 1000
    assert df.select("key").distinct().count() == 1000


def test_snapshot_reader_pushes_filters_and_prunes_columns(spark, tmp):
    _write(spark, tmp).awaitTermination()
    df = read_snapshot(spark, f"{tmp}/table").where("data = 5").select("key")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "EqualTo(data,5)" in plan
    assert "ReadSchema: struct<data:int,key:string>" in plan
    assert df.count() == 1
