"""Ordered staging: one pass over the table, files streamed in range order."""

import pytest
from pyspark.sql import functions as F

from rivulet.plans.catalog import run_in_order
from rivulet.sources.fs import modified
from rivulet.streaming import staging
from rivulet.streaming.staging import admit, stage_in_order, staged


def test_files_hold_consecutive_ranges(spark, tmp):
    rows = spark.range(1000).select(((F.col("id") * 37) % 200).alias("at"), "id")  # each five times
    files = stage_in_order(rows, "at", f"{tmp}/s", rows_per_file=90)
    assert files == staged(spark, f"{tmp}/s") and len(files) > 8
    ends = [tuple(spark.read.parquet(f).agg(F.min("at"), F.max("at")).first()) for f in files]
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))  # equal values share a file
    for f in files:
        got = [r["at"] for r in spark.read.parquet(f).collect()]
        assert got == sorted(got)


def test_admitted_files_come_in_order_of_time_also_after_a_kill(spark, tmp):
    files = stage_in_order(spark.range(100), "id", f"{tmp}/s", rows_per_file=10)
    admit(spark, files[:4], f"{tmp}/in")
    rest = staged(spark, f"{tmp}/s")  # what a restart finds
    assert rest == files[4:]
    admit(spark, rest, f"{tmp}/in")
    times = modified(spark, f"{tmp}/in")
    order = sorted(times, key=times.get)
    assert order == [f.rsplit("/", 1)[1] for f in files]
    assert len(set(times.values())) == len(files)


def test_a_file_system_without_times_is_refused(spark, tmp, monkeypatch):
    files = stage_in_order(spark.range(100), "id", f"{tmp}/s", rows_per_file=10)
    monkeypatch.setattr(staging, "set_modified", lambda *a: None)
    monkeypatch.setattr(staging, "modified", lambda s, p: dict.fromkeys(modified(s, p), 5))
    with pytest.raises(OSError, match="modification times"):
        admit(spark, files, f"{tmp}/in")


@pytest.mark.parametrize("files", [3, 40])
def test_the_table_is_read_as_often_whatever_the_number_of_files(spark, tmp, files):
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    table = spark.range(0, 4000, 1, 2).mapInArrow(seen, "id long")
    batches = []

    def start(stream, run):
        q = (stream.writeStream.format("noop").option("checkpointLocation", f"{tmp}/ck-{files}")
             .trigger(availableNow=True).start())
        batches.append(q)
        return q

    run_in_order(spark, table, "id", start, runs=2, rows_per_file=4000 // files)
    assert len(batches) == 2
    assert reads.value <= 4 * 4000  # two counts, the sample of the order, the write


def test_one_stream_reads_micro_batches_in_range_order(spark, tmp):
    files = stage_in_order(spark.range(1000).withColumn("at", 1000 - F.col("id")), "at", f"{tmp}/s", 100)
    admit(spark, files, f"{tmp}/in")
    stream = spark.readStream.schema("id long, at long").option("maxFilesPerTrigger", 1).parquet(f"{tmp}/in")
    q = (stream.observe("o", F.min("at").alias("low"), F.max("at").alias("high")).writeStream
         .format("noop").option("checkpointLocation", f"{tmp}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    seen = [(p.observedMetrics["o"]["low"], p.observedMetrics["o"]["high"]) for p in q.recentProgress
            if "o" in p.observedMetrics]
    assert len(seen) == len(files) and seen == sorted(seen)
