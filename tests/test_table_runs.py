"""Runs into a table: its own checkpoint, runs that end, counts from commits,
files sized in bytes, partitions by name, read parallelism."""

import contextlib
import io

import pytest
from conftest import T0
from pyspark.sql import functions as F

from jobs import reader as reader_job
from jobs import writer as writer_job
from rivulet.fixed import DEFAULT_PARTITION_NAME, READ_COUNTER, WRITTEN_COUNTER
from rivulet.operators.metrics import WrittenCounter, rows_read
from rivulet.schemas import ENRICHMENT
from rivulet.session import session_conf
from rivulet.sources import read_incremental, read_snapshot
from rivulet.sources.fs import names
from rivulet.sources.lake import read_parallelism
from rivulet.streaming import append_sink, discard_sink
from rivulet.streaming.sinks import owner_path, table_checkpoint
from rivulet.streaming.watermark import with_enrichment_watermark

TABLE = "event_time long, data int, enrichment string, key string, partition string"


def land(spark, path, start, n, partitions="p"):
    (spark.range(start, start + n, 1, 1).select(
        F.col("id").alias("event_time"), F.col("id").cast("int").alias("data"),
        F.lit("e").alias("enrichment"), F.col("id").cast("string").alias("key"),
        F.lit(partitions).alias("partition")).write.mode("append").parquet(path))


def run(spark, source, table, checkpoint=None, **opts):
    q = append_sink(table, checkpoint, **opts)(spark.readStream.schema(TABLE).parquet(source))
    q.awaitTermination()
    return q


def test_another_tables_checkpoint_is_refused_and_nothing_is_lost(spark, tmp):
    for t in "ab":
        land(spark, f"{tmp}/in-{t}", 0, 1000)
        run(spark, f"{tmp}/in-{t}", f"{tmp}/{t}")
    land(spark, f"{tmp}/in-a", 1000, 500)
    with pytest.raises(ValueError, match="another checkpoint"):
        run(spark, f"{tmp}/in-a", f"{tmp}/a", table_checkpoint(f"{tmp}/b"))
    run(spark, f"{tmp}/in-a", f"{tmp}/a")
    assert read_snapshot(spark, f"{tmp}/a").count() == 1500
    assert read_snapshot(spark, f"{tmp}/b").count() == 1000


def test_a_table_without_an_owner_is_bound_at_its_next_run(spark, tmp):
    import os

    land(spark, f"{tmp}/in", 0, 10)
    run(spark, f"{tmp}/in", f"{tmp}/t")
    os.remove(owner_path(f"{tmp}/t"))  # as if killed before it was written
    land(spark, f"{tmp}/in", 10, 10)
    run(spark, f"{tmp}/in", f"{tmp}/t")
    assert read_snapshot(spark, f"{tmp}/t").count() == 20 and os.path.exists(owner_path(f"{tmp}/t"))


def test_default_mode_ends_prints_its_count_and_adds_up(spark, tmp, capsys):
    for n in (1, 2):
        assert writer_job.main(["--output-dir", f"{tmp}/t", "--num-records", "1000",
                                "--checkpoint-interval", "300"]) == 0
        assert f"{WRITTEN_COUNTER}=1000" in capsys.readouterr().out
        assert read_snapshot(spark, f"{tmp}/t").count() == 1000 * n
    assert [n for n in names(spark, f"{tmp}/t.checkpoint.runs") if n.endswith(".done")] == [
        "0.done", "1.done"]


def test_counts_need_no_progress_events(spark, tmp):
    spark.range(0, 1200, 1, 120).selectExpr("id AS event_time", "CAST(id AS INT) AS data",
                                            "'e' AS enrichment", "'k' AS key", "'p' AS partition") \
        .write.parquet(f"{tmp}/in")
    with session_conf(spark, {"spark.sql.streaming.numRecentProgressUpdates": 2}):
        counter = WrittenCounter(spark, f"{tmp}/t")
        stream = spark.readStream.schema(TABLE).option("maxFilesPerTrigger", 1).parquet(f"{tmp}/in")
        append_sink(f"{tmp}/t")(stream).awaitTermination()
        assert counter.total == 1200
        rows = read_incremental(spark, f"{tmp}/t", max_files_per_trigger=1)
        q = discard_sink(f"{tmp}/ck", "available_now")(rows)
        q.awaitTermination()
        assert len(q.recentProgress) <= 2
    assert rows_read(spark, f"{tmp}/ck", f"{tmp}/t") == 1200
    assert rows_read(spark, f"{tmp}/ck", f"{tmp}/t", after=99) == 200
    assert WrittenCounter(spark, f"{tmp}/t").total == 0


def test_reader_job_counts_its_own_run(spark, tmp, capsys):
    for n in (100, 50):
        land(spark, f"{tmp}/in", n, n)
        run(spark, f"{tmp}/in", f"{tmp}/t")
        assert reader_job.main(["--input-dir", f"{tmp}/t", "--once", "--checkpoint", f"{tmp}/ck"]) == 0
        assert f"{READ_COUNTER}={n}" in capsys.readouterr().out


def test_files_are_sized_in_bytes(spark, tmp):
    spark.range(0, 60_000, 1, 8).select(
        F.col("id").alias("event_time"), F.col("id").cast("int").alias("data"),
        F.sha2(F.col("id").cast("string"), 256).alias("enrichment"), F.col("id").cast("string").alias("key"),
        F.when(F.col("id") % 3 == 0, "small").otherwise("hot").alias("partition")) \
        .write.parquet(f"{tmp}/in")
    count = {}
    for size in (256 << 10, 64 << 20):
        run(spark, f"{tmp}/in", f"{tmp}/t{size}", bytes_per_file=size)
        got = read_snapshot(spark, f"{tmp}/t{size}")
        assert got.count() == 60_000
        files = got.select("partition", "_metadata.file_name", "_metadata.file_size").distinct().collect()
        count[size] = len(files)
    assert count[64 << 20] == 2  # one for each value: a small batch makes no more
    assert count[256 << 10] >= 8  # the hot value is split
    plain = append_sink(f"{tmp}/plain")(spark.readStream.schema(TABLE).parquet(f"{tmp}/in"))
    plain.awaitTermination()
    assert len(read_snapshot(spark, f"{tmp}/plain").inputFiles()) > 4  # tasks times values


def test_writer_job_takes_bytes_per_file(spark, tmp):
    assert writer_job.main(["--output-dir", f"{tmp}/t", "--num-records", "1000", "--once",
                            "--bytes-per-file", str(1 << 20)]) == 0
    assert len(read_snapshot(spark, f"{tmp}/t").inputFiles()) == 5  # one for each minute


def partition_filters(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return [x for x in buf.getvalue().splitlines() if x.startswith("PartitionFilters")]


def test_the_default_name_prunes_folders(spark, tmp):
    rows = [(1, 1, None, "1|1", None), (2, 2, None, "2|2", "p"), (3, 3, None, "3|3", "q")]
    spark.createDataFrame(rows, TABLE).write.partitionBy("partition").parquet(f"{tmp}/t")

    def read(where):
        return read_snapshot(spark, f"{tmp}/t", name_missing=True, where=where)

    for where, keys in ((lambda p: p == DEFAULT_PARTITION_NAME, ["1|1"]), (lambda p: p == "p", ["2|2"]),
                        (lambda p: p >= "o", ["2|2", "3|3"]), (lambda p: p < "o", ["1|1"]),
                        (lambda p: p.isin("q", DEFAULT_PARTITION_NAME), ["1|1", "3|3"])):
        got = read(where)
        assert sorted(r.key for r in got.collect()) == keys
        (filters,) = partition_filters(got)
        assert "partition" in filters and "coalesce" not in filters
    named = read(lambda p: p == DEFAULT_PARTITION_NAME)
    assert named.first()["partition"] == DEFAULT_PARTITION_NAME
    assert "isnull(partition" in partition_filters(named)[0]


def test_read_parallelism(spark, tmp):
    spark.range(0, 1000, 1, 12).selectExpr("id AS event_time", "CAST(id AS INT) AS data", "'e' AS enrichment",
                                           "'k' AS key", "'p' AS partition").write.parquet(f"{tmp}/t")
    assert read_snapshot(spark, f"{tmp}/t").rdd.getNumPartitions() < 12
    with session_conf(spark, read_parallelism(12)):
        assert read_snapshot(spark, f"{tmp}/t").rdd.getNumPartitions() >= 12


def test_late_updates_are_left_out_of_hours_that_are_given_out(spark, tmp):
    hour = 3_600_000

    def put(name, rows):
        spark.createDataFrame([(T0 // hour * hour + ms, 1, "v") for ms in rows], ENRICHMENT) \
            .coalesce(1).write.mode("append").parquet(f"{tmp}/in")
        stream = spark.readStream.schema(ENRICHMENT).parquet(f"{tmp}/in")
        hours = (with_enrichment_watermark(stream).groupBy(F.window("event_ts", "1 hour")).count()
                 .select(F.unix_millis("window.start").alias("hour"), "count"))
        q = (hours.writeStream.format("parquet").option("path", f"{tmp}/out")
             .option("checkpointLocation", f"{tmp}/ck").trigger(availableNow=True).start())
        q.awaitTermination()

    put("first", [0, 1, 3 * hour])  # the watermark passes the first hour
    put("late", [2, 3 * hour + 1])  # a row of the first hour is late, one of the fourth is not
    put("last", [5 * hour])
    base = T0 // hour * hour
    got = {(r["hour"] - base) // hour: r["count"] for r in spark.read.parquet(f"{tmp}/out").collect()}
    assert got == {0: 2, 3: 2}
