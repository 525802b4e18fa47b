"""Runs that earlier lost rows or gave other values: many micro-batches,
second runs, changed layouts, input out of order, tied rows."""

import pytest
from conftest import T0
from pyspark.sql import functions as F

from jobs import writer as writer_job
from rivulet.operators.enrich import attach_enrichment, latest_by_key
from rivulet.operators.metrics import WRITTEN_COUNTER, ProgressCounter, RecordCounter
from rivulet.schemas import ENRICHMENT, RAW
from rivulet.sources import enrichments, read_snapshot
from rivulet.sources.generated import raw_from_ids
from rivulet.streaming.arrival import StateLayout, enrich_stateful, keep_layout, kept_layout
from rivulet.streaming.sinks import append_sink, discard_sink, rows_per_file, table_checkpoint


def test_counter_sees_every_one_of_120_batches(spark, tmp):
    spark.range(1200).repartition(120).write.parquet(f"{tmp}/in")
    stream = (spark.readStream.schema("id long").option("maxFilesPerTrigger", 1)
              .parquet(f"{tmp}/in"))
    q = discard_sink(f"{tmp}/ck", "available_now")(RecordCounter(WRITTEN_COUNTER).wrap(stream))
    counter = ProgressCounter(WRITTEN_COUNTER)
    assert counter.follow(q) == 1200 and counter.batches == 120


def test_counter_refuses_a_gap():
    counter = ProgressCounter("n")
    counter._per_batch = {0: 5, 1: 5, 3: 5}
    with pytest.raises(RuntimeError, match="1 batches"):
        counter.complete_total()


def test_two_default_runs_append(spark, tmp, capsys):
    for run in (1, 2):
        assert writer_job.main(["--output-dir", f"{tmp}/t", "--num-records", "1000", "--once"]) == 0
        assert f"{WRITTEN_COUNTER}=1000" in capsys.readouterr().out
        assert read_snapshot(spark, f"{tmp}/t").count() == 1000 * run
    with pytest.raises(ValueError, match="another checkpoint"):
        writer_job.main(["--output-dir", f"{tmp}/t", "--num-records", "10", "--once",
                         "--checkpoint", f"{tmp}/new"])


def test_killed_generated_run_is_finished_first(spark, tmp):
    a = writer_job.parse(["--output-dir", f"{tmp}/t", "--num-records", "500", "--once"])
    ck = table_checkpoint(f"{tmp}/t")
    assert writer_job.landed(spark, a, ck) == writer_job.landed(spark, a, ck)  # killed here, twice
    assert writer_job.main(["--output-dir", f"{tmp}/t", "--num-records", "500", "--once"]) == 0
    got = read_snapshot(spark, f"{tmp}/t")
    assert got.count() == 500 and got.select("data").distinct().count() == 500


def test_layout_is_kept_and_another_refused(spark, tmp):
    first = StateLayout(hot_keys={7: 3}, key_groups=4, partitions=8)
    assert kept_layout(spark, f"{tmp}/ck") is None
    assert keep_layout(spark, f"{tmp}/ck", first) == first == kept_layout(spark, f"{tmp}/ck")
    with pytest.raises(ValueError, match="holds state"):
        keep_layout(spark, f"{tmp}/ck", StateLayout(hot_keys={7: 3}, key_groups=5, partitions=8))


def test_batches_out_of_arrival_order_raise(spark, tmp):
    raw_schema, enr_schema = RAW.simpleString()[7:-1], ENRICHMENT.simpleString()[7:-1]

    def run(raw, enr):
        spark.createDataFrame(raw, f"{raw_schema},at:bigint").write.mode("append").parquet(f"{tmp}/raw")
        spark.createDataFrame(enr, f"{enr_schema},at:bigint").write.mode("append").parquet(f"{tmp}/enr")
        streams = [spark.readStream.schema(spark.read.parquet(p).schema).parquet(p)
                   for p in (f"{tmp}/raw", f"{tmp}/enr")]
        out = enrich_stateful(*streams, arrival_col="at")
        (out.writeStream.format("parquet").option("path", f"{tmp}/out")
         .option("checkpointLocation", f"{tmp}/ck").trigger(availableNow=True).start()
         .awaitTermination())

    run([(1, 1, 3)], [(1, 1, "a", 2)])
    run([(2, 1, 5)], [(2, 1, "b", 4)])
    assert sorted(r.enrichment for r in spark.read.parquet(f"{tmp}/out").collect()) == ["a", "b"]
    with pytest.raises(Exception, match="arrival order"):
        run([(3, 1, 3)], [(3, 2, "c", 6)])


def test_ties_are_decided_by_value(spark):
    dim = spark.createDataFrame([(5, 1, v) for v in "bca"] + [(4, 1, "z")], ENRICHMENT)
    for n in (1, 4):
        assert latest_by_key(dim.repartition(n)).first().enrichment == "c"


def test_a_large_dimension_is_never_broadcast(spark):
    raw = spark.createDataFrame([(1, 3)], RAW)
    for opts in ({"strategy": "broadcast"}, {"dim_rows_bound": 10}):
        out = attach_enrichment(raw, enrichments(spark, 10, T0), max_broadcast_bytes=50, **opts)
        assert out.first().enrichment == "Enrichment-3"
        assert "BroadcastHashJoin" not in out._jdf.queryExecution().optimizedPlan().toString()
        assert "strategy=broadcast" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_generated_ids_past_the_int_range(spark):
    ids = spark.createDataFrame([(2 ** 31 - 1,), (2 ** 31,), (2 ** 31 + 5,)], "id long")
    assert [r.data for r in raw_from_ids(ids).orderBy("data").collect()] == [0, 5, 2 ** 31 - 1]


def test_rows_per_file_from_bytes(spark, tmp):
    spark.range(10_000).write.parquet(f"{tmp}/p")
    n = rows_per_file(spark, f"{tmp}/p", 1000)
    assert 1 <= n < 10_000 and rows_per_file(spark, f"{tmp}/p", 2000) >= 2 * n - 1


def test_null_partition_reads_under_the_default_name(spark, tmp):
    from rivulet.fixed import DEFAULT_PARTITION_NAME

    rows = spark.createDataFrame([(1, 1, None, "1|1", None), (2, 2, None, "2|2", "p")],
                                 "event_time long, data int, enrichment string, key string, "
                                 "partition string")
    rows.write.partitionBy("partition").parquet(f"{tmp}/t")
    got = read_snapshot(spark, f"{tmp}/t", name_missing=True).select(F.sort_array(F.collect_set("partition"))).first()[0]
    assert sorted(got) == sorted([DEFAULT_PARTITION_NAME, "p"])


def test_writing_tasks_do_not_narrow_the_scan(spark, tmp):
    spark.range(0, 1000, 1, 8).selectExpr("id AS event_time", "CAST(id AS INT) AS data").write \
        .parquet(f"{tmp}/in")
    stream = spark.readStream.schema(RAW).parquet(f"{tmp}/in").selectExpr(
        "event_time", "data", "CAST(NULL AS STRING) AS enrichment", "'k' AS key", "'p' AS partition")
    append_sink(f"{tmp}/t", write_parallelism=2)(stream).awaitTermination()
    assert len(read_snapshot(spark, f"{tmp}/t").inputFiles()) == 2
