"""Arrival-ordered enrichment with keyed state."""

import os

import pytest
from conftest import SF001

from rivulet.operators import to_enriched
from rivulet.schemas import ENRICHMENT, RAW
from rivulet.sources import enrichment_updates, events_as_raw, load_table
from rivulet.streaming.arrival import enrich_stateful


class Script:
    """Raw and enrichment landing folders; each step lands one file."""

    def __init__(self, spark, tmp, salt_buckets=4, raw_udf=None, key_groups=None):
        self.spark, self.tmp, self.salts, self.raw_udf = spark, tmp, salt_buckets, raw_udf
        self.key_groups = key_groups
        os.makedirs(f"{tmp}/raw", exist_ok=True)
        os.makedirs(f"{tmp}/enr", exist_ok=True)
        self.q = None

    def start(self):
        raw = self.spark.readStream.schema(RAW).parquet(f"{self.tmp}/raw")
        if self.raw_udf is not None:
            raw = raw.withColumn("event_time", self.raw_udf("event_time").cast("bigint"))
        enr = self.spark.readStream.schema(ENRICHMENT).parquet(f"{self.tmp}/enr")
        out = enrich_stateful(raw, enr, salt_buckets=self.salts, key_groups=self.key_groups)
        self.q = (out.writeStream.format("parquet").option("path", f"{self.tmp}/out")
                  .option("checkpointLocation", f"{self.tmp}/ck").start())
        return self

    def land(self, raws=(), enrs=()):
        if raws:
            self.spark.createDataFrame(list(raws), RAW).coalesce(1).write.mode("append") \
                .parquet(f"{self.tmp}/raw")
        if enrs:
            self.spark.createDataFrame(list(enrs), ENRICHMENT).coalesce(1).write.mode("append") \
                .parquet(f"{self.tmp}/enr")
        self.q.processAllAvailable()

    def stop(self):
        self.q.stop()

    def rows(self):
        return sorted(tuple(r) for r in self.spark.read.parquet(f"{self.tmp}/out")
                      .select("event_time", "data", "enrichment").collect())


@pytest.mark.parametrize("groups", [None, 2])
def test_arrival_script(spark, tmp, groups):
    # FIXTURES arrival_script, one step per micro-batch.
    s = Script(spark, tmp, key_groups=groups).start()
    s.land(raws=[(10, 1)])
    s.land(enrs=[(5, 1, "v1")])
    s.land(raws=[(11, 1), (12, 2)])
    s.land(enrs=[(6, 1, "v2")])
    s.land(raws=[(13, 1)])
    s.stop()
    assert s.rows() == [(10, 1, None), (11, 1, "v1"), (12, 2, None), (13, 1, "v2")]


@pytest.mark.parametrize("groups", [None, 2])
def test_same_batch_applies_enrichments_first(spark, tmp, groups):
    # FIXTURES arrival_same_batch: enr(5,1,v1) and raw(10,1) in one batch.
    s = Script(spark, tmp, key_groups=groups)
    # Both files land before the query starts, so they share batch 0.
    spark.createDataFrame([(5, 1, "v1")], ENRICHMENT).coalesce(1).write.mode("append") \
        .parquet(f"{tmp}/enr")
    spark.createDataFrame([(10, 1)], RAW).coalesce(1).write.mode("append").parquet(f"{tmp}/raw")
    s.start()
    s.q.processAllAvailable()
    s.stop()
    assert s.rows() == [(10, 1, "v1")]


@pytest.mark.parametrize("groups", [None, 2])
def test_later_batch_wins_over_newer_timestamp(spark, tmp, groups):
    s = Script(spark, tmp, key_groups=groups).start()
    s.land(enrs=[(100, 1, "new")])
    s.land(enrs=[(1, 1, "older-but-later")])
    s.land(raws=[(20, 1)])
    s.stop()
    assert s.rows() == [(20, 1, "older-but-later")]


@pytest.mark.parametrize("groups", [None, 2])
def test_state_survives_restart(spark, tmp, groups):
    s = Script(spark, tmp, key_groups=groups).start()
    s.land(enrs=[(5, 1, "v1")])
    s.stop()
    s2 = Script(spark, tmp, key_groups=groups).start()  # same checkpoint
    s2.land(raws=[(10, 1)])
    s2.stop()
    assert s2.rows() == [(10, 1, "v1")]


@pytest.mark.parametrize("salts,groups", [(1, None), (3, None), (1, 5), (3, 5)])
def test_arrival_column_matches_lag(spark, tmp, salts, groups):
    events = load_table(spark, SF001, "events")
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet") \
        .parquet(SF001)
    out = enrich_stateful(events_as_raw(stream, keep=("event_id",)),
                          enrichment_updates(stream, keep=("event_id",)),
                          arrival_col="event_id", enrichment_first_on_tie=False,
                          salt_buckets=salts, key_groups=groups)
    q = (to_enriched(out, grain="day").writeStream.format("parquet")
         .option("path", f"{tmp}/out").option("checkpointLocation", f"{tmp}/ck")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = {(r.event_time, r.data): r.enrichment for r in spark.read.parquet(f"{tmp}/out").collect()}
    events.createOrReplaceTempView("ev_arrival")
    want = spark.sql(
        "select cast(user_id as int) data, event_id, ts, lag(event_type) over"
        " (partition by user_id order by event_id) prev from ev_arrival")
    raw = events_as_raw(events, keep=("event_id",))
    joined = raw.join(want.select("event_id", "prev"), "event_id").collect()
    assert len(got) == 1000
    assert all(got[(r.event_time, r.data)] == r.prev for r in joined)


@pytest.mark.parametrize("groups", [None, 2])
def test_null_keys_never_match(spark, tmp, groups):
    s = Script(spark, tmp, key_groups=groups).start()
    spark.createDataFrame([(5, None, "ghost"), (6, 1, "v1")],
                          "timestamp bigint, key int, enrichment string").coalesce(1) \
        .write.mode("append").parquet(f"{tmp}/enr")
    s.q.processAllAvailable()
    s.land(raws=[(10, 1)])
    spark.createDataFrame([(11, None)], "event_time bigint, data int").coalesce(1) \
        .write.mode("append").parquet(f"{tmp}/raw")
    s.q.processAllAvailable()
    s.stop()
    assert s.rows() == [(10, 1, "v1"), (11, None, None)]


def test_selective_salting_gives_same_result(spark, tmp):
    events = load_table(spark, SF001, "events")
    results = []
    for i, (hot, groups) in enumerate([(None, None), ([3], None), ([], None), ([3], 4)]):
        stream = spark.readStream.schema(events.schema) \
            .option("pathGlobFilter", "events.parquet").parquet(SF001)
        out = enrich_stateful(events_as_raw(stream, keep=("event_id",)),
                              enrichment_updates(stream, keep=("event_id",)),
                              arrival_col="event_id", enrichment_first_on_tie=False,
                              salt_buckets=4, hot_keys=hot, key_groups=groups)
        q = (out.writeStream.format("parquet").option("path", f"{tmp}/o{i}")
             .option("checkpointLocation", f"{tmp}/c{i}").trigger(availableNow=True).start())
        q.awaitTermination()
        results.append(sorted(tuple(r) for r in spark.read.parquet(f"{tmp}/o{i}").collect()))
    assert len(results[0]) == 1000
    assert results[0] == results[1] == results[2] == results[3]


def test_failed_batch_rerun_keeps_state_exact(spark, tmp):
    from pyspark.errors import StreamingQueryException

    from faults import failing_once

    boom = failing_once(f"{tmp}/marker", fail_on=11)
    s = Script(spark, tmp, raw_udf=boom).start()
    s.land(raws=[(10, 1)])
    s.land(enrs=[(5, 1, "v1")])
    try:
        s.land(raws=[(11, 1), (12, 2)])  # the task holding event_time 11 fails
        failed = False
    except StreamingQueryException:
        failed = True
    assert failed
    s2 = Script(spark, tmp, raw_udf=boom).start()  # re-runs the failed batch
    s2.q.processAllAvailable()
    s2.land(enrs=[(6, 1, "v2")])
    s2.land(raws=[(13, 1)])
    s2.stop()
    assert s2.rows() == [(10, 1, None), (11, 1, "v1"), (12, 2, None), (13, 1, "v2")]
