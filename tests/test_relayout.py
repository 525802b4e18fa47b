"""State read back, and taken on by a query of another layout."""

from collections import Counter

import pytest
from conftest import SF001
from pyspark.sql import functions as F

from rivulet.session import session_conf
from rivulet.sources import enrichment_updates, events_as_raw, load_table
from rivulet.streaming.arrival import StateLayout, enrich_stateful, kept_layout
from rivulet.streaming.relayout import read_state, relayout, seeded


def run(spark, source, out, checkpoint, layout, first):
    stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
    updates = enrichment_updates(stream, keep=("event_id",))
    updates = updates if first else seeded(updates, checkpoint, "event_id")
    rows = enrich_stateful(events_as_raw(stream, keep=("event_id",)), updates, arrival_col="event_id",
                           enrichment_first_on_tie=False, salt_buckets=layout.salt_buckets,
                           hot_keys=layout.hot_keys, key_groups=layout.key_groups)
    with session_conf(spark, {"spark.sql.shuffle.partitions": layout.partitions}):
        q = (rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
        q.awaitTermination()


@pytest.mark.parametrize("old,new", [
    (StateLayout(hot_keys={}, key_groups=4, partitions=3), StateLayout(hot_keys={5: 3}, key_groups=7, partitions=5)),
    (StateLayout(salt_buckets=3, partitions=4), StateLayout(hot_keys={}, key_groups=2, partitions=2)),
])
def test_a_query_goes_on_with_another_layout(spark, tmp, old, new):
    events = load_table(spark, SF001, "events")
    for n, cond in enumerate(("event_id < 400", "event_id >= 400 AND event_id < 700", "event_id >= 700")):
        events.filter(cond).write.parquet(f"{tmp}/e{n}")
    run(spark, f"{tmp}/e0", f"{tmp}/o0", f"{tmp}/c0", old, True)

    want = (events.filter("event_id < 400").groupBy("user_id")
            .agg(F.max("event_id").alias("at"), F.max_by("event_type", "event_id").alias("v")))
    assert sorted(tuple(r) for r in read_state(spark, f"{tmp}/c0").collect()) == sorted(
        (r["user_id"], r["v"], r["at"]) for r in want.collect())

    relayout(spark, f"{tmp}/c0", f"{tmp}/c1", new)
    relayout(spark, f"{tmp}/c0", f"{tmp}/c1", new)  # after a kill
    assert kept_layout(spark, f"{tmp}/c1") == new
    run(spark, f"{tmp}/e1", f"{tmp}/o1", f"{tmp}/c1", new, False)
    spark.read.parquet(f"{tmp}/e2").write.mode("append").parquet(f"{tmp}/e1")
    run(spark, f"{tmp}/e1", f"{tmp}/o1", f"{tmp}/c1", new, False)  # resumes: the seed is not taken again

    last, expected = {}, Counter()
    for r in sorted(events.collect(), key=lambda r: r["event_id"]):
        expected[(r["user_id"], last.get(r["user_id"]))] += 1
        last[r["user_id"]] = r["event_type"]
    got = spark.read.parquet(f"{tmp}/o0").unionByName(spark.read.parquet(f"{tmp}/o1"))
    assert Counter((r["data"], r["enrichment"]) for r in got.collect()) == expected
