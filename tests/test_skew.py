"""One key holding a third of all rows: joins and keyed state split it."""

from pyspark.sql import functions as F

from rivulet.operators import enrich
from rivulet.streaming.arrival import _tagged_union

HOT = 7


def _skewed_raw(spark, n=30_000):
    return spark.range(n).select(
        (F.lit(1_700_000_000_000) + F.col("id") * 1000).alias("event_time"),
        F.when(F.col("id") % 3 == 0, F.lit(HOT)).otherwise(F.col("id") % 1000)
        .cast("int").alias("data"))


def _dim(spark, n=1000):
    return spark.range(n).select(F.lit(0).cast("bigint").alias("timestamp"),
                                 F.col("id").cast("int").alias("key"),
                                 F.concat(F.lit("v"), F.col("id").cast("string")).alias("enrichment"))


SKEW_CONF = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


def test_aqe_splits_hot_key_in_streaming_micro_batch(spark, tmp, capsys):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        _skewed_raw(spark).write.parquet(f"{tmp}/raw")
        stream = spark.readStream.schema("event_time bigint, data int").parquet(f"{tmp}/raw")
        out = enrich(stream, _dim(spark), strategy="shuffle")
        q = (out.writeStream.format("parquet").option("path", f"{tmp}/out")
             .option("checkpointLocation", f"{tmp}/ck").trigger(availableNow=True).start())
        q.awaitTermination()
        capsys.readouterr()
        q.explain()
        plan = capsys.readouterr().out
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "SortMergeJoin(skew=true)" in plan
    assert spark.read.parquet(f"{tmp}/out").count() == 30_000


def test_aqe_splits_hot_key_in_shuffle_join(spark):
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = enrich(_skewed_raw(spark), _dim(spark), strategy="shuffle")
        rows = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "SortMergeJoin(skew=true)" in plan or "isSkew" in plan or "skew=true" in plan
    assert len(rows) == 30_000
    assert sum(r.data == HOT for r in rows) == 10_000 + 20  # id % 3 == 0, or id % 1000 == 7
    assert all(r.enrichment == f"v{r.data}" for r in rows)


def test_salted_join_spreads_hot_key(spark):
    out = enrich(_skewed_raw(spark), _dim(spark), strategy="salted", salt_buckets=8)
    rows = out.collect()
    assert len(rows) == 30_000 and all(r.enrichment == f"v{r.data}" for r in rows)


def test_state_salting_spreads_hot_key_and_replicates_enrichments(spark):
    raw = _skewed_raw(spark).withColumn("arrival", F.col("event_time"))
    enr = _dim(spark).withColumn("arrival", F.lit(0).cast("bigint"))
    tagged = _tagged_union(raw, enr, "arrival", 8)
    hot_raw = {r.salt: r["count"] for r in
               tagged.filter(~F.col("is_enrichment") & (F.col("gkey") == HOT))
               .groupBy("salt").count().collect()}
    assert sorted(hot_raw) == list(range(8))
    assert max(hot_raw.values()) < 10_000 / 8 * 1.3  # near-even split
    hot_enr = tagged.filter(F.col("is_enrichment") & (F.col("gkey") == HOT))
    assert sorted(r.salt for r in hot_enr.collect()) == list(range(8))


def test_find_hot_keys_and_selective_salting(spark):
    from rivulet.streaming.arrival import find_hot_keys

    raw = _skewed_raw(spark).withColumn("arrival", F.col("event_time"))
    assert find_hot_keys(raw, "data", min_share=0.05) == [HOT]
    enr = _dim(spark).withColumn("arrival", F.lit(0).cast("bigint"))
    tagged = _tagged_union(raw, enr, "arrival", 8, hot_keys=[HOT])
    salts = {r.gkey: r.n for r in tagged.groupBy("gkey").agg(
        F.countDistinct("salt").alias("n")).collect()}
    assert salts[HOT] == 8
    assert {n for k, n in salts.items() if k != HOT} == {1}
    # Only the hot key's enrichment is replicated.
    assert tagged.filter("is_enrichment").count() == 1000 - 1 + 8


def test_salted_join_with_hot_key_list(spark):
    out = enrich(_skewed_raw(spark), _dim(spark), strategy="salted", salt_buckets=8,
                 hot_keys=[HOT])
    rows = out.collect()
    assert len(rows) == 30_000 and all(r.enrichment == f"v{r.data}" for r in rows)


def test_plan_state_layout(spark):
    from rivulet.streaming.arrival import plan_state_layout

    raw = _skewed_raw(spark)
    hot, groups = plan_state_layout(raw, "data", min_share=0.05, keys_per_group=64)
    assert list(hot) == [HOT] and hot[HOT] >= 2
    assert groups == -(-1000 // 64)  # 1,000 distinct keys
    assert plan_state_layout(raw.limit(0), "data", min_groups=8) == ({}, 8)


def test_bucketed_stream_static_join_shuffles_only_raw(spark, tmp, capsys):
    _skewed_raw(spark).write.parquet(f"{tmp}/raw")
    stream = spark.readStream.schema("event_time bigint, data int").parquet(f"{tmp}/raw")
    out = enrich(stream, _dim(spark), strategy="bucketed", buckets=8, salt_buckets=4,
                 hot_keys=[HOT])
    q = (out.writeStream.format("parquet").option("path", f"{tmp}/out")
         .option("checkpointLocation", f"{tmp}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    capsys.readouterr()
    q.explain()
    plan = capsys.readouterr().out.split("== Initial Plan ==")[0]
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    assert plan.count("Exchange") == 1  # the raw side only
    rows = spark.read.parquet(f"{tmp}/out").collect()
    assert len(rows) == 30_000 and all(r.enrichment == f"v{r.data}" for r in rows)
