"""Enrichment watermark and query status."""

from rivulet.schemas import ENRICHMENT
from rivulet.streaming.watermark import EVENT_TIME_COLUMN, with_enrichment_watermark


def test_watermark_is_max_timestamp_seen(spark, tmp):
    rows = [(1_700_000_000_000 + i * 1000, i, f"e{i}") for i in range(10)]
    spark.createDataFrame(rows, ENRICHMENT).coalesce(1).write.parquet(f"{tmp}/enr")
    stream = spark.readStream.schema(ENRICHMENT).parquet(f"{tmp}/enr")
    wm = with_enrichment_watermark(stream)
    assert dict(wm.dtypes)[EVENT_TIME_COLUMN] == "timestamp"
    q = (wm.writeStream.format("parquet").option("path", f"{tmp}/out")
         .option("checkpointLocation", f"{tmp}/ck").start())
    assert q.isActive and q.exception() is None and "message" in q.status
    q.processAllAvailable()
    # The watermark advances after the batch: trigger one more (empty) batch.
    spark.createDataFrame([], ENRICHMENT).write.mode("append").parquet(f"{tmp}/enr")
    q.processAllAvailable()
    marks = [p.eventTime.get("watermark") for p in q.recentProgress if p.eventTime]
    q.stop()
    assert not q.isActive
    assert "2023-11-14T22:13:29.000Z" in marks  # max timestamp, 0 s delay
    assert spark.read.parquet(f"{tmp}/out").count() == 10  # nothing dropped
