"""P2, P3 and epoch conversion; time edges under two session zones."""

import pytest
from pyspark.sql import functions as F

from rivulet.functions import epoch_ms_from_ntz, record_key, utc_bucket

# FIXTURES time_edges: epoch ms -> UTC minute bucket.
TIME_EDGES = [
    (0, "19700101-0000"),
    (-1, "19691231-2359"),
    (1710037800000, "20240310-0230"),
    (1699164000000, "20231105-0600"),
]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_utc_bucket_is_zone_free(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(ms,) for ms, _ in TIME_EDGES], "ms bigint")
        got = dict(df.select("ms", utc_bucket("ms").alias("b")).collect())
        assert got == dict(TIME_EDGES)
        hours = dict(df.select("ms", utc_bucket("ms", "hour").alias("b")).collect())
        days = dict(df.select("ms", utc_bucket("ms", "day").alias("b")).collect())
        for ms, b in TIME_EDGES:
            assert hours[ms] == b[:11] and days[ms] == b[:8]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_bad_grain():
    with pytest.raises(ValueError):
        utc_bucket("ms", "week")


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_epoch_ms_from_ntz(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        row = spark.sql(
            "select timestamp_ntz'2024-03-10 02:30:00.5' a,"
            " timestamp_ntz'1969-12-31 23:59:59.9995' b,"
            " timestamp_ntz'2024-01-01 00:00:07.179575' c").select(
            epoch_ms_from_ntz("a").alias("a"), epoch_ms_from_ntz("b").alias("b"),
            epoch_ms_from_ntz("c").alias("c")).first()
        assert row["a"] == 1710037800500
        assert row["b"] == -1  # floored, not truncated
        assert row["c"] == 1704067207179  # floored, not rounded
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_record_key(spark):
    df = spark.createDataFrame([(1700000000000, 7), (-5, -3)], "event_time bigint, data int")
    got = [r[0] for r in df.select(record_key()).collect()]
    assert got == ["1700000000000|7", "-5|-3"]
    # Same text as Java's "%d|%d".
    want = [r[0] for r in df.select(F.format_string("%d|%d", "event_time", "data")).collect()]
    assert got == want


def test_survey_names(spark):
    from rivulet.functions import partition_key
    from rivulet.operators import counted

    df = spark.createDataFrame([(1710037800000, 1)], "event_time bigint, data int")
    assert df.select(partition_key()).first()[0] == "20240310-0230"
    assert df.select(partition_key("event_time", "day")).first()[0] == "20240310"
    assert counted(df, "n-test").count() == 1
