"""Property tests: time functions against Python's calendar arithmetic."""

from datetime import datetime, timedelta, timezone

from hypothesis import given, settings
from hypothesis import strategies as st

from rivulet.functions import epoch_ms_from_ntz, utc_bucket

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
# Years 1900 .. 2200 in epoch milliseconds.
MS = st.integers(min_value=-2_208_988_800_000, max_value=7_258_118_400_000)


def _bucket(ms: int, grain: str) -> str:
    t = EPOCH + timedelta(milliseconds=ms)
    return t.strftime({"minute": "%Y%m%d-%H%M", "hour": "%Y%m%d-%H", "day": "%Y%m%d"}[grain])


@settings(max_examples=5, deadline=None)
@given(st.lists(MS, min_size=50, max_size=200))
def test_utc_bucket_matches_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "ms bigint")
    rows = df.select("ms", utc_bucket("ms", "minute").alias("m"), utc_bucket("ms", "hour").alias("h"),
                     utc_bucket("ms", "day").alias("d")).collect()
    for r in rows:
        assert r.m == _bucket(r.ms, "minute")
        assert r.h == _bucket(r.ms, "hour")
        assert r.d == _bucket(r.ms, "day")


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(min_value=-2_208_988_800_000_000, max_value=7_258_118_400_000_000),
                min_size=50, max_size=200))
def test_epoch_ms_from_ntz_floors(spark, micros):
    naive = [(EPOCH + timedelta(microseconds=u)).replace(tzinfo=None) for u in micros]
    df = spark.createDataFrame([(t,) for t in naive], "ts timestamp_ntz")
    got = [r[0] for r in df.select(epoch_ms_from_ntz("ts")).collect()]
    assert got == [u // 1000 for u in micros]  # floor division, also below zero
