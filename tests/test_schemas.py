"""Conform to the table schema, required columns."""

import pytest
from pyspark.errors import PySparkException

from rivulet.schemas import ENRICHED, RAW, conform


def test_conform_orders_and_casts(spark):
    df = spark.createDataFrame([("x", 5, 1, "k", "p", "extra")],
                               "enrichment string, data long, event_time int, key string,"
                               " partition string, junk string")
    out = conform(df, ENRICHED)
    assert out.columns == [f.name for f in ENRICHED.fields]
    assert [f.dataType for f in out.schema.fields] == [f.dataType for f in ENRICHED.fields]
    assert out.first().asDict() == {"event_time": 1, "data": 5, "enrichment": "x", "key": "k",
                                    "partition": "p"}


def test_require_raises_on_null(spark):
    # FIXTURES null_required: data is null.
    df = spark.createDataFrame([(1, None)], "event_time bigint, data int")
    with pytest.raises(Exception) as e:
        conform(df, RAW, require=True).collect()
    assert "required column 'data' is null" in str(e.value)
    assert isinstance(e.value, (PySparkException, Exception))


def test_optional_keeps_null(spark):
    df = spark.createDataFrame([(1, 2, None, "k", "p")], ENRICHED)
    assert conform(df, ENRICHED, require=True).first().enrichment is None
