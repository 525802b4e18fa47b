"""Record schemas (P7) and schema conformance on write and read.

The schemas are fixed at build time, as in the reference; nothing is inferred.
File sources report every column as nullable, so "not null" is enforced by
``conform(..., require=True)`` rather than by the ``nullable`` flag.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.fixed import PARTITION_COLUMN, RECORD_KEY_COLUMN  # noqa: F401  (re-exported)

# Raw record: event time in epoch milliseconds (UTC) and an int payload.
RAW = T.StructType(
    [
        T.StructField("event_time", T.LongType(), False),
        T.StructField("data", T.IntegerType(), False),
    ]
)

# Enrichment record: arrival timestamp (epoch ms), lookup key, value.
ENRICHMENT = T.StructType(
    [
        T.StructField("timestamp", T.LongType(), False),
        T.StructField("key", T.IntegerType(), False),
        T.StructField("enrichment", T.StringType(), True),
    ]
)

# Table record; ``partition`` is the partition column and comes last.
ENRICHED = T.StructType(
    [
        T.StructField("event_time", T.LongType(), False),
        T.StructField("data", T.IntegerType(), False),
        T.StructField("enrichment", T.StringType(), True),
        T.StructField("key", T.StringType(), False),
        T.StructField("partition", T.StringType(), False),
    ]
)



def _required(c: Column, name: str, dtype: T.DataType) -> Column:
    # raise_error yields NULL of type void; cast it so coalesce type-checks.
    return F.coalesce(
        c, F.raise_error(F.lit(f"required column '{name}' is null")).cast(dtype)
    )


def conform(df: DataFrame, schema: T.StructType, require: bool = False) -> DataFrame:
    """Project ``df`` onto ``schema``: by name, in schema order, cast to type.

    Extra columns are dropped. With ``require=True`` every non-nullable field
    raises at run time when a null reaches it (the reference dereferences
    required fields without a null test). All of this is Catalyst
    expressions, so it stays inside whole-stage codegen.
    """
    cols = []
    for f in schema.fields:
        c = F.col(f.name).cast(f.dataType)
        if require and not f.nullable:
            c = _required(c, f.name, f.dataType)
        cols.append(c.alias(f.name))
    return df.select(*cols)
