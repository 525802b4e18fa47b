"""Scale check (not a unit test): N generated events, one key holding a
third of them, through the lookup join, the bounded and the streaming
arrival-ordered enrichment. Prints one JSON line per operator.

    python tests/scale_check.py [N]      (default 10,000,000)
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from rivulet.operators import enrich, enrich_arrival_bounded  # noqa: E402
from rivulet.session import local_session, scratch_path  # noqa: E402
from rivulet.sources import enrichments  # noqa: E402
from rivulet.streaming.arrival import enrich_stateful, plan_state_layout  # noqa: E402

HOT = 7


def main() -> None:
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 10_000_000
    spark = local_session(8, 64)
    base = scratch_path(spark, "scale")
    types = F.array(*[F.lit(x) for x in ("view", "click", "buy")])
    spark.range(n, numPartitions=32).select(
        F.col("id").alias("event_id"),
        (F.lit(1_700_000_000_000) + F.col("id") * 37).alias("event_time"),
        F.when(F.col("id") % 3 == 0, F.lit(HOT)).otherwise(F.col("id") % 100_000)
        .cast("int").alias("data"),
        F.element_at(types, (F.col("id") % 3 + 1).cast("int")).alias("event_type"),
    ).write.parquet(f"{base}/events")

    def updates(df):
        return df.select(F.col("event_time").alias("timestamp"), F.col("data").alias("key"),
                         F.col("event_type").alias("enrichment"), "event_id")

    ev = spark.read.parquet(f"{base}/events")
    raw = ev.select("event_time", "data", "event_id")
    runs = {
        "lookup_broadcast_100": lambda: enrich(raw.drop("event_id"), enrichments(spark)),
        "lookup_latest_100k_keys": lambda: enrich(raw.drop("event_id"), updates(ev),
                                                  order=("timestamp", "event_id")),
        "arrival_bounded": lambda: enrich_arrival_bounded(raw, updates(ev), "event_id", False),
    }
    for name, build in runs.items():
        t = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        sec = time.perf_counter() - t
        print(json.dumps({"op": name, "rows": n, "sec": round(sec, 2),
                          "rows_per_sec": round(n / sec)}), flush=True)

    hot, groups = plan_state_layout(ev, "data", 0.01, keys_per_group=64)
    for layout, key_groups in (("per_key", None), ("key_groups", groups)):
        t = time.perf_counter()
        stream = spark.readStream.schema(ev.schema).parquet(f"{base}/events")
        out = enrich_stateful(stream.select("event_time", "data", "event_id"), updates(stream),
                              arrival_col="event_id", enrichment_first_on_tie=False,
                              salt_buckets=8, hot_keys=hot, key_groups=key_groups)
        q = (out.writeStream.format("noop").option("checkpointLocation", f"{base}/ck-{layout}")
             .trigger(availableNow=True).start())
        q.awaitTermination()
        sec = time.perf_counter() - t
        print(json.dumps({"op": f"arrival_stream_one_batch_{layout}", "rows": n,
                          "hot_keys": hot, "key_groups": key_groups, "sec": round(sec, 2),
                          "rows_per_sec": round(n / sec)}), flush=True)


if __name__ == "__main__":
    main()
