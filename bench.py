"""Benchmark: time every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is forced with a ``noop`` write (full computation, nothing
collected) after a warm-up on sf0.001; the best of ``$BENCH_RUNS`` (2) runs
is reported, since single runs on a shared machine vary by about 30%. The writer job (stream of events -> enrich -> count -> table)
and the reader job (incremental read -> count -> discard) are also timed on
their own and reported as rows/s, the BASELINE metric (floor: 10,000 rows/s),
as is the reference writer job at its default size (1,000,000 generated
records, landed once then streamed).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(p for p in (ROOT, os.environ.get("PYTHONPATH", "")) if p)

from rivulet.operators.metrics import READ_COUNTER, WRITTEN_COUNTER, ProgressCounter  # noqa: E402
from rivulet.plans import build_reader, build_writer, catalog, stage_bounded  # noqa: E402
from rivulet.session import local_session, scratch_path  # noqa: E402
from rivulet.sources import enrichments, raw_events  # noqa: E402
from rivulet.streaming import append_sink, discard_sink  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def _sf(path: str) -> str:
    name = os.path.basename(path.rstrip("/"))
    return name[2:] if name.startswith("sf") else name


def main() -> None:
    spark = local_session(CPUS, int(CPUS) if CPUS.isdigit() else 8)
    # Warm-up on the smallest data: JVM, codegen, Python workers.
    for name in ("enrich_lookup", "append_snapshot", "enrich_arrival_order"):
        catalog.QUERIES[name](spark, "/root/testdata/sf0.001").write.format("noop") \
            .mode("overwrite").save()

    times: dict[str, float | None] = {}
    errors: dict[str, str] = {}
    for name, fn in catalog.QUERIES.items():
        best = float("inf")
        try:
            for _ in range(RUNS):
                t = time.perf_counter()
                fn(spark, SF_DIR).write.format("noop").mode("overwrite").save()
                best = min(best, time.perf_counter() - t)
            times[name] = round(best, 3)
        except Exception as e:  # report, keep measuring the others
            times[name] = None
            errors[name] = str(e)[:300]

    t = time.perf_counter()
    table, written = catalog.write_table(spark, SF_DIR)
    writer_sec = time.perf_counter() - t
    t = time.perf_counter()
    q = build_reader(spark, table, discard_sink(scratch_path(spark, "bench-rck"),
                                                trigger="available_now"))
    q.awaitTermination()
    read = ProgressCounter(READ_COUNTER).poll(q)
    reader_sec = time.perf_counter() - t

    # The reference writer job's default size: 1,000,000 generated records,
    # P = 2, minute grain (5 partitions), 100 enrichments.
    t = time.perf_counter()
    landing, table1m = scratch_path(spark, "bench-landing"), scratch_path(spark, "bench-1m")
    raw = stage_bounded(spark, raw_events(spark, 1_000_000, 2), landing)
    q = build_writer(raw, enrichments(spark), append_sink(table1m, scratch_path(spark, "bench-1m-ck")))
    q.awaitTermination()
    gen_written = ProgressCounter(WRITTEN_COUNTER).poll(q)
    gen_sec = time.perf_counter() - t

    print(json.dumps({
        "metric": "total_query_time",
        "value": round(sum(v for v in times.values() if v is not None), 3),
        "unit": "sec",
        "queries": times,
        "sf": _sf(SF_DIR),
        "writer_rows": written,
        "writer_rows_per_sec": round(written / writer_sec, 1),
        "reader_rows": read,
        "reader_rows_per_sec": round(read / reader_sec, 1),
        "generated_writer_rows": gen_written,
        "generated_writer_rows_per_sec": round(gen_written / gen_sec, 1),
        "cpus": CPUS,
        "runs_per_query": RUNS,
        **({"errors": errors} if errors else {}),
    }))


if __name__ == "__main__":
    main()
