"""Reader job (E3): incremental read of the table -> count -> discard.

    spark-submit jobs/reader.py --input-dir <table> [--poll-interval S]
        [--once] [--max-files-per-trigger K] [--parallelism N]

Starts even if the table does not exist yet (T6) and then waits for the
first commit. Prints the running count every poll; ``--once`` reads what is
committed and stops.
"""

from __future__ import annotations

import argparse
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from rivulet.operators.metrics import (  # noqa: E402
    READ_COUNTER,
    ProgressCounter,
    last_batch,
    rows_read,
)
from rivulet.plans import build_reader  # noqa: E402
from rivulet.session import scratch_path  # noqa: E402
from rivulet.sources.lake import read_parallelism  # noqa: E402
from rivulet.sources.streams import byte_limit  # noqa: E402
from rivulet.streaming import discard_sink  # noqa: E402


def parse(argv=None):
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("--input-dir", required=True)
    p.add_argument("--poll-interval", type=int, default=10, help="seconds")
    p.add_argument("--max-files-per-trigger", type=int)
    p.add_argument("--max-bytes-per-trigger", type=int,
                   help="default 2 GiB, unless files per trigger are given")
    p.add_argument("--parallelism", type=int,
                   help="minimum number of read tasks per micro-batch (S9)")
    p.add_argument("--checkpoint")
    p.add_argument("--once", action="store_true")
    p.add_argument("--expect", type=int, help="stop after this many rows")
    p.add_argument("--timeout", type=int, default=0, help="seconds; 0 = none")
    p.add_argument("--verbose", action="store_true", help="print the running count each poll")
    return p.parse_args(argv)


def main(argv=None) -> int:
    a = parse(argv)
    spark = SparkSession.builder.appName("rivulet-reader").getOrCreate()
    for k, v in (read_parallelism(a.parallelism) if a.parallelism else {}).items():
        spark.conf.set(k, v)
    checkpoint = a.checkpoint or scratch_path(spark, "reader-ckpt")
    before = last_batch(spark, checkpoint)
    sink = discard_sink(checkpoint,
                        trigger="available_now" if a.once else f"{a.poll_interval} seconds",
                        query_name="reader")
    q = build_reader(spark, a.input_dir, sink, create=True,
                     max_files_per_trigger=a.max_files_per_trigger,
                     max_bytes_per_trigger=byte_limit(a))
    counter = ProgressCounter(READ_COUNTER)
    start = time.time()
    while q.isActive:
        n = counter.poll(q)
        if a.verbose:
            print(f"{READ_COUNTER}={n} batches={counter.batches}", flush=True)
        if a.expect is not None and n >= a.expect:
            break
        if a.timeout and time.time() - start > a.timeout:
            break
        q.awaitTermination(min(1, a.poll_interval))
    if q.isActive:
        q.stop()
    # The count of the run from its commits, whatever progress was seen.
    n = rows_read(spark, checkpoint, a.input_dir, -1 if before is None else before)
    print(f"{READ_COUNTER}={n}")
    return 0 if q.exception() is None else 1


if __name__ == "__main__":
    sys.exit(main())
