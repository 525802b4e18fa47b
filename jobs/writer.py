"""Writer job (E1): raw records -> enrich -> count -> append to the table.

    spark-submit jobs/writer.py --output-dir <table> [--num-records N]
        [--input-dir <raw parquet folder>] [--enrichments <parquet>]
        [--enrichment-stream-dir <parquet folder>]
        [--parallelism P] [--checkpoint-interval MS] [--grain minute|hour|day]
        [--once]

Without ``--input-dir`` the reference's generator (S1) makes ``N`` records,
which are landed once and streamed (bounded input, T4). With it, the folder
is an unbounded file stream (S3). ``--enrichment-stream-dir`` switches from
the static lookup to arrival-ordered enrichment from a second stream (J3).
``--once`` processes what is there and
stops (K4); otherwise a micro-batch runs every ``--checkpoint-interval``
(T3), for ever with ``--input-dir``, and until all generated records are
committed without. The checkpoint is the table's own (``<table>.checkpoint``) unless
``--checkpoint`` is given, so a second run appends to the table. Generated
records land under the checkpoint; a run that was killed is finished by the
next start before any new records are made.
"""

from __future__ import annotations

import argparse
import os
import sys
from dataclasses import replace

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from rivulet.operators.metrics import WRITTEN_COUNTER, WrittenCounter  # noqa: E402
from rivulet.plans import build_stateful_writer, build_writer  # noqa: E402
from rivulet.schemas import ENRICHMENT, RAW  # noqa: E402
from rivulet.session import RECOMMENDED_CONF, session_conf, state_partitions  # noqa: E402
from rivulet.sources import enrichment_stream, enrichments, raw_events, raw_stream  # noqa: E402
from rivulet.sources.fs import exists, mkdirs, names, rename, write_text  # noqa: E402
from rivulet.sources.streams import byte_limit  # noqa: E402
from rivulet.streaming import append_sink  # noqa: E402
from rivulet.streaming.arrival import (  # noqa: E402
    StateLayout,
    keep_layout,
    kept_layout,
    plan_state_layout,
)
from rivulet.streaming.sinks import table_checkpoint  # noqa: E402


def parse(argv=None):
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("--num-records", type=int, default=1_000_000)
    p.add_argument("--output-dir", required=True)
    p.add_argument("--parallelism", type=int, default=2,
                   help="partitions of the generated input (S1)")
    p.add_argument("--write-parallelism", type=int,
                   help="shuffle to this many writing tasks (K7); default: as read")
    p.add_argument("--checkpoint-interval", type=int, default=10_000, help="ms")
    p.add_argument("--input-dir")
    p.add_argument("--max-files-per-trigger", type=int)
    p.add_argument("--max-bytes-per-trigger", type=int,
                   help="default 2 GiB, unless files per trigger are given")
    p.add_argument("--enrichments", help="parquet folder of enrichment records")
    p.add_argument("--enrichment-stream-dir",
                   help="folder of enrichment files read as a stream; enrich in arrival "
                        "order with keyed state instead of a static lookup")
    p.add_argument("--key-groups", type=int,
                   help="arrival-order state: hash keys into this many groups "
                        "(fixed for the life of the checkpoint)")
    p.add_argument("--salt-buckets", type=int,
                   help="arrival-order state: salts per key (fixed per checkpoint)")
    p.add_argument("--layout-from",
                   help="parquet folder of past raw records: salt only its hot keys and "
                        "size key groups from its key count (first start of a checkpoint)")
    p.add_argument("--grain", default="minute", choices=["minute", "hour", "day"])
    p.add_argument("--checkpoint")
    p.add_argument("--max-records-per-file", type=int)
    p.add_argument("--bytes-per-file", type=int,
                   help="rebalance each micro-batch by partition to files of about this size")
    p.add_argument("--parquet-block-size", type=int, help="bytes (row group size)")
    p.add_argument("--parquet-page-size", type=int, help="bytes")
    p.add_argument("--compression", help="Parquet codec, e.g. zstd or snappy")
    p.add_argument("--cluster-by-partition", action="store_true")
    p.add_argument("--once", action="store_true")
    return p.parse_args(argv)


def landed(spark, a, checkpoint: str) -> str:
    """Land the generated records of this run and return the landing folder.

    A run is staged, moved file by file (a move that was done is not repeated)
    and marked as landed; its end is marked too. So a start after a kill
    finishes the run before, and only then does a start begin a new one."""
    landing, marks = f"{checkpoint}.landing", f"{checkpoint}.runs"
    done = names(spark, marks)
    run = sum(n.endswith(".done") for n in done)
    if f"{run}.landed" not in done:
        staged = f"{checkpoint}.staging/{run}"
        if f"{run}.staged" not in done:
            (raw_events(spark, a.num_records, a.parallelism).write.mode("overwrite")
             .parquet(staged))
            write_text(spark, f"{marks}/{run}.staged", "")
        mkdirs(spark, landing)
        for n in names(spark, staged):
            if n.endswith(".parquet"):
                rename(spark, f"{staged}/{n}", f"{landing}/run-{run}-{n}")
        write_text(spark, f"{marks}/{run}.landed", "")
    return landing


def finished(spark, checkpoint: str) -> None:
    """Mark the run as done, once its last batch is committed."""
    marks = f"{checkpoint}.runs"
    if exists(spark, marks):
        run = sum(n.endswith(".done") for n in names(spark, marks))
        write_text(spark, f"{marks}/{run}.done", "")


def state_layout(spark, a, checkpoint: str) -> StateLayout:
    """The checkpoint's layout; at its first start, from the options and the
    history. Options given later must agree with it."""
    kept = kept_layout(spark, checkpoint)
    if kept is None:
        hot_keys, key_groups = None, a.key_groups
        if a.layout_from:
            hot_keys, planned = plan_state_layout(
                spark.read.schema(RAW).parquet(a.layout_from), "data")
            key_groups = key_groups or planned
        kept = StateLayout(a.salt_buckets or StateLayout().salt_buckets, hot_keys, key_groups,
                           state_partitions(spark))
    asked = replace(kept, salt_buckets=a.salt_buckets or kept.salt_buckets,
                    key_groups=a.key_groups or kept.key_groups)
    return keep_layout(spark, checkpoint, asked)


def main(argv=None) -> int:
    a = parse(argv)
    builder = SparkSession.builder.appName("rivulet-writer")
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()

    checkpoint = a.checkpoint or table_checkpoint(a.output_dir)
    limit = byte_limit(a)
    raw = raw_stream(spark, a.input_dir or landed(spark, a, checkpoint), RAW,
                     a.max_files_per_trigger, max_bytes_per_trigger=limit)
    dim = (spark.read.schema(ENRICHMENT).parquet(a.enrichments) if a.enrichments
           else enrichments(spark))  # static dimension of the lookup
    sink = append_sink(
        a.output_dir, checkpoint,
        trigger="available_now" if a.once else f"{a.checkpoint_interval} milliseconds",
        max_records_per_file=a.max_records_per_file,
        parquet_block_size=a.parquet_block_size,
        parquet_page_size=a.parquet_page_size,
        compression=a.compression,
        cluster_by_partition=a.cluster_by_partition,
        bytes_per_file=a.bytes_per_file,
        write_parallelism=None if a.cluster_by_partition else a.write_parallelism,
        query_name="writer")
    written = WrittenCounter(spark, a.output_dir)
    if a.enrichment_stream_dir:
        enr = enrichment_stream(spark, a.enrichment_stream_dir, ENRICHMENT,
                                a.max_files_per_trigger,
                                max_bytes_per_trigger=limit)
        layout = state_layout(spark, a, checkpoint)
        with session_conf(spark, {"spark.sql.shuffle.partitions": layout.partitions}):
            q = build_stateful_writer(raw, enr, sink, grain=a.grain,
                                      salt_buckets=layout.salt_buckets,
                                      hot_keys=layout.hot_keys, key_groups=layout.key_groups)
    else:
        q = build_writer(raw, dim, sink, grain=a.grain)
    if not a.input_dir and not a.once:
        # Generated input ends: all of it landed before the start. The stream
        # is stopped once its last file is committed.
        q.processAllAvailable()
        q.stop()
    q.awaitTermination()
    if not a.input_dir:
        finished(spark, checkpoint)
    print(f"{WRITTEN_COUNTER}={written.total}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
