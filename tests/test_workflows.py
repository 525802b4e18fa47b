"""The reference's two end-to-end tests, at their size (100,000 records,
P = 2, 100 enrichments), plus the job entry points."""

import time

from conftest import T0

import jobs.reader as reader_job
import jobs.writer as writer_job
from rivulet.operators.metrics import READ_COUNTER, WRITTEN_COUNTER, ProgressCounter
from rivulet.plans import build_reader, build_writer, stage_bounded
from rivulet.sources import enrichments, raw_events, read_snapshot
from rivulet.streaming import append_sink, discard_sink

NUM_RESULTS = 100_000


def test_query_of_existing_table(spark, tmp):
    raw = stage_bounded(spark, raw_events(spark, NUM_RESULTS, 2, T0), f"{tmp}/landing")
    wq = build_writer(raw, enrichments(spark, 100, T0),
                      append_sink(f"{tmp}/table", f"{tmp}/wck"))
    wq.awaitTermination()
    rq = build_reader(spark, f"{tmp}/table", discard_sink(f"{tmp}/rck", trigger="1 second"))
    counter = ProgressCounter(READ_COUNTER)
    deadline = time.time() + 10  # the reference allows 10 s
    while counter.poll(rq) < NUM_RESULTS and time.time() < deadline:
        time.sleep(0.1)
    rq.stop()
    assert counter.total == NUM_RESULTS


def test_write_and_incremental_query(spark, tmp):
    # Writer runs continuously over 10 landed files, 1 file per micro-batch.
    stage_bounded(spark, raw_events(spark, NUM_RESULTS, 2, T0).coalesce(1), f"{tmp}/landing",
                  max_records_per_file=NUM_RESULTS // 10)
    raw = spark.readStream.schema("event_time bigint, data int") \
        .option("maxFilesPerTrigger", 1).parquet(f"{tmp}/landing")
    rq = build_reader(spark, f"{tmp}/table", discard_sink(f"{tmp}/rck", trigger="1 second"),
                      create=True)
    wq = build_writer(raw, enrichments(spark, 100, T0),
                      append_sink(f"{tmp}/table", f"{tmp}/wck", trigger="500 milliseconds"))
    deadline = time.time() + 5
    while not rq.isActive and time.time() < deadline:
        time.sleep(0.1)
    assert rq.isActive
    counter = ProgressCounter(READ_COUNTER)
    deadline = time.time() + 200  # "2 ms/result"
    while counter.poll(rq) < NUM_RESULTS and time.time() < deadline:
        time.sleep(0.2)
    wq.stop()
    rq.stop()
    assert counter.total == NUM_RESULTS
    assert ProgressCounter(WRITTEN_COUNTER).poll(wq) == NUM_RESULTS
    assert read_snapshot(spark, f"{tmp}/table").count() == NUM_RESULTS


def test_jobs_cli(spark, tmp, capsys):
    assert writer_job.main(["--output-dir", f"{tmp}/table", "--num-records", "1000",
                            "--once", "--checkpoint", f"{tmp}/wck"]) == 0
    assert f"{WRITTEN_COUNTER}=1000" in capsys.readouterr().out
    assert reader_job.main(["--input-dir", f"{tmp}/table", "--once",
                            "--checkpoint", f"{tmp}/rck"]) == 0
    assert f"{READ_COUNTER}=1000" in capsys.readouterr().out
    rows = read_snapshot(spark, f"{tmp}/table").collect()
    assert len(rows) == 1000 and sum(r.enrichment is not None for r in rows) == 100


def test_writer_file_sizing_options(spark, tmp, capsys):
    import os

    assert writer_job.main(["--output-dir", f"{tmp}/table", "--num-records", "2000", "--once",
                            "--checkpoint", f"{tmp}/wck", "--max-records-per-file", "100",
                            "--parquet-block-size", str(1 << 20),
                            "--parquet-page-size", str(1 << 20), "--compression", "zstd"]) == 0
    capsys.readouterr()
    files = [f for d in os.listdir(f"{tmp}/table") if d.startswith("partition=")
             for f in os.listdir(f"{tmp}/table/{d}") if f.endswith(".parquet")]
    assert len(files) >= 20  # at most 100 rows per file
    assert all(".zstd." in f for f in files)
    assert read_snapshot(spark, f"{tmp}/table").count() == 2000


def test_writer_and_reader_in_separate_applications(spark, tmp):
    """The only link between writer and reader is the table folder."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    table = f"{tmp}/table"
    rq = build_reader(spark, table, discard_sink(f"{tmp}/rck", trigger="1 second"), create=True)
    n = 20_000
    proc = subprocess.run(
        [sys.executable, os.path.join(root, "jobs", "writer.py"), "--output-dir", table,
         "--num-records", str(n), "--once", "--checkpoint", f"{tmp}/wck"],
        capture_output=True, text=True, timeout=300,
        env={**os.environ, "PYTHONPATH": root, "PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.ui.enabled=false pyspark-shell"})
    assert proc.returncode == 0, proc.stderr[-2000:]
    assert f"{WRITTEN_COUNTER}={n}" in proc.stdout
    counter = ProgressCounter(READ_COUNTER)
    deadline = time.time() + 60
    while counter.poll(rq) < n and time.time() < deadline:
        time.sleep(0.5)
    rq.stop()
    assert counter.total == n


def test_writer_job_with_enrichment_stream(spark, tmp, capsys):
    from rivulet.schemas import ENRICHMENT

    spark.createDataFrame([(1, 5, "five"), (2, 6, "six")], ENRICHMENT).coalesce(1) \
        .write.parquet(f"{tmp}/enr")
    assert writer_job.main(["--output-dir", f"{tmp}/table", "--num-records", "100", "--once",
                            "--checkpoint", f"{tmp}/wck",
                            "--enrichment-stream-dir", f"{tmp}/enr", "--key-groups", "4"]) == 0
    assert f"{WRITTEN_COUNTER}=100" in capsys.readouterr().out
    rows = {r.data: r.enrichment for r in read_snapshot(spark, f"{tmp}/table").collect()}
    # Both streams arrive in one batch: enrichments apply first.
    assert len(rows) == 100 and rows[5] == "five" and rows[6] == "six" and rows[7] is None


def test_writer_job_on_input_folder_in_bounded_batches(spark, tmp, capsys):
    raw_events(spark, 3000, 2, T0).repartition(6).write.parquet(f"{tmp}/in")
    assert writer_job.main(["--output-dir", f"{tmp}/table", "--input-dir", f"{tmp}/in",
                            "--max-files-per-trigger", "2", "--once", "--grain", "hour",
                            "--checkpoint", f"{tmp}/wck"]) == 0
    assert f"{WRITTEN_COUNTER}=3000" in capsys.readouterr().out
    df = read_snapshot(spark, f"{tmp}/table")
    assert df.count() == 3000
    assert {len(r.partition) for r in df.select("partition").distinct().collect()} == {11}


def test_reader_job_continuous_stops_at_expected_count(spark, tmp, capsys):
    assert writer_job.main(["--output-dir", f"{tmp}/table", "--num-records", "500", "--once",
                            "--checkpoint", f"{tmp}/wck"]) == 0
    capsys.readouterr()
    start = time.time()
    assert reader_job.main(["--input-dir", f"{tmp}/table", "--poll-interval", "1",
                            "--expect", "500", "--timeout", "60", "--verbose",
                            "--checkpoint", f"{tmp}/rck"]) == 0
    assert f"{READ_COUNTER}=500" in capsys.readouterr().out
    assert time.time() - start < 60
    assert not any(q.isActive for q in spark.streams.active if q.name == "reader")


def test_query_cli(spark, tmp, capsys):
    import jobs.query as query_job

    assert query_job.main(["--list"]) == 0
    assert "enrich_lookup" in capsys.readouterr().out
    assert query_job.main(["latest_enrichment", "--sf-dir", "/root/testdata/sf0.001",
                           "--out", f"{tmp}/out"]) == 0
    assert spark.read.parquet(f"{tmp}/out").count() == 15
    assert query_job.main(["enrich_lookup", "--sql"]) == 0
    assert "LEFT JOIN" in capsys.readouterr().out
    assert query_job.main(["enrich_lookup", "--sf-dir", "/root/testdata/sf0.001",
                           "--explain"]) == 0
    assert "BroadcastHashJoin" in capsys.readouterr().out


def test_writer_job_stateful_with_layout_from_history(spark, tmp, capsys):
    from rivulet.schemas import ENRICHMENT

    raw_events(spark, 2000, 2, T0).write.parquet(f"{tmp}/history")
    spark.createDataFrame([(1, 5, "five")], ENRICHMENT).coalesce(1).write.parquet(f"{tmp}/enr")
    assert writer_job.main(["--output-dir", f"{tmp}/table", "--num-records", "200", "--once",
                            "--checkpoint", f"{tmp}/wck", "--enrichment-stream-dir",
                            f"{tmp}/enr", "--layout-from", f"{tmp}/history"]) == 0
    assert f"{WRITTEN_COUNTER}=200" in capsys.readouterr().out
    rows = {r.data: r.enrichment for r in read_snapshot(spark, f"{tmp}/table").collect()}
    assert rows[5] == "five" and sum(v is not None for v in rows.values()) == 1


def test_writer_killed_mid_stream_then_restarted_is_exactly_once(spark, tmp):
    """Driver loss: SIGKILL the writer application between micro-batches (or
    inside one), restart it on the same checkpoint, every row exactly once."""
    import os
    import signal
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    n, files = 20_000, 20
    raw_events(spark, n, 2, T0).repartition(files).write.parquet(f"{tmp}/in")
    table = f"{tmp}/table"
    args = [sys.executable, os.path.join(root, "jobs", "writer.py"), "--output-dir", table,
            "--input-dir", f"{tmp}/in", "--max-files-per-trigger", "1",
            "--checkpoint-interval", "200", "--checkpoint", f"{tmp}/wck"]
    env = {**os.environ, "PYTHONPATH": root,
           "PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.ui.enabled=false pyspark-shell"}
    proc = subprocess.Popen(args, env=env, stdout=subprocess.DEVNULL,
                            stderr=subprocess.DEVNULL, start_new_session=True)
    commits = f"{tmp}/wck/commits"
    deadline = time.time() + 120
    try:
        while time.time() < deadline:
            done = [c for c in os.listdir(commits) if c.isdigit()] if os.path.isdir(commits) else []
            if len(done) >= 3:
                break
            time.sleep(0.2)
    finally:
        os.killpg(proc.pid, signal.SIGKILL)  # the group this test started
        proc.wait(timeout=60)
    done = [c for c in os.listdir(commits) if c.isdigit()]
    assert 3 <= len(done) < files  # killed part-way through
    # Restart: finish what is left, then stop.
    rerun = subprocess.run(args + ["--once"], env=env, capture_output=True, text=True,
                           timeout=300)
    assert rerun.returncode == 0, rerun.stderr[-2000:]
    df = read_snapshot(spark, table, require=True)
    assert df.count() == n
    assert df.select("key").distinct().count() == n


def test_stateful_writer_killed_then_restarted_keeps_state(spark, tmp):
    """Keyed state survives a SIGKILL of the application: enrichments seen
    before the kill still enrich raw rows that arrive after the restart."""
    import os
    import signal
    import subprocess
    import sys

    from rivulet.schemas import ENRICHMENT

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    n, files = 6000, 12
    spark.createDataFrame([(1, k, f"e{k}") for k in range(0, 6000, 7)], ENRICHMENT) \
        .coalesce(1).write.parquet(f"{tmp}/enr")
    raw_events(spark, n, 2, T0).repartition(files).write.parquet(f"{tmp}/in")
    table = f"{tmp}/table"
    args = [sys.executable, os.path.join(root, "jobs", "writer.py"), "--output-dir", table,
            "--input-dir", f"{tmp}/in", "--enrichment-stream-dir", f"{tmp}/enr",
            "--max-files-per-trigger", "1", "--checkpoint-interval", "200",
            "--checkpoint", f"{tmp}/wck", "--key-groups", "8"]
    env = {**os.environ, "PYTHONPATH": root,
           "PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.ui.enabled=false"
                                  " --conf spark.sql.shuffle.partitions=4 pyspark-shell"}
    proc = subprocess.Popen(args, env=env, stdout=subprocess.DEVNULL,
                            stderr=subprocess.DEVNULL, start_new_session=True)
    commits = f"{tmp}/wck/commits"
    deadline = time.time() + 180
    try:
        while time.time() < deadline:
            done = [c for c in os.listdir(commits) if c.isdigit()] if os.path.isdir(commits) else []
            if len(done) >= 3:
                break
            time.sleep(0.2)
    finally:
        os.killpg(proc.pid, signal.SIGKILL)  # the group this test started
        proc.wait(timeout=60)
    assert 3 <= len([c for c in os.listdir(commits) if c.isdigit()]) < files
    rerun = subprocess.run(args + ["--once"], env=env, capture_output=True, text=True,
                           timeout=300)
    assert rerun.returncode == 0, rerun.stderr[-2000:]
    rows = read_snapshot(spark, table, require=True).collect()
    assert len(rows) == n and len({r.key for r in rows}) == n
    # The one enrichment file arrived in batch 0, with the first raw file.
    assert all(r.enrichment == (f"e{r.data}" if r.data % 7 == 0 else None) for r in rows)
