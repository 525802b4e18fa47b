"""Session settings and the shared scratch folder.

Scratch data (stream checkpoints, staged inputs, result tables of the
registered streaming queries) goes under the folder the cluster names in
``spark.checkpoint.dir``. Only a local-mode session without that setting
(tests, a laptop) gets a local folder made and set; on a cluster a missing
setting is an error.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings this library relies on; all can be overridden by the cluster.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Keyed state of the arrival-ordered enrichment: off-heap, spills to
    # local disk, incremental checkpoints. Fixed at a query's first start.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests, the bench and the job scripts when run locally."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("rivulet")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only a local-mode session (tests, a laptop) without one gets a folder
    made here; on a cluster a machine-local folder would be invisible to the
    executors, so a missing setting is an error there.
    """
    root = spark.sparkContext.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if root:
            spark.sparkContext.setCheckpointDir(root)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
        root = tempfile.mkdtemp(prefix="rivulet-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir() or root
    return root.rstrip("/")


def materialize(df):
    """Compute ``df`` once and cut its lineage with a reliable checkpoint in
    the shared checkpoint folder (survives executor loss; never a
    local checkpoint). Keeps the plan's output partitioning."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/rivulet/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def session_conf(spark: SparkSession, settings: dict):
    """Set SQL confs for the queries started (and awaited) inside the block,
    then restore them. A streaming query keeps the values it started with in
    its checkpoint (e.g. its number of state partitions)."""
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, str(v))
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def state_partitions(spark: SparkSession) -> int:
    """State partitions for a new stateful query, fixed at its first start:
    ``spark.rivulet.statePartitions``, else ``spark.sql.shuffle.partitions``.
    Never read off the executors of the moment, which come and go."""
    return int(spark.conf.get("spark.rivulet.statePartitions", None)
               or spark.conf.get("spark.sql.shuffle.partitions"))
