"""Session helpers: shared checkpoint folder, scoped confs, state partitions."""

from rivulet.session import checkpoint_root, scratch_path, session_conf, state_partitions


def test_checkpoint_root_is_the_sessions(spark):
    root = checkpoint_root(spark)
    assert root == spark.sparkContext.getCheckpointDir().rstrip("/")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root + "/rivulet/x-")


def test_session_conf_restores(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with session_conf(spark, {key: 3, "spark.sql.caseSensitive": "true"}):
        assert spark.conf.get(key) == "3"
    assert spark.conf.get(key) == before
    assert spark.conf.get("spark.sql.caseSensitive") == "false"


def test_state_partitions_bounded(spark):
    n = state_partitions(spark)
    assert 1 <= n <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert n <= 2 * spark.sparkContext.defaultParallelism
