from __future__ import annotations

import os

from arqueo.session import cluster_conf, ensure_checkpoint_dir, materialize


def test_checkpoint_dir_is_read_from_the_session(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    root = ensure_checkpoint_dir(spark)
    if configured:
        assert root == configured  # the shared folder named by the cluster is used as is
    df = materialize(spark.range(10), "probe")
    assert df.count() == 10
    assert df.inputFiles() and all(root.rstrip("/") in f for f in df.inputFiles())
    assert ensure_checkpoint_dir(spark) == root  # stable within the session


def test_cluster_conf_values():
    conf = cluster_conf()
    assert conf["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == "256m"
    assert int(conf["spark.sql.shuffle.partitions"]) >= 1000
    assert os.path.sep not in "".join(conf.values())  # no machine-local paths in cluster settings
