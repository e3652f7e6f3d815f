"""Session construction and lineage cutting.

Nothing here holds state: operators take DataFrames and return DataFrames.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Settings every job of the engine relies on.  AQE re-plans joins and
# coalesces small shuffle partitions at run time; skew-join splitting covers
# the lookup joins whose big side may carry one hot account.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # fiscal years are text ('2024'); partition folders must not turn them into integers
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def cluster_conf(shuffle_partitions: int = 8000, advisory_mb: int = 256, max_partition_mb: int = 512) -> dict:
    """Settings for a large cluster (hundreds of TB, ~1000 executors).

    Shuffle partitions start high and AQE coalesces them to ~``advisory_mb``;
    skewed partitions above 5x the median (and 256 MB) are split for joins;
    scans read ``max_partition_mb`` per task.  Pass the result as ``conf`` to
    :func:`build_session`, or set it in the deployment.
    """
    return {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{advisory_mb}m",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
        "spark.sql.files.maxPartitionBytes": f"{max_partition_mb}m",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
    }


LOCAL_CHECKPOINT_KEY = "arqueo.localCheckpointFolder"


def build_session(master: str = "local[8]", app: str = "arqueo", shuffle_partitions: int | None = 8,
                  conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    The deployment sets it; it is only read here.  Where it is unset, a scratch
    folder is made in local mode (one machine, as in tests); on a cluster the
    call raises, because executors would not see each other's files.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(LOCAL_CHECKPOINT_KEY, None)
    if not path:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        # spark.checkpoint.dir cannot change at run time; remember the local
        # fallback under a session key of our own
        path = tempfile.mkdtemp(prefix="arqueo-ckpt-")
        spark.conf.set(LOCAL_CHECKPOINT_KEY, path)
    return path


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Point ``checkpoint()`` at :func:`checkpoint_root` and return it."""
    path = checkpoint_root(spark)
    spark.sparkContext.setCheckpointDir(path)
    return path


def materialize(df: DataFrame, name: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder and read it back.

    Used when an intermediate result (e.g. the netted ledger) feeds several
    controls: later jobs start from the written table, so a lost executor
    re-reads files instead of recomputing the whole lineage.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark).rstrip('/')}/{name or 'table'}-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    return spark.read.parquet(path)


#: Jobs that are started at a time where several do not depend on each other.
JOBS = 8


def together(spark: SparkSession, calls: list[Callable]) -> list:
    """The results of calls that start jobs, ``JOBS`` at a time: jobs of few tasks then fill the cores that others leave idle."""
    with ThreadPoolExecutor(JOBS) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(call)) for call in calls]
        return [one.result() for one in started]
