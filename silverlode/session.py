"""Session settings and the shared work folder.

Every operator takes a ``SparkSession`` or a ``DataFrame``; nothing here is needed to use them on a session
that already exists. ``scale_conf`` lists the settings the operators were planned for.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def scale_conf() -> dict[str, str]:
    """Settings that matter at scale; all of them are ordinary Spark SQL options."""
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # A hot key (one key with a third of the rows) is split at run time in left, semi and inner joins.
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Extra shuffle is accepted when it lets a skewed join be split.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        # Spark decides on broadcasts from the size estimate, AQE from the measured size.
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.session.timeZone": "UTC",
        # Building a plan is many small calls; without a recorded Python call site each is much cheaper.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }


def local_session(cores: int | str = 8, app: str = "silverlode", **extra: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "16g")
    )
    for key, value in {**scale_conf(), **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine; on a cluster executors would not see it.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="silverlode-")
        spark.conf.set(CHECKPOINT_KEY, root)
    return root.rstrip("/")


def ensure_checkpoints(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable: it needs a folder that all executors share."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
