"""Session settings shared by the tests, the bench and interactive use."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


INPUT_PARTITIONS = "spark.commentscope.inputPartitions"


def build_session(master: str | None = None, app: str = "commentscope",
                  shuffle_partitions: int | None = None, input_partitions: int | None = None) -> SparkSession:
    """Session with adaptive execution and UTC; cluster settings win where they exist.

    ``input_partitions`` is for files of fewer row groups than cores: the caller asks that comments be
    dealt into that many partitions after the scan. Without it a text query has no shuffle.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # joins whose measured partitions are small are hashed instead of sorted
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64m")
        # recording the Python line of every column call costs seconds on wide feature plans
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if input_partitions:
        builder = builder.config(INPUT_PARTITIONS, str(input_partitions))
    if master and master.startswith("local"):
        builder = builder.config("spark.driver.memory", "16g")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named by ``spark.checkpoint.dir``.

    Only a local master without that setting gets a folder of its own: on a cluster a
    machine-local folder would be lost together with the machine.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if shared:
        sc.setCheckpointDir(shared)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix=f"commentscope-{os.getpid()}-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
