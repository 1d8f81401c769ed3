"""Session settings and the shared scratch folder."""

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


HUGE_METHOD, HUGE_METHOD_DEFAULT = "spark.sql.codegen.hugeMethodLimit", "65535"


def build_session(master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the jobs expect; cluster settings win where given."""
    builder = (
        SparkSession.builder.appName("parcelmill")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # split a skewed join even where that costs a later shuffle
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        # text searching is heavy per byte: do not merge small shuffles into a few tasks
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
    )
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Settings that wide records need in any session: code that Java would only interpret is generated in pieces.

    Java compiles no method of more than 8,000 bytes, and a projection of many fields is one such method.
    """
    if spark.conf.get(HUGE_METHOD) == HUGE_METHOD_DEFAULT:  # a session's own value stays
        spark.conf.set(HUGE_METHOD, "8000")
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    Only in local mode (tests) may `spark.checkpoint.dir` be unset; a local folder is used then.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="run-parcelmill-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir() or root
    return os.path.join(root, f"{label}-{uuid.uuid4().hex[:12]}")
