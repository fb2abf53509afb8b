"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(
    app_name: str = "tickframe", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """A session in UTC with adaptive execution; everything else is left to the cluster's defaults."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone: time stamps in every dataset here are UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a session whose driver and executors are one process sets its own; any other is refused.
    """
    context = spark.sparkContext
    configured = spark.conf.get(_CHECKPOINT_DIR, None) or context.getConf().get(_CHECKPOINT_DIR) or context.getCheckpointDir()
    if not configured:
        if not re.fullmatch(r"local(\[[^]]*])?", context.master):
            raise ValueError(f"set {_CHECKPOINT_DIR} to a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tickframe-"))
        configured = context.getCheckpointDir()
    return configured.rstrip("/")


def new_scratch(spark: SparkSession, name: str) -> str:
    """A fresh path under the scratch root; nothing is created there yet."""
    return f"{scratch_root(spark)}/tickframe/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a scratch path once nothing reads it any more; a path outside the scratch root is refused."""
    if not path.startswith(f"{scratch_root(spark)}/tickframe/"):
        raise ValueError(f"{path} is no scratch path")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
