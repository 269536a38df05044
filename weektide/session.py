"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "weektide", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the engine relies on; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.ui.enabled": "false",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new path for one run, below the shared folder the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, the warehouse is taken, which executors share too.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "_steps")
    return os.path.join(root, f"{purpose}-{uuid.uuid4().hex}")


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of an earlier :func:`shared_folder` call, on whatever file system it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
