"""Scratch folders in the shared one that the cluster names in spark.checkpoint.dir."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where it is unset, a local session (tests) gets one of its own and any other an
    error: executors that write to disks of their own would leave tables of which later reads see a part."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="kinspark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def shared_path(spark: SparkSession, what: str) -> str:
    """A new name in the shared folder."""
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
