"""Session settings the pipelines rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def utc(spark: SparkSession) -> SparkSession:
    """Pin the session to UTC: every bucket is a UTC floor."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only a local session, whose executors share the machine, may go without one; it gets
    a temporary folder. Elsewhere rows written to a machine's own disk would be lost.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="clickmeter-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
