"""Batches of a stream as folders that appear whole, once, and under a name of their own."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmeter.sources.files import delete, file_system, make_folder, rename_once


def batch_name(spark: SparkSession, number: int) -> str:
    """Name of a batch, the same when it is repeated. A query with another checkpoint is another one."""
    query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{query}-{number:012d}"


def publish(spark: SparkSession, folder: str, name: str, write: Callable[[str], None]) -> bool:
    """Let `write` fill a draft and show it as `folder/batch=name`, unless that is there already.

    A batch that is repeated after a crash finds its folder or does not; never a part of it.
    Drafts lie beside the folder, where no reader looks.
    """
    fs, root = file_system(spark, folder)
    draft = f"{root}.drafts/{uuid.uuid4().hex}"
    write(draft)
    make_folder(fs, spark, root)
    if rename_once(spark, draft, f"{root}/batch={name}"):
        return True
    delete(fs, spark, draft)
    return False


def replace_batch(
    rows: DataFrame, path: str, partitions: list[str], batch: str | None, sorted_by: list[str] | None = None
) -> None:
    """Add the rows below `path`, each partition with a folder for the writing.

    A writing with the name `batch` replaces the folders of that name: a batch that is repeated
    after a crash has the same rows and leaves each once, however far it came before. Large
    partitions are split over several files, small ones share a task.
    """
    named = rows.withColumn("batch", F.lit(batch or f"job-{uuid.uuid4().hex}")).hint("rebalance", *partitions)
    if sorted_by:
        named = named.sortWithinPartitions(*partitions, *sorted_by)
    writer = named.write.partitionBy(*partitions, "batch")
    if batch:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    else:
        writer.mode("append").parquet(path)
