"""Reading the click stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmeter.functions.timebucket import instant
from clickmeter.schemas import STREAM_CLICK


def read_json_folder(
    spark: SparkSession, path: str, files_per_batch: int | None = None
) -> DataFrame:
    """A folder of JSON lines as a stream of `value` text."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def read_topic(
    spark: SparkSession, servers: str, topic: str, starting: str = "latest"
) -> DataFrame:
    """A Kafka topic as a stream of `value` text; needs the Kafka connector on the cluster."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .load()
        .select(F.col("value").cast("string").alias("value"))
    )


def decode_clicks(records: DataFrame) -> DataFrame:
    """Records to clicks with their event time.

    Broken JSON and unreadable times are passed over here; the archive keeps them.
    Only the fields the counter needs are parsed.
    """
    clicks = records.select(F.from_json("value", STREAM_CLICK).alias("click")).select("click.*")
    return clicks.withColumn("click_time", instant(F.col("click_ts"))).where(
        F.col("click_time").isNotNull() & F.col("campaign_id").isNotNull()
    )
