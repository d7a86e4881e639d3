"""The raw click archive: Parquet, laid out by the day and hour of the minute bucket.

Below an hour is a folder for every writing: a job, or a batch of a stream. A batch that is
repeated replaces its own folders and so leaves each of its rows once, however far it came
before; other writers, and days removed meanwhile, are not touched.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from clickmeter.schemas import CLICK_EVENT, RAW_CLICKS
from clickmeter.settings import EVENT_FIELDS, RETENTION_DAYS
from clickmeter.sources.batches import replace_batch
from clickmeter.sources.files import delete, file_system, folder_names

PARTITIONS = ["dt", "hr"]
WRITING = "batch"
_STORED = StructType([*RAW_CLICKS.fields, StructField(WRITING, StringType())])


def with_partitions(events: DataFrame) -> DataFrame:
    """Add `dt` and `hr` from the minute bucket, so that periods prune exactly."""
    return events.withColumns(
        {
            "dt": F.substring("minute_bucket", 1, 10),
            "hr": F.substring("minute_bucket", 12, 2),
        }
    )


def write_archive(events: DataFrame, path: str, batch: str | None = None) -> None:
    """Add events, a file at least for every hour they have."""
    replace_batch(with_partitions(events.select(*EVENT_FIELDS)), path, PARTITIONS, batch)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    stored = spark.read.schema(_STORED).parquet(path)
    return stored.drop(WRITING)


def create_archive_table(spark: SparkSession, table: str, path: str) -> None:
    """Declare the archive as a partitioned table and take in the hours it holds.

    To be repeated after writes: it adds the hours and writings that came since.
    """
    columns = ", ".join(f"{field.name} STRING" for field in RAW_CLICKS)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}, {WRITING} STRING) "
        f"USING parquet PARTITIONED BY (dt, hr, {WRITING}) LOCATION '{path}'"
    )
    spark.catalog.recoverPartitions(table)


def partitions_of(start: str, end: str) -> Column:
    """Partition test for the hours that overlap `[start, end)`, both ISO text."""
    hour_start = F.concat(F.col("dt"), F.lit("T"), F.col("hr"), F.lit(":00:00Z"))
    return (
        F.col("dt").between(start[:10], end[:10])
        & (hour_start >= f"{start[:13]}:00:00Z")
        & (hour_start < end)
    )


def bucket_between(start: str, end: str) -> Column:
    """`[start, end)` on bucket text: ISO text of one width sorts like time."""
    return (F.col("minute_bucket") >= start) & (F.col("minute_bucket") < end)


def read_period(spark: SparkSession, path: str, start: str, end: str) -> DataFrame:
    """Events of a closed period; only its hours are opened."""
    return read_archive(spark, path).where(partitions_of(start, end) & bucket_between(start, end))


def split_records(records: DataFrame, as_of: Column) -> tuple[DataFrame, DataFrame]:
    """JSON records to events that can be archived and rows for the error folder.

    `records` has a text column `value`. Text that is no JSON object and events that miss
    a required field are kept whole under their kind of error.
    """
    from clickmeter.functions.events import violations

    schema = "{}, broken STRING".format(
        ", ".join(f"{field.name} STRING" for field in CLICK_EVENT)
    )
    parsed = records.select(
        "value",
        F.from_json("value", schema, {"columnNameOfCorruptRecord": "broken"}).alias("event"),
    ).select("value", "event.*")
    judged = parsed.withColumn("findings", violations()).withColumn(
        "error_type",
        F.when(F.col("value").isNull() | F.col("broken").isNotNull(), "malformed_json").when(
            F.size("findings") > 0, "invalid_event"
        ),
    )
    good = judged.where(F.col("error_type").isNull()).select(*EVENT_FIELDS)
    bad = judged.where(F.col("error_type").isNotNull()).select(
        "value", "findings", "error_type", F.date_format(as_of, "yyyy-MM-dd").alias("dt")
    )
    return good, bad


def write_errors(errors: DataFrame, path: str, batch: str | None = None) -> None:
    replace_batch(errors, path, ["error_type", "dt"], batch)


def read_errors(spark: SparkSession, path: str) -> DataFrame:
    schema = f"value string, findings array<string>, error_type string, dt string, {WRITING} string"
    return spark.read.schema(schema).parquet(path).drop(WRITING)


def retained(raw: DataFrame, as_of: Column, days: int = RETENTION_DAYS) -> DataFrame:
    """Rows of the last `days` days, as a partition filter."""
    return raw.where(F.col("dt") >= F.date_format(F.date_sub(as_of, days), "yyyy-MM-dd"))


def drop_expired(
    spark: SparkSession, path: str, as_of: date, days: int = RETENTION_DAYS
) -> list[str]:
    """Remove the day partitions that are past retention; returns the removed days."""
    oldest = (as_of - timedelta(days=days)).isoformat()
    fs, _ = file_system(spark, path)
    days_held = [
        name.removeprefix("dt=") for name in folder_names(fs, spark, path) if name.startswith("dt=")
    ]
    expired = sorted(day for day in days_held if day < oldest)
    for day in expired:
        delete(fs, spark, f"{path}/dt={day}")
    return expired
