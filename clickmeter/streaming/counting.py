"""The minute counter: click stream to `stream` rows of the aggregate table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickmeter.settings import CHECKPOINT_INTERVAL, WATERMARK_DELAY, WINDOW_LENGTH
from clickmeter.sources.aggregates import AggregateTable
from clickmeter.sources.batches import batch_name
from clickmeter.sources.clickstream import decode_clicks


def windowed_counts(
    records: DataFrame, delay: str = WATERMARK_DELAY, distinct_impressions: bool = False
) -> DataFrame:
    """Clicks per campaign and event-time minute, emitted once when the minute is over.

    Clicks later than `delay` are left to reconciliation. The counter trusts capture to
    have removed repeats; `distinct_impressions` makes it drop those that arrive within
    the watermark delay itself.
    """
    clicks = decode_clicks(records).withWatermark("click_time", delay)
    if distinct_impressions:
        clicks = clicks.dropDuplicatesWithinWatermark(["impression_id"])
    return (
        clicks.groupBy("campaign_id", F.window("click_time", WINDOW_LENGTH).alias("minute"))
        .agg(F.count(F.lit(1)).alias("click_count"))
        .select("campaign_id", F.col("minute.start").alias("minute_bucket"), "click_count")
    )


def start_counting(
    records: DataFrame,
    table: AggregateTable,
    checkpoint: str,
    trigger: dict | None = None,
    as_of: Column | None = None,
    protect_batch: bool = True,
    **options,
) -> StreamingQuery:
    """Write closed minutes to the table. Counts are set, so a replayed batch adds nothing."""

    def publish(counts: DataFrame, number: int) -> None:
        now = F.current_timestamp() if as_of is None else as_of
        table.upsert(counts, now, protect_batch, batch_name(counts.sparkSession, number))

    return (
        windowed_counts(records, **options)
        .writeStream.outputMode("append")
        .foreachBatch(publish)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": CHECKPOINT_INTERVAL}))
        .start()
    )
