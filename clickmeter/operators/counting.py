"""Counts per campaign and minute."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmeter.functions.text import salt_of
from clickmeter.settings import DEFAULT_SALT


def minute_counts(clicks: DataFrame) -> DataFrame:
    """Clicks per campaign and minute. Hot campaigns shrink in the partial aggregate."""
    return clicks.groupBy("campaign_id", "minute_bucket").agg(
        F.count(F.lit(1)).alias("click_count")
    )


def salted_minute_counts(
    clicks: DataFrame, spread_by: str = "impression_id", factor: int = DEFAULT_SALT
) -> DataFrame:
    """The same counts in two steps, the first spread over `factor` salts per key."""
    return (
        clicks.groupBy(
            "campaign_id", "minute_bucket", salt_of(F.col(spread_by), factor).alias("salt")
        )
        .agg(F.count(F.lit(1)).alias("part"))
        .groupBy("campaign_id", "minute_bucket")
        .agg(F.sum("part").alias("click_count"))
    )


def distinct_minute_counts(clicks: DataFrame) -> DataFrame:
    """Distinct impressions per campaign and minute, the yardstick for stored counts."""
    return clicks.groupBy("campaign_id", "minute_bucket").agg(
        F.count_distinct("impression_id").alias("exact")
    )


def captured_per_day(clicks: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct impressions per archive day, exact unless asked otherwise."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return clicks.groupBy("dt").agg(count("impression_id").alias("captured"))
