"""Audits: loss, outcomes, hot ads, delays, row sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmeter.functions.timebucket import instant, iso
from clickmeter.operators.selection import value_of_rank


def unmatched_impressions(sent: DataFrame, captured: DataFrame) -> DataFrame:
    """Impressions on one side only: `lost` if sent alone, `unexpected` if captured alone.

    One aggregate over both sides stands for two anti joins, and repeats of an
    impression shrink before the shuffle.
    """
    sides = sent.select(
        "impression_id", F.lit(True).alias("sent"), F.lit(False).alias("captured")
    ).unionByName(
        captured.select(
            "impression_id", F.lit(False).alias("sent"), F.lit(True).alias("captured")
        )
    )
    return (
        sides.groupBy("impression_id")
        .agg(F.bool_or("sent").alias("sent"), F.bool_or("captured").alias("captured"))
        .where(F.col("sent") != F.col("captured"))
        .select(
            "impression_id",
            F.when(F.col("sent"), "lost").otherwise("unexpected").alias("finding"),
        )
    )


def loss_audit(outcomes: DataFrame, captured: DataFrame) -> DataFrame:
    """One row: distinct impressions accepted and captured, lost and unexpected ones."""
    accepted = outcomes.where("status = 302").select(
        "impression_id", F.lit(True).alias("accepted"), F.lit(False).alias("captured")
    )
    archived = captured.select(
        "impression_id", F.lit(False).alias("accepted"), F.lit(True).alias("captured")
    )
    sides = (
        accepted.unionByName(archived)
        .groupBy("impression_id")
        .agg(F.bool_or("accepted").alias("accepted"), F.bool_or("captured").alias("captured"))
    )
    return sides.agg(
        F.count_if("accepted").alias("accepted"),
        F.count_if("captured").alias("captured"),
        F.count_if(F.col("accepted") & ~F.col("captured")).alias("lost"),
        F.count_if(~F.col("accepted") & F.col("captured")).alias("unexpected"),
    )


def outcome_tally(outcomes: DataFrame) -> DataFrame:
    """Requests by answer."""
    return outcomes.groupBy("status", "reason", "emitted").agg(F.count(F.lit(1)).alias("requests"))


def hot_ads(clicks: DataFrame, threshold: float) -> DataFrame:
    """Ads with at least `threshold` of all clicks, with their share."""
    counts = clicks.groupBy("ad_id").agg(F.count(F.lit(1)).alias("clicks"))
    total = counts.agg(F.sum("clicks")).scalar()
    return counts.withColumn("share", F.col("clicks") / total).where(F.col("share") >= threshold)


def rank_percentile(
    samples: DataFrame,
    value: str,
    fraction: float = 0.95,
    by: list[str] | None = None,
    weight: str | None = None,
) -> DataFrame:
    """The sample of rank `floor(n * fraction)` in ascending order, and the largest one.

    Equal samples are counted first (`weight` tells how many a row stands for). Of the values,
    only a few around the rank are put in order; see `operators.selection`. Null where there
    are too few samples for that rank.
    """
    by = by or []
    steps = (
        samples.where(F.col(value).isNotNull())
        .groupBy(*by, value)
        .agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("n"))
    )
    found = value_of_rank(steps, value, by, lambda n: F.floor(n * F.lit(fraction)))
    if by:
        return found
    # One row even where there is no sample.
    return found.agg(*(F.max(c).alias(c) for c in ("percentile", "largest")), F.coalesce(F.max("samples"), F.lit(0)).alias("samples")).select(
        "samples", "percentile", "largest"
    )


def approximate_percentile(
    samples: DataFrame, value: str, fraction: float = 0.95, by: list[str] | None = None
) -> DataFrame:
    """A quick estimate for continuous samples, where nearly every value is distinct."""
    return samples.groupBy(*(by or [])).agg(
        F.count(value).alias("samples"),
        F.percentile_approx(value, fraction).alias("percentile"),
        F.max(value).alias("largest"),
    )


def delay_seconds(earlier: Column, later: Column) -> Column:
    return F.unix_timestamp(later) - F.unix_timestamp(earlier)


def freshness(raw: DataFrame, aggregates: DataFrame) -> DataFrame:
    """Seconds from the capture of clicks until their row was written, with how many clicks.

    Clicks of one minute captured in the same second are counted first, so a hot minute
    brings few rows to the join.
    """
    captured = raw.groupBy("campaign_id", "minute_bucket", "ingest_ts").agg(
        F.count(F.lit(1)).alias("clicks")
    )
    written = aggregates.select(
        "campaign_id", iso(F.col("minute_bucket")).alias("minute_bucket"), "updated_at"
    )
    return captured.join(written, ["campaign_id", "minute_bucket"]).select(
        "campaign_id",
        delay_seconds(instant(F.col("ingest_ts")), F.col("updated_at")).alias("delay"),
        "clicks",
    )


def source_mix(aggregates: DataFrame) -> DataFrame:
    """Rows and clicks per day and source: how much of a day is still approximate."""
    return aggregates.groupBy(
        F.date_format("minute_bucket", "yyyy-MM-dd").alias("day"), "source"
    ).agg(F.count(F.lit(1)).alias("rows"), F.sum("click_count").alias("clicks"))
