"""Reconciliation: exact counts from the archive in place of what the stream wrote."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmeter import periods
from clickmeter.functions.timebucket import instant
from clickmeter.operators.counting import distinct_minute_counts, minute_counts
from clickmeter.operators.dedup import one_per_impression
from clickmeter.operators.merging import KEY
from clickmeter.settings import STEP_SECONDS
from clickmeter.sources.aggregates import AggregateTable
from clickmeter.sources.archive import PARTITIONS, bucket_between, partitions_of, read_archive, read_period
from clickmeter.sources.batches import replace_batch


def recompute(raw: DataFrame, keep: str = "first") -> DataFrame:
    """Exact clicks per campaign and minute, each impression counted once.

    Only four columns are read: of equally early copies the one with the smaller minute
    and campaign counts, which settles the result without the wide event id.
    """
    narrow = raw.select("impression_id", "ingest_ts", "minute_bucket", "campaign_id")
    return minute_counts(one_per_impression(narrow, keep))


def recompute_period(
    spark: SparkSession,
    archive: str,
    start: datetime,
    end: datetime,
    lookback: timedelta | None = None,
) -> DataFrame:
    """Recompute of a closed period of the archive.

    Impressions are told apart within the period. With `lookback`, repeats of a click up
    to that long before the period are left out as well.
    """
    first, last = periods.text(start), periods.text(end)
    if lookback is None:
        return recompute(read_period(spark, archive, first, last))
    earliest = periods.text(start - lookback)
    counts = recompute(read_period(spark, archive, earliest, last))
    return counts.where(bucket_between(first, last))


def typed(counts: DataFrame) -> DataFrame:
    """Counts with the bucket text as a timestamp, the way the table keeps it."""
    return counts.withColumn("minute_bucket", instant(F.col("minute_bucket")))


def reconcile(
    spark: SparkSession,
    archive: str,
    table: str,
    start: datetime,
    end: datetime,
    as_of: Column | None = None,
    lookback: timedelta | None = None,
) -> None:
    """Recompute `[start, end)` and publish it."""
    counts = typed(recompute_period(spark, archive, start, end, lookback))
    AggregateTable(spark, table).swap(
        counts, start, end, F.current_timestamp() if as_of is None else as_of
    )


def last_closed(as_of: Column, cadence: str = "hour") -> tuple[Column, Column]:
    """Bounds of the last closed hour or day, for a column of firing times."""
    end = F.date_trunc(cadence, as_of)
    return end - F.expr(f"INTERVAL {STEP_SECONDS[cadence]} SECONDS"), end


def hour_digests(counts: DataFrame, count: str = "click_count") -> DataFrame:
    """`hour` and an order-free digest of its rows: two hashes of key and count, combined by xor, and their number."""
    fields = [F.col("campaign_id"), F.unix_timestamp("minute_bucket"), F.col(count)]
    return counts.groupBy(F.date_trunc("hour", "minute_bucket").alias("hour")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.bit_xor(F.xxhash64(*fields)).alias("digest"),
        F.bit_xor(F.xxhash64(*reversed(fields), F.lit(1))).alias("other"),
    )


def differing_hours(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """Hours whose digests differ, or that one side lacks."""
    same = [F.col(c).eqNullSafe(F.col(f"{c}_")) for c in ("rows", "digest", "other")]
    renamed = theirs.withColumnsRenamed({c: f"{c}_" for c in ("rows", "digest", "other")})
    return ours.join(renamed, "hour", "full_outer").where(~(same[0] & same[1] & same[2])).select("hour")


def drift(stored: DataFrame, raw: DataFrame) -> DataFrame:
    """Stored counts that differ from the distinct impressions of the archive.

    Hours are compared by digests, and only those that differ by rows. Rows on one side only
    are reported too, with nulls for the other side.
    """
    exact = typed(distinct_minute_counts(raw))
    held = stored.select(*KEY, "click_count", "source")
    hours = differing_hours(hour_digests(held), hour_digests(exact, "exact"))
    of_hour = F.date_trunc("hour", "minute_bucket")

    def open_(rows: DataFrame) -> DataFrame:
        return rows.withColumn("hour", of_hour).join(hours, "hour", "left_semi").drop("hour")

    return open_(held).join(open_(exact), KEY, "full_outer").where(~F.col("click_count").eqNullSafe(F.col("exact")))


def write_impression_index(raw: DataFrame, path: str, batch: str | None = None) -> None:
    """Which impressions an hour has, as 64-bit hashes: what a lookback must read of every hour."""
    hashes = raw.where("impression_id is not null").select(F.xxhash64("impression_id").alias("impression"), "dt", "hr").distinct()
    replace_batch(hashes, path, PARTITIONS, batch, sorted_by=["impression"])


def recompute_by_index(spark: SparkSession, archive: str, index: str, start: datetime, end: datetime, lookback: timedelta) -> DataFrame:
    """`recompute_period` with lookback, reading earlier hours only where the index knows an impression of the period.

    A hash that meets another impression's costs a read and changes nothing, as rows are told
    apart by the impression itself.
    """
    first, last, earliest = periods.text(start), periods.text(end), periods.text(start - lookback)
    narrow = ("impression_id", "ingest_ts", "minute_bucket", "campaign_id")
    period = read_period(spark, archive, first, last).select(*narrow)
    known = spark.read.schema("impression long, dt string, hr string, batch string").parquet(index).where(partitions_of(earliest, last))
    wanted = period.select(F.xxhash64("impression_id").alias("impression"))
    hits = known.join(wanted, "impression", "left_semi").select("impression", "dt", "hr").distinct()
    earlier = read_archive(spark, archive).where(partitions_of(earliest, last) & bucket_between(earliest, first))
    met = earlier.withColumn("impression", F.xxhash64("impression_id")).join(hits, ["dt", "hr", "impression"], "left_semi").select(*narrow)
    return recompute(period.unionByName(met)).where(bucket_between(first, last))
