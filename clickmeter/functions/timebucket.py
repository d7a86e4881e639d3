"""UTC time buckets as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickmeter.settings import BUCKET_PATTERN, GRANULARITIES, ISO_SECOND, STEP_SECONDS


def instant(text: Column) -> Column:
    """Timestamp text to a timestamp, honouring offsets; null when unreadable."""
    return F.try_to_timestamp(text)


def instant_or(text: Column, default: Column) -> Column:
    """`default` where no time was given. Unreadable text stays null so it can be rejected."""
    return F.when(text.isNull(), default).otherwise(instant(text))


def iso(ts: Column) -> Column:
    """`yyyy-MM-ddTHH:mm:ssZ` text of a timestamp."""
    return F.date_format(ts, ISO_SECOND)


def minute_bucket(ts: Column) -> Column:
    """ISO text of the UTC minute holding `ts`."""
    return iso(F.date_trunc("minute", ts))


def is_bucket(text: Column) -> Column:
    """Shape test of a bucket key; null counts as malformed."""
    return F.coalesce(text.rlike(BUCKET_PATTERN), F.lit(False))


def floor_to(granularity: Column, ts: Column) -> Column:
    """Calendar floor whose unit is itself a column."""
    floored = F.when(granularity == GRANULARITIES[0], F.date_trunc(GRANULARITIES[0], ts))
    for unit in GRANULARITIES[1:]:
        floored = floored.when(granularity == unit, F.date_trunc(unit, ts))
    return floored


def step_seconds(granularity: Column) -> Column:
    """Bucket length in seconds, per row."""
    seconds = F.when(granularity == GRANULARITIES[0], F.lit(STEP_SECONDS[GRANULARITIES[0]]))
    for unit in GRANULARITIES[1:]:
        seconds = seconds.when(granularity == unit, F.lit(STEP_SECONDS[unit]))
    return seconds


def step_interval(granularity: Column) -> Column:
    zero = F.lit(0)
    return F.make_dt_interval(
        zero, zero, zero, step_seconds(granularity).cast("decimal(18,6)")
    )


def ceil_to(unit: str, ts: Column) -> Column:
    """The first start of `unit` at or after `ts`."""
    floored = F.date_trunc(unit, ts)
    step = F.expr(f"INTERVAL {STEP_SECONDS[unit]} SECONDS")
    return F.when(floored == ts, ts).otherwise(floored + step)
