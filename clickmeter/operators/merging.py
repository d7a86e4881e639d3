"""Upsert and period swap on the aggregate table, as DataFrame functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmeter.settings import SOURCE_BATCH

KEY = ["campaign_id", "minute_bucket"]
_VALUES = ["click_count", "source", "updated_at"]


def upsert(stored: DataFrame, new: DataFrame, protect_batch: bool = True) -> DataFrame:
    """Replace the stored row of a key by the new one, and add keys not stored yet.

    Counts are replaced, never added, so a replay changes nothing. A reconciled row is
    exact and stays, unless `protect_batch` is off. Both sides hold a key once.
    """
    old = stored.select(*KEY, F.struct(*_VALUES).alias("old"))
    fresh = new.select(*KEY, F.struct(*_VALUES).alias("new"))
    chosen = F.coalesce("new", "old")
    if protect_batch:
        chosen = F.when(F.col("old.source") == SOURCE_BATCH, F.col("old")).otherwise(chosen)
    return (
        old.join(fresh, KEY, "full_outer")
        .select(*KEY, chosen.alias("row"))
        .select(*KEY, "row.*")
    )


def in_period(bucket: Column, start, end) -> Column:
    """`[start, end)` test; nulls are outside."""
    return F.coalesce((bucket >= F.lit(start)) & (bucket < F.lit(end)), F.lit(False))


def swap_period(stored: DataFrame, counts: DataFrame, start, end, as_of: Column) -> DataFrame:
    """Drop every stored row of `[start, end)` and put the recomputed ones in their place.

    Stored rows the recompute did not find vanish with the rest of the period. Counts outside
    it are left out: their minutes were not taken away.
    """
    columns = [*KEY, *_VALUES]
    kept = stored.where(~in_period(F.col("minute_bucket"), start, end)).select(*columns)
    return kept.unionByName(
        counts.where(in_period(F.col("minute_bucket"), start, end)).select(
            *KEY,
            "click_count",
            F.lit(SOURCE_BATCH).alias("source"),
            as_of.alias("updated_at"),
        )
    )


def repeated_keys(aggregates: DataFrame) -> DataFrame:
    """Keys held more than once; empty for a sound table."""
    return aggregates.groupBy(*KEY).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
