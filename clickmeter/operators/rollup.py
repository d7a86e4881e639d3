"""Rolling minute rows up to hours and days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmeter.settings import GRANULARITIES, SOURCE_BATCH, SOURCE_STREAM


def exact_source(source: Column) -> Column:
    """`batch` only if every row of the bucket is."""
    return F.when(F.bool_and(source == SOURCE_BATCH), SOURCE_BATCH).otherwise(SOURCE_STREAM)


SOURCE_RULES = {"exact": exact_source, "min": F.min}

# The same rules on `is it a batch row`: `batch` is the smaller of the two texts.
# Flags keep the aggregates in hash tables, where text would make Spark sort.
BATCH_RULES = {"exact": F.bool_and, "min": F.bool_or}


def rollup(rows: DataFrame, granularity: str, source_rule: str = "exact") -> DataFrame:
    """Sum `click_count` by campaign and bucket.

    `rows` holds minute rows, or the result of an earlier roll-up under its own column
    names, so coarser buckets can be had from finer ones. `source_rule` is `exact`, or
    `min` for the smallest source text of the bucket.
    """
    if granularity not in GRANULARITIES:
        raise ValueError(f"unsupported granularity: {granularity}")
    start = "bucket_start" if "bucket_start" in rows.columns else "minute_bucket"
    return rows.groupBy(
        "campaign_id", F.date_trunc(granularity, start).alias("bucket_start")
    ).agg(
        F.sum("click_count").alias("click_count"),
        SOURCE_RULES[source_rule](F.col("source")).alias("source"),
    )


def unit_counts(rows: DataFrame, source_rule: str = "exact") -> DataFrame:
    """Counts for every unit at once: `campaign_id, unit, unit_start` and the sums.

    Each row adds to its minute, its hour and its day; the partial aggregate folds the
    three before the shuffle.
    """
    starts = F.array(
        *[
            F.struct(
                F.lit(unit).alias("unit"), F.date_trunc(unit, "minute_bucket").alias("unit_start")
            )
            for unit in GRANULARITIES
        ]
    )
    return (
        rows.select("campaign_id", "click_count", "source", F.inline(starts))
        .groupBy("campaign_id", "unit", "unit_start")
        .agg(
            F.sum("click_count").alias("unit_count"),
            BATCH_RULES[source_rule](F.col("source") == SOURCE_BATCH).alias("unit_batch"),
        )
    )
