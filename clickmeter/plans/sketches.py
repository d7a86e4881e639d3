"""Hourly summaries of the archive that merge to any period.

An hour keeps a distinct sketch of its impressions, a quantile sketch of its delays and the
number of its clicks. A day, or any period of whole hours, is then told from as many small rows
instead of its clicks, within a stated error; the exact figures stay beside them in `counting`
and `audits`.
"""

from __future__ import annotations

from math import sqrt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmeter.functions.timebucket import instant
from clickmeter.plans.audits import delay_seconds
from clickmeter.sources.batches import replace_batch

#: Registers of a distinct sketch, as a power of two, and the relative error that 19 of 20 estimates keep.
REGISTERS = 14
DISTINCT_ERROR = 2 * 1.04 / sqrt(1 << REGISTERS)
#: Size of a quantile sketch, and by how much of all samples a rank may be off.
QUANTILE_SIZE = 400
RANK_ERROR = 0.01
_SKETCHES = "dt string, hr string, clicks long, impressions binary, delays binary, batch string"


def hour_sketches(raw: DataFrame) -> DataFrame:
    """dt, hr, clicks, impressions and delays of the hours of raw clicks; combines on the map side."""
    delay = delay_seconds(instant(F.col("click_ts")), instant(F.col("ingest_ts")))
    return raw.groupBy("dt", "hr").agg(
        F.count(F.lit(1)).alias("clicks"),
        F.hll_sketch_agg("impression_id", F.lit(REGISTERS)).alias("impressions"),
        F.kll_sketch_agg_bigint(delay, F.lit(QUANTILE_SIZE)).alias("delays"),
    )


def write_sketches(sketches: DataFrame, path: str, batch: str | None = None) -> None:
    """Add the summaries of hours. A batch of the same name takes the place of itself."""
    replace_batch(sketches, path, ["dt"], batch)


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_SKETCHES).parquet(path).drop("batch")


def merged(sketches: DataFrame, by: list[str], fraction: float = 0.95) -> DataFrame:
    """Clicks, estimated distinct impressions and delay quantile of groups of hours.

    Several summaries of one hour, as of the writings of an archive, merge like those of hours.
    """
    return sketches.groupBy(*by).agg(
        F.sum("clicks").alias("clicks"),
        F.hll_sketch_estimate(F.hll_union_agg("impressions")).alias("captured"),
        F.kll_sketch_get_quantile_bigint(F.kll_merge_agg_bigint("delays"), F.lit(fraction)).alias("delay"),
    )
