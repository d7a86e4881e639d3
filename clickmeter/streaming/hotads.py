"""Hot ads while the clicks come in.

A window keeps a summary of its most frequent ads of bounded size, which combines on the map
side, and the number of its clicks. An ad of at least the threshold is sure to be among the
candidates as long as the summary tracks some times the inverse of the threshold; the archive
then counts the candidates of a closed window exactly.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickmeter.functions.timebucket import instant
from clickmeter.settings import CHECKPOINT_INTERVAL, WATERMARK_DELAY
from clickmeter.sources.batches import batch_name, replace_batch
from clickmeter.sources.clickstream import decode_clicks

#: A summary of m items overstates or misses by at most 3.5 / m of a window's clicks.
ERROR_ITEMS = 3.5
SPARE = 4
CANDIDATES = "window_start timestamp, clicks long, ads array<struct<item:string,count:long>>, batch string"


def tracked_items(threshold: float) -> int:
    return ceil(SPARE * ERROR_ITEMS / threshold)


def window_candidates(records: DataFrame, threshold: float, window: str, delay: str = WATERMARK_DELAY) -> DataFrame:
    """window_start, clicks and the ads that may be hot of every window that is over."""
    items = tracked_items(threshold)
    clicks = decode_clicks(records).where("ad_id is not null").withWatermark("click_time", delay)
    return (
        clicks.groupBy(F.window("click_time", window).alias("window"))
        .agg(F.count(F.lit(1)).alias("clicks"), F.expr(f"approx_top_k_accumulate(ad_id, {items})").alias("state"))
        .select(F.col("window.start").alias("window_start"), "clicks", F.expr(f"approx_top_k_estimate(state, {items})").alias("ads"))
    )


def start_watching(records: DataFrame, path: str, checkpoint: str, threshold: float, window: str = "1 hour", trigger: dict | None = None) -> StreamingQuery:
    """Write the candidates of closed windows; a repeated batch takes the place of itself."""
    return (
        window_candidates(records, threshold, window)
        .writeStream.outputMode("append")
        .foreachBatch(lambda rows, n: replace_batch(rows, path, [], batch_name(rows.sparkSession, n)))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": CHECKPOINT_INTERVAL}))
        .start()
    )


def hot_ads_of_windows(spark: SparkSession, candidates: str, raw: DataFrame, threshold: float, window: str = "1 hour") -> DataFrame:
    """window_start, ad_id, clicks, share of the hot ads of the windows that are over, exact.

    Only clicks on candidates of their window are counted.
    """
    rows = spark.read.schema(CANDIDATES).parquet(candidates)
    error = ERROR_ITEMS / tracked_items(threshold)
    likely = rows.select("window_start", F.col("clicks").alias("total"), F.inline("ads")).where(F.col("count") >= (threshold - error) * F.col("total"))
    start = F.window(instant(F.col("click_ts")), window)["start"]
    clicks = raw.select(start.alias("window_start"), "ad_id")
    return (
        clicks.join(likely.select("window_start", F.col("item").alias("ad_id"), "total"), ["window_start", "ad_id"])
        .groupBy("window_start", "ad_id", "total")
        .agg(F.count(F.lit(1)).alias("clicks"))
        .withColumn("share", F.col("clicks") / F.col("total"))
        .where(F.col("share") >= threshold)
        .drop("total")
    )
