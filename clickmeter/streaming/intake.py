"""Streaming capture, first stage: requests are judged, sorted by time and thinned out.

No state but one number: how far arrivals have come. Every batch becomes one folder that
appears whole, `<root>/taken/batch=<name>/kind=<kind>`:

* `refused`: requests with a reason; they are answered by it;
* `ahead`: arrivals later than the batch's clock allows. One request dated into the future
  must not move the watermark of the second stage, which would drop all that is sound;
* `behind`: arrivals so far behind the newest that their impressions are forgotten;
* `folded`: requests that another of the same impression and second of the batch stands for;
* `valid`: at most one request for each impression and second, for the second stage.

Nothing is dropped: `clickmeter.plans.settling` settles what was set aside.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickmeter.functions.text import presence
from clickmeter.plans.capture import judged_requests
from clickmeter.settings import AHEAD_TOLERANCE, ARRIVAL_DELAY, CHECKPOINT_INTERVAL, HOT_CLICKS
from clickmeter.sources.batches import batch_name, publish
from clickmeter.sources.files import exists, file_system, read_text, write_text

TAKEN = (
    "request_id string, ad_id string, impression_id string, campaign_id string, advertiser_id string, "
    "destination_url string, user_agent string, received_at timestamp, clicked_at timestamp, reason string"
)
_COLUMNS = [field.split()[0] for field in TAKEN.split(", ")]


def numbered(requests: DataFrame) -> DataFrame:
    """Requests with a `row` that tells apart even those delivered twice.

    The number depends on the order of the input, so it is to be used within one job.
    """
    return requests.withColumn("row", F.monotonically_increasing_id())


def looked_up(requests: DataFrame, ads: DataFrame, hot_clicks: int = HOT_CLICKS) -> DataFrame:
    """Numbered requests judged against the ads they name.

    Of the catalog only the ads of the batch take part. An ad with many clicks is given a row
    for each `hot_clicks` of them, and its clicks are dealt out over those rows.
    """
    ad = presence(F.col("ad_id"))
    counts = requests.groupBy(ad.alias("ad_id")).agg(F.count(F.lit(1)).alias("clicks")).where("ad_id is not null")
    pieces = F.ceil(F.col("clicks") / hot_clicks).cast("int")
    known = ads.join(counts, "ad_id").withColumn("piece", F.explode(F.sequence(F.lit(0), pieces - 1))).drop("clicks")
    # At most as many rows as the batch has times `hot_clicks`.
    hot = counts.where(F.col("clicks") > hot_clicks).select(F.col("ad_id").alias("hot_ad"), pieces.alias("pieces"))
    dealt = requests.join(F.broadcast(hot), ad == F.col("hot_ad"), "left").withColumn(
        "piece", F.pmod(F.xxhash64("row"), F.coalesce("pieces", F.lit(1))).cast("int")
    )
    return judged_requests(dealt, known, ["piece"], ["row"])


def sorted_out(judged: DataFrame, clock: Column, frontier: Column, delay: str = ARRIVAL_DELAY, tolerance: str = AHEAD_TOLERANCE) -> DataFrame:
    """Judged requests with their `kind`.

    Of an impression and second the request that opens it, by click time and id, stands for
    all: that is found by an aggregate that combines on the map side, and matched back by the
    number of the row, so the clicks of a hot impression meet nowhere.
    """
    received = F.col("received_at")
    kind = (
        F.when(F.col("reason").isNotNull(), "refused")
        .when(received > clock + F.expr(f"INTERVAL {tolerance}"), "ahead")
        .when(received < frontier - F.expr(f"INTERVAL {delay}"), "behind")
        .otherwise("valid")
    )
    timed = judged.withColumn("kind", kind)
    opening = (
        timed.where("kind = 'valid'")
        .groupBy("impression_id", F.unix_timestamp("received_at").alias("arrival"))
        .agg(F.min(F.struct("clicked_at", "request_id", "ad_id", "user_agent", "click_text", "row")).alias("first"))
        .select("first.row", F.lit(True).alias("opens"))
    )
    folded = F.when((F.col("kind") == "valid") & F.col("opens").isNull(), "folded").otherwise(F.col("kind"))
    return timed.join(opening, "row", "left").select(*_COLUMNS, folded.alias("kind"))


def start_taking(
    requests: DataFrame,
    catalog: Callable[[SparkSession], DataFrame],
    root: str,
    checkpoint: str,
    trigger: dict | None = None,
    clock: Column | None = None,
    delay: str = ARRIVAL_DELAY,
) -> StreamingQuery:
    """Take in requests; `catalog` is called for every batch, so it may change meanwhile.

    The clock is the time at which a batch is worked on, unless one is given.
    """
    folder = f"{root}/taken"
    now = F.current_timestamp() if clock is None else clock

    def take(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        fs, path = file_system(spark, folder)
        name, before = batch_name(spark, number), batch_name(spark, number - 1)
        if exists(fs, spark, f"{path}/batch={name}"):
            return  # repeated after its folder had appeared
        marker = f"{path}/batch={before}/_frontier"
        reached = int(read_text(fs, spark, marker)) if exists(fs, spark, marker) else None
        frontier = F.lit(None).cast("timestamp") if reached is None else F.timestamp_micros(F.lit(reached))

        def write(draft: str) -> None:
            rows = sorted_out(judged, now, frontier, delay)
            newest = Observation()
            timely = F.when(F.col("kind").isin("valid", "folded"), F.unix_micros("received_at"))
            watched = rows.observe(newest, F.max(timely).alias("micros"))
            watched.hint("rebalance", "kind").write.partitionBy("kind").parquet(draft)
            seen = [x for x in (newest.get["micros"], reached) if x is not None]
            if seen:
                write_text(fs, spark, f"{draft}/_frontier", str(max(seen)))

        judged = looked_up(numbered(batch), catalog(spark)).persist()  # it is looked at twice
        try:
            publish(spark, folder, name, write)
        finally:
            judged.unpersist()

    return (
        requests.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": CHECKPOINT_INTERVAL}))
        .start()
    )
