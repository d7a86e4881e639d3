"""The click tables, derived from the given order and event tables.

Events of type click become click requests and raw clicks, customers become ads and
metrics requests. Every table grows with the given ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmeter.functions.timebucket import iso, minute_bucket

CREATED_AT = "2024-01-01T00:00:00Z"


def _text(prefix: str, *parts: str) -> Column:
    return F.concat(F.lit(prefix), F.concat_ws("_", *[F.col(p).cast("string") for p in parts]))


def ads(spark: SparkSession, folder: str) -> DataFrame:
    """One ad per customer; its nation is the campaign, its region the advertiser."""
    customer = spark.read.parquet(f"{folder}/customer.parquet")
    nation = spark.read.parquet(f"{folder}/nation.parquet")
    return customer.join(
        nation, customer["c_nationkey"] == nation["n_nationkey"]
    ).select(
        _text("ad_", "c_custkey").alias("ad_id"),
        _text("camp_", "c_nationkey").alias("campaign_id"),
        _text("adv_", "n_regionkey").alias("advertiser_id"),
        _text("https://example.com/", "c_custkey").alias("destination_url"),
        (F.col("c_acctbal") >= 0).alias("active"),
        F.lit(CREATED_AT).alias("created_at"),
    )


def events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The event table as a stream of its files; the pattern lets it be a single file."""
    schema = events(spark, folder).schema
    return spark.readStream.schema(schema).parquet(f"{folder}/events[.]parquet")


def _timed(rows: DataFrame) -> DataFrame:
    delay = F.get_json_object("props", "$.k").cast("int")
    return rows.select(
        F.col("event_id").cast("string").alias("event_id"),
        "user_id",
        "event_type",
        F.date_trunc("second", F.col("ts").cast("timestamp")).alias("clicked_at"),
        delay.alias("k"),
    )


def raw_clicks(spark: SparkSession, folder: str, rows: DataFrame | None = None) -> DataFrame:
    """Clicks in the shape of the archive, of the event table or the given event `rows`."""
    clicks = (
        _timed((events(spark, folder) if rows is None else rows).where("event_type = 'click'"))
        .select(
            "event_id",
            _text("imp_", "user_id", "k").alias("impression_id"),
            _text("ad_", "user_id").alias("ad_id"),
            iso(F.col("clicked_at")).alias("click_ts"),
            minute_bucket(F.col("clicked_at")).alias("minute_bucket"),
            F.lit(None).cast("string").alias("user_agent"),
            iso(F.col("clicked_at") + F.make_dt_interval(secs=F.col("k"))).alias("ingest_ts"),
        )
    )
    owners = ads(spark, folder).select("ad_id", "campaign_id", "advertiser_id")
    return clicks.join(owners, "ad_id").withColumns(
        {
            "dt": F.substring("minute_bucket", 1, 10),
            "hr": F.substring("minute_bucket", 12, 2),
        }
    )


def click_requests(spark: SparkSession, folder: str, rows: DataFrame | None = None) -> DataFrame:
    """Every event as a request to the click endpoint.

    Clicks are sound. Errors name an ad nobody knows, views miss the impression or have it
    blank, signups carry no click time and pad their ids, purchases have one that cannot be read.
    """
    kind = F.col("event_type")
    ad = F.when(kind == "error", _text("ad_x", "user_id")).otherwise(_text("ad_", "user_id"))
    impression = _text("imp_", "user_id", "k")
    return _timed(events(spark, folder) if rows is None else rows).select(
        F.col("event_id").alias("request_id"),
        F.when(kind == "signup", F.concat(F.lit(" "), ad, F.lit("\t"))).otherwise(ad).alias("ad_id"),
        F.when((kind == "view") & (F.col("k") % 2 == 0), F.lit(None))
        .when(kind == "view", F.lit("  "))
        .when(kind == "signup", F.concat(F.lit("s"), impression))
        .otherwise(impression)
        .alias("impression_id"),
        F.when(kind == "purchase", F.lit("not-a-time"))
        .when(kind == "signup", F.lit(None))
        .otherwise(iso(F.col("clicked_at")))
        .alias("click_ts"),
        F.lit(None).cast("string").alias("user_agent"),
        iso(F.col("clicked_at") + F.make_dt_interval(secs=F.col("k"))).alias("received_at"),
    )


def metrics_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Every customer asks for its campaign; some are refused, some ask for a whole month."""
    customer = spark.read.parquet(f"{folder}/customer.parquet")
    nation = spark.read.parquet(f"{folder}/nation.parquet")
    key = F.col("c_custkey")
    region = F.col("n_regionkey") + F.when(key % 19 == 0, 1).otherwise(0)
    segment = F.col("c_mktsegment")
    length = (
        F.when(key % 17 == 0, F.lit(30 * 86400))
        .when(segment == "MACHINERY", F.lit(9 * 86400 + 3600 * 5))
        .when(segment == "HOUSEHOLD", F.lit(86400 + 1234))
        .otherwise(F.lit(7200 + 30))
    )
    start = F.timestamp_seconds(F.lit(1704067200) + key * 7919 % (29 * 86400))
    return (
        customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"])
        .withColumn("start", start)
        .select(
            _text("req_", "c_custkey").alias("request_id"),
            F.when(key % 11 == 0, F.lit(None))
            .when(key % 11 == 1, F.lit("Basic adv_1"))
            .otherwise(F.concat(F.lit("Bearer adv_"), region.cast("string")))
            .alias("authorization"),
            F.when(key % 13 == 0, F.lit(" "))
            .otherwise(_text("camp_", "c_nationkey"))
            .alias("campaign_id"),
            iso(F.col("start")).alias("from"),
            F.when(key % 23 == 0, F.lit("soon"))
            .otherwise(iso(F.col("start") + F.make_dt_interval(secs=length)))
            .alias("to"),
            F.when(segment == "MACHINERY", F.lit("day"))
            .when(segment == "HOUSEHOLD", F.lit("hour"))
            .when(segment == "BUILDING", F.lit(None))
            .when((segment == "AUTOMOBILE") & (key % 2 == 0), F.lit("weekly"))
            .otherwise(F.lit("minute"))
            .alias("granularity"),
        )
    )


def shipment_clicks(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as clicks, the largest of the given tables: suppliers are campaigns."""
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    at = F.col("l_shipdate").cast("timestamp") + F.make_dt_interval(
        mins=(F.col("l_partkey") % 1440).cast("int")
    )
    return lines.select(
        _text("imp_", "l_orderkey", "l_linenumber").alias("impression_id"),
        _text("camp_", "l_suppkey").alias("campaign_id"),
        minute_bucket(at).alias("minute_bucket"),
        iso(at + F.make_dt_interval(secs=(F.col("l_partkey") % 100).cast("int"))).alias(
            "ingest_ts"
        ),
    )
