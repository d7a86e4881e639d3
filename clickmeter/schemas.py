"""Schemas of the tables the pipelines exchange."""

from pyspark.sql import types as T

from clickmeter.settings import EVENT_FIELDS


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


CLICK_EVENT = T.StructType(_strings(*EVENT_FIELDS))

# The archive lays events out by the hour of their minute bucket.
RAW_CLICKS = T.StructType(_strings(*EVENT_FIELDS, "dt", "hr"))

# What the minute counter needs from a record; anything else is not parsed.
STREAM_CLICK = T.StructType(
    _strings("impression_id", "ad_id", "campaign_id", "advertiser_id", "click_ts")
)

AD = T.StructType(
    _strings("ad_id", "campaign_id", "advertiser_id", "destination_url")
    + [T.StructField("active", T.BooleanType())]
    + _strings("created_at")
)

CATALOG_DOCUMENT = T.StructType(
    [
        T.StructField("advertisers", T.ArrayType(T.StructType(_strings("advertiser_id", "name")))),
        T.StructField(
            "campaigns",
            T.ArrayType(T.StructType(_strings("campaign_id", "advertiser_id", "name"))),
        ),
        T.StructField("ads", T.ArrayType(T.StructType(AD.fields[:-1]))),
    ]
)

CLICK_AGGREGATES = T.StructType(
    [
        T.StructField("campaign_id", T.StringType()),
        T.StructField("minute_bucket", T.TimestampType()),
        T.StructField("click_count", T.LongType()),
        T.StructField("source", T.StringType()),
        T.StructField("updated_at", T.TimestampType()),
        T.StructField("dt", T.StringType()),
        T.StructField("hr", T.StringType()),
    ]
)

CLICK_REQUEST = T.StructType(
    _strings("request_id", "ad_id", "impression_id", "click_ts", "user_agent", "received_at")
)

METRICS_REQUEST = T.StructType(
    _strings("request_id", "authorization", "campaign_id", "from", "to", "granularity")
)
