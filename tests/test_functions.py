"""Time buckets, text cleaning, event checks."""

import json

import pytest
from pyspark.sql import functions as F

from clickmeter.functions import events, text, timebucket
from clickmeter.schemas import CLICK_EVENT


def one(spark, column):
    return spark.range(1).select(column.alias("v")).collect()[0].v


@pytest.mark.parametrize(
    ("given", "bucket"),
    [
        ("2026-06-13T14:07:42Z", "2026-06-13T14:07:00Z"),
        ("2026-06-13T09:07:42-05:00", "2026-06-13T14:07:00Z"),
        ("2026-01-02 03:04:05", "2026-01-02T03:04:00Z"),
        ("2026-01-02T03:04:59.999Z", "2026-01-02T03:04:00Z"),
        ("nope", None),
    ],
)
def test_minute_bucket(spark, given, bucket):
    assert one(spark, timebucket.minute_bucket(timebucket.instant(F.lit(given)))) == bucket


@pytest.mark.parametrize(
    ("given", "valid"),
    [
        ("2026-06-13T14:07:00Z", True),
        ("2026-06-13T14:07:42Z", False),
        ("2026-06-13T14:07:00Z\n", False),
        ("9999-99-99T99:99:00Z", True),
        ("not-a-time", False),
        (None, False),
    ],
)
def test_bucket_shape(spark, given, valid):
    assert one(spark, timebucket.is_bucket(F.lit(given).cast("string"))) is valid


def test_missing_time_takes_the_default_but_unreadable_does_not(spark):
    now = F.lit("2026-06-13T14:07:43Z").cast("timestamp")
    missing = timebucket.instant_or(F.lit(None).cast("string"), now)
    assert one(spark, timebucket.iso(missing)) == "2026-06-13T14:07:43Z"
    assert one(spark, timebucket.instant_or(F.lit("soon"), now)) is None


@pytest.mark.parametrize(
    ("given", "clean"), [(" ad_1\t\n", "ad_1"), (" \t", None), ("", None), (None, None)]
)
def test_presence(spark, given, clean):
    assert one(spark, text.presence(F.lit(given).cast("string"))) == clean


@pytest.mark.parametrize(
    ("header", "principal"),
    [
        ("Bearer adv_1", "adv_1"),
        ("Bearer  adv_1 ", "adv_1"),
        ("Bearer ", None),
        ("bearer adv_1", None),
        ("Basic adv_1", None),
        (None, None),
    ],
)
def test_bearer_principal(spark, header, principal):
    assert one(spark, text.bearer_principal(F.lit(header).cast("string"))) == principal


def test_salted_keys_stay_in_range_and_are_stable(spark):
    keys = spark.range(100).select(
        text.salted_key(F.lit("ad_42"), F.col("id").cast("string"), 8).alias("key")
    )
    salts = {int(row.key.split(":")[1]) for row in keys.collect()}
    assert salts <= set(range(8)) and len(salts) > 1
    assert keys.collect() == keys.collect()
    assert one(spark, text.salted_key(F.lit("ad_1"), F.lit("x"), 0)) == "ad_1:0"


EVENT = {
    "event_id": "e",
    "impression_id": "imp_1",
    "ad_id": "ad_1",
    "campaign_id": "camp_1",
    "advertiser_id": "adv_1",
    "click_ts": "2026-06-13T14:07:42Z",
    "minute_bucket": "2026-06-13T14:07:00Z",
    "ingest_ts": "2026-06-13T14:07:43Z",
}


def findings(spark, **changes):
    row = spark.createDataFrame([EVENT | changes], CLICK_EVENT)
    return row.select(events.violations().alias("v")).collect()[0].v


def test_event_violations(spark):
    assert findings(spark) == []
    assert findings(spark, impression_id="") == ["impression_id is required"]
    assert findings(spark, campaign_id=None) == ["campaign_id is required"]
    assert findings(spark, minute_bucket=EVENT["click_ts"]) == ["minute_bucket is malformed"]


def test_event_json_leaves_out_absent_fields(spark):
    row = spark.createDataFrame([EVENT], CLICK_EVENT)
    text_of = row.select(events.event_json().alias("v")).collect()[0].v
    assert json.loads(text_of) == EVENT
    agent = row.withColumn("user_agent", F.lit("x")).select(events.event_json().alias("v"))
    assert json.loads(agent.collect()[0].v)["user_agent"] == "x"


def schema_findings(spark, value):
    return one(spark, events.schema_violations(F.lit(value)))


def test_closed_schema(spark):
    def found(**changes):
        whole = {k: v for k, v in (EVENT | changes).items() if v is not ...}
        return schema_findings(spark, json.dumps(whole))

    assert found() == []
    assert found(user_agent="x") == []
    assert found(referrer="x") == ["unknown field referrer"]
    assert found(ad_id=...) == ["ad_id is missing"]
    assert found(ad_id="") == ["ad_id is empty"]
    assert found(event_id="") == []
    assert found(ad_id=7) == ["ad_id is not text"]
    assert found(minute_bucket="2026") == ["minute_bucket is malformed"]
    assert schema_findings(spark, "{broken") == ["not a JSON object"]
    assert schema_findings(spark, "[1]") == ["not a JSON object"]


def test_event_id_is_the_same_on_a_rerun_and_differs_between_clicks(spark):
    first = events.event_id(F.lit("r1"), F.lit("imp_1"))
    assert one(spark, first) == one(spark, first)
    assert one(spark, first) != one(spark, events.event_id(F.lit("r2"), F.lit("imp_1")))
