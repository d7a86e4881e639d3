"""Capture: click requests to outcomes and click events."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmeter.functions.events import event_columns, event_id
from clickmeter.functions.text import presence
from clickmeter.functions.timebucket import instant, instant_or
from clickmeter.operators.dedup import first_clicks
from clickmeter.settings import EVENT_FIELDS, IMPRESSION_TTL_SECONDS

_PAYLOAD = ["request_id", "ad_id", "campaign_id", "advertiser_id", "user_agent"]


def judged_requests(
    requests: DataFrame, ads: DataFrame, also: Sequence[str] = (), keep: Sequence[str] = ()
) -> DataFrame:
    """Click requests with the ad they name and, if refused, the `reason`.

    A request and its row of the catalog agree in the ad and in the columns named `also`.
    Requests keep the columns named `keep`.

    The tests run in the order of the click endpoint: parameters, ad, click time. The
    catalog join comes without a hint: Spark broadcasts the catalog while it is small
    enough by its own size check and otherwise shuffles, splitting the clicks of a hot
    ad over several tasks (adaptive skew join).
    """
    cleaned = requests.select(
        "request_id",
        presence(F.col("ad_id")).alias("ad_id"),
        presence(F.col("impression_id")).alias("impression_id"),
        presence(F.col("click_ts")).alias("click_text"),
        "user_agent",
        instant(F.col("received_at")).alias("received_at"),
        *also,
        *keep,
    )
    catalog = ads.select("ad_id", "campaign_id", "advertiser_id", "destination_url", "active", *also)
    looked_up = cleaned.join(catalog, ["ad_id", *also], "left").withColumn(
        "clicked_at", instant_or(F.col("click_text"), F.col("received_at"))
    )
    reason = (
        F.when(F.col("ad_id").isNull() | F.col("impression_id").isNull(), "missing_parameter")
        .when(~F.col("active").eqNullSafe(True), "unknown_ad")
        .when(F.col("clicked_at").isNull() | F.col("received_at").isNull(), "bad_timestamp")
    )
    return looked_up.withColumn("reason", reason)


def click_events(
    requests: DataFrame, ads: DataFrame, ttl_seconds: int = IMPRESSION_TTL_SECONDS
) -> DataFrame:
    """The events of the accepted clicks: the first of each impression per lifetime."""
    valid = judged_requests(requests, ads).where(F.col("reason").isNull())
    opening = first_clicks(valid, _PAYLOAD, ttl_seconds)
    return as_events(opening.withColumn("received_at", F.timestamp_seconds("arrival")))


def as_events(clicks: DataFrame, *also: Column | str) -> DataFrame:
    """Accepted clicks in the shape of the event schema, with any columns named besides."""
    return clicks.withColumns(
        event_columns(F.col("clicked_at"), F.col("received_at"))
        | {"event_id": event_id(F.col("request_id"), F.col("impression_id"), F.col("ad_id"))}
    ).select(*EVENT_FIELDS, *also)


def outcomes(
    requests: DataFrame, ads: DataFrame, ttl_seconds: int = IMPRESSION_TTL_SECONDS
) -> DataFrame:
    """What each request is answered: `status`, `reason`, `location`, and if it `emitted`.

    Accepted clicks are matched back by request and impression, so that a hot impression
    spreads evenly. Of deliveries of the same request one is the accepted one: they are told
    apart by a number, and the first goes with the click.
    """
    judged = judged_requests(requests, ads)
    valid = judged.where(F.col("reason").isNull())
    match = ["request_id", "impression_id", "ad_id", "arrival", "clicked_at"]
    accepted = first_clicks(valid, ["request_id", "ad_id"], ttl_seconds).select(
        *(F.col(name).alias(f"first_{name}") for name in match), F.lit(True).alias("accepted")
    )
    arrival = F.unix_timestamp("received_at")
    delivery = F.row_number().over(
        Window.partitionBy(*match).orderBy("user_agent", "click_text")
    )
    same = [F.col(name).eqNullSafe(F.col(f"first_{name}")) for name in match]
    return (
        judged.withColumn("arrival", arrival)
        .withColumn("delivery", delivery)
        .join(accepted, reduce(and_, [*same, F.col("delivery") == 1]), "left")
        .withColumns(
            {
                "emitted": F.coalesce("accepted", F.lit(False)),
            }
        )
        .select(*answer_columns())
    )


def answer_columns() -> list[Column | str]:
    """What a judged request is answered, given if it `emitted` an event."""
    accepting = F.col("reason").isNull()
    status = F.when(accepting, 302).when(F.col("reason") == "unknown_ad", 404).otherwise(400)
    location = F.when(accepting, F.col("destination_url"))
    return ["request_id", "ad_id", "impression_id", status.alias("status"), "reason", "emitted", location.alias("location")]


def active_ads(ads: DataFrame) -> DataFrame:
    """Ads that may be clicked; an unset flag is not active."""
    return ads.where(F.col("active").eqNullSafe(True))


def rejected_clicks(clicks: DataFrame, ads: DataFrame) -> DataFrame:
    """Clicks on ads that are unknown or inactive."""
    return clicks.join(active_ads(ads).select("ad_id"), "ad_id", "left_anti")
