"""Which advertiser owns which campaign."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def owned_pairs(ads: DataFrame) -> DataFrame:
    """Distinct `(advertiser_id, campaign_id)`; whether an ad is active plays no role."""
    return ads.select("advertiser_id", "campaign_id").dropna().distinct()


def owned(requests: DataFrame, ads: DataFrame) -> DataFrame:
    """Requests for a campaign of the asking advertiser."""
    return requests.join(owned_pairs(ads), ["advertiser_id", "campaign_id"], "left_semi")


def not_owned(requests: DataFrame, ads: DataFrame) -> DataFrame:
    """Requests for somebody else's campaign, or one without ads."""
    return requests.join(owned_pairs(ads), ["advertiser_id", "campaign_id"], "left_anti")


def campaigns_of(ads: DataFrame, advertisers: DataFrame) -> DataFrame:
    """The campaigns of each listed advertiser."""
    return owned_pairs(ads).join(advertisers.select("advertiser_id"), "advertiser_id", "left_semi")
