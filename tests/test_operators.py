"""Deduplication, counting, roll-up, merging, ownership."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from clickmeter.functions.timebucket import instant, iso
from clickmeter.operators import counting, dedup, merging, ownership
from clickmeter.operators.rollup import rollup
from clickmeter.plans.reconcile import recompute

RAW = "impression_id string, campaign_id string, minute_bucket string, ingest_ts string"
M7, M8 = "2026-06-13T14:07:00Z", "2026-06-13T14:08:00Z"


def raw(spark, *clicks):
    return spark.createDataFrame(clicks, RAW)


def test_triple_delivery_counts_once(spark):
    clicks = [("imp_1", "c1", M7, f"2026-06-13T14:07:0{s}Z") for s in (1, 2, 3)]
    assert rows(recompute(raw(spark, *clicks))) == [("c1", M7, 1)]


def test_counts_per_campaign_and_minute(spark):
    counts = recompute(
        raw(
            spark,
            ("imp_1", "c1", M7, "2026-06-13T14:07:01Z"),
            ("imp_2", "c1", M7, "2026-06-13T14:07:02Z"),
            ("imp_3", "c1", M8, "2026-06-13T14:08:01Z"),
            ("imp_4", "c2", M7, "2026-06-13T14:07:05Z"),
        )
    )
    assert rows(counts) == [("c1", M7, 2), ("c1", M8, 1), ("c2", M7, 1)]


def test_late_click_counts_in_its_own_minute(spark):
    late = ("imp_1", "c1", M7, "2026-06-13T14:09:00Z")
    assert rows(recompute(raw(spark, late, ("imp_2", "c1", M7, "2026-06-13T14:07:02Z")))) == [
        ("c1", M7, 2)
    ]


def test_ties_do_not_depend_on_input_order_and_nulls_are_no_clicks(spark):
    tied = [("imp_1", "c2", M8, M8), ("imp_1", "c1", M8, M8), (None, "c1", M7, M7)]
    for clicks in (tied, tied[::-1]):
        assert rows(recompute(raw(spark, *clicks))) == [("c1", M8, 1)]
        assert rows(recompute(raw(spark, *clicks), keep="last")) == [("c2", M8, 1)]
    with pytest.raises(ValueError):
        recompute(raw(spark, *tied), keep="any")


def test_salted_counts_equal_plain_ones(spark, folder):
    clicks = raw(spark, *[(f"i{n}", f"c{n % 3 and 1}", M7, M7) for n in range(200)])
    plain = rows(counting.minute_counts(clicks))
    for factor in (0, 1, 8):
        salted = counting.salted_minute_counts(clicks, factor=factor)
        assert rows(salted) == plain


def accepted_by_hand(clicks, ttl):
    """Clicks in arrival order, one accepted per lifetime and impression."""
    last, accepted = {}, []
    for impression, arrival, request in sorted(clicks, key=lambda c: (c[1], c[2])):
        if impression not in last or arrival - last[impression] >= ttl:
            last[impression] = arrival
            accepted.append((impression, arrival, request))
    return sorted(accepted, key=repr)


def test_first_clicks_match_a_walk_in_arrival_order(spark):
    draw = random.Random(7)
    ttl = 100
    clicks = [
        # One impression holds a third of all clicks and many seconds hold several.
        (draw.choice(["hot"] * 10 + [f"i{n}" for n in range(20)]), draw.randrange(2000), f"r{n:04}")
        for n in range(1500)
    ]
    given = spark.createDataFrame(clicks, "impression_id string, at long, request_id string")
    given = given.select(
        "impression_id",
        F.timestamp_seconds("at").alias("received_at"),
        F.timestamp_seconds("at").alias("clicked_at"),
        "request_id",
    )
    found = dedup.first_clicks(given, ["request_id"], ttl)
    assert rows(found, "impression_id", "arrival", "request_id") == accepted_by_hand(clicks, ttl)


def test_lifetime_is_not_extended_by_repeats_and_ends_exactly(spark):
    hours = [0, 30, 47, 48, 60, 96]
    given = spark.createDataFrame([("i", h * 3600, f"r{h}") for h in hours], "i string, s long, r string")
    given = given.select(
        F.col("i").alias("impression_id"),
        F.timestamp_seconds("s").alias("received_at"),
        F.timestamp_seconds("s").alias("clicked_at"),
        F.col("r").alias("request_id"),
    )
    assert rows(dedup.first_clicks(given, ["request_id"]), "request_id") == [
        ("r0",),
        ("r48",),
        ("r96",),
    ]


def aggregates(spark, *held):
    return spark.createDataFrame(
        held, "campaign_id string, minute_bucket string, click_count long, source string"
    ).withColumns({"minute_bucket": instant(F.col("minute_bucket")), "updated_at": F.current_timestamp()})


def shown(frame):
    bucket = "bucket_start" if "bucket_start" in frame.columns else "minute_bucket"
    return rows(frame, "campaign_id", iso(F.col(bucket)), "click_count", "source")


HOUR14, HOUR15 = "2026-06-13T14:00:00Z", "2026-06-13T15:00:00Z"


def test_rollup_rules(spark):
    held = aggregates(
        spark,
        ("c1", HOUR14, 2, "batch"),
        ("c1", "2026-06-13T14:30:00Z", 4, "batch"),
        ("c1", "2026-06-13T15:10:00Z", 1, "stream"),
        ("c1", "2026-06-13T15:20:00Z", 1, "batch"),
    )
    assert shown(rollup(held, "hour")) == [
        ("c1", HOUR14, 6, "batch"),
        ("c1", HOUR15, 2, "stream"),
    ]
    assert shown(rollup(held, "hour", "min"))[1] == ("c1", HOUR15, 2, "batch")
    assert shown(rollup(rollup(held, "hour"), "day")) == [
        ("c1", "2026-06-13T00:00:00Z", 8, "stream")
    ]
    assert shown(rollup(held, "minute")) == shown(held)
    with pytest.raises(ValueError):
        rollup(held, "week")


def test_upsert_replaces_and_protects_exact_rows(spark):
    stored = aggregates(
        spark, ("c1", M7, 5, "stream"), ("c1", M8, 9, "batch"), ("c2", M7, 1, "stream")
    )
    new = aggregates(
        spark, ("c1", M7, 3, "stream"), ("c1", M8, 2, "stream"), ("c3", M7, 4, "stream")
    )
    after = [
        ("c1", M7, 3, "stream"),
        ("c1", M8, 9, "batch"),
        ("c2", M7, 1, "stream"),
        ("c3", M7, 4, "stream"),
    ]
    assert shown(merging.upsert(stored, new)) == after
    assert shown(merging.upsert(merging.upsert(stored, new), new)) == after
    assert shown(merging.upsert(stored, new, protect_batch=False))[1] == ("c1", M8, 2, "stream")
    assert rows(merging.repeated_keys(merging.upsert(stored, new))) == []
    assert len(rows(merging.repeated_keys(stored.unionByName(new)))) == 2


def test_ownership_ignores_active_and_ads_without_owner(spark):
    ads = spark.createDataFrame(
        [("a1", "c1", False), ("a1", "c1", True), ("a2", "c2", True), (None, "c3", True)],
        "advertiser_id string, campaign_id string, active boolean",
    )
    asked = spark.createDataFrame(
        [("a1", "c1"), ("a1", "c2"), ("a2", "c2"), ("a2", "c9")],
        "advertiser_id string, campaign_id string",
    )
    assert rows(ownership.owned(asked, ads)) == [("a1", "c1"), ("a2", "c2")]
    assert rows(ownership.not_owned(asked, ads)) == [("a1", "c2"), ("a2", "c9")]
    assert rows(ownership.campaigns_of(ads, asked.where("advertiser_id = 'a1'"))) == [("a1", "c1")]
