"""Metrics requests to dense series."""

import json
import random
from datetime import timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from clickmeter import periods
from clickmeter.functions.timebucket import instant
from clickmeter.plans import metrics
from clickmeter.schemas import METRICS_REQUEST
from clickmeter.sources.aggregates import AggregateTable

ADS = "advertiser_id string, campaign_id string"


def ads(spark):
    return spark.createDataFrame([("adv_1", "camp_1"), ("adv_1", "camp_1"), ("adv_2", "camp_2")], ADS)


def requests(spark, *asked):
    return spark.createDataFrame([(f"r{n}", *a) for n, a in enumerate(asked)], METRICS_REQUEST)


def aggregates(spark, *held):
    return spark.createDataFrame(
        held, "campaign_id string, minute_bucket string, click_count long, source string"
    ).withColumn("minute_bucket", instant(F.col("minute_bucket")))


def t(clock):
    return f"2026-06-13T{clock}Z"


def ask(start, end, granularity="minute", campaign="camp_1", token="Bearer adv_1"):
    return (token, campaign, start, end, granularity)


def answer(spark, asked, held, rule="exact"):
    found = metrics.metrics(requests(spark, asked), ads(spark), aggregates(spark, *held), rule)
    return [(r.bucket_start, r.click_count, r.source) for r in found.collect()]


def test_zero_fill(spark):
    held = [("camp_1", t("14:00:00"), 5, "batch"), ("camp_1", t("14:02:00"), 3, "stream")]
    assert answer(spark, ask(t("14:00:00"), t("14:03:00")), held) == [
        (t("14:00:00"), 5, "batch"),
        (t("14:01:00"), 0, "stream"),
        (t("14:02:00"), 3, "stream"),
    ]


HOURS = [
    ("camp_1", t("14:00:00"), 2, "batch"),
    ("camp_1", t("14:30:00"), 4, "batch"),
    ("camp_1", t("15:10:00"), 1, "stream"),
    ("camp_1", t("15:40:00"), 1, "batch"),
    ("camp_2", t("14:10:00"), 99, "batch"),
]


def test_hour_and_day_rollup(spark):
    assert answer(spark, ask(t("14:00:00"), t("16:00:00"), "hour"), HOURS) == [
        (t("14:00:00"), 6, "batch"),
        (t("15:00:00"), 2, "stream"),
    ]
    day = ask("2026-06-12T00:00:00Z", "2026-06-14T00:00:00Z", "day")
    assert answer(spark, day, HOURS) == [
        ("2026-06-12T00:00:00Z", 0, "stream"),
        ("2026-06-13T00:00:00Z", 8, "stream"),
    ]
    assert answer(spark, day, HOURS, "min")[1] == ("2026-06-13T00:00:00Z", 8, "batch")


def test_bounds_inside_buckets(spark):
    # The first hour keeps its start but counts only from the bound on; the last minute
    # counts whole because its row starts before the bound.
    assert answer(spark, ask(t("14:20:00"), t("15:10:30"), "hour"), HOURS) == [
        (t("14:00:00"), 4, "batch"),
        (t("15:00:00"), 1, "stream"),
    ]
    assert answer(spark, ask(t("14:00:30"), t("14:02:30")), HOURS) == [
        (t("14:00:00"), 0, "stream"),
        (t("14:01:00"), 0, "stream"),
        (t("14:02:00"), 0, "stream"),
    ]
    assert answer(spark, ask(t("15:10:00"), t("15:10:00.5")), HOURS) == [(t("15:10:00"), 1, "stream")]


def test_random_bounds_agree_with_the_single_campaign_scan(spark):
    draw = random.Random(3)
    origin = periods.parse(t("00:00:00"))
    minutes = draw.sample(range(4 * 1440), 700)
    held = aggregates(
        spark,
        *[
            (
                "camp_1",
                periods.text(origin + timedelta(minutes=m)),
                draw.randrange(9),
                draw.choice(["batch"] * 4 + ["stream"]),
            )
            for m in minutes
        ],
    ).cache()
    asked = []
    for granularity in ("minute", "hour", "day") * 3:
        start = origin + timedelta(seconds=draw.randrange(2 * 86400))
        asked.append((start, start + timedelta(seconds=draw.randrange(1, 2 * 86400)), granularity))
    together = metrics.metrics(
        requests(spark, *[ask(s.isoformat(), e.isoformat(), g) for s, e, g in asked]),
        ads(spark),
        held,
    ).collect()
    for n, (start, end, granularity) in enumerate(asked):
        alone = metrics.campaign_series(held, "camp_1", start, end, granularity).collect()
        assert [r[2:] for r in together if r.request_id == f"r{n}"] == [r[1:] for r in alone]


@pytest.mark.parametrize(
    ("end", "asked", "effective", "buckets"),
    [
        ("2026-01-01T01:00:00Z", "minute", "minute", 60),
        ("2026-01-02T01:00:00Z", "minute", "minute", 1500),
        ("2026-01-02T01:00:01Z", "minute", "hour", 26),
        ("2026-04-01T00:00:00Z", "minute", "day", 90),
        ("2026-03-04T12:00:00Z", "hour", "hour", 1500),
        ("2026-03-04T12:00:01Z", "hour", "day", 63),
        ("2036-01-01T00:00:00Z", "day", "day", 3652),
    ],
)
def test_coarsening(spark, end, asked, effective, buckets):
    start, stop = instant(F.lit("2026-01-01T00:00:00Z")), instant(F.lit(end))
    fitted = metrics.effective_granularity(start, stop, F.lit(asked))
    row = spark.range(1).select(
        fitted.alias("effective"), metrics.bucket_count(start, stop, fitted).alias("buckets")
    )
    assert rows(row) == [(effective, buckets)]
    assert metrics.fitted(periods.parse("2026-01-01T00:00:00Z"), periods.parse(end), asked) == effective


def test_request_guards_in_order(spark):
    ok = (t("14:00:00"), t("14:02:00"))
    asked = [
        ask(*ok),
        ask(*ok, token=None),
        ask(*ok, token="Bearer  "),
        ask(*ok, campaign=" ", granularity="weekly"),
        ask(*ok, granularity="weekly"),
        ask(t("15:00:00"), t("14:00:00")),
        ask(t("14:00:00"), t("14:00:00")),
        ask("soon", t("14:00:00"), campaign="camp_2"),
        ask(None, t("14:00:00")),
        ask(*ok, campaign="camp_2"),
        ask(*ok, campaign="unknown"),
        ask(*ok, granularity=" "),
    ]
    judged = metrics.judged_requests(requests(spark, *asked), ads(spark))
    found = {r.request_id: (r.status, r.reason) for r in judged.collect()}
    assert [found[f"r{n}"] for n in range(len(asked))] == [
        (200, None),
        (401, "unauthenticated"),
        (401, "unauthenticated"),
        (400, "missing_parameter"),
        (400, "bad_granularity"),
        (400, "bad_range"),
        (400, "bad_range"),
        (400, "bad_range"),
        (400, "bad_range"),
        (403, "forbidden"),
        (403, "forbidden"),
        (200, None),
    ]


def test_responses(spark):
    asked = [ask(t("14:00:00"), t("16:00:00"), "hour"), ask(None, None, token=None)]
    found = metrics.responses(requests(spark, *asked), ads(spark), aggregates(spark, *HOURS))
    bodies = {r.request_id: (r.status, json.loads(r.body)) for r in found.collect()}
    assert bodies["r1"] == (401, {"error": "unauthenticated", "detail": "missing bearer token"})
    assert bodies["r0"] == (
        200,
        {
            "campaign_id": "camp_1",
            "granularity": "hour",
            "from": t("14:00:00"),
            "to": t("16:00:00"),
            "buckets": [
                {"bucket_start": t("14:00:00"), "click_count": 6, "source": "batch"},
                {"bucket_start": t("15:00:00"), "click_count": 2, "source": "stream"},
            ],
        },
    )


def test_one_request_is_answered_like_many(spark, tmp_path):
    table = AggregateTable(spark, str(tmp_path / "t")).create()
    table.upsert(aggregates(spark, *HOURS).drop("source", "updated_at"), F.current_timestamp())
    asked = [
        ask(t("14:20:00"), t("15:10:30"), "hour"),
        ask(t("14:00:00"), t("15:00:00"), campaign=" camp_1\n"),
        ask(None, None, token=None),
        ask(t("14:00:00"), t("16:00:00"), campaign="camp_2"),
        ask(t("14:00:00"), t("13:00:00")),
        ask(t("14:00:00"), t("16:00:00"), granularity="weekly"),
    ]
    frame = requests(spark, *asked)
    many = {r.request_id: (r.status, json.loads(r.body)) for r in metrics.responses(frame, ads(spark), table.read()).collect()}
    for row in frame.collect():
        status, body = metrics.answer(row.asDict(), ads(spark), table)
        assert (status, json.loads(body)) == many[row.request_id]


def test_no_request_meets_all_rows_of_its_campaign(spark):
    """Requests and rows are matched by equality only: no nested loop, no product."""
    series = metrics.metrics(
        requests(spark, ask(t("14:20:00"), t("15:10:30"), "hour")),
        ads(spark),
        aggregates(spark, *HOURS),
    )
    plan = series._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_tasks_follow_from_the_number_of_buckets(spark, monkeypatch):
    """However many requests there are, a task puts only so many buckets in order."""
    monkeypatch.setattr(metrics, "BUCKETS_PER_TASK", 100)
    asked = requests(spark, *[ask(t("00:00:00"), t("20:00:00")) for _ in range(30)])
    series = metrics.metrics(asked, ads(spark), aggregates(spark, *HOURS))
    parts = [part for part in series.rdd.map(lambda row: (row.request_id, row.bucket_start)).glom().collect() if part]
    assert series.rdd.getNumPartitions() == metrics.MOST_TASKS
    assert sum(map(len, parts)) == 36_000 and max(map(len, parts)) <= 6_000
    assert all(part == sorted(part) for part in parts)
    assert sum(len({request for request, _ in part}) for part in parts) == 30


def shuffled(plan):
    """Rows written by the shuffles of a plan that has run."""
    name = plan.nodeName()
    if name == "AdaptiveSparkPlan":
        return shuffled(plan.executedPlan())
    if name.endswith("QueryStage"):
        return shuffled(plan.plan())
    written = plan.metrics().get("shuffleRecordsWritten")
    children = plan.children()
    below = sum(shuffled(children.apply(n)) for n in range(children.size()))
    return below + (written.get().value() if written.isDefined() else 0)


def test_buckets_of_a_response_are_not_shuffled_one_by_one(spark):
    """What goes through joins and groups is far less than the buckets, whole or put together."""
    asked = [ask(t("00:00:00"), t("20:00:00")) for _ in range(30)]
    asked += [ask("2026-06-01T00:01:00Z", "2026-06-01T23:59:00Z", "day") for _ in range(30)]
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = metrics.responses(requests(spark, *asked), ads(spark), aggregates(spark, *HOURS))
        bodies = [json.loads(row.body)["buckets"] for row in found.collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    assert sum(map(len, bodies)) == 36_030
    assert 0 < shuffled(found._jdf.queryExecution().executedPlan()) < 6_000


def test_stretches_over_many_blocks_and_before_the_epoch(spark):
    """Blocks begin at the epoch: series over their bounds, and before 1970, miss nothing."""
    held = [("camp_1", f"1969-{month:02d}-28T23:59:00Z", month, "batch") for month in range(1, 13)]
    (year,) = metrics.responses(
        requests(spark, ask("1968-12-31T12:00:00Z", "1970-01-02T00:00:01Z", "day")), ads(spark), aggregates(spark, *held)
    ).collect()
    buckets = json.loads(year.body)["buckets"]
    starts = [bucket["bucket_start"] for bucket in buckets]
    assert len(starts) == 368 and starts == sorted(set(starts))
    assert [b["click_count"] for b in buckets if b["click_count"]] == list(range(1, 13))
    assert {b["bucket_start"][8:10] for b in buckets if b["source"] == "batch"} == {"28"}


def test_an_id_that_comes_twice_lists_all_its_buckets_in_order(spark):
    asked = [("r0", *ask(t(start), t("16:00:00"), unit)) for start, unit in [("14:00:00", "hour"), ("14:30:00", "hour"), ("15:58:00", "minute")]]
    found = metrics.responses(spark.createDataFrame(asked, METRICS_REQUEST), ads(spark), aggregates(spark, *HOURS))
    for row in found.collect():
        assert [(b["bucket_start"], b["click_count"]) for b in json.loads(row.body)["buckets"]] == [
            (t("14:00:00"), 4),
            (t("14:00:00"), 6),
            (t("15:00:00"), 2),
            (t("15:00:00"), 2),
            (t("15:58:00"), 0),
            (t("15:59:00"), 0),
        ]
