"""Streams over folders of JSON lines, one file per batch."""

import json
import os
import random
from datetime import UTC, date, datetime

from conftest import rows
from pyspark.sql import functions as F

from clickmeter import periods
from clickmeter.functions.timebucket import iso
from clickmeter.jobs import AUDITS, main
from clickmeter.plans import capture as batch_capture
from clickmeter.plans import audits, metrics, reconcile, settling, sketches
from clickmeter.schemas import AD, CLICK_EVENT, CLICK_REQUEST, METRICS_REQUEST
from clickmeter.sources import archive
from clickmeter.sources.aggregates import AggregateTable
from clickmeter.sources.clickstream import read_json_folder
from clickmeter.streaming import answering, hotads, intake
from clickmeter.streaming.archiving import start_archiving
from clickmeter.streaming.counting import start_counting

ALL = {"availableNow": True}


def put(folder, number, *records):
    """File `number` of the stream; its time stamp keeps the files in order."""
    folder.mkdir(exist_ok=True)
    path = folder / f"{number:03}.json"
    lines = [r if isinstance(r, str) else json.dumps(r) for r in records]
    path.write_text("\n".join(lines) + "\n")
    os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))


def click(clock, campaign="camp_1", impression=None):
    ts = f"2026-06-13T{clock}Z"
    impression = impression or f"imp_{campaign}_{clock}"
    return {
        "event_id": f"e_{impression}_{clock}",
        "impression_id": impression,
        "ad_id": "ad_1",
        "campaign_id": campaign,
        "advertiser_id": "adv_1",
        "click_ts": ts,
        "minute_bucket": ts[:17] + "00Z",
        "ingest_ts": ts,
    }


def count(spark, folder, table, checkpoint, **options):
    records = read_json_folder(spark, str(folder), files_per_batch=1)
    start_counting(records, table, str(checkpoint), ALL, **options).awaitTermination()


def minutes(table):
    return rows(table.read(), "campaign_id", F.date_format("minute_bucket", "HH:mm"), "click_count")


def test_out_of_order_clicks_land_in_their_own_minute(spark, tmp_path):
    put(
        tmp_path / "in",
        1,
        click("14:07:10"),
        click("14:07:50"),
        click("14:07:05"),
        click("14:08:01"),
        click("14:07:30", "camp_2"),
        "{broken",
        click("14:07:40") | {"click_ts": "soon"},
    )
    put(tmp_path / "in", 2, click("14:10:00"))
    table = AggregateTable(spark, str(tmp_path / "t")).create()
    count(spark, tmp_path / "in", table, tmp_path / "c")
    # The minute of the newest click is still open.
    assert minutes(table) == [
        ("camp_1", "14:07", 3),
        ("camp_1", "14:08", 1),
        ("camp_2", "14:07", 1),
    ]


def test_late_clicks_wait_for_reconciliation_and_a_restart_goes_on(spark, tmp_path):
    folder, table = tmp_path / "in", AggregateTable(spark, str(tmp_path / "t")).create()
    put(folder, 1, click("14:07:10"), click("14:07:50"))
    put(folder, 2, click("14:09:00"))
    count(spark, folder, table, tmp_path / "c")
    put(folder, 3, click("14:09:10"))
    put(folder, 4, click("14:07:59", impression="late"), click("14:09:20"))
    put(folder, 5, click("14:12:00"))
    count(spark, folder, table, tmp_path / "c")
    assert minutes(table) == [("camp_1", "14:07", 2), ("camp_1", "14:09", 3)]
    # A lost checkpoint replays everything; counts are set, not added.
    count(spark, folder, table, tmp_path / "c2")
    assert minutes(table) == [("camp_1", "14:07", 2), ("camp_1", "14:09", 3)]
    archive.write_archive(spark.read.schema(CLICK_EVENT).json(str(folder)), str(tmp_path / "raw"))
    reconcile.reconcile(
        spark,
        str(tmp_path / "raw"),
        str(tmp_path / "t"),
        periods.parse("2026-06-13T14:00:00Z"),
        periods.parse("2026-06-13T15:00:00Z"),
    )
    assert minutes(table) == [
        ("camp_1", "14:07", 3),
        ("camp_1", "14:09", 3),
        ("camp_1", "14:12", 1),
    ]


def test_repeats_are_counted_unless_asked_otherwise(spark, tmp_path):
    put(tmp_path / "in", 1, *[click("14:07:10", impression="same")] * 3)
    put(tmp_path / "in", 2, click("14:10:00"))
    for distinct, clicks in ((False, 3), (True, 1)):
        table = AggregateTable(spark, str(tmp_path / f"t{distinct}")).create()
        count(
            spark, tmp_path / "in", table, tmp_path / f"c{distinct}", distinct_impressions=distinct
        )
        assert minutes(table) == [("camp_1", "14:07", clicks)]


def ads(spark):
    return spark.createDataFrame(
        [("ad_1", "camp_1", "adv_1", "https://a.example/1", True, "2026-06-01T00:00:00Z")], AD
    )


def ask(number, impression, received, ad="ad_1", click_ts=None):
    return {
        "request_id": f"r{number:02}",
        "ad_id": ad,
        "impression_id": impression,
        "click_ts": click_ts,
        "received_at": received,
    }


def request_stream(spark, folder):
    return (
        spark.readStream.schema(CLICK_REQUEST).option("maxFilesPerTrigger", 1).json(str(folder))
    )


NOW = "2026-06-20T00:00:00Z"


def capture(spark, tmp_path, catalog=ads, ttl=172800, delay="48 hours"):
    """Both stages over `requests`; the folder of the events."""
    root, events = str(tmp_path / "state"), str(tmp_path / "events")
    requests = request_stream(spark, tmp_path / "requests")
    intake.start_taking(requests, catalog, root, str(tmp_path / "c1"), ALL, F.lit(NOW).cast("timestamp"), delay).awaitTermination()
    answering.start_answering(spark, root, events, str(tmp_path / "c2"), ALL, ttl, delay).awaitTermination()
    return events


REQUESTS = [
    [
        ask(1, "imp_1", "2026-06-13T14:00:09Z"),
        ask(2, "imp_1", "2026-06-13T14:00:05Z"),
        ask(3, "imp_1", "2026-06-13T14:00:05Z", click_ts="2026-06-13T14:00:01Z"),
        ask(4, "imp_2", "2026-06-13T14:00:06Z", ad="nope"),
        ask(5, " ", "2026-06-13T14:00:06Z"),
    ],
    [
        ask(6, "imp_1", "2026-06-13T14:20:00Z"),
        ask(7, "imp_2", "2026-06-13T14:20:00Z"),
        ask(8, "imp_3", "2026-06-13T14:20:01Z", click_ts="soon"),
    ],
    [
        ask(9, "imp_1", "2026-06-15T14:00:04Z"),
        ask(10, "imp_1", "2026-06-15T14:00:05Z"),
        ask(11, "imp_2", "2026-06-15T13:00:00Z"),
    ],
]


def test_each_impression_is_captured_once_per_lifetime(spark, tmp_path):
    folder = tmp_path / "requests"
    captured = []
    for number, batch in enumerate(REQUESTS):
        put(folder, number, *batch)
        # One run per file: what was accepted is remembered over restarts.
        events = answering.read_events(spark, capture(spark, tmp_path))
        captured = rows(events, "impression_id", "click_ts", "ingest_ts")
    assert captured == [
        ("imp_1", "2026-06-13T14:00:01Z", "2026-06-13T14:00:05Z"),
        ("imp_1", "2026-06-15T14:00:05Z", "2026-06-15T14:00:05Z"),
        ("imp_2", "2026-06-13T14:20:00Z", "2026-06-13T14:20:00Z"),
    ]


def test_a_backlog_lets_nothing_count_twice(spark, tmp_path):
    """Lifetimes end by arrivals, however long the stream was stopped in between."""
    folder = tmp_path / "requests"
    arrivals = [("imp", "14:00:00"), ("other", "14:00:22"), ("imp", "14:00:10"), ("imp", "14:00:20")]
    for number, (impression, time) in enumerate(arrivals):
        at = f"2026-06-13T{time}Z"
        put(folder, number, ask(number, impression, at))
        events = capture(spark, tmp_path, ttl=20, delay="20 seconds")
    found = answering.read_events(spark, events)
    assert rows(found, "impression_id", "ingest_ts") == [
        ("imp", "2026-06-13T14:00:00Z"),
        ("imp", "2026-06-13T14:00:20Z"),
        ("other", "2026-06-13T14:00:22Z"),
    ]


def test_batch_writers_may_append_to_a_streamed_archive(spark, tmp_path):
    raw, source = str(tmp_path / "raw"), tmp_path / "events"
    event = {name: "x" for name in CLICK_EVENT.fieldNames()} | {"minute_bucket": "2026-06-13T14:00:00Z"}
    source.mkdir()
    (source / "0.json").write_text(json.dumps(event) + "\n")
    records = read_json_folder(spark, str(source))
    for query in start_archiving(records, raw, str(tmp_path / "bad"), str(tmp_path / "c"), ALL):
        query.awaitTermination()
    late = event | {"minute_bucket": "2026-04-13T14:00:00Z"}
    archive.write_archive(spark.createDataFrame([late] * 4, CLICK_EVENT), raw)
    assert archive.read_archive(spark, raw).count() == 5
    archive.drop_expired(spark, raw, date(2026, 6, 14))
    assert archive.read_archive(spark, raw).count() == 1


def test_from_requests_to_metrics(spark, tmp_path):
    """Capture feeds the counter and the archiver; reconciliation and metrics follow."""
    events, raw, table_path = (str(tmp_path / name) for name in ("events", "raw", "table"))
    for number, batch in enumerate(REQUESTS):
        put(tmp_path / "requests", number, *batch)
    capture(spark, tmp_path)
    records = read_json_folder(spark, events)
    table = AggregateTable(spark, table_path).create()
    start_counting(records, table, str(tmp_path / "c3"), ALL).awaitTermination()
    for query in start_archiving(records, raw, str(tmp_path / "bad"), str(tmp_path / "c4"), ALL):
        query.awaitTermination()
    assert archive.read_archive(spark, raw).count() == 3
    start, end = periods.parse("2026-06-13T14:00:00Z"), periods.parse("2026-06-13T15:00:00Z")
    assert {row.source for row in table.read().collect()} == {"stream"}
    reconcile.reconcile(spark, raw, table_path, start, end)
    asked = spark.createDataFrame(
        [("r", "Bearer adv_1", "camp_1", periods.text(start), "2026-06-13T16:00:00Z", "hour")],
        METRICS_REQUEST,
    )
    series = metrics.metrics(asked, ads(spark), table.read())
    assert rows(series, "bucket_start", "click_count", "source") == [
        ("2026-06-13T14:00:00Z", 2, "batch"),
        ("2026-06-13T15:00:00Z", 0, "stream"),
    ]
    assert rows(table.read(end), iso(F.col("minute_bucket"))) == []


def test_jobs_from_the_command_line(spark, tmp_path):
    def run(job, **options):
        flags = [word for name, value in options.items() for word in (f"--{name}", str(value))]
        main([job, *flags])

    at = {name: str(tmp_path / name) for name in ("events", "raw", "bad", "t", "ads", "ads2", "out")}
    (tmp_path / "catalog.json").write_text(
        json.dumps({"ads": [row.asDict() for row in ads(spark).drop("created_at").collect()]})
    )
    run("create-tables", table=at["t"])
    run("load-catalog", document=tmp_path / "catalog.json", created_at="x", out=at["ads"])
    run(
        "load-catalog",
        document=tmp_path / "catalog.json",
        created_at="y",
        catalog=at["ads"],
        out=at["ads2"],
    )
    for number, batch in enumerate(REQUESTS):
        put(tmp_path / "requests", number, *batch)

    def stream(job, folder, **options):
        flags = [word for name, value in options.items() for word in (f"--{name}", str(value))]
        main([job, "--folder", str(folder), "--once", *flags])

    stream(
        "capture", tmp_path / "requests", catalog=at["ads2"], state=tmp_path / "state",
        out=at["events"], checkpoint=tmp_path / "c1",
    )
    stream("count", at["events"], table=at["t"], checkpoint=tmp_path / "c2")
    stream(
        "archive", at["events"], raw_path=at["raw"], error_path=at["bad"],
        checkpoint=tmp_path / "c3",
    )
    hour = {"period_start": "2026-06-13T14:00:00Z", "period_end": "2026-06-13T15:00:00Z"}
    run("reconcile", raw_path=at["raw"], table=at["t"], **hour)
    (tmp_path / "asked.json").write_text(
        json.dumps(
            {
                "request_id": "r",
                "authorization": "Bearer adv_1",
                "campaign_id": "camp_1",
                "from": hour["period_start"],
                "to": hour["period_end"],
                "granularity": "hour",
            }
        )
    )
    run(
        "metrics", requests=tmp_path / "asked.json", catalog=at["ads2"], table=at["t"],
        out=at["out"],
    )
    answered = spark.read.json(at["out"]).collect()[0]
    assert answered.status == 200
    assert json.loads(answered.body)["buckets"] == [
        {"bucket_start": hour["period_start"], "click_count": 2, "source": "batch"}
    ]
    # Every audit has its command.
    for kind in AUDITS:
        run("audit", kind=kind, out=tmp_path / kind, state=tmp_path / "state", raw_path=at["raw"], table=at["t"])
    found = {kind: spark.read.json(str(tmp_path / kind)) for kind in ("loss", "outcomes", "truth", "sources")}
    assert rows(found["loss"], "accepted", "captured", "lost", "unexpected") == [(2, 2, 0, 0)]
    assert sum(r.requests for r in found["outcomes"].collect()) == 11
    assert found["truth"].count() == 3 and rows(found["sources"], "source")[0] == ("batch",)
    period = {"period_start": "2026-06-13T00:00:00Z", "period_end": "2026-06-14T00:00:00Z"}
    for _ in range(2):
        run("summarise", raw_path=at["raw"], out=tmp_path / "hours", **period)
    days = sketches.merged(sketches.read_sketches(spark, str(tmp_path / "hours")), ["dt"])
    assert rows(days, "dt", "clicks", "captured") == [("2026-06-13", 2, 2)]
    # Days past retention go as folders; what a period needs stays readable.
    main(["expire", "--raw_path", at["raw"], "--days", "100000"])
    assert archive.drop_expired(spark, at["raw"], date(2026, 7, 14)) == ["2026-06-13"]
    kept = archive.read_period(spark, at["raw"], "2026-06-15T00:00:00Z", "2026-06-16T00:00:00Z")
    assert rows(kept, "impression_id") == [("imp_1",)]


def asked_again(spark, tmp_path, deliveries):
    """Deliveries one after the other; all requests as a batch frame."""
    for number, batch in enumerate(deliveries):
        put(tmp_path / "requests", number, *batch)
        events = capture(spark, tmp_path)
    everything = spark.createDataFrame([tuple(x[c] for c in REQUEST) for b in deliveries for x in b], ", ".join(f"{c} string" for c in REQUEST))
    return events, everything.withColumn("user_agent", F.lit(None).cast("string"))


REQUEST = ("request_id", "ad_id", "impression_id", "click_ts", "received_at")


def test_outcomes_of_the_stream_are_those_of_the_batch(spark, tmp_path):
    events, requests = asked_again(spark, tmp_path, REQUESTS)
    streamed = answering.read_outcomes(spark, str(tmp_path / "state"))
    # Two batches apart, a repeat is told by the state; within one by the first stage.
    assert rows(streamed) == rows(batch_capture.outcomes(requests, ads(spark)))
    assert rows(answering.read_events(spark, events)) == rows(batch_capture.click_events(requests, ads(spark)))


def test_one_future_and_one_late_request_lose_nothing(spark, tmp_path):
    deliveries = [
        [ask(1, "imp_1", "2026-06-13T14:00:00Z"), ask(2, "imp_9", "2031-01-01T00:00:00Z"), ask(3, "imp_1", "2031-01-02T00:00:00Z")],
        [ask(4, "imp_2", "2026-06-13T15:00:00Z"), ask(5, "imp_9", "2026-06-13T15:00:00Z")],
        [ask(6, "imp_3", "2026-06-13T16:00:00Z"), ask(7, "imp_4", "2026-06-06T00:00:00Z"), ask(8, "imp_4", "2026-06-06T00:00:00Z")],
    ]
    events, requests = asked_again(spark, tmp_path, deliveries)
    root = str(tmp_path / "state")
    assert rows(settling.set_aside(spark, root), "request_id", "kind") == [("r02", "ahead"), ("r03", "ahead"), ("r07", "behind"), ("r08", "behind")]
    streamed = answering.read_events(spark, events)
    assert streamed.count() == 4
    expected = rows(batch_capture.click_events(requests, ads(spark)))
    assert rows(streamed.unionByName(settling.settled_events(spark, root, events))) == expected
    outcomes = answering.read_outcomes(spark, root).unionByName(settling.settled_outcomes(spark, root, events))
    assert rows(outcomes) == rows(batch_capture.outcomes(requests, ads(spark)))
    main(["settle", "--state", root, "--events", events, "--out", str(tmp_path / "settled")])
    written = spark.read.schema(CLICK_EVENT).json(str(tmp_path / "settled/events"))
    assert rows(streamed.unionByName(written)) == expected


def test_settling_leaves_a_counted_impression_alone(spark, tmp_path):
    """The late request came first, but the stream has counted a later one within its lifetime."""
    deliveries = [[ask(1, "imp_1", "2026-06-13T14:00:00Z"), ask(2, "other", "2026-06-16T00:00:00Z")], [ask(3, "imp_1", "2026-06-12T00:00:00Z"), ask(4, "imp_1", "2026-06-11T00:00:00Z")]]
    events, _ = asked_again(spark, tmp_path, deliveries)
    late = settling.settled_outcomes(spark, str(tmp_path / "state"), events)
    assert rows(late, "request_id", "status", "emitted") == [("r03", 302, False), ("r04", 302, True)]


def test_an_ad_switched_off_between_batches_is_refused(spark, tmp_path):
    put(tmp_path / "requests", 1, ask(1, "imp_1", "2026-06-13T14:00:00Z"))
    capture(spark, tmp_path)
    put(tmp_path / "requests", 2, ask(2, "imp_2", "2026-06-13T14:01:00Z"), ask(3, "imp_3", "2026-06-13T14:01:00Z"))
    capture(spark, tmp_path, lambda session: ads(session).withColumn("active", F.lit(False)))
    outcomes = answering.read_outcomes(spark, str(tmp_path / "state"))
    assert rows(outcomes, "request_id", "status", "emitted") == [("r01", 302, True), ("r02", 404, False), ("r03", 404, False)]


def test_a_batch_taken_in_twice_appears_once(spark, tmp_path):
    """Commits of both stages are lost after all was written, as by a crash."""
    put(tmp_path / "requests", 1, *REQUESTS[0])
    events = capture(spark, tmp_path)
    before = rows(answering.read_outcomes(spark, str(tmp_path / "state"))), rows(answering.read_events(spark, events))
    for stage in ("c1", "c2"):
        for file in (tmp_path / stage / "commits").iterdir():
            file.unlink()
    capture(spark, tmp_path)
    assert (rows(answering.read_outcomes(spark, str(tmp_path / "state"))), rows(answering.read_events(spark, events))) == before
    put(tmp_path / "requests", 2, *REQUESTS[1])
    capture(spark, tmp_path)
    assert answering.read_events(spark, events).count() == 2


def test_half_the_clicks_on_one_impression_and_ad(spark, tmp_path):
    """The hot ad is spread over rows of its own; seconds of the hot impression are thinned first."""
    start = 1_781_359_200  # 2026-06-13T14:00:00Z
    stamp = lambda i: datetime.fromtimestamp(start + i // 50, UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    batch = [ask(i, "hot" if i % 2 else f"imp_{i}", stamp(i)) for i in range(4000)]
    events, requests = asked_again(spark, tmp_path, [batch])
    assert rows(answering.read_events(spark, events)) == rows(batch_capture.click_events(requests, ads(spark)))
    taken = spark.read.parquet(str(tmp_path / "state/taken"))
    assert taken.where("impression_id = 'hot' and kind = 'valid'").count() == 80
    spread = intake.looked_up(intake.numbered(requests), ads(spark), hot_clicks=500)
    pieces = spread.groupBy("piece").count().collect()
    assert len(pieces) == 8 and max(r["count"] for r in pieces) < 700
    assert rows(spread.drop("piece", "row")) == rows(batch_capture.judged_requests(requests, ads(spark)))


def test_the_counter_takes_shuffled_batches_and_two_consumers_follow_one_stream(spark, tmp_path):
    """Files in any order within the watermark give the minutes of the batch; the archive gets every record."""
    random_ = random.Random(2)
    clicks = [click(f"14:{m:02}:{s:02}", f"camp_{random_.randint(1, 3)}") for m in range(20) for s in range(0, 60, 7)]
    shuffled = sorted(clicks, key=lambda c: (c["click_ts"][:18], random_.random()))
    for number in range(0, len(shuffled), 9):
        put(tmp_path / "in", number // 9, *shuffled[number : number + 9])
    put(tmp_path / "in", 999, click("14:30:00"))
    table = AggregateTable(spark, str(tmp_path / "t")).create()
    records = read_json_folder(spark, str(tmp_path / "in"), files_per_batch=7)
    queries = [start_counting(records, table, str(tmp_path / "c"), ALL)]
    queries += start_archiving(records, str(tmp_path / "raw"), str(tmp_path / "bad"), str(tmp_path / "a"), ALL)
    for query in queries:
        query.awaitTermination()
    stored = archive.read_archive(spark, str(tmp_path / "raw"))
    assert stored.count() == len(clicks) + 1
    exact = reconcile.typed(reconcile.recompute(stored)).where("minute_bucket < '2026-06-13T14:30:00Z'")
    assert minutes(table) == rows(exact, "campaign_id", F.date_format("minute_bucket", "HH:mm"), "click_count")


def test_a_batch_archived_again_after_a_killed_commit_is_kept_once(spark, tmp_path):
    raw, bad = str(tmp_path / "raw"), str(tmp_path / "bad")

    def run():
        for query in start_archiving(read_json_folder(spark, str(tmp_path / "in"), 1), raw, bad, str(tmp_path / "c"), ALL):
            query.awaitTermination()

    put(tmp_path / "in", 1, click("14:07:10"), click("15:07:50"), "{broken")
    put(tmp_path / "in", 2, click("14:08:10"), "{worse")
    run()
    for part in ("archive", "errors"):  # the last batch is known to have begun, not to have ended
        for file in (tmp_path / "c" / part / "commits").glob("*1*"):
            file.unlink()
    lost = next((tmp_path / "raw").glob("dt=*/hr=14/batch=*000000000001/*.parquet"))
    lost.unlink()  # part of it was never moved to its place
    run()
    assert archive.read_archive(spark, raw).count() == 3
    assert rows(archive.read_errors(spark, bad), "value") == [("{broken",), ("{worse",)]


def test_hot_ads_of_windows_agree_with_the_exact_ones(spark, tmp_path):
    """Many ads, a few of them hot in some hours; the summary tracks fewer than there are."""
    random_ = random.Random(4)
    clicks = []
    for hour in range(3):
        for i in range(700):
            ad = f"hot_{hour}" if i % 4 == 0 else f"warm_{i % 3}" if i % 9 == 0 else f"ad_{random_.randrange(900)}"
            clicks.append(click(f"1{hour}:{i % 60:02}:{i // 60:02}", impression=f"i{hour}_{i}") | {"ad_id": ad})
    put(tmp_path / "in", 1, *clicks)
    put(tmp_path / "in", 2, click("14:00:00"))
    records = read_json_folder(spark, str(tmp_path / "in"), files_per_batch=1)
    hotads.start_watching(records, str(tmp_path / "hot"), str(tmp_path / "c"), 0.03, "1 hour", ALL).awaitTermination()
    assert hotads.tracked_items(0.03) < 900
    raw = spark.read.schema(CLICK_EVENT).json(str(tmp_path / "in"))
    found = hotads.hot_ads_of_windows(spark, str(tmp_path / "hot"), raw, 0.03)
    for hour in range(3):
        exact = audits.hot_ads(raw.where(F.substring("click_ts", 12, 2) == f"1{hour}"), 0.03)
        own = found.where(F.date_format("window_start", "HH") == f"1{hour}").drop("window_start")
        assert rows(own) == rows(exact) and own.count() >= 2


def test_impressions_share_state_and_count_as_in_batch(spark, tmp_path):
    """Thousands of impressions of an hour take a row of state for each bucket, not one each."""
    draw = random.Random(3)
    stamp = lambda second: datetime.fromtimestamp(1_781_359_200 + second, UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    repeated = sorted(draw.randrange(8 * 86400) for _ in range(600))
    deliveries = [[ask(i, f"once_{i}", stamp(i)) for i in range(2000)], *(repeated[i : i + 150] for i in range(0, 600, 150))]
    deliveries[1:] = [[ask(f"{n}_{i}", f"imp_{draw.randrange(30)}", stamp(s)) for i, s in enumerate(part)] for n, part in enumerate(deliveries[1:])]
    root, events = str(tmp_path / "state"), str(tmp_path / "events")
    held = []
    for number, batch in enumerate(deliveries):
        put(tmp_path / "requests", number, *batch)
        requests = request_stream(spark, tmp_path / "requests")
        intake.start_taking(requests, ads, root, str(tmp_path / "c1"), ALL, F.lit("2026-06-30").cast("timestamp")).awaitTermination()
        query = answering.start_answering(spark, root, events, str(tmp_path / "c2"), ALL)
        query.awaitTermination()
        held.append(query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"])
    assert held[0] <= answering.BUCKETS
    # What has passed its lifetime and the delay is forgotten where clicks come.
    assert held[-1] < held[0] + 600
    everything = spark.read.schema(CLICK_REQUEST).json(str(tmp_path / "requests"))
    assert settling.set_aside(spark, root).isEmpty()
    assert rows(answering.read_events(spark, events)) == rows(batch_capture.click_events(everything, ads(spark)))
    assert rows(answering.read_outcomes(spark, root)) == rows(batch_capture.outcomes(everything, ads(spark)))
