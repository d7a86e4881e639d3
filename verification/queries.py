"""One query per operator, over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmeter import periods
from clickmeter.functions import events as event_functions
from clickmeter.functions.text import salted_key
from clickmeter.functions.timebucket import floor_to, instant, is_bucket, iso, minute_bucket
from clickmeter.operators import counting, dedup, merging, ownership, selection
from clickmeter.operators.rollup import rollup
from clickmeter.plans import audits, capture, metrics, reconcile, settling, sketches
from clickmeter.schemas import CLICK_REQUEST
from clickmeter.session import scratch_folder, utc
from clickmeter.sources import archive, catalog, clickstream, given
from clickmeter.sources.aggregates import AggregateTable
from clickmeter.sources.files import delete, file_system
from clickmeter.streaming import answering, archiving, hotads, intake
from clickmeter.streaming import counting as stream_counting

Query = Callable[[SparkSession, str], DataFrame]

# The scene: reconciliation has reached MIDDLE, in the middle of an hour.
EARLIEST = periods.parse("2023-12-31T00:00:00Z")
PERIOD_START = periods.parse("2024-01-08T06:30:00Z")
MIDDLE = periods.parse("2024-01-16T12:30:00Z")
LATEST = periods.parse("2024-02-02T00:00:00Z")
AS_OF = "2024-01-31T12:00:00Z"


def as_of() -> Column:
    return instant(F.lit(AS_OF))


def stream_rows(raw: DataFrame) -> DataFrame:
    """What the minute counter leaves behind: every delivery counted."""
    return reconcile.typed(counting.minute_counts(raw)).select(
        "campaign_id",
        "minute_bucket",
        "click_count",
        F.lit("stream").alias("source"),
        as_of().alias("updated_at"),
    )


def stored_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Stream rows, replaced by exact ones up to MIDDLE."""
    raw = given.raw_clicks(spark, folder)
    exact = reconcile.recompute(
        raw.where(archive.bucket_between(periods.text(EARLIEST), periods.text(MIDDLE)))
    )
    return merging.swap_period(
        stream_rows(raw), reconcile.typed(exact), EARLIEST, MIDDLE, as_of()
    )


def as_text(rows: DataFrame) -> DataFrame:
    """Aggregate rows with the bucket as text, for comparison."""
    bucket = "bucket_start" if "bucket_start" in rows.columns else "minute_bucket"
    return rows.withColumn(bucket, iso(F.col(bucket))).drop("updated_at", "dt", "hr")


def recompute_minute(spark, folder):
    return reconcile.recompute(given.raw_clicks(spark, folder))


def recompute_shipments(spark, folder):
    return reconcile.recompute(given.shipment_clicks(spark, folder))


def recompute_keep_last(spark, folder):
    return reconcile.recompute(given.raw_clicks(spark, folder), keep="last")


def recompute_salted(spark, folder):
    survivors = dedup.one_per_impression(
        given.raw_clicks(spark, folder).select(
            "impression_id", "ingest_ts", "minute_bucket", "campaign_id"
        )
    )
    return counting.salted_minute_counts(survivors)


def surviving_clicks(spark, folder):
    return dedup.one_per_impression(given.raw_clicks(spark, folder)).drop("user_agent")


def ground_truth_distinct(spark, folder):
    return counting.distinct_minute_counts(given.raw_clicks(spark, folder))


def period_scan(spark, folder):
    start, end = periods.text(PERIOD_START), periods.text(MIDDLE)
    return (
        given.raw_clicks(spark, folder)
        .where(archive.partitions_of(start, end) & archive.bucket_between(start, end))
        .select("event_id", "campaign_id", "minute_bucket", "dt", "hr")
    )


def minute_floor(spark, folder):
    return given.events(spark, folder).select(
        "event_id", minute_bucket(F.col("ts").cast("timestamp")).alias("minute_bucket")
    )


def bucket_valid(spark, folder):
    requests = given.click_requests(spark, folder)
    return requests.select("request_id", "click_ts", is_bucket(F.col("click_ts")).alias("valid"))


def capture_outcomes(spark, folder):
    return capture.outcomes(given.click_requests(spark, folder), given.ads(spark, folder))


def capture_events(spark, folder):
    return capture.click_events(
        given.click_requests(spark, folder), given.ads(spark, folder)
    ).drop("user_agent")


def first_click_48h(spark, folder):
    clicks = given.raw_clicks(spark, folder).select(
        "impression_id",
        "event_id",
        instant(F.col("ingest_ts")).alias("received_at"),
        instant(F.col("click_ts")).alias("clicked_at"),
    )
    return dedup.first_clicks(clicks, ["event_id"]).select("impression_id", "event_id", "arrival")


def rejected_clicks(spark, folder):
    return capture.rejected_clicks(
        given.raw_clicks(spark, folder), given.ads(spark, folder)
    ).select("event_id", "ad_id")


def flawed_clicks(spark: SparkSession, folder: str) -> DataFrame:
    """Raw clicks with a flaw each, chosen by the arrival second."""
    digit = F.substring("ingest_ts", 19, 1)
    return given.raw_clicks(spark, folder).withColumns(
        {
            "impression_id": F.when(digit == "0", F.lit(None))
            .when(digit == "1", F.lit(""))
            .otherwise(F.col("impression_id")),
            "click_ts": F.when(digit == "7", F.lit("soon")).otherwise(F.col("click_ts")),
            "minute_bucket": F.when(
                digit == "2", F.concat(F.substring("minute_bucket", 1, 17), F.lit("42Z"))
            ).otherwise(F.col("minute_bucket")),
            "campaign_id": F.when(digit.isin("1", "3"), F.lit(None)).otherwise(
                F.col("campaign_id")
            ),
        }
    )


def event_violations(spark, folder):
    return (
        flawed_clicks(spark, folder)
        .withColumn("found", event_functions.violations())
        .where(F.size("found") > 0)
        .select("event_id", F.array_join("found", "; ").alias("findings"))
    )


def schema_violations(spark, folder):
    """Raw clicks as JSON, some with a field too many, a number for text, or none at all."""
    digit = F.substring("ingest_ts", 19, 1)
    text = F.when(digit == "4", F.lit("{broken")).otherwise(
        F.concat(
            F.expr("substring(whole, 1, length(whole) - 1)"),
            F.when(digit == "5", F.lit(',"referrer":"x"')).otherwise(F.lit("")),
            F.when(digit == "6", F.lit(',"user_agent":7')).otherwise(F.lit("")),
            F.lit("}"),
        )
    )
    return (
        flawed_clicks(spark, folder)
        .withColumn("whole", event_functions.event_json())
        .select("event_id", event_functions.schema_violations(text).alias("found"))
        .where(F.size("found") > 0)
        .select("event_id", F.array_join("found", "; ").alias("findings"))
    )


def event_json(spark, folder):
    return given.raw_clicks(spark, folder).select(
        "event_id", event_functions.event_json().alias("event")
    )


def catalog_quality(spark, folder):
    flawed = given.ads(spark, folder).withColumns(
        {
            "destination_url": F.when(
                F.col("active"), F.col("destination_url")
            ).otherwise(F.replace("destination_url", F.lit("https"), F.lit("http"))),
            "campaign_id": F.when(F.col("campaign_id") != "camp_7", F.col("campaign_id")),
        }
    )
    return catalog.catalog_findings(flawed).select(
        "ad_id", F.array_join("findings", "; ").alias("findings")
    )


def catalog_upsert(spark, folder):
    """The catalog after the ads of one campaign were switched off and moved."""
    ads = given.ads(spark, folder)
    changed = ads.where("campaign_id = 'camp_3'").withColumns(
        {"active": F.lit(False), "destination_url": F.lit("https://example.com/closed")}
    )
    added = changed.withColumn("ad_id", F.concat("ad_id", F.lit("_b")))
    return catalog.upsert_ads(ads, changed.unionByName(added))


def advertiser_campaigns(spark, folder):
    ads = given.ads(spark, folder)
    return ownership.campaigns_of(ads, ads.select("advertiser_id").distinct())


def aggregate_key_unique(spark, folder):
    """Keys held twice if exact rows were added without removing the stream rows."""
    exact = reconcile.typed(recompute_minute(spark, folder)).withColumn("source", F.lit("batch"))
    both = stream_rows(given.raw_clicks(spark, folder)).drop("updated_at").unionByName(exact)
    return as_text(merging.repeated_keys(both))


def metrics_judged(spark, folder):
    judged = metrics.judged_requests(given.metrics_requests(spark, folder), given.ads(spark, folder))
    return judged.select("request_id", "advertiser_id", "status", "reason", "granularity")


def _readable_requests(spark, folder):
    return given.metrics_requests(spark, folder).withColumns(
        {
            "advertiser_id": metrics.bearer_principal(F.col("authorization")),
            "start": instant(F.col("from")),
            "end": instant(F.col("to")),
        }
    )


def owned_campaigns(spark, folder):
    return ownership.owned(
        _readable_requests(spark, folder), given.ads(spark, folder)
    ).select("request_id", "advertiser_id", "campaign_id")


def denied_requests(spark, folder):
    return ownership.not_owned(
        _readable_requests(spark, folder), given.ads(spark, folder)
    ).select("request_id", "advertiser_id", "campaign_id")


def effective_granularity(spark, folder):
    start, end = F.col("start"), F.col("end")
    ranged = _readable_requests(spark, folder).where("end > start")
    return ranged.select(
        "request_id",
        *[
            metrics.bucket_count(start, end, F.lit(unit)).alias(f"{unit}s")
            for unit in ("minute", "hour", "day")
        ],
        metrics.effective_granularity(start, end, F.lit("minute")).alias("of_minute"),
        metrics.effective_granularity(start, end, F.lit("hour")).alias("of_hour"),
        metrics.effective_granularity(start, end, F.lit("day")).alias("of_day"),
        iso(floor_to(F.lit("hour"), start)).alias("hour_floor"),
    )


def rollup_hour(spark, folder):
    return as_text(rollup(stored_rows(spark, folder), "hour"))


def rollup_day(spark, folder):
    return as_text(rollup(stored_rows(spark, folder), "day"))


def rollup_day_from_hours(spark, folder):
    return as_text(rollup(rollup(stored_rows(spark, folder), "hour"), "day"))


def rollup_min_source(spark, folder):
    return as_text(rollup(stored_rows(spark, folder), "day", "min"))


def metrics_series(spark, folder):
    return metrics.metrics(
        given.metrics_requests(spark, folder), given.ads(spark, folder), stored_rows(spark, folder)
    )


def metrics_series_min_source(spark, folder):
    return metrics.metrics(
        given.metrics_requests(spark, folder),
        given.ads(spark, folder),
        stored_rows(spark, folder),
        "min",
    )


def metrics_responses(spark, folder):
    return metrics.responses(
        given.metrics_requests(spark, folder), given.ads(spark, folder), stored_rows(spark, folder)
    )


def campaign_series(spark, folder):
    """One campaign's week at hour grain, cut at both ends."""
    return metrics.campaign_series(
        stored_rows(spark, folder),
        "camp_3",
        periods.parse("2024-01-13T05:20:30Z"),
        periods.parse("2024-01-20T07:45:10Z"),
        "hour",
    )


def _upsert(spark, folder, protect_batch):
    """Exact counts put in: those of one campaign move to keys that are not stored yet."""
    stored = stored_rows(spark, folder)
    moved = F.when(F.col("campaign_id") == "camp_1", F.lit("camp_1_new"))
    new = reconcile.typed(recompute_minute(spark, folder)).withColumns(
        {
            "campaign_id": F.coalesce(moved, "campaign_id"),
            "source": F.lit("stream"),
            "updated_at": as_of(),
        }
    )
    return as_text(merging.upsert(stored, new, protect_batch))


def upsert_protected(spark, folder):
    return _upsert(spark, folder, True)


def upsert_literal(spark, folder):
    return _upsert(spark, folder, False)


def period_swap(spark, folder):
    exact = reconcile.recompute(period_scan_rows(spark, folder))
    return as_text(
        merging.swap_period(
            stream_rows(given.raw_clicks(spark, folder)),
            reconcile.typed(exact),
            PERIOD_START,
            MIDDLE,
            as_of(),
        )
    )


def period_scan_rows(spark: SparkSession, folder: str) -> DataFrame:
    start, end = periods.text(PERIOD_START), periods.text(MIDDLE)
    return given.raw_clicks(spark, folder).where(archive.bucket_between(start, end))


def phantom_removed(spark, folder):
    """Stored rows of a campaign that never had a click are gone after the swap."""
    stream = stream_rows(given.raw_clicks(spark, folder))
    phantoms = stream.withColumn("campaign_id", F.concat(F.lit("ghost_"), "campaign_id"))
    exact = reconcile.recompute(period_scan_rows(spark, folder))
    return as_text(
        merging.swap_period(
            stream.unionByName(phantoms),
            reconcile.typed(exact),
            PERIOD_START,
            MIDDLE,
            as_of(),
        )
    )


def drift_report(spark, folder):
    """Stored rows against the archive: what the stream over-counted, and injected drift."""
    stored = stored_rows(spark, folder)
    wrong = stored.withColumn(
        "click_count",
        F.col("click_count") + F.when(F.col("campaign_id") == "camp_1", 999).otherwise(0),
    )
    return as_text(reconcile.drift(wrong, given.raw_clicks(spark, folder)))


def last_closed_hour(spark, folder):
    fired = F.col("ts").cast("timestamp")
    hour_start, hour_end = reconcile.last_closed(fired)
    day_start, day_end = reconcile.last_closed(fired, "day")
    return given.events(spark, folder).select(
        "event_id",
        iso(hour_start).alias("hour_start"),
        iso(hour_end).alias("hour_end"),
        iso(day_start).alias("day_start"),
        iso(day_end).alias("day_end"),
    )


def captured_per_day(spark, folder):
    return counting.captured_per_day(given.raw_clicks(spark, folder))


def _captured_archive(spark, folder):
    """The events of the capture query, archived and read back."""
    path = scratch_folder(spark, "captured")
    archive.write_archive(capture_events(spark, folder).withColumn("user_agent", F.lit("")), path)
    return archive.read_archive(spark, path)


def no_loss_audit(spark, folder):
    return audits.loss_audit(capture_outcomes(spark, folder), _captured_archive(spark, folder))


def loss_found(spark, folder):
    """The same with the clicks of one campaign lost on the way."""
    left = _captured_archive(spark, folder).where("campaign_id <> 'camp_1'")
    return audits.loss_audit(capture_outcomes(spark, folder), left)


def unmatched_impressions(spark, folder):
    """Accepted impressions against the raw clicks, which hold inactive ads but no signups."""
    accepted = capture_outcomes(spark, folder).where("status = 302")
    return audits.unmatched_impressions(accepted, given.raw_clicks(spark, folder))


def outcome_tally(spark, folder):
    return audits.outcome_tally(capture_outcomes(spark, folder))


def hot_ads(spark, folder):
    found = audits.hot_ads(given.raw_clicks(spark, folder), 0.001)
    return found.withColumn("share", F.round("share", 9))


def delays(spark: SparkSession, folder: str) -> DataFrame:
    return given.raw_clicks(spark, folder).withColumn(
        "delay",
        audits.delay_seconds(instant(F.col("click_ts")), instant(F.col("ingest_ts"))),
    )


def freshness_p95(spark, folder):
    return audits.rank_percentile(delays(spark, folder), "delay")


def freshness_p95_by_campaign(spark, folder):
    return audits.rank_percentile(delays(spark, folder), "delay", by=["campaign_id"])


def delay_outliers_p95(spark, folder):
    """Delays in microseconds with one that is far off, by campaign: no width of ranges fits them all."""
    micros = F.col("delay") * 1_000_003 + F.col("event_id").cast("long") % 997
    far = F.when(F.col("event_id").cast("long") % 5003 == 11, F.lit(10**15)).otherwise(micros)
    samples = delays(spark, folder).withColumn("micros", far)
    steps = samples.groupBy("campaign_id", "micros").agg(F.count(F.lit(1)).alias("n"))
    return selection.value_of_rank(steps, "micros", ["campaign_id"], lambda n: F.floor(n * F.lit(0.95)), few=4, ranges=8)


def _counted_weeks(spark: SparkSession, folder: str) -> tuple[AggregateTable, DataFrame]:
    """The table after each week of clicks was counted with the time of its end, and the clicks."""
    root = scratch_folder(spark, "weeks")
    table = AggregateTable(spark, f"{root}/table").create()
    raw = given.raw_clicks(spark, folder)
    for number in range(5):
        text = raw.where(_week() == number).select(event_functions.event_json().alias("value"))
        text.write.mode("append").text(f"{root}/clicks")
        records = clickstream.read_json_folder(spark, f"{root}/clicks")
        end = instant(F.lit(f"2024-01-{7 * number + 7:02}T00:00:00Z" if number < 4 else "2024-02-04T00:00:00Z"))
        _once(stream_counting.start_counting(records, table, f"{root}/checkpoint", trigger=ONCE, as_of=end))
    return table, raw


def freshness_visible(spark, folder):
    """Capture to visible row, by the times that the published table holds."""
    table, raw = _counted_weeks(spark, folder)
    return audits.rank_percentile(audits.freshness(raw, table.read()), "delay", weight="clicks")


def captured_from_sketches(spark, folder):
    """Days from the stored summaries of their hours, and whether they are as close as stated."""
    path = scratch_folder(spark, "sketches")
    raw = given.raw_clicks(spark, folder)
    sketches.write_sketches(sketches.hour_sketches(raw), path)
    days = sketches.merged(sketches.read_sketches(spark, path), ["dt"])
    exact = counting.captured_per_day(raw).withColumnRenamed("captured", "exact")
    close = F.abs(F.col("captured") - F.col("exact")) <= 1 + 3 * sketches.DISTINCT_ERROR * F.col("exact")
    return days.join(exact, "dt").select("dt", "clicks", "exact", close.alias("close"))


def delays_from_sketches(spark, folder):
    """The month's delay from the summaries of its hours: the share of samples up to it is near the fraction."""
    path = scratch_folder(spark, "sketches")
    sketches.write_sketches(sketches.hour_sketches(given.raw_clicks(spark, folder)), path)
    month = sketches.merged(sketches.read_sketches(spark, path), [])
    told = month.select(F.col("delay").alias("told"))
    share = F.avg((F.col("delay") <= F.col("told")).cast("double"))
    below = F.avg((F.col("delay") < F.col("told")).cast("double"))
    near = (share >= 0.95 - sketches.RANK_ERROR) & (below <= 0.95 + sketches.RANK_ERROR)
    return delays(spark, folder).withColumn("told", told.scalar()).agg(F.count(F.lit(1)).alias("samples"), near.alias("near"))


def source_mix(spark, folder):
    return audits.source_mix(stored_rows(spark, folder))


def retained_archive(spark, folder):
    on = instant(F.lit("2024-02-12T00:00:00Z"))
    return archive.retained(given.raw_clicks(spark, folder), on).select("event_id", "dt")


def expired_archive(spark, folder):
    """The archive after its days past retention were removed."""
    path = scratch_folder(spark, "archive")
    archive.write_archive(given.raw_clicks(spark, folder), path)
    archive.drop_expired(spark, path, date(2024, 2, 12))
    return archive.read_archive(spark, path).select("event_id", "dt")


def salted_keys(spark, folder):
    """Clicks of each ad over its salted keys, and whether all salts are in range."""
    key = salted_key(F.col("ad_id"), F.col("event_id"))
    salts = given.raw_clicks(spark, folder).select("ad_id", key.alias("key")).groupBy("ad_id", "key").agg(F.count(F.lit(1)).alias("n"))
    sound = F.col("key") == F.concat_ws(":", "ad_id", F.regexp_extract("key", ":([0-7])$", 1))
    return salts.groupBy("ad_id").agg(F.sum("n").alias("clicks"), F.bool_and(sound).alias("sound"))


def reconciled_now(spark, folder):
    """Without a given time, rows hold the time at which they were reconciled or counted."""
    root = scratch_folder(spark, "now")
    raw = given.raw_clicks(spark, folder)
    archive.write_archive(raw, f"{root}/raw")
    table = AggregateTable(spark, f"{root}/table").create()
    table.upsert(stream_rows(raw), F.current_timestamp())
    reconcile.reconcile(spark, f"{root}/raw", f"{root}/table", PERIOD_START, MIDDLE)
    age = F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp("updated_at")
    return as_text(table.read().withColumn("recent", age.between(0, 3600)))


def archive_roundtrip(spark, folder):
    """Written to the archive, then a period read back from its folders."""
    path = scratch_folder(spark, "archive")
    archive.write_archive(given.raw_clicks(spark, folder), path)
    return archive.read_period(
        spark, path, periods.text(PERIOD_START), periods.text(MIDDLE)
    ).drop("user_agent")


def reconcile_published(spark, folder):
    """Stream rows published, then a period reconciled from the archive on top."""
    root = scratch_folder(spark, "reconcile")
    raw = given.raw_clicks(spark, folder)
    archive.write_archive(raw, f"{root}/raw")
    table = AggregateTable(spark, f"{root}/table").create()
    table.upsert(stream_rows(raw), as_of())
    reconcile.reconcile(
        spark, f"{root}/raw", f"{root}/table", PERIOD_START, MIDDLE, as_of=as_of()
    )
    return as_text(table.read())


def drift_corrected(spark, folder):
    """Wrong counts published, then the period reconciled: those inside it are exact again."""
    root = scratch_folder(spark, "drifted")
    raw = given.raw_clicks(spark, folder)
    archive.write_archive(raw, f"{root}/raw")
    table = AggregateTable(spark, f"{root}/table").create()
    wrong = F.col("click_count") + F.when(F.col("campaign_id") == "camp_1", 999).otherwise(0)
    table.upsert(stream_rows(raw).withColumn("click_count", wrong), as_of())
    reconcile.reconcile(
        spark, f"{root}/raw", f"{root}/table", PERIOD_START, MIDDLE, as_of=as_of()
    )
    return as_text(table.read())


def outcomes_redelivered(spark, folder):
    """Every request delivered twice: one delivery of an accepted click is the emitted one."""
    requests = given.click_requests(spark, folder)
    return capture.outcomes(requests.unionByName(requests), given.ads(spark, folder))


def archive_table_scan(spark, folder):
    """The archive as a table, with the hours a stream and a batch job wrote."""
    root = scratch_folder(spark, "table")
    raw = given.raw_clicks(spark, folder)
    _once(
        archiving.start_archiving(
            _records(spark, folder), f"{root}/raw", f"{root}/bad", f"{root}/c", {"availableNow": True}
        )
    )
    archive.write_archive(raw, f"{root}/raw")
    name = f"raw_clicks_{root[-32:]}"
    archive.create_archive_table(spark, name, f"{root}/raw")
    return spark.table(name).groupBy("dt", "hr").agg(F.count(F.lit(1)).alias("clicks"))


def reconcile_lookback(spark, folder):
    """The period's counts without clicks repeated from the two days before it."""
    path = scratch_folder(spark, "archive")
    archive.write_archive(given.raw_clicks(spark, folder), path)
    return reconcile.recompute_period(
        spark, path, PERIOD_START, MIDDLE, lookback=timedelta(hours=48)
    )


def lookback_by_index(spark, folder):
    """The same counts, with earlier hours read only where the impression index has a hit."""
    root = scratch_folder(spark, "archive")
    raw = given.raw_clicks(spark, folder)
    archive.write_archive(raw, f"{root}/raw")
    reconcile.write_impression_index(raw, f"{root}/index")
    return reconcile.recompute_by_index(
        spark, f"{root}/raw", f"{root}/index", PERIOD_START, MIDDLE, lookback=timedelta(hours=48)
    )


def _once(query_or_queries) -> None:
    started = query_or_queries if isinstance(query_or_queries, list) else [query_or_queries]
    for query in started:
        query.awaitTermination()


def _records(spark: SparkSession, folder: str) -> DataFrame:
    """Clicks of the event stream as JSON records."""
    return given.raw_clicks(spark, folder, given.event_stream(spark, folder)).select(
        event_functions.event_json().alias("value")
    )


def _count_stream(spark, records, table, checkpoint):
    _once(
        stream_counting.start_counting(
            records, table, checkpoint, trigger={"availableNow": True}, as_of=as_of()
        )
    )


def stream_minute_counts(spark, folder):
    root = scratch_folder(spark, "counter")
    table = AggregateTable(spark, f"{root}/table").create()
    _count_stream(spark, _records(spark, folder), table, f"{root}/checkpoint")
    return as_text(table.read())


def stream_replay_idempotent(spark, folder):
    """The whole stream counted again from a lost checkpoint leaves the same rows."""
    root = scratch_folder(spark, "counter")
    table = AggregateTable(spark, f"{root}/table").create()
    for attempt in ("first", "second"):
        _count_stream(spark, _records(spark, folder), table, f"{root}/{attempt}")
    return as_text(table.read())


def _week() -> Column:
    week = F.floor(F.datediff(F.to_date(F.substring("minute_bucket", 1, 10)), F.lit("2023-12-31")) / 7)
    return F.greatest(F.lit(0), F.least(F.lit(4), week))


def _count_weeks(spark: SparkSession, folder: str, again: list[int]) -> DataFrame:
    """Clicks arriving week by week, with the counter stopped and started after each.

    Weeks given `again` arrive once more at the end, as clicks of other impressions.
    """
    root = scratch_folder(spark, "weeks")
    table = AggregateTable(spark, f"{root}/table").create()
    raw = given.raw_clicks(spark, folder)
    for number, chosen in enumerate([*range(5), *again]):
        rows = raw.where(_week() == chosen)
        if number >= 5:
            rows = rows.withColumn("impression_id", F.concat("impression_id", F.lit("_late")))
        text = rows.select(event_functions.event_json().alias("value"))
        text.write.mode("append").text(f"{root}/clicks")
        records = clickstream.read_json_folder(spark, f"{root}/clicks")
        _count_stream(spark, records, table, f"{root}/checkpoint")
    return as_text(table.read())


def stream_restart(spark, folder):
    return _count_weeks(spark, folder, [])


def stream_late_rows(spark, folder):
    """Clicks that come weeks too late are left to reconciliation."""
    return _count_weeks(spark, folder, [0, 2])


def _shuffled_clicks(spark: SparkSession, folder: str) -> str:
    """A folder of files in which clicks lie by arrival, up to 99 seconds out of order."""
    path = scratch_folder(spark, "shuffled")
    text = given.raw_clicks(spark, folder).withColumn("value", event_functions.event_json())
    for day in ("2024-01-01", "2024-01-09", "2024-01-17", "2024-01-25"):
        after = (date.fromisoformat(day) + timedelta(days=8)).isoformat()
        part = text.where(F.col("ingest_ts").between(day, after) & (F.col("ingest_ts") < after))
        part.repartition(3).sortWithinPartitions(F.xxhash64("event_id")).select("value").write.mode("append").text(path)
    return path


def stream_out_of_order(spark, folder):
    """Batches of a file each, out of order within the allowed delay: every click in its own minute."""
    root = scratch_folder(spark, "counter")
    records = clickstream.read_json_folder(spark, _shuffled_clicks(spark, folder), files_per_batch=3)
    table = AggregateTable(spark, f"{root}/table").create()
    _once(stream_counting.start_counting(records, table, f"{root}/c", trigger=ONCE, as_of=as_of(), delay="9 days"))
    return as_text(table.read())


def stream_two_consumers(spark, folder):
    """The counter and the archiver on one stream, each with a checkpoint of its own."""
    root = scratch_folder(spark, "fan-out")
    records = clickstream.read_json_folder(spark, _shuffled_clicks(spark, folder), files_per_batch=3)
    table = AggregateTable(spark, f"{root}/table").create()
    queries = [stream_counting.start_counting(records, table, f"{root}/c", trigger=ONCE, as_of=as_of(), delay="9 days")]
    queries += archiving.start_archiving(records, f"{root}/raw", f"{root}/bad", f"{root}/a", ONCE, as_of())
    _once(queries)
    archived = counting.minute_counts(archive.read_archive(spark, f"{root}/raw")).withColumnRenamed("click_count", "archived")
    counted = as_text(table.read()).select(*merging.KEY, F.col("click_count").alias("counted"))
    return archived.join(counted, merging.KEY, "full_outer")


HOT_SHARE = 0.02


def stream_hot_ads(spark, folder):
    """Hot ads of every day that is over, watched as they came and counted in the archive."""
    root = scratch_folder(spark, "watch")
    _once(hotads.start_watching(_records(spark, folder), f"{root}/hot", f"{root}/c", HOT_SHARE, "1 day", ONCE))
    found = hotads.hot_ads_of_windows(spark, f"{root}/hot", given.raw_clicks(spark, folder), HOT_SHARE, "1 day")
    return found.select(iso(F.col("window_start")).alias("window_start"), "ad_id", "clicks", F.round("share", 9).alias("share"))


#: The clock of streamed requests: all given times lie before it.
CLOCK = "2024-02-05T00:00:00Z"
ONCE = {"availableNow": True}


def _capture(spark: SparkSession, requests: DataFrame, catalog, root: str) -> None:
    """Both stages of capture, one after the other, until the requests are used up."""
    clock = instant(F.lit(CLOCK))
    _once(intake.start_taking(requests, catalog, root, f"{root}/c1", ONCE, clock))
    _once(answering.start_answering(spark, root, f"{root}/events", f"{root}/c2", ONCE))


def _captured(spark: SparkSession, folder: str) -> str:
    root = scratch_folder(spark, "capture")
    requests = given.click_requests(spark, folder, given.event_stream(spark, folder))
    _capture(spark, requests, lambda session: given.ads(session, folder), root)
    return root


def stream_capture_events(spark, folder):
    return answering.read_events(spark, f"{_captured(spark, folder)}/events").drop("user_agent")


def stream_outcomes(spark, folder):
    """What streaming capture answers every request."""
    return answering.read_outcomes(spark, _captured(spark, folder))


def untimely_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Requests with their `delivery`: some are dated into the future, some come weeks late.

    Late ones are of impressions of their own: of one that a stream has counted meanwhile, the
    count stays with the click that came in time.
    """
    at, number = instant(F.col("received_at")), F.col("request_id").cast("long")
    ahead = number % 31 == 3
    late = (number % 40 == 7) & (F.col("received_at") < "2024-01-10") & ~ahead
    return given.click_requests(spark, folder).withColumns(
        {
            "delivery": F.when(late, 3).when(F.col("received_at") < "2024-01-20", 1).otherwise(2),
            "impression_id": F.when(late, F.concat("impression_id", F.lit("_late"))).otherwise(F.col("impression_id")),
            "received_at": F.when(ahead, iso(at + F.expr("INTERVAL 7 YEARS"))).otherwise(F.col("received_at")),
        }
    )


def _delivered(spark: SparkSession, requests: DataFrame, catalogs: dict, root: str) -> None:
    """Capture of deliveries, each with the catalog of its time; stopped and started between them."""
    for number, catalog in catalogs.items():
        requests.where(F.col("delivery") == number).drop("delivery").write.mode("append").json(f"{root}/requests")
        stream = spark.readStream.schema(CLICK_REQUEST).json(f"{root}/requests")
        _capture(spark, stream, catalog, root)


def _untimely(spark: SparkSession, folder: str) -> str:
    root = scratch_folder(spark, "untimely")
    catalog = lambda session: given.ads(session, folder)
    _delivered(spark, untimely_requests(spark, folder), dict.fromkeys((1, 2, 3), catalog), root)
    return root


def stream_untimely_events(spark, folder):
    """Events of the stream together with those settled: as if all had come in time."""
    root = _untimely(spark, folder)
    late = settling.settled_events(spark, root, f"{root}/events")
    return answering.read_events(spark, f"{root}/events").unionByName(late).drop("user_agent")


def stream_untimely_outcomes(spark, folder):
    root = _untimely(spark, folder)
    late = settling.settled_outcomes(spark, root, f"{root}/events")
    return answering.read_outcomes(spark, root).unionByName(late)


def stream_set_aside(spark, folder):
    """Which requests the stream leaves to settling."""
    return settling.set_aside(spark, _untimely(spark, folder)).select("request_id", "impression_id", "kind")


def stream_catalog_change(spark, folder):
    """The ads of a campaign are switched off, and one is moved, between two deliveries."""
    root = scratch_folder(spark, "catalog")
    off = F.when(F.col("campaign_id") == "camp_3", F.lit(False)).otherwise(F.col("active"))
    moved = F.when(F.col("campaign_id") == "camp_5", F.lit("https://example.com/moved")).otherwise(F.col("destination_url"))
    catalogs = {
        1: lambda session: given.ads(session, folder),
        2: lambda session: given.ads(session, folder).withColumns({"active": off, "destination_url": moved}),
    }
    second = F.col("received_at") >= "2024-01-20"
    requests = given.click_requests(spark, folder).withColumn("delivery", F.when(second, 2).otherwise(1))
    _delivered(spark, requests, catalogs, root)
    return answering.read_outcomes(spark, root)


def _archive_stream(spark, folder, times=1):
    """Flawed clicks and broken text archived from the stream; the two folders.

    For more than one time the batch's commits are forgotten in between, as by a crash after
    all was written, so that it is worked on again.
    """
    root = scratch_folder(spark, "archiver")
    digit = F.substring("ingest_ts", 19, 1)
    raw = given.raw_clicks(spark, folder, given.event_stream(spark, folder))
    text = F.when(digit == "4", F.lit("{broken")).otherwise(event_functions.event_json())
    records = raw.withColumn(
        "impression_id", F.when(digit != "0", F.col("impression_id"))
    ).select(text.alias("value"))
    fs, _ = file_system(spark, root)
    for _ in range(times):
        for part in ("archive", "errors"):
            delete(fs, spark, f"{root}/checkpoint/{part}/commits")
        _once(
            archiving.start_archiving(
                records, f"{root}/raw", f"{root}/errors", f"{root}/checkpoint", ONCE, as_of()
            )
        )
    return f"{root}/raw", f"{root}/errors"


def archive_stream(spark, folder):
    raw, _ = _archive_stream(spark, folder)
    return archive.read_archive(spark, raw).drop("user_agent")


def _error_counts(spark, path):
    return archive.read_errors(spark, path).groupBy("error_type", "dt").agg(F.count(F.lit(1)).alias("records"))


def archive_errors(spark, folder):
    _, errors = _archive_stream(spark, folder)
    return _error_counts(spark, errors)


def archive_repeated_batch(spark, folder):
    """A batch that is worked on twice leaves each row once."""
    raw, _ = _archive_stream(spark, folder, 2)
    return archive.read_archive(spark, raw).drop("user_agent")


def archive_repeated_errors(spark, folder):
    _, errors = _archive_stream(spark, folder, 2)
    return _error_counts(spark, errors)


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        recompute_minute,
        recompute_shipments,
        recompute_salted,
        recompute_keep_last,
        surviving_clicks,
        ground_truth_distinct,
        period_scan,
        minute_floor,
        bucket_valid,
        capture_outcomes,
        capture_events,
        first_click_48h,
        rejected_clicks,
        event_violations,
        schema_violations,
        event_json,
        catalog_quality,
        catalog_upsert,
        advertiser_campaigns,
        aggregate_key_unique,
        metrics_judged,
        owned_campaigns,
        denied_requests,
        effective_granularity,
        rollup_hour,
        rollup_day,
        rollup_day_from_hours,
        rollup_min_source,
        metrics_series,
        metrics_series_min_source,
        metrics_responses,
        campaign_series,
        upsert_protected,
        upsert_literal,
        period_swap,
        phantom_removed,
        drift_report,
        last_closed_hour,
        captured_per_day,
        no_loss_audit,
        loss_found,
        unmatched_impressions,
        outcome_tally,
        hot_ads,
        freshness_p95,
        freshness_p95_by_campaign,
        freshness_visible,
        delay_outliers_p95,
        captured_from_sketches,
        delays_from_sketches,
        source_mix,
        retained_archive,
        expired_archive,
        salted_keys,
        reconciled_now,
        archive_roundtrip,
        reconcile_published,
        reconcile_lookback,
        lookback_by_index,
        drift_corrected,
        outcomes_redelivered,
        archive_table_scan,
        stream_minute_counts,
        stream_replay_idempotent,
        stream_restart,
        stream_late_rows,
        stream_out_of_order,
        stream_two_consumers,
        stream_hot_ads,
        stream_capture_events,
        stream_outcomes,
        stream_untimely_events,
        stream_untimely_outcomes,
        stream_set_aside,
        stream_catalog_change,
        archive_stream,
        archive_errors,
        archive_repeated_batch,
        archive_repeated_errors,
    )
}


def prepared(query: Query) -> Query:
    """The query on a UTC session."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return query(utc(spark), folder)

    return run
