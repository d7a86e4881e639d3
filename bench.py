"""Timings of the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmeter import periods
from clickmeter.plans import metrics, reconcile
from clickmeter.session import scratch_folder, utc
from clickmeter.sources import archive, given
from clickmeter.sources.aggregates import AggregateTable
from verification import queries as q

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
DAY = periods.parse("2024-01-10T00:00:00Z")


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("clickmeter-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return utc(spark)


def drain(rows: DataFrame) -> None:
    rows.write.format("noop").mode("overwrite").save()


def p95(run, times: int = 100) -> float:
    """Time of the slower runs of a request repeated in a row, the first one left out."""
    run(0)
    taken = []
    for number in range(times):
        started = time.perf_counter()
        run(number)
        taken.append(time.perf_counter() - started)
    return round(sorted(taken)[int(times * 0.95) - 1], 3)


def main() -> None:
    spark = session()
    root = scratch_folder(spark, "bench")
    next_day = DAY + timedelta(days=1)

    # Prepared before the clock starts: an archive around the day, and a stored table.
    around = archive.bucket_between(
        periods.text(DAY - timedelta(days=1)), periods.text(next_day + timedelta(days=1))
    )
    archive.write_archive(given.raw_clicks(spark, FOLDER).where(around), f"{root}/raw")
    stored_path = f"{root}/stored"
    q.stored_rows(spark, FOLDER).write.parquet(stored_path)
    stored = spark.read.parquet(stored_path)
    table = AggregateTable(spark, f"{root}/table").create()
    table.upsert(q.stream_rows(given.raw_clicks(spark, FOLDER)), q.as_of())
    exact = reconcile.typed(reconcile.recompute(given.raw_clicks(spark, FOLDER)))
    table.swap(exact, q.EARLIEST, q.MIDDLE, q.as_of())
    ads = given.ads(spark, FOLDER)
    requests = given.metrics_requests(spark, FOLDER)
    requests.write.parquet(f"{root}/requests")
    hundred = spark.read.parquet(f"{root}/requests").limit(100)
    timed = {
        "recompute_minute": lambda: drain(q.recompute_minute(spark, FOLDER)),
        "recompute_shipments": lambda: drain(q.recompute_shipments(spark, FOLDER)),
        "recompute_salted": lambda: drain(q.recompute_salted(spark, FOLDER)),
        "ground_truth_distinct": lambda: drain(q.ground_truth_distinct(spark, FOLDER)),
        "capture_events": lambda: drain(q.capture_events(spark, FOLDER)),
        "capture_outcomes": lambda: drain(q.capture_outcomes(spark, FOLDER)),
        "rollup_day": lambda: drain(q.rollup(stored, "day")),
        "metrics_100": lambda: drain(metrics.metrics(hundred, ads, stored)),
        "metrics_all": lambda: drain(metrics.metrics(requests, ads, stored)),
        "drift_report": lambda: drain(q.drift_report(spark, FOLDER)),
        "reconcile_day": lambda: reconcile.reconcile(
            spark, f"{root}/raw", f"{root}/table", DAY, next_day, as_of=q.as_of()
        ),
        "stream_count": lambda: q.stream_minute_counts(spark, FOLDER),
        "stream_capture": lambda: q.stream_capture_events(spark, FOLDER),
    }
    drain(given.raw_clicks(spark, FOLDER))

    owners = {r.campaign_id: r.advertiser_id for r in ads.select("campaign_id", "advertiser_id").distinct().collect()}

    def one_request(number: int) -> None:
        """The whole path: token, checks, ownership, and a day of the month that is stored."""
        campaign = sorted(owners)[number % len(owners)]
        request = {
            "request_id": f"r{number}",
            "authorization": f"Bearer {owners[campaign]}",
            "campaign_id": campaign,
            "from": periods.text(DAY),
            "to": periods.text(next_day),
            "granularity": "hour",
        }
        status, _ = metrics.answer(request, ads, table)
        assert status == 200

    seconds = {"metrics_1_p95": p95(one_request)}
    for name, run in timed.items():
        started = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
