"""Command line of the pipelines: `python -m clickmeter.jobs <job> --option value`.

Each job works on the folders and tables it is given. Streams run until stopped, or with
`--once` until their input is used up.
"""

from __future__ import annotations

import argparse
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmeter import periods
from clickmeter.functions.timebucket import instant
from clickmeter.operators import counting as counting_operators
from clickmeter.operators.merging import repeated_keys
from clickmeter.plans import audits, metrics, reconcile, settling, sketches
from clickmeter.plans.capture import answer_columns, as_events
from clickmeter.schemas import AD, CLICK_REQUEST, METRICS_REQUEST
from clickmeter.session import utc
from clickmeter.settings import RETENTION_DAYS, TRIGGER_SECONDS, WATERMARK_DELAY
from clickmeter.sources import archive, catalog, clickstream
from clickmeter.sources.aggregates import AggregateTable
from clickmeter.streaming import answering, archiving, counting, intake


def _trigger(args) -> dict:
    return {"availableNow": True} if args.once else {"processingTime": f"{args.every_seconds} seconds"}


def _records(spark: SparkSession, args) -> DataFrame:
    """JSON records of a folder, or of a topic if one is named."""
    if args.topic:
        return clickstream.read_topic(spark, args.servers, args.topic)
    return clickstream.read_json_folder(spark, args.folder)


def create_tables(spark: SparkSession, args) -> None:
    AggregateTable(spark, args.table).create()
    if args.archive_name:
        archive.create_archive_table(spark, args.archive_name, args.raw_path)


def load_catalog(spark: SparkSession, args) -> None:
    """Write the catalog with the ads of the document put in, to a new folder."""
    ads = catalog.load_catalog(spark, args.document, args.created_at)
    if args.catalog:
        ads = catalog.upsert_ads(spark.read.schema(AD).parquet(args.catalog), ads)
    ads.write.parquet(args.out)


def capture(spark: SparkSession, args) -> None:
    """Both stages: requests to answers below the state folder and to events; the catalog is read for every batch."""
    requests = (
        _records(spark, args)
        .select(F.from_json("value", CLICK_REQUEST).alias("request"))
        .select("request.*")
    )
    ads = lambda session: session.read.schema(AD).parquet(args.catalog)
    trigger = _trigger(args)
    taking = intake.start_taking(requests, ads, args.state, f"{args.checkpoint}/taking", trigger)
    if args.once:
        taking.awaitTermination()
    answers = answering.start_answering(spark, args.state, args.out, f"{args.checkpoint}/answering", trigger)
    _run([taking, answers])


def settle(spark: SparkSession, args) -> None:
    """Write the events and answers of requests that capture has set aside, to a new folder."""
    rows = settling.settled(settling.set_aside(spark, args.state), answering.read_events(spark, args.events))
    rows.write.parquet(f"{args.out}/requests")
    stored = spark.read.schema(answering.ANSWERED).parquet(f"{args.out}/requests")
    stored.select(*answer_columns()).write.json(f"{args.out}/outcomes")
    as_events(stored.where("emitted")).write.json(f"{args.out}/events")


def count(spark: SparkSession, args) -> None:
    counting.start_counting(
        _records(spark, args),
        AggregateTable(spark, args.table).create(),
        args.checkpoint,
        _trigger(args),
        delay=args.delay,
    ).awaitTermination()


def archive_stream(spark: SparkSession, args) -> None:
    """Good records to the archive, others to the error folder."""
    _run(archiving.start_archiving(_records(spark, args), args.raw_path, args.error_path, args.checkpoint, _trigger(args)))


def _run(queries: list) -> None:
    """Until all have ended; if one fails the others are stopped and the job fails."""
    try:
        while any(query.isActive for query in queries):
            for query in queries:
                query.awaitTermination(1)
        for query in queries:
            query.awaitTermination()
    finally:
        for query in queries:
            query.stop()


def expire(spark: SparkSession, args) -> None:
    archive.drop_expired(spark, args.raw_path, datetime.now(UTC).date(), args.days)


def forget(spark: SparkSession, args) -> None:
    """Remove rows of the aggregate table that were replaced some hours ago."""
    AggregateTable(spark, args.table).forget(timedelta(hours=args.hours))


def reconcile_period(spark: SparkSession, args) -> None:
    """The given period, or the last closed hour or day."""
    if args.period_start:
        start, end = periods.parse(args.period_start), periods.parse(args.period_end)
    else:
        start, end = periods.last_closed(datetime.now(UTC), args.cadence)
    lookback = timedelta(hours=args.lookback_hours) if args.lookback_hours else None
    reconcile.reconcile(spark, args.raw_path, args.table, start, end, lookback=lookback)


def answer_metrics(spark: SparkSession, args) -> None:
    """Answer a file of requests, one JSON object per line."""
    requests = spark.read.schema(METRICS_REQUEST).json(args.requests)
    metrics.responses(
        requests,
        spark.read.schema(AD).parquet(args.catalog),
        AggregateTable(spark, args.table).read(*metrics.bounds(requests)),
        args.source_rule,
    ).write.json(args.out)


def _outcomes(spark: SparkSession, args) -> DataFrame:
    return answering.read_outcomes(spark, args.state)


def _raw(spark: SparkSession, args) -> DataFrame:
    return archive.read_archive(spark, args.raw_path)


def _stored(spark: SparkSession, args) -> DataFrame:
    return AggregateTable(spark, args.table).read()


def _delays(spark: SparkSession, args) -> DataFrame:
    ends = (instant(F.col(name)) for name in ("click_ts", "ingest_ts"))
    return _raw(spark, args).withColumn("delay", audits.delay_seconds(*ends))


#: What can be audited, from the archive, the table and the state of capture.
AUDITS = {
    "drift": lambda spark, args: reconcile.drift(_stored(spark, args), _raw(spark, args)),
    "loss": lambda spark, args: audits.loss_audit(_outcomes(spark, args), _raw(spark, args)),
    "impressions": lambda spark, args: audits.unmatched_impressions(
        _outcomes(spark, args).where("status = 302"), _raw(spark, args)
    ),
    "outcomes": lambda spark, args: audits.outcome_tally(_outcomes(spark, args)),
    "hot-ads": lambda spark, args: audits.hot_ads(_raw(spark, args), float(args.threshold)),
    "captured": lambda spark, args: counting_operators.captured_per_day(_raw(spark, args)),
    "truth": lambda spark, args: counting_operators.distinct_minute_counts(_raw(spark, args)),
    "delay": lambda spark, args: audits.rank_percentile(_delays(spark, args), "delay"),
    "freshness": lambda spark, args: audits.rank_percentile(
        audits.freshness(_raw(spark, args), _stored(spark, args)), "delay", weight="clicks"
    ),
    "keys": lambda spark, args: repeated_keys(_stored(spark, args)),
    "sources": lambda spark, args: audits.source_mix(_stored(spark, args)),
}


def audit(spark: SparkSession, args) -> None:
    """Write the findings of one kind of audit as JSON."""
    AUDITS[args.kind](spark, args).write.json(args.out)


def summarise(spark: SparkSession, args) -> None:
    """Add the mergeable summaries of the archive's hours in a period."""
    hours = archive.read_period(spark, args.raw_path, args.period_start, args.period_end)
    sketches.write_sketches(sketches.hour_sketches(hours), args.out, f"{args.period_start}-{args.period_end}".replace(":", ""))


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description=__doc__)
    jobs = parser.add_subparsers(required=True)

    def job(name, run, *required, **optional):
        one = jobs.add_parser(name, help=run.__doc__)
        one.set_defaults(run=run)
        for option in required:
            one.add_argument(f"--{option}", required=True)
        for option, default in optional.items():
            if isinstance(default, bool):
                one.add_argument(f"--{option}", action="store_true")
            else:
                one.add_argument(
                    f"--{option}", default=default, type=int if isinstance(default, int) else str
                )

    stream = {"folder": None, "topic": None, "servers": None, "once": False, "every_seconds": TRIGGER_SECONDS}
    job("create-tables", create_tables, "table", archive_name=None, raw_path=None)
    job("load-catalog", load_catalog, "document", "created_at", "out", catalog=None)
    job("capture", capture, "catalog", "state", "out", "checkpoint", **stream)
    job("settle", settle, "state", "events", "out")
    job("count", count, "table", "checkpoint", delay=WATERMARK_DELAY, **stream)
    job("archive", archive_stream, "raw_path", "error_path", "checkpoint", **stream)
    job("forget", forget, "table", hours=24)
    job("expire", expire, "raw_path", days=RETENTION_DAYS)
    job(
        "reconcile",
        reconcile_period,
        "raw_path",
        "table",
        period_start=None,
        period_end=None,
        cadence="hour",
        lookback_hours=0,
    )
    job("audit", audit, "kind", "out", state=None, raw_path=None, table=None, threshold="0.5")
    job("summarise", summarise, "raw_path", "period_start", "period_end", "out")
    job("metrics", answer_metrics, "requests", "catalog", "table", "out", source_rule="exact")
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = utc(SparkSession.builder.appName("clickmeter").getOrCreate())
    args.run(spark, args)


if __name__ == "__main__":
    main()
