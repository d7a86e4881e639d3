"""Metrics: a table of requests to dense series of clicks.

All requests are answered in one job. Counts are packed into blocks of `BLOCK_UNITS` minutes,
hours or days, and a request's stretches of buckets are matched to blocks by equality on
`(campaign, unit, block)`. Single buckets never go through a join, and no request is ever
paired with all the rows of its campaign: bounds inside a bucket are met by splitting that
one bucket into whole hours and minutes.
"""

from __future__ import annotations

import json
from datetime import UTC, datetime, timedelta
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmeter import periods
from clickmeter.functions.text import bearer_principal, presence
from clickmeter.functions.timebucket import (
    ceil_to,
    floor_to,
    instant,
    iso,
    step_interval,
    step_seconds,
)
from clickmeter.operators.ownership import owned_pairs
from clickmeter.operators.rollup import BATCH_RULES, unit_counts
from clickmeter.schemas import METRICS_REQUEST
from clickmeter.settings import (
    BLOCK_UNITS,
    BUCKETS_PER_TASK,
    DEFAULT_GRANULARITY,
    GRANULARITIES,
    MAX_BUCKETS,
    METRICS_ERROR_DETAILS,
    MOST_TASKS,
    SOURCE_BATCH,
    SOURCE_STREAM,
    STEP_SECONDS,
)
from clickmeter.sources.aggregates import AggregateTable

_STATUS = {
    "unauthenticated": 401,
    "missing_parameter": 400,
    "bad_granularity": 400,
    "bad_range": 400,
    "forbidden": 403,
}
_RESULT = ["bucket_start", "click_count", "source"]
_REQUEST = ["request_id", "campaign_id", "granularity"]
_BUCKET = [*_REQUEST, "bucket_start"]
_STRETCH = ["granularity", "lo", "hi", "held"]


def bucket_count(start: Column, end: Column, granularity: Column) -> Column:
    """Buckets from the floor of `start` up to `end`, a started one counting whole."""
    seconds = F.unix_timestamp(end) - F.unix_timestamp(floor_to(granularity, start))
    return F.ceil(seconds / step_seconds(granularity))


def effective_granularity(start: Column, end: Column, requested: Column) -> Column:
    """The requested granularity, or the first coarser one with few enough buckets.

    Days are never refused.
    """
    chosen = F.lit(GRANULARITIES[-1])
    for unit in reversed(GRANULARITIES[:-1]):
        fits = bucket_count(start, end, F.lit(unit)) <= MAX_BUCKETS
        asked = [g for g in GRANULARITIES if GRANULARITIES.index(g) <= GRANULARITIES.index(unit)]
        chosen = F.when(requested.isin(asked) & fits, F.lit(unit)).otherwise(chosen)
    return chosen


def judged_requests(requests: DataFrame, ads: DataFrame) -> DataFrame:
    """Requests with principal, bounds, effective granularity, `status` and `reason`.

    Tests run in the order principal, campaign, granularity, range, ownership. The
    advertiser comes from the bearer token only.
    """
    pairs = owned_pairs(ads).withColumn("owned", F.lit(True))
    return _judged(_read(requests).join(pairs, ["advertiser_id", "campaign_id"], "left"))


def _read(requests: DataFrame) -> DataFrame:
    return requests.select(*_read_columns())


def _judged(read: DataFrame) -> DataFrame:
    """Read requests by their `owned`."""
    return read.withColumns(_judgements()).drop("owned")


# Building these takes longer than using them, so a service builds them once.
@cache
def _read_columns() -> tuple[Column | str, ...]:
    return (
        "request_id",
        bearer_principal(F.col("authorization")).alias("advertiser_id"),
        presence(F.col("campaign_id")).alias("campaign_id"),
        F.coalesce(presence(F.col("granularity")), F.lit(DEFAULT_GRANULARITY)).alias("requested"),
        instant(F.col("from")).alias("start"),
        instant(F.col("to")).alias("end"),
    )


@cache
def _judgements() -> dict[str, Column]:
    reason = (
        F.when(F.col("advertiser_id").isNull(), "unauthenticated")
        .when(F.col("campaign_id").isNull(), "missing_parameter")
        .when(~F.col("requested").isin(*GRANULARITIES), "bad_granularity")
        .when(~F.coalesce(F.col("end") > F.col("start"), F.lit(False)), "bad_range")
        .when(F.col("owned").isNull(), "forbidden")
    )
    status = F.lit(200)
    for name, code in _STATUS.items():
        status = F.when(reason == name, code).otherwise(status)
    fitted_unit = effective_granularity(F.col("start"), F.col("end"), F.col("requested"))
    return {"reason": reason, "status": status, "granularity": F.when(reason.isNull(), fitted_unit)}


def _before(end: Column) -> Column:
    return end - F.expr("INTERVAL 1 MICROSECOND")


def whole_buckets(accepted: DataFrame) -> DataFrame:
    """The stretch `[lo, hi)` of buckets that no bound of the request cuts, where there is one.

    A minute row counts when its start is within the request, so the end cuts no minute.
    """
    unit = F.col("granularity")
    floor = floor_to(unit, F.col("start"))
    lo = F.when(floor == F.col("start"), floor).otherwise(floor + step_interval(unit))
    hi = floor_to(unit, ceil_to("minute", F.col("end")))
    return accepted.select(*_REQUEST, unit.alias("unit"), lo.alias("lo"), hi.alias("hi")).where("lo < hi")


def cut_buckets(accepted: DataFrame) -> DataFrame:
    """The buckets that a bound cuts: at most the first and the last of a request.

    `lo` and `hi` bound the minutes that count in the bucket.
    """
    unit = F.col("granularity")
    first, last = floor_to(unit, F.col("start")), floor_to(unit, _before(F.col("end")))
    bucket_end = F.col("bucket_start") + step_interval(unit)
    lo = F.greatest("bucket_start", ceil_to("minute", F.col("start")))
    hi = F.least(bucket_end, ceil_to("minute", F.col("end")))
    return (
        accepted.withColumn("bucket_start", F.explode(F.array_distinct(F.array(first, last))))
        .withColumns({"lo": lo, "hi": hi})
        .where((F.col("lo") != F.col("bucket_start")) | (F.col("hi") != bucket_end))
        .select(*_BUCKET, "lo", "hi")
    )


def pieces(cut: DataFrame) -> DataFrame:
    """Split cut buckets into a stretch of whole hours and one of minutes on each side.

    A bucket without any minute keeps its first stretch, an empty one.
    """
    inner_lo = F.least(ceil_to("hour", F.col("lo")), F.col("hi"))
    inner_hi = F.greatest(F.date_trunc("hour", "hi"), F.col("inner_lo"))

    def stretch(unit: str, lo: str, hi: str) -> Column:
        return F.struct(F.lit(unit).alias("unit"), F.col(lo).alias("lo"), F.col(hi).alias("hi"))

    later = F.array(stretch("hour", "inner_lo", "inner_hi"), stretch("minute", "inner_hi", "hi"))
    return (
        cut.withColumn("inner_lo", inner_lo)
        .withColumn("inner_hi", inner_hi)
        .select(
            *_BUCKET,
            F.inline(
                F.concat(
                    F.array(stretch("minute", "lo", "inner_lo")),
                    F.filter(later, lambda s: s["lo"] < s["hi"]),
                )
            ),
        )
    )


def block_seconds(unit: Column) -> Column:
    return step_seconds(unit) * BLOCK_UNITS


def block_of(unit: Column, ts: Column) -> Column:
    """The number of the block of units holding `ts`, counted from the epoch."""
    return F.floor(F.unix_timestamp(ts) / block_seconds(unit))


def packed(counts: DataFrame) -> DataFrame:
    """Unit counts, those of a block `held` in one row, by the start of the unit."""
    return (
        counts.where("unit_start is not null")
        .groupBy("campaign_id", "unit", block_of(F.col("unit"), F.col("unit_start")).alias("block"))
        .agg(
            F.map_from_entries(
                F.collect_list(F.struct("unit_start", F.struct("unit_count", "unit_batch")))
            ).alias("held")
        )
    )


def counted(stretches: DataFrame, blocks: DataFrame) -> DataFrame:
    """Stretches `[lo, hi)` of units, split by block, each with the counts `held` for it."""
    unit, lo, hi = F.col("unit"), F.col("lo"), F.col("hi")
    first, last = block_of(unit, lo), block_of(unit, F.greatest(lo, _before(hi)))
    length = block_seconds(unit)
    return (
        stretches.withColumn("block", F.explode(F.sequence(first, last)))
        .withColumns(
            {
                "lo": F.greatest(lo, F.timestamp_seconds(F.col("block") * length)),
                "hi": F.least(hi, F.timestamp_seconds((F.col("block") + 1) * length)),
            }
        )
        .join(blocks, ["campaign_id", "unit", "block"], "left")
        .withColumn("held", F.map_filter("held", lambda at, _: (at >= lo) & (at < hi)))
    )


def rows_asked_for(aggregates: DataFrame, accepted: DataFrame) -> DataFrame:
    """Aggregate rows of the campaigns and days some request covers.

    Where the table has its `dt` partition column, the match on the day prunes folders.
    """
    day = F.explode(
        F.sequence(
            F.to_date("start"),
            F.to_date(_before(F.col("end"))),
        )
    )
    wanted = (
        accepted.select("campaign_id", day.alias("day"))
        .distinct()
        .select("campaign_id", F.date_format("day", "yyyy-MM-dd").alias("dt"))
    )
    if "dt" not in aggregates.columns:
        aggregates = aggregates.withColumn("dt", F.date_format("minute_bucket", "yyyy-MM-dd"))
    return aggregates.join(wanted, ["campaign_id", "dt"], "left_semi")


def tasks_for(judged: DataFrame) -> int:
    """Tasks among which the buckets of the accepted requests are put in order, by their number.

    Shuffled buckets are many times smaller than sorted ones, so a number of tasks that
    follows from bytes, or is small, would let the memory of a task grow with the requests.
    To more than `MOST_TASKS`, a shuffle would write by sorting, which takes memory again.
    """
    buckets = bucket_count(F.col("start"), F.col("end"), F.col("granularity"))
    rows = judged.where(F.col("status") == 200).agg(F.sum(buckets)).first()[0] or 0
    return max(judged.sparkSession.sparkContext.defaultParallelism, min(-(-rows // BUCKETS_PER_TASK), MOST_TASKS))


def answered(
    judged: DataFrame, aggregates: DataFrame, source_rule: str = "exact"
) -> DataFrame:
    """The series of every accepted request, as stretches of buckets with the counts in them.

    Only whole blocks of units are joined, and empty buckets take no place: `buckets_of`
    fills them in, where they are wanted. At most the first and the last bucket of a request
    are cut; only these are put together from pieces.
    """
    accepted = judged.where(F.col("status") == 200).select(*_REQUEST, "start", "end")
    blocks = packed(unit_counts(rows_asked_for(aggregates, accepted), source_rule))
    whole = counted(whole_buckets(accepted), blocks)
    cut = (
        counted(pieces(cut_buckets(accepted)), blocks)
        .select(*_BUCKET, F.explode_outer(F.map_values("held")).alias("count"))
        .groupBy(*_BUCKET)
        .agg(
            F.sum("count.unit_count").alias("unit_count"),
            BATCH_RULES[source_rule]("count.unit_batch").alias("unit_batch"),
        )
        .select(
            *_REQUEST,
            F.col("bucket_start").alias("lo"),
            (F.col("bucket_start") + step_interval(F.col("granularity"))).alias("hi"),
            F.create_map("bucket_start", F.struct("unit_count", "unit_batch")).alias("held"),
        )
    )
    return whole.select(*_REQUEST, "lo", "hi", "held").unionByName(cut)


def buckets_of(granularity: Column, lo: Column, hi: Column, held: Column) -> Column:
    """Array of the buckets of a stretch, empty ones as zero."""
    return F.transform(
        F.sequence(lo, _before(hi), step_interval(granularity)),
        lambda at: F.struct(
            iso(at).alias("bucket_start"),
            F.coalesce(held[at]["unit_count"], F.lit(0)).alias("click_count"),
            F.when(held[at]["unit_batch"], SOURCE_BATCH).otherwise(SOURCE_STREAM).alias("source"),
        ),
    )


def series(stretches: DataFrame) -> DataFrame:
    """The dense series of answered requests, a row for each bucket."""
    return stretches.select(*_REQUEST, F.inline(buckets_of(*[F.col(name) for name in _STRETCH])))


def metrics(
    requests: DataFrame, ads: DataFrame, aggregates: DataFrame, source_rule: str = "exact"
) -> DataFrame:
    """Series of the accepted requests, each in bucket order and in one partition.

    Buckets are filled in where they are put in order: stretches are dealt out evenly by
    request, while the blocks they come from differ much in how many requests ask for them.
    """
    judged = judged_requests(requests, ads)
    stretches = answered(judged, aggregates, source_rule).repartition(tasks_for(judged), "request_id")
    return series(stretches).sortWithinPartitions("request_id", "bucket_start")


def bounds(requests: DataFrame) -> tuple[datetime | None, datetime | None]:
    """The least and greatest time that any readable request asks for."""
    start, end = instant(F.col("from")), instant(F.col("to"))
    row = requests.where(end > start).agg(F.unix_micros(F.min(start)), F.unix_micros(F.max(end))).first()
    return tuple(None if time is None else _time(time) for time in row)


def _time(micros: int) -> datetime:
    return datetime.fromtimestamp(0, UTC) + timedelta(microseconds=micros)


def campaign_series(
    aggregates: DataFrame,
    campaign_id: str,
    start: datetime,
    end: datetime,
    granularity: str = DEFAULT_GRANULARITY,
    source_rule: str = "exact",
) -> DataFrame:
    """The ordered series of one campaign, for a single request already let through.

    Its bounds are constants, so the scan is filtered by them and one small aggregate does.
    The few buckets are put in order in one partition.
    """
    first, last = F.lit(start), F.lit(end)
    unit = fitted(start, end, granularity)
    step = F.expr(f"INTERVAL {STEP_SECONDS[unit]} SECONDS")
    counts = (
        aggregates.where(
            (F.col("campaign_id") == campaign_id)
            & (F.col("minute_bucket") >= first)
            & (F.col("minute_bucket") < last)
        )
        .groupBy(F.date_trunc(unit, "minute_bucket").alias("bucket_start"))
        .agg(
            F.sum("click_count").alias("click_count"),
            BATCH_RULES[source_rule](F.col("source") == SOURCE_BATCH).alias("batch"),
        )
    )
    starts = F.sequence(F.date_trunc(unit, first), _before(last), step)
    buckets = aggregates.sparkSession.range(0, 1, 1, numPartitions=1).select(
        F.explode(starts).alias("bucket_start")
    )
    return (
        buckets.join(counts, "bucket_start", "left")
        .select(
            F.lit(campaign_id).alias("campaign_id"),
            F.lit(unit).alias("granularity"),
            iso(F.col("bucket_start")).alias("bucket_start"),
            F.coalesce("click_count", F.lit(0)).alias("click_count"),
            F.when(F.col("batch"), SOURCE_BATCH).otherwise(SOURCE_STREAM).alias("source"),
        )
        .coalesce(1)
        .sortWithinPartitions("bucket_start")
    )


def answer(request: dict, ads: DataFrame, table: AggregateTable, source_rule: str = "exact") -> tuple[int, str]:
    """Status and JSON body of one request, with all tests; only its days of the table are read.

    What the request alone tells is worked out by the optimizer, from one literal row. Whether
    the campaign is owned comes along with its series, so one job answers.
    """
    names = METRICS_REQUEST.fieldNames()
    marks = ", ".join(f"CAST(:{name} AS STRING)" for name in names)
    listed = ", ".join(f"`{name}`" for name in names)
    asked = ads.sparkSession.sql(f"SELECT * FROM VALUES ({marks}) AS asked({listed})", {n: request.get(n) for n in names})
    times = {name: F.unix_micros(name) for name in ("start", "end")}
    row = _judged(_read(asked).withColumn("owned", F.lit(True))).withColumns(times).first()
    if row.status != 200:
        return row.status, _error(row.reason)
    start, end = _time(row.start), _time(row.end)
    owner = ads.where((F.col("campaign_id") == row.campaign_id) & (F.col("advertiser_id") == row.advertiser_id))
    stored = table.read(start, end, row.granularity)
    found = campaign_series(stored, row.campaign_id, start, end, row.requested, source_rule)
    rows = found.withColumn("owned", owner.limit(1).agg(F.count(F.lit(1))).scalar() > 0).collect()
    if not rows[0].owned:
        return _STATUS["forbidden"], _error("forbidden")
    buckets = [{name: bucket[name] for name in _RESULT} for bucket in rows]
    body = {
        "campaign_id": row.campaign_id,
        "granularity": row.granularity,
        "from": periods.text(start),
        "to": periods.text(end),
        "buckets": buckets,
    }
    return 200, json.dumps(body, separators=(",", ":"))


def _error(reason: str) -> str:
    return json.dumps({"error": reason, "detail": METRICS_ERROR_DETAILS[reason]}, separators=(",", ":"))


def fitted(start: datetime, end: datetime, granularity: str) -> str:
    """The effective granularity of one request."""
    for unit in GRANULARITIES[GRANULARITIES.index(granularity) : -1]:
        step = STEP_SECONDS[unit]
        floor = int(start.timestamp()) // step * step
        if -((floor - int(end.timestamp())) // step) <= MAX_BUCKETS:
            return unit
    return GRANULARITIES[-1]


def responses(
    requests: DataFrame, ads: DataFrame, aggregates: DataFrame, source_rule: str = "exact"
) -> DataFrame:
    """One row per request: `status` and the JSON `body`, an error or the ordered series.

    A request's buckets fit one row: they are capped, or one per day. They are filled in
    and written out last, so that only counts are shuffled and sorted.
    """
    judged = judged_requests(requests, ads)
    listed = (
        answered(judged, aggregates, source_rule)
        .groupBy("request_id")
        .agg(F.collect_list(F.struct(*_STRETCH)).alias("stretches"))
    )
    buckets = F.transform("stretches", lambda s: buckets_of(*[s[name] for name in _STRETCH]))
    body = F.to_json(
        F.struct(
            "campaign_id",
            "granularity",
            iso(F.col("start")).alias("from"),
            iso(F.col("end")).alias("to"),
            F.sort_array(F.flatten(buckets)).alias("buckets"),
        )
    )
    detail = F.lit(None).cast("string")
    for name, text in METRICS_ERROR_DETAILS.items():
        detail = F.when(F.col("reason") == name, text).otherwise(detail)
    error = F.to_json(F.struct(F.col("reason").alias("error"), detail.alias("detail")))
    return judged.join(listed, "request_id", "left").select(
        "request_id", "status", F.when(F.col("status") == 200, body).otherwise(error).alias("body")
    )
