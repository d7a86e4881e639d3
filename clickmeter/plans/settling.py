"""Settling, in batch, of requests that streaming capture has set aside.

A request that was set aside is accepted by its own arrival unless its impression has an
accepted click less than the lifetime before or after it: what the stream has emitted stays,
and no impression counts twice. The result follows from the folders alone, so it may be
computed again at any time, as more is set aside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickmeter.functions.timebucket import instant
from clickmeter.plans.capture import answer_columns, as_events
from clickmeter.settings import IMPRESSION_TTL_SECONDS
from clickmeter.streaming.answering import read_events
from clickmeter.streaming.intake import TAKEN

_OPENING = ["arrival", "clicked_at", "request_id", "ad_id"]


def set_aside(spark: SparkSession, root: str) -> DataFrame:
    """Requests ahead of the clock or behind the watermark."""
    taken = spark.read.schema(TAKEN + ", batch string, kind string").parquet(f"{root}/taken")
    return taken.where("kind in ('ahead', 'behind')").drop("batch")


def settled(aside: DataFrame, events: DataFrame, ttl_seconds: int = IMPRESSION_TTL_SECONDS) -> DataFrame:
    """The requests with `emitted`, given the events of the stream.

    Per impression there is at most one candidate for each second, and events of the stream
    are a lifetime apart, so what is folded is bounded by the time it spans.
    """
    timed = aside.withColumn("arrival", F.unix_timestamp("received_at"))
    seconds = timed.groupBy("impression_id", "arrival").agg(F.min(F.struct(*_OPENING)).alias("click"))
    wanted = seconds.groupBy("impression_id").agg(F.array_sort(F.collect_list("click")).alias("clicks"))
    held = (
        events.select("impression_id", F.unix_timestamp(instant(F.col("ingest_ts"))).alias("arrival"))
        .join(wanted.select("impression_id"), "impression_id", "left_semi")
        .groupBy("impression_id")
        .agg(F.collect_list("arrival").alias("held"))
    )
    chosen = wanted.join(held, "impression_id", "left").select(
        "impression_id", F.explode(_apart(F.col("clicks"), F.coalesce("held", F.array().cast("array<bigint>")), ttl_seconds)).alias("click")
    )
    chosen = chosen.select(F.col("impression_id").alias("of"), *(F.col(f"click.{c}").alias(f"first_{c}") for c in _OPENING), F.lit(True).alias("opens"))
    same = F.col("impression_id") == F.col("of")
    for name in _OPENING:
        same &= F.col(name).eqNullSafe(F.col(f"first_{name}"))
    delivery = F.row_number().over(Window.partitionBy("impression_id", *_OPENING).orderBy("user_agent"))
    matched = timed.withColumn("delivery", delivery).join(chosen, same & (F.col("delivery") == 1), "left")
    return matched.select(*aside.columns, F.coalesce("opens", F.lit(False)).alias("emitted"))


def _apart(clicks: Column, held: Column, ttl_seconds: int) -> Column:
    """Of clicks in order, those a lifetime away from all that are held or taken before."""
    nothing = F.struct(held.alias("held"), F.filter(clicks, lambda _: F.lit(False)).alias("taken"))
    return F.aggregate(
        clicks,
        nothing,
        lambda state, click: F.when(
            F.forall(state["held"], lambda at: F.abs(click["arrival"] - at) >= ttl_seconds),
            F.struct(
                F.concat(state["held"], F.array(click["arrival"])).alias("held"),
                F.concat(state["taken"], F.array(click)).alias("taken"),
            ),
        ).otherwise(state),
        lambda state: state["taken"],
    )


def settled_events(spark: SparkSession, root: str, events: str, ttl_seconds: int = IMPRESSION_TTL_SECONDS) -> DataFrame:
    """Events that were set aside and count after all."""
    return as_events(settled(set_aside(spark, root), read_events(spark, events), ttl_seconds).where("emitted"))


def settled_outcomes(spark: SparkSession, root: str, events: str, ttl_seconds: int = IMPRESSION_TTL_SECONDS) -> DataFrame:
    """Answers of the requests that were set aside."""
    return settled(set_aside(spark, root), read_events(spark, events), ttl_seconds).select(*answer_columns())
