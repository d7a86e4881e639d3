"""One row per impression.

An impression may be delivered any number of times, so nothing here gathers the rows of
an impression: survivors come from `min`/`max` aggregates, which combine on the map side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmeter.settings import IMPRESSION_TTL_SECONDS

_ARRIVAL_ORDER = ("ingest_ts", "click_ts", "event_id")


def one_per_impression(raw: DataFrame, keep: str = "first") -> DataFrame:
    """Keep the earliest (`first`) or latest (`last`) ingested row of each impression.

    Ties are broken by click time, then event id, then the remaining columns, so the
    survivor never depends on the order of the input. Rows without an impression are
    no clicks and are left out.
    """
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be 'first' or 'last', got {keep!r}")
    order = [name for name in _ARRIVAL_ORDER if name in raw.columns]
    rest = sorted(set(raw.columns) - set(order) - {"impression_id"})
    pick = F.min if keep == "first" else F.max
    return (
        raw.where(F.col("impression_id").isNotNull())
        .groupBy("impression_id")
        .agg(pick(F.struct(*order, *rest)).alias("row"))
        .select("impression_id", "row.*")
        .select(*raw.columns)
    )


def first_clicks(
    clicks: DataFrame,
    payload: list[str],
    ttl_seconds: int = IMPRESSION_TTL_SECONDS,
) -> DataFrame:
    """The clicks that open an impression.

    A click is accepted unless one of the same impression was accepted less than
    `ttl_seconds` before it; repeats do not extend that time. `clicks` needs
    `impression_id`, `received_at` and `clicked_at` timestamps and the `payload` columns,
    which also break ties. Arrival counts in whole seconds, as events record it.

    Nearly every impression lives for less than the ttl, and then its earliest click is
    the only one: one aggregate with map-side combine. The others are found by their
    first and last arrival, and just their later clicks are thinned to one per second
    and folded in order. The folded array is thus bounded by the seconds of the period,
    however many clicks an impression has.
    """
    timed = clicks.where(F.col("impression_id").isNotNull()).select(
        "impression_id",
        F.unix_timestamp("received_at").alias("arrival"),
        "clicked_at",
        *payload,
    )
    pick = ["clicked_at", *payload]
    lives = timed.groupBy("impression_id").agg(
        F.min(F.struct("arrival", *pick)).alias("click"), F.max("arrival").alias("last_seen")
    )
    # Both branches use both aggregates, so that one shuffle serves the two.
    opening = lives.where(F.col("last_seen").isNotNull()).select("impression_id", "click.*")
    long_lived = lives.where(F.col("last_seen") - F.col("click.arrival") >= ttl_seconds).select(
        "impression_id", F.col("click.arrival").alias("opened")
    )
    # Grouping by a struct asks for a shuffle of its own: a hot impression is thinned on the
    # map side and spread by second, and the join before it may split its clicks (adaptive
    # skew join), which it may not if its partitions were grouped as they are.
    second = F.struct("impression_id", "opened", "arrival").alias("second")
    later = (
        timed.join(long_lived, "impression_id")
        .where(F.col("arrival") - F.col("opened") >= ttl_seconds)
        .groupBy(second)
        .agg(F.min(F.struct(*pick)).alias("click"))
        .groupBy("second.impression_id", "second.opened")
        .agg(
            F.array_sort(F.collect_list(F.struct("second.arrival", "click.*"))).alias("clicks")
        )
    )
    reopening = later.select(
        "impression_id",
        F.inline(_spaced(F.col("clicks"), F.col("opened"), ttl_seconds)),
    )
    return opening.unionByName(reopening)


def _spaced(clicks: Column, opened: Column, ttl_seconds: int) -> Column:
    """From clicks in arrival order, those at least the ttl after the one accepted before."""
    nothing = F.struct(
        opened.alias("accepted_at"), F.filter(clicks, lambda _: F.lit(False)).alias("accepted")
    )
    return F.aggregate(
        clicks,
        nothing,
        lambda state, click: F.when(
            click["arrival"] - state["accepted_at"] >= ttl_seconds,
            F.struct(
                click["arrival"].alias("accepted_at"),
                F.concat(state["accepted"], F.array(click)).alias("accepted"),
            ),
        ).otherwise(state),
        lambda state: state["accepted"],
    )
