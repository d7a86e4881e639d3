"""The value of a rank, without putting all values in order.

Values are counted by ranges between the least and the greatest. The range that holds the rank
is looked at again between its own least and greatest value, and so on, until few values are
left; only these are put in order. Ranges are of equal width, or of equal width in the logarithm
where the values span many magnitudes, so an outlier costs a round and gathers nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmeter.session import scratch_folder

RANGES = 1000
FEW = 10_000
WIDE = 1e6


def value_of_rank(steps: DataFrame, value: str, by: list[str], rank, few: int = FEW, ranges: int = RANGES) -> DataFrame:
    """by, samples, percentile, largest: the least value that `rank(samples)` samples do not exceed.

    `steps` holds each value of a group once, with its number `n`. Null where the rank is below 1.
    Every round is a job over the values that are still open; bounds and values are kept as files.
    """
    key = F.struct(*by) if by else F.struct(F.lit(0).alias("all"))  # structs join nulls as well
    open_ = _kept(steps.select(key.alias("k"), F.col(value).alias("x"), F.col("n").cast("long").alias("n")), "values")
    bounds = open_.groupBy("k").agg(
        F.sum("n").alias("samples"), F.min("x").alias("low"), F.max("x").alias("high"), F.count(F.lit(1)).alias("held"), F.max("x").alias("largest")
    )
    bounds = _kept(bounds.withColumns({"rank": rank(F.col("samples")).cast("long"), "before": F.lit(0).cast("long")}), "bounds")
    wide = (F.col("held") > few) & (F.col("rank") >= 1)
    while bounds.where(wide).limit(1).count():
        counted = _inside(open_, bounds.where(wide), not by).groupBy("k", _place(F.col("x"), ranges).alias("place")).agg(
            F.sum("n").alias("n"), F.min("x").alias("least"), F.max("x").alias("most"), F.count(F.lit(1)).alias("values")
        )
        so_far = Window.partitionBy("k").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)  # as many rows as ranges
        placed = counted.withColumn("seen", F.sum("n").over(so_far)).join(bounds.select("k", "rank", "before"), "k")
        seen = F.col("before") + F.col("seen")
        chosen = placed.where((seen >= F.col("rank")) & (seen - F.col("n") < F.col("rank"))).select(
            "k", F.col("least").alias("low_"), F.col("most").alias("high_"), F.col("values").alias("held_"), (seen - F.col("n")).alias("before_")
        )
        changed = ("low", "high", "held", "before")
        bounds = bounds.join(chosen, "k", "left").withColumns({c: F.coalesce(f"{c}_", c) for c in changed}).drop(*(f"{c}_" for c in changed))
        bounds = _kept(bounds, "bounds")
    ordered = Window.partitionBy("k").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    reached = F.col("before") + F.sum("n").over(ordered) >= F.col("rank")
    few_left = _inside(open_, bounds.where("rank >= 1"), not by)
    found = few_left.withColumn("reached", reached).where("reached").groupBy("k").agg(F.min("x").alias("percentile"))
    return bounds.join(found, "k", "left").select(*(F.col("k")[c].alias(c) for c in by), "samples", "percentile", "largest")


def _kept(rows: DataFrame, label: str) -> DataFrame:
    path = scratch_folder(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _inside(values: DataFrame, bounds: DataFrame, alone: bool) -> DataFrame:
    """The values of a group that may hold its rank; with one group its bounds prune the scan."""
    edge = bounds.first() if alone else None
    if edge:
        values = values.where(F.col("x").between(F.lit(edge["low"]), F.lit(edge["high"])))
    open_ = bounds.select("k", "low", "high", "rank", "before")
    return values.join(open_, "k").where(F.col("x").between(F.col("low"), F.col("high")))


def _place(x: Column, ranges: int) -> Column:
    """The range of a value between `low` and `high`, in their order."""
    low, high = F.col("low").cast("double"), F.col("high").cast("double")

    def scaled(value: Column) -> Column:
        return F.signum(value) * F.log1p(F.abs(value))

    spread = (F.abs(low) + F.abs(high)) > F.lit(WIDE)
    far = spread & ~((low > 0) & (high < 2 * low)) & ~((high < 0) & (low > 2 * high))
    value = x.cast("double")
    linear = (value - low) / (high - low)
    steep = (scaled(value) - scaled(low)) / (scaled(high) - scaled(low))
    place = F.floor(F.when(far, steep).otherwise(linear) * ranges)
    # The ends get ranges of their own, so that every round leaves some values behind.
    return F.when(x == F.col("low"), F.lit(-1)).when(x == F.col("high"), F.lit(ranges)).otherwise(F.least(F.greatest(F.coalesce(place, F.lit(0)), F.lit(0)), F.lit(ranges - 1)))
