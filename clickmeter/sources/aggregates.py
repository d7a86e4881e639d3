"""The aggregate table: one row per campaign and minute.

Nothing that is written is ever rewritten. A batch of the stream adds its counts, a
reconciliation adds a period, and what is current is told when reading:

    <path>/stream/dt=<day>/batch=<name>/*.parquet     counts of the stream
    <path>/exact/batch=<period>/unit=<unit>/dt=<day>/*.parquet   a reconciled period

A minute belongs to the latest reconciled period that holds it, with all of its rows and no
others, so stored rows that the recompute did not find are gone. Minutes of no period have the
counts the stream set last. A period appears by the renaming of its folder, whose name has its
bounds and time: readers see all of a change or none of it.

Periods also hold the sums of their whole hours and days, for coarse reads. Their rows are
ranged by campaign, with Bloom filters, as a request asks for one.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmeter.operators.merging import KEY, in_period
from clickmeter.operators.rollup import unit_counts
from clickmeter.periods import micros, utc
from clickmeter.schemas import CLICK_AGGREGATES
from clickmeter.settings import GRANULARITIES, SOURCE_BATCH, SOURCE_STREAM, STEP_SECONDS
from clickmeter.sources.batches import publish, replace_batch
from clickmeter.sources.files import delete, exists, file_system, folder_names, make_folder

_COUNTS = "campaign_id string, minute_bucket timestamp, click_count long"
_STREAM = f"{_COUNTS}, updated_at timestamp, written_at long, dt string, batch string"
_EXACT = f"{_COUNTS}, updated_at timestamp, batch string, unit string, dt string"
_LEAST, _MOST = -(1 << 62), 1 << 62


@dataclass(frozen=True)
class Piece:
    """Minutes `[lo, hi)` that belong to the period of folder `name`, made at `made`; all in microseconds."""

    lo: int
    hi: int
    name: str
    made: int


def owned_pieces(names: list[str], lo: int, hi: int) -> list[Piece]:
    """Which period holds which part of `[lo, hi)`: later ones go before earlier ones."""
    held = []
    for name in names:
        start, end, made, _ = name.split("_")
        held.append((int(made), name, max(int(start), lo), min(int(end), hi)))
    free, pieces = [(lo, hi)], []
    for made, name, start, end in sorted(held, reverse=True):
        left = []
        for a, b in free:
            x, y = max(a, start), min(b, end)
            if x >= y:
                left.append((a, b))
                continue
            pieces.append(Piece(x, y, name, made))
            left += [(p, q) for p, q in ((a, x), (y, b)) if p < q]
        free = left
    return sorted(pieces, key=lambda p: p.lo)


def _joined(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges in order, with neighbours made one."""
    out: list[tuple[int, int]] = []
    for lo, hi in ranges:
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def _within(column: str, ranges: list[tuple[int, int]]) -> Column:
    found = F.lit(False)
    for lo, hi in ranges:
        found |= (F.col(column) >= _at(lo)) & (F.col(column) < _at(hi))
    return found


def _at(time_micros: int) -> Column:
    return F.timestamp_micros(F.lit(min(max(time_micros, -(10**17)), 10**17)))


def _whole(lo: int, hi: int, unit: str) -> tuple[int, int]:
    """The whole units within `[lo, hi)`; empty at `lo` if there is none."""
    step = STEP_SECONDS[unit] * 1_000_000
    first, last = -(-lo // step) * step, hi // step * step
    return (first, last) if first < last else (lo, lo)


def _days(lo: int, hi: int) -> list[str]:
    day = 86_400_000_000
    return [(datetime(1970, 1, 1) + timedelta(days=d)).strftime("%Y-%m-%d") for d in range(lo // day, -(-hi // day))]


class AggregateTable:
    """Reads and writes the aggregate table below `path`."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.fs, self.path = file_system(spark, path)

    def create(self) -> AggregateTable:
        """Make an empty table; does nothing where one exists."""
        for part in ("stream", "exact"):
            make_folder(self.fs, self.spark, f"{self.path}/{part}")
        return self

    def _periods(self) -> list[str]:
        return [n.removeprefix("batch=") for n in folder_names(self.fs, self.spark, f"{self.path}/exact") if n.startswith("batch=")]

    def read(self, start: datetime | None = None, end: datetime | None = None, unit: str = "minute") -> DataFrame:
        """The current rows, of `[start, end)` if bounds are given; other days stay closed.

        For a coarser `unit` whole units that were reconciled come as one row each.
        """
        lo, hi = (micros(start) if start else _LEAST), (micros(end) if end else _MOST)
        pieces = owned_pieces(self._periods(), lo, hi)
        days = _days(lo, hi) if start and end else None
        rows = self._exact(pieces, GRANULARITIES[: GRANULARITIES.index(unit) + 1], days)
        owned = _joined([(p.lo, p.hi) for p in pieces])
        if owned != [(lo, hi)]:
            fresh = self._latest(self._stream("stream", lo, hi, days).where(~_within("minute_bucket", owned)))
            rows = rows.unionByName(fresh.withColumn("source", F.lit(SOURCE_STREAM)))
        if exists(self.fs, self.spark, f"{self.path}/literal"):
            rows = self._overwritten(rows, pieces, lo, hi, days)
        return rows.select(
            *KEY,
            "click_count",
            "source",
            "updated_at",
            F.date_format("minute_bucket", "yyyy-MM-dd").alias("dt"),
            F.date_format("minute_bucket", "HH").alias("hr"),
        ).select(*CLICK_AGGREGATES.fieldNames())

    def _load(self, folder: str, schema: str, paths: list[str]) -> DataFrame:
        """Rows of those of the folders that are there."""
        found = [p for p in paths if exists(self.fs, self.spark, p)]
        if not found:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/{folder}").parquet(*found)

    def _stream(self, folder: str, lo: int, hi: int, days: list[str] | None) -> DataFrame:
        root = f"{self.path}/{folder}"
        rows = self._load(folder, _STREAM, [root] if days is None else [f"{root}/dt={day}" for day in days])
        if days is not None:
            rows = rows.where(F.col("dt").between(days[0], days[-1]))
        return rows if (lo, hi) == (_LEAST, _MOST) else rows.where(_within("minute_bucket", [(lo, hi)]))

    @staticmethod
    def _latest(rows: DataFrame) -> DataFrame:
        """Of each key what was written last."""
        last = F.max(F.struct("written_at", "batch", "click_count", "updated_at")).alias("last")
        return rows.groupBy(*KEY).agg(last).select(*KEY, "last.click_count", "last.updated_at")

    def _exact(self, pieces: list[Piece], units: tuple[str, ...], days: list[str] | None) -> DataFrame:
        """The rows of the pieces, as whole units where there are any, coarsest first."""
        wanted: dict[tuple[str, str], list[tuple[int, int]]] = {}
        for piece in pieces:
            left = [(piece.lo, piece.hi)]
            for unit in reversed(units):
                rest = []
                for lo, hi in left:
                    first, last = _whole(lo, hi, unit) if unit != GRANULARITIES[0] else (lo, hi)
                    if first < last:
                        wanted.setdefault((piece.name, unit), []).append((first, last))
                    rest += [(a, b) for a, b in ((lo, first), (last, hi)) if a < b]
                left = rest
        paths, ours = [], F.lit(False)
        for (name, unit), ranges in wanted.items():
            own = [d for d in (days or [""]) if days is None or any(lo < b and a < hi for lo, hi in ranges for a, b in [_day(d)])]
            root = f"{self.path}/exact/batch={name}/unit={unit}"
            paths += [f"{root}/dt={d}" if d else root for d in own]
            ours |= (F.col("batch") == name) & (F.col("unit") == unit) & _within("minute_bucket", ranges)
        rows = self._load("exact", _EXACT, paths).where(ours)
        return rows.select(*KEY, "click_count", "updated_at").withColumn("source", F.lit(SOURCE_BATCH))

    def _overwritten(self, rows: DataFrame, pieces: list[Piece], lo: int, hi: int, days: list[str] | None) -> DataFrame:
        """The rows with counts in their place that were written over reconciled ones on request."""
        made = F.lit(_LEAST)
        for piece in pieces:
            made = F.when(_within("minute_bucket", [(piece.lo, piece.hi)]), F.lit(piece.made)).otherwise(made)
        over = self._latest(self._stream("literal", lo, hi, days).where(F.col("written_at") > made))
        return rows.join(over.select(*KEY), KEY, "left_anti").unionByName(over.withColumn("source", F.lit(SOURCE_STREAM)))

    def upsert(self, counts: DataFrame, as_of: Column, protect_batch: bool = True, batch: str | None = None) -> None:
        """Set the counts of the given keys as `stream` rows, by one append.

        A `batch` written again takes the place of itself. Without `protect_batch` the counts
        also go over reconciled rows that are there now.
        """
        now = time.time_ns() // 1000
        rows = counts.select(*KEY, "click_count").withColumns(
            {"updated_at": as_of, "written_at": F.lit(now), "dt": F.date_format("minute_bucket", "yyyy-MM-dd")}
        )
        folders = ["stream"] if protect_batch else ["stream", "literal"]
        for folder in folders:
            replace_batch(rows, f"{self.path}/{folder}", ["dt"], batch, sorted_by=KEY)

    def swap(self, counts: DataFrame, start: datetime, end: datetime, as_of: Column) -> None:
        """Put the recomputed counts in place of all rows of `[start, end)`.

        They are staged first, so that ranging them by campaign does not compute them twice.
        Counts outside of the period are left out: its other rows stay.
        """
        lo, hi = micros(start), micros(end)
        name = f"{lo}_{hi}_{time.time_ns() // 1000}_{uuid.uuid4().hex[:8]}"
        stage = f"{self.path}/stage/{name}"
        inside = counts.where(in_period(F.col("minute_bucket"), utc(start), utc(end)))
        inside.select(*KEY, "click_count").write.parquet(stage)
        try:
            staged = self.spark.read.schema(_COUNTS).parquet(stage)
            units = unit_counts(staged.withColumn("source", F.lit(SOURCE_BATCH))).where(
                F.lit(False)
                if lo >= hi
                else F.col("unit").isin(GRANULARITIES[0]) | _any_unit({u: _whole(lo, hi, u) for u in GRANULARITIES[1:]})
            )
            rows = units.select(
                "campaign_id",
                F.col("unit_start").alias("minute_bucket"),
                F.col("unit_count").alias("click_count"),
                as_of.alias("updated_at"),
                "unit",
                F.date_format("unit_start", "yyyy-MM-dd").alias("dt"),
            )
            ranged = rows.repartitionByRange("unit", "dt", "campaign_id").sortWithinPartitions("unit", "dt", *KEY)
            writer = ranged.write.partitionBy("unit", "dt").option("parquet.bloom.filter.enabled#campaign_id", "true")
            publish(self.spark, f"{self.path}/exact", name, writer.parquet)
        finally:
            delete(self.fs, self.spark, stage)

    def forget(self, older_than: timedelta = timedelta(days=1)) -> None:
        """Remove what no reader has seen for this long: periods that later ones cover, and
        days of the stream that are wholly reconciled. The age must cover the longest read."""
        before = (time.time_ns() // 1000) - older_than // timedelta(microseconds=1)
        # What was hidden before then is hidden by periods made before then.
        old = [p for p in self._periods() if int(p.split("_")[2]) < before or older_than <= timedelta(0)]
        pieces = owned_pieces(old, _LEAST, _MOST)
        for name in set(old) - {p.name for p in pieces}:
            delete(self.fs, self.spark, f"{self.path}/exact/batch={name}")
        owned = _joined([(p.lo, p.hi) for p in pieces])
        for name in folder_names(self.fs, self.spark, f"{self.path}/stream"):
            if name.startswith("dt="):
                first, last = _day(name.removeprefix("dt="))
                if any(lo <= first and last <= hi for lo, hi in owned):
                    delete(self.fs, self.spark, f"{self.path}/stream/{name}")


def _day(name: str) -> tuple[int, int]:
    first = (datetime.strptime(name, "%Y-%m-%d") - datetime(1970, 1, 1)) // timedelta(microseconds=1)
    return first, first + 86_400_000_000


def _any_unit(ranges: dict[str, tuple[int, int]]) -> Column:
    found = F.lit(False)
    for unit, (lo, hi) in ranges.items():
        found |= (F.col("unit") == unit) & _within("unit_start", [(lo, hi)])
    return found
