"""Archive, aggregate table, reconciliation."""

import random
from datetime import UTC, date, datetime, timedelta, timezone

import pytest
from conftest import rows
from pyspark.sql import functions as F

from clickmeter import periods
from clickmeter.functions.timebucket import instant, iso
from clickmeter.operators.counting import captured_per_day
from clickmeter.operators import selection
from clickmeter.operators.rollup import rollup
from clickmeter.operators.selection import value_of_rank
from clickmeter.plans import audits, reconcile, sketches
from clickmeter.schemas import CLICK_EVENT
from clickmeter.sources import archive
from clickmeter.sources.aggregates import AggregateTable, owned_pieces

H13, H14, H15, H16 = (periods.parse(f"2026-06-13T{h}:00:00Z") for h in (13, 14, 15, 16))


def events(spark, *clicks):
    """Events from `(impression, campaign, click time)`."""
    return spark.createDataFrame(
        [
            (f"e{n}", imp, "ad_1", camp, "adv_1", ts, ts[:17] + "00Z", ts, None)
            for n, (imp, camp, ts) in enumerate(clicks)
        ],
        CLICK_EVENT,
    )


CLICKS = [
    ("imp_1", "c1", "2026-06-13T13:59:59Z"),
    ("imp_1", "c1", "2026-06-13T14:00:10Z"),
    ("imp_2", "c1", "2026-06-13T14:00:20Z"),
    ("imp_2", "c1", "2026-06-13T14:00:25Z"),
    ("imp_3", "c2", "2026-06-13T14:59:59Z"),
    ("imp_4", "c2", "2026-06-13T15:00:00Z"),
    ("imp_5", "c2", "2026-05-01T00:30:00Z"),
]


@pytest.fixture
def raw(spark, tmp_path):
    path = str(tmp_path / "raw")
    archive.write_archive(events(spark, *CLICKS), path)
    return path


def counts(spark, *held):
    return spark.createDataFrame(
        held, "campaign_id string, minute_bucket string, click_count long"
    ).withColumn("minute_bucket", instant(F.col("minute_bucket")))


def shown(table):
    return rows(table, "campaign_id", iso(F.col("minute_bucket")), "click_count", "source")


def now():
    return F.lit("2026-06-13T16:00:00Z").cast("timestamp")


def test_period_scan_opens_only_its_hours(spark, raw):
    scan = archive.read_period(spark, raw, "2026-06-13T14:00:00Z", "2026-06-13T15:00:00Z")
    assert rows(scan, "event_id") == [("e1",), ("e2",), ("e3",), ("e4",)]
    assert {(r.dt, r.hr) for r in scan.collect()} == {("2026-06-13", "14")}
    assert len(scan.inputFiles()) >= 1
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "PushedFilters: [IsNotNull(minute" in plan
    inside = archive.read_period(spark, raw, "2026-06-13T13:59:00Z", "2026-06-13T14:00:30Z")
    assert rows(inside, "event_id") == [("e0",), ("e1",), ("e2",), ("e3",)]


def test_archive_table_and_daily_captures(spark, raw):
    for _ in range(2):
        archive.create_archive_table(spark, "raw_clicks", raw)
    table = spark.table("raw_clicks")
    assert [f.dataType.simpleString() for f in table.schema] == ["string"] * 12
    exact = [("2026-05-01", 1), ("2026-06-13", 4)]
    assert rows(captured_per_day(table)) == exact
    assert rows(captured_per_day(table, approximate=True)) == exact
    spark.sql("DROP TABLE raw_clicks")


def test_retention(spark, raw):
    kept = archive.retained(archive.read_archive(spark, raw), now())
    assert kept.count() == 6
    assert archive.drop_expired(spark, raw, date(2026, 6, 13)) == ["2026-05-01"]
    assert archive.read_archive(spark, raw).count() == 6
    assert archive.drop_expired(spark, raw, date(2026, 6, 13)) == []


def test_bad_records_are_set_aside_whole(spark, tmp_path):
    good = events(spark, CLICKS[0]).select(F.to_json(F.struct("*"))).collect()[0][0]
    missing = good.replace('"impression_id":"imp_1",', "")
    records = spark.createDataFrame([(good,), ("{broken",), (missing,), (None,)], "value string")
    kept, bad = archive.split_records(records, now())
    assert rows(kept, "impression_id") == [("imp_1",)]
    archive.write_errors(bad, str(tmp_path / "errors"))
    found = spark.read.parquet(str(tmp_path / "errors"))
    assert rows(found.where("value is not null"), "error_type", "value") == [
        ("invalid_event", missing),
        ("malformed_json", "{broken"),
    ]
    assert found.count() == 3


def test_table_is_created_once_and_starts_empty(spark, tmp_path):
    table = AggregateTable(spark, str(tmp_path / "t")).create().create()
    assert shown(table.read()) == shown(table.read(H14, H15)) == []


def test_upsert_and_range_read(spark, tmp_path):
    table = AggregateTable(spark, str(tmp_path / "t")).create()
    held = counts(spark, ("c1", "2026-06-13T14:00:00Z", 3), ("c1", "2026-06-13T15:00:00Z", 1))
    table.upsert(held, now())
    table.upsert(held, now())
    table.upsert(counts(spark, ("c1", "2026-06-13T15:00:00Z", 7)), now())
    assert shown(table.read()) == [
        ("c1", "2026-06-13T14:00:00Z", 3, "stream"),
        ("c1", "2026-06-13T15:00:00Z", 7, "stream"),
    ]
    assert shown(table.read(H14, H15)) == [("c1", "2026-06-13T14:00:00Z", 3, "stream")]
    table.upsert(counts(spark, ("c1", "2026-06-14T14:00:00Z", 3)), now())
    assert all("dt=2026-06-13" in name for name in table.read(H14, H14 + timedelta(minutes=5)).inputFiles())
    table.upsert(held.limit(0), now())
    assert len(shown(table.read())) == 3


def test_a_repeated_batch_takes_the_place_of_itself(spark, tmp_path):
    table = AggregateTable(spark, str(tmp_path / "t")).create()
    held = counts(spark, ("c1", "2026-06-13T14:00:00Z", 3), ("c1", "2026-06-14T15:00:00Z", 1))
    for _ in range(2):
        table.upsert(held, now(), batch="q-1")
    assert spark.read.parquet(str(tmp_path / "t/stream")).count() == 2
    table.upsert(held.withColumn("click_count", F.lit(9).cast("long")), now(), batch="q-2")
    assert [row[2] for row in shown(table.read())] == [9, 9]


def test_pieces_go_to_the_latest_period():
    names = ["0_100_1_a", "20_40_2_b", "30_60_3_c", "200_300_4_d", "90_95_0_e"]
    pieces = [(p.lo, p.hi, p.name[-1]) for p in owned_pieces(names, 10, 250)]
    assert pieces == [(10, 20, "a"), (20, 30, "b"), (30, 60, "c"), (60, 100, "a"), (200, 250, "d")]
    random_ = random.Random(6)
    for _ in range(50):
        bounds = [sorted(random_.sample(range(60), 2)) for _ in range(8)]
        names = [f"{a}_{b}_{made}_x" for made, (a, b) in enumerate(bounds)]
        owner = {t: made for made, (a, b) in enumerate(bounds) for t in range(a, b)}
        found = {t: p.made for p in owned_pieces(names, 5, 50) for t in range(p.lo, p.hi)}
        assert found == {t: made for t, made in owner.items() if 5 <= t < 50}


def test_coarse_reads_use_whole_units_and_agree_with_minutes(spark, tmp_path):
    """Periods with odd bounds, one over the other, and the stream around them."""
    table = AggregateTable(spark, str(tmp_path / "t")).create()
    random_ = random.Random(3)
    start = periods.parse("2026-06-11T00:00:00Z")

    def clicks(lo, hi, n):
        chosen = [(f"c{random_.randint(1, 3)}", periods.text(start + timedelta(minutes=m))) for m in random_.sample(range(lo, hi), n)]
        return counts(spark, *((c, m, random_.randint(1, 9)) for c, m in chosen))

    table.upsert(clicks(0, 5 * 1440, 400), now())
    for lo, hi in ((600, 4 * 1440), (1500, 3005), (2880, 2880 + 61)):
        table.swap(clicks(lo, hi, min(300, hi - lo)), start + timedelta(minutes=lo), start + timedelta(minutes=hi), now())
    assert {r.unit for r in spark.read.parquet(str(tmp_path / "t/exact")).select("unit").distinct().collect()} == {"minute", "hour", "day"}
    for unit in ("hour", "day"):
        assert rows(rollup(table.read(unit=unit), unit)) == rows(rollup(table.read(), unit))
        for lo, hi in ((0, 5 * 1440), (30, 1513), (1441, 1442), (2000, 4000)):
            bounds = (start + timedelta(minutes=lo), start + timedelta(minutes=hi))
            coarse, fine = table.read(*bounds, unit), table.read(*bounds)
            assert rows(rollup(coarse, unit)) == rows(rollup(fine, unit))
            assert rows(fine) == rows(table.read().where(F.col("minute_bucket").between(F.lit(bounds[0]), F.lit(bounds[1] - timedelta(minutes=1)))))
    assert table.read(unit="day").count() < table.read(unit="hour").count() < table.read().count()


def test_rows_are_ranged_by_campaign_and_read_by_it(spark, tmp_path):
    import pyarrow.parquet as pq

    table = AggregateTable(spark, str(tmp_path / "t")).create()
    held = [(f"c{i:03}", f"2026-06-13T14:{i % 60:02}:00Z", 1) for i in range(300)]
    table.swap(counts(spark, *held), H14, H15, now())
    file = next((tmp_path / "t/exact").glob("*/unit=minute/dt=*/*.parquet"))
    column = pq.read_table(file)["campaign_id"].to_pylist()
    assert column == sorted(column)
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    plan = table.read(H14, H15).where("campaign_id = 'c007'")._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "EqualTo(campaign_id,c007)" in plan


def test_reconcile_corrects_drift_and_phantoms_and_repeats_safely(spark, raw, tmp_path):
    path = str(tmp_path / "t")
    table = AggregateTable(spark, path).create()
    table.upsert(
        counts(
            spark,
            ("c1", "2026-06-13T14:00:00Z", 3 + 999),
            ("ghost", "2026-06-13T14:30:00Z", 5),
            ("c2", "2026-06-13T15:00:00Z", 1),
        ),
        now(),
    )
    after = [
        ("c1", "2026-06-13T14:00:00Z", 2, "batch"),
        ("c2", "2026-06-13T14:59:00Z", 1, "batch"),
        ("c2", "2026-06-13T15:00:00Z", 1, "stream"),
    ]
    for _ in range(2):
        reconcile.reconcile(spark, raw, path, H14, H15)
        assert shown(table.read()) == after
    period = archive.read_period(spark, raw, periods.text(H14), periods.text(H15))
    assert rows(reconcile.drift(table.read(H14, H15), period)) == []
    # A replay of the stream does not undo the exact counts, and an emptied hour stays empty.
    table.upsert(counts(spark, ("c1", "2026-06-13T14:00:00Z", 3)), now())
    assert shown(table.read()) == after
    table.upsert(counts(spark, ("c1", "2026-06-13T14:00:00Z", 3)), now(), protect_batch=False)
    assert shown(table.read())[0] == ("c1", "2026-06-13T14:00:00Z", 3, "stream")
    reconcile.reconcile(spark, raw, path, H15 + timedelta(minutes=30), H16)
    assert shown(table.read(H15)) == [("c2", "2026-06-13T15:00:00Z", 1, "stream")]
    assert rows(audits.source_mix(table.read()), "day", "source", "rows") == [
        ("2026-06-13", "batch", 1),
        ("2026-06-13", "stream", 2),
    ]


def test_period_with_nothing_left_is_emptied(spark, raw, tmp_path):
    table = AggregateTable(spark, str(tmp_path / "t")).create()
    table.upsert(counts(spark, ("ghost", "2026-06-13T16:10:00Z", 5)), now())
    reconcile.reconcile(spark, raw, str(tmp_path / "t"), H16, H16 + timedelta(hours=1))
    assert shown(table.read()) == []


def test_lookback_drops_repeats_of_the_hour_before(spark, raw):
    plain = reconcile.recompute_period(spark, raw, H14, H15)
    assert rows(plain)[0] == ("c1", "2026-06-13T14:00:00Z", 2)
    strict = reconcile.recompute_period(spark, raw, H14, H15, lookback=timedelta(hours=48))
    assert rows(strict)[0] == ("c1", "2026-06-13T14:00:00Z", 1)


def test_readers_keep_what_they_saw_and_old_rows_go(spark, tmp_path):
    path = str(tmp_path / "t")
    table = AggregateTable(spark, path).create()
    table.upsert(counts(spark, ("c1", "2026-06-13T14:00:00Z", 3), ("c1", "2026-06-15T00:00:00Z", 1)), now())
    reader = table.read()
    other = AggregateTable(spark, path)  # another process
    day, step = periods.parse("2026-06-13T00:00:00Z"), timedelta(days=1)
    for n in (5, 6):
        other.swap(counts(spark, ("c9", "2026-06-13T14:00:00Z", n)), day, day + step, now())
    assert [row[0] for row in shown(reader)] == ["c1", "c1"]
    current = [("c1", "2026-06-15T00:00:00Z", 1, "stream"), ("c9", "2026-06-13T14:00:00Z", 6, "batch")]
    assert shown(table.read()) == current
    table.forget(timedelta(days=1))
    assert len(list((tmp_path / "t/exact").iterdir())) == 2 and (tmp_path / "t/stream/dt=2026-06-13").exists()
    table.forget(timedelta(0))
    assert shown(AggregateTable(spark, path).read()) == current
    assert len(list((tmp_path / "t/exact").iterdir())) == 1 and not (tmp_path / "t/stream/dt=2026-06-13").exists()
    assert not list((tmp_path / "t/stage").iterdir()) and not list((tmp_path / "t/exact.drafts").iterdir())


@pytest.mark.parametrize(
    ("cadence", "start", "end"),
    [
        ("hour", "2026-06-13T13:00:00Z", "2026-06-13T14:00:00Z"),
        ("day", "2026-06-12T00:00:00Z", "2026-06-13T00:00:00Z"),
    ],
)
def test_last_closed_period(spark, cadence, start, end):
    fired = "2026-06-13T14:05:09Z"
    first, last = periods.last_closed(periods.parse(fired), cadence)
    assert (periods.text(first), periods.text(last)) == (start, end)
    lo, hi = reconcile.last_closed(instant(F.lit(fired)), cadence)
    assert rows(spark.range(1).select(iso(lo), iso(hi))) == [(start, end)]


def test_percentile_takes_the_floored_rank(spark):
    samples = spark.range(1, 41).withColumn("group", F.lit("g"))
    assert rows(audits.rank_percentile(samples, "id")) == [(40, 38, 40)]
    assert rows(audits.rank_percentile(samples.limit(1), "id", by=["group"])) == [("g", 1, None, 1)]
    weighted = spark.createDataFrame([(1, 94), (5, 1), (9, 5)], "id long, n long")
    assert rows(audits.rank_percentile(weighted, "id", weight="n")) == [(100, 5, 9)]
    assert rows(audits.approximate_percentile(samples, "id")) == [(40, 38, 40)]


def plain_rank(values, rank):
    return sorted(values)[rank - 1] if rank >= 1 else None


def test_selection_narrows_to_the_rank(spark, monkeypatch):
    """By rounds over all kinds of values, with few ranges and few values left in the end."""
    random_ = random.Random(8)
    groups = {
        "even": [random_.randrange(10**6) for _ in range(900)],
        "outlier": [random_.randrange(100) * 7 for _ in range(900)] + [10**15, -(10**15)],
        "same": [5] * 300,
        "steep": [int(1.5**k) * random_.choice([1, -1]) for k in range(90)],
        "one": [3],
        None: list(range(-400, 400)),
    }
    held = [(g, v, random_.randint(1, 3)) for g, values in groups.items() for v in values]
    for kind in ("long", "double"):
        frame = spark.createDataFrame(held, "g string, v long, w long").withColumn("v", F.col("v").cast(kind))
        steps = frame.groupBy("g", "v").agg(F.sum("w").alias("n"))
        for fraction in (0.0, 0.5, 0.95, 1.0):
            found = value_of_rank(steps, "v", ["g"], lambda n, f=fraction: F.floor(n * F.lit(f)), few=5, ranges=10)
            got = {r.g: (r.samples, r.percentile, r.largest) for r in found.collect()}
            for g in groups:
                values = [v for group, v, w in held if group == g for _ in range(w)]
                assert got[g] == (len(values), plain_rank(values, int(len(values) * fraction)), max(values)), (g, kind, fraction)
    assert value_of_rank(steps.limit(0), "v", ["g"], lambda n: n).count() == 0


def test_an_outlier_gathers_no_values(spark, monkeypatch):
    """A million values and one far off: two rounds leave a few thousand to put in order."""
    seen = []
    real = selection._kept

    def kept(rows_, label):
        out = real(rows_, label)
        if label == "bounds":
            seen.append(out.first().held)
        return out

    monkeypatch.setattr(selection, "_kept", kept)
    samples = spark.range(10**6).withColumn("v", F.when(F.col("id") == 7, F.lit(10**12)).otherwise(F.col("id")))
    assert rows(audits.rank_percentile(samples, "v")) == [(10**6, 950_000, 10**12)]
    assert seen[0] == 10**6 and seen[-1] <= selection.FEW and len(seen) <= 4


def test_equal_hours_are_told_by_their_digests(spark):
    held = [("c1", "2026-06-13T14:00:00Z", 3), ("c2", "2026-06-13T14:05:00Z", 1), ("c1", "2026-06-13T15:00:00Z", 2), ("c1", "2026-06-13T16:00:00Z", 2)]
    other = [held[1], held[0], ("c1", "2026-06-13T15:00:00Z", 9), ("c1", "2026-06-13T17:00:00Z", 2)]
    digests = [reconcile.hour_digests(counts(spark, *x)) for x in (held, other)]
    hours = rows(reconcile.differing_hours(*digests).select(F.date_format("hour", "HH")))
    assert hours == [("15",), ("16",), ("17",)]


def test_lookback_by_index_reads_hours_with_hits(spark, raw, tmp_path):
    index = str(tmp_path / "index")
    reconcile.write_impression_index(archive.read_archive(spark, raw), index)
    bounds = (H14, H15, timedelta(hours=48))
    by_index = reconcile.recompute_by_index(spark, raw, index, *bounds)
    assert rows(by_index) == rows(reconcile.recompute_period(spark, raw, *bounds)) and by_index.count() == 2
    # A wider look finds no hit in May and agrees all the same.
    wide = (H14, H16, timedelta(days=60))
    assert rows(reconcile.recompute_by_index(spark, raw, index, *wide)) == rows(reconcile.recompute_period(spark, raw, *wide))


def test_hour_summaries_merge_to_any_period(spark):
    clicks = [(f"imp_{i % 5000}", "c1", f"2026-06-1{3 + i % 2}T{i % 24:02}:00:{i % 60:02}Z") for i in range(20_000)]
    raw = archive.with_partitions(events(spark, *clicks))
    hours = sketches.hour_sketches(raw)
    assert hours.count() == 24
    for row in sketches.merged(hours, ["dt"]).collect():
        exact = len({c[0] for c in clicks if c[2].startswith(row.dt)})
        assert abs(row.captured - exact) <= 2 * sketches.DISTINCT_ERROR * exact and row.clicks == 10_000
    assert sketches.merged(hours, []).first().delay == 0


def test_hot_ads(spark):
    clicks = spark.createDataFrame([("a",)] * 3 + [("b",)], "ad_id string")
    assert rows(audits.hot_ads(clicks, 0.5)) == [("a", 3, 0.75)]


def test_swap_leaves_other_hours_alone(spark, tmp_path):
    table = AggregateTable(spark, str(tmp_path / "t")).create()
    stored = [("c1", "2026-06-13T12:00:00Z", 3), ("c1", "2026-06-13T12:05:00Z", 4)]
    table.upsert(counts(spark, *stored), now())
    start, end = periods.parse("2026-06-13T10:00:00Z"), periods.parse("2026-06-13T11:00:00Z")
    stray = counts(spark, ("c1", "2026-06-13T12:00:00Z", 9), ("c1", "2026-06-13T10:00:00Z", 1))
    table.swap(stray, start, end, now())
    assert [row[1:3] for row in shown(table.read())] == [
        ("2026-06-13T10:00:00Z", 1),
        ("2026-06-13T12:00:00Z", 3),
        ("2026-06-13T12:05:00Z", 4),
    ]


def test_periods_may_have_any_offset(spark, tmp_path):
    table = AggregateTable(spark, str(tmp_path / "t")).create()
    table.upsert(counts(spark, ("c1", "2026-06-13T12:00:00Z", 3)), now())
    zone = timezone(timedelta(hours=5, minutes=30))
    start = periods.parse("2026-06-13T12:00:00Z")
    for bounds in ((start, start + timedelta(minutes=30)), (start - timedelta(hours=1), start)):
        here, there = (
            shown(table.read(*(time.astimezone(z) for time in bounds))) for z in (UTC, zone)
        )
        assert here == there
    with pytest.raises(ValueError):
        table.read(datetime(2026, 6, 13))


def test_a_cluster_without_a_shared_folder_is_refused():
    from types import SimpleNamespace

    from clickmeter.session import shared_folder

    conf = SimpleNamespace(get=lambda name, default: default, set=lambda name, value: None)
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            shared_folder(SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master)))
    local = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="local[2]"))
    assert shared_folder(local)
