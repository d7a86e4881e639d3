"""Streaming capture, second stage: the first click of an impression is accepted.

The state holds the accepted arrivals. A call to the state store costs a Python worker about as
much as a thousand clicks, so impressions share a key: those of a bucket, by hash, are worked on
together, and a map state keeps their accepted arrivals by slots of time, a fixed part of the
lifetime each. A batch reads the bucket's slots and writes those it adds to. A slot is kept until
arrivals, not clocks, have passed its lifetime and the delay that a click may have, so stopping
the stream or working off a backlog lets nothing count twice. The first stage has set aside what
is later than that, so no row is dropped here.

Every row comes back with its answer. A batch becomes `<root>/answered/batch=<name>`, and its
accepted rows become events, as JSON lines for the counter and the archiver to follow.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from clickmeter.functions.events import event_json
from clickmeter.plans.capture import answer_columns, as_events
from clickmeter.schemas import CLICK_EVENT
from clickmeter.settings import ARRIVAL_DELAY, CHECKPOINT_INTERVAL, IMPRESSION_TTL_SECONDS
from clickmeter.sources.batches import batch_name, publish
from clickmeter.sources.files import file_system, make_folder
from clickmeter.streaming.intake import TAKEN

# A checkpoint goes with its number of buckets.
BUCKETS = 512
ANSWERED = TAKEN + ", emitted boolean"
# A query keeps the settings it was started with. Remembered impressions are too many for memory.
_STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def first_click_processor(ttl_seconds: int) -> StatefulProcessor:
    # The class stays inside, so that executors need not have this package.
    slot_seconds = max(1, ttl_seconds // 12)

    def packed(clicks: dict[str, int]) -> bytes:
        table = pa.table({"impression_id": pa.array(clicks.keys(), pa.string()), "arrival": pa.array(clicks.values(), pa.int64())})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_table(table)
        return sink.getvalue().to_pybytes()

    def unpacked(stored: bytes, asked: pa.Array | None = None) -> dict[str, int]:
        table = pa.ipc.open_stream(pa.py_buffer(bytes(stored))).read_all()
        if asked is not None:
            table = table.filter(pc.is_in(table["impression_id"], value_set=asked))
        return dict(zip(table["impression_id"].to_pylist(), table["arrival"].to_pylist(), strict=True))

    class FirstClicks(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.accepted = handle.getMapState("accepted", "slot long", "clicks binary")

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            clicks = pd.concat(list(rows), ignore_index=True).sort_values(["arrival", "opens"], kind="stable")
            asked = pa.array(clicks["impression_id"].unique(), pa.string())
            last, slots = {}, set()
            for (slot,), (stored,) in self.accepted.iterator():
                slots.add(slot)
                for impression, arrival in unpacked(stored, asked).items():
                    last[impression] = max(arrival, last.get(impression, arrival))
            new: dict[int, dict[str, int]] = {}
            emitted = []
            for impression, arrival in zip(clicks["impression_id"].tolist(), clicks["arrival"].tolist(), strict=True):
                accepted = impression not in last or arrival - last[impression] >= ttl_seconds
                if accepted:
                    last[impression] = arrival
                    new.setdefault(arrival // slot_seconds, {})[impression] = arrival
                emitted.append(accepted)
            # No later arrival comes before this one, so what ended by then refuses nothing any more.
            earliest = clicks["earliest"].max()
            for slot in slots | new.keys():
                ended = (slot + 1) * slot_seconds + ttl_seconds <= earliest
                if ended and slot in slots:
                    self.accepted.removeKey((slot,))
                elif slot in new and not ended:
                    held = unpacked(self.accepted.getValue((slot,))[0]) if slot in slots else {}
                    self.accepted.updateValue((slot,), (packed(held | new[slot]),))
            yield pd.DataFrame({"taken": clicks["taken"], "emitted": emitted})

        def close(self) -> None:
            pass

    return FirstClicks()


def answered(taken: DataFrame, ttl_seconds: int = IMPRESSION_TTL_SECONDS, delay: str = ARRIVAL_DELAY) -> DataFrame:
    """Valid requests of the first stage with `emitted`.

    A request crosses to Python as one text; there it is only tagged. The watermark drops rows
    at its delay as well as those behind, hence the second more.
    """
    # The column of the watermark goes to pandas, which knows these years only.
    known = F.greatest(F.least("received_at", F.lit("2262-01-01").cast("timestamp")), F.lit("1678-01-01").cast("timestamp"))
    order = F.concat(F.date_format("clicked_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.coalesce("request_id", F.lit("")))
    columns = [field.split()[0] for field in TAKEN.split(", ")]
    return (
        taken.withColumn("known", known)
        .withWatermark("known", f"{delay} 1 second")
        .select(
            F.pmod(F.xxhash64("impression_id"), F.lit(BUCKETS)).alias("bucket"),
            "known",
            "impression_id",
            F.unix_timestamp("received_at").alias("arrival"),
            F.unix_timestamp(F.col("known") - F.expr(f"INTERVAL {delay} 1 second")).alias("earliest"),
            order.alias("opens"),
            F.to_json(F.struct(*columns)).alias("taken"),
        )
        .groupBy("bucket")
        .transformWithStateInPandas(first_click_processor(ttl_seconds), "taken string, emitted boolean", "Append", "EventTime")
        .select(F.from_json("taken", TAKEN).alias("taken"), "emitted")
        .select("taken.*", "emitted")
    )


def start_answering(
    spark: SparkSession,
    root: str,
    events: str,
    checkpoint: str,
    trigger: dict | None = None,
    ttl_seconds: int = IMPRESSION_TTL_SECONDS,
    delay: str = ARRIVAL_DELAY,
) -> StreamingQuery:
    """Answer what the first stage takes in below `root`; accepted clicks go to the folder `events`."""
    fs, path = file_system(spark, f"{root}/taken")
    make_folder(fs, spark, path)
    taken = spark.readStream.schema(TAKEN + ", batch string, kind string").parquet(path).where("kind = 'valid'")

    def answer(batch: DataFrame, number: int) -> None:
        session, name = batch.sparkSession, batch_name(batch.sparkSession, number)
        # The draft is written even where the folder is there, as the state must follow.
        publish(session, f"{root}/answered", name, lambda draft: batch.write.parquet(draft))
        accepted = session.read.schema(ANSWERED).parquet(f"{root}/answered/batch={name}").where("emitted")
        lines = as_events(accepted).select(event_json().alias("value"))
        publish(session, events, name, lambda draft: lines.write.text(draft))

    conf = spark.conf
    before = {name: conf.get(name) for name in _STATE_SETTINGS}
    for name, value in _STATE_SETTINGS.items():
        conf.set(name, value)
    try:
        return (
            answered(taken, ttl_seconds, delay)
            .writeStream.outputMode("append")
            .foreachBatch(answer)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": CHECKPOINT_INTERVAL}))
            .start()
        )
    finally:
        for name, value in before.items():
            conf.set(name, value)


def read_events(spark: SparkSession, events: str) -> DataFrame:
    return spark.read.schema(CLICK_EVENT).json(f"{events}/batch=*")


def read_outcomes(spark: SparkSession, root: str) -> DataFrame:
    """What every request is answered that was not set aside: refused, folded, accepted or repeated."""
    taken = spark.read.schema(TAKEN + ", batch string, kind string").parquet(f"{root}/taken")
    early = taken.where("kind in ('refused', 'folded')").withColumn("emitted", F.lit(False))
    late = spark.read.schema(ANSWERED + ", batch string").parquet(f"{root}/answered")
    return early.select(*answer_columns()).unionByName(late.select(*answer_columns()))
