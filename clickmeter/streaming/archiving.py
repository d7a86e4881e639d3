"""The archiver: click stream to Parquet hours, with what cannot be read set aside.

Batches are written as plain Parquet, like those of batch jobs: any number of writers may
share an archive, and days may be removed from it. The folders of a batch carry its name, and
a batch that is repeated after a crash replaces them, so every record is kept once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickmeter.settings import CHECKPOINT_INTERVAL
from clickmeter.sources.archive import split_records, write_archive, write_errors
from clickmeter.sources.batches import batch_name


def start_archiving(
    records: DataFrame,
    path: str,
    error_path: str,
    checkpoint: str,
    trigger: dict | None = None,
    as_of: Column | None = None,
) -> list[StreamingQuery]:
    """Start the archive and the error writer, each with its own checkpoint.

    The number of files and tasks of an hour follows from its bytes in the batch.
    """
    trigger = trigger or {"processingTime": CHECKPOINT_INTERVAL}
    good, bad = split_records(records, F.current_timestamp() if as_of is None else as_of)
    return [
        _start(good, lambda rows, name: write_archive(rows, path, name), f"{checkpoint}/archive", trigger),
        _start(bad, lambda rows, name: write_errors(rows, error_path, name), f"{checkpoint}/errors", trigger),
    ]


def _start(
    rows: DataFrame, write: Callable[[DataFrame, str], None], checkpoint: str, trigger: dict
) -> StreamingQuery:
    return (
        rows.writeStream.outputMode("append")
        .foreachBatch(lambda batch, number: write(batch, batch_name(batch.sparkSession, number)))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
