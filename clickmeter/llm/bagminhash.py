"""Near copies of documents by weighted minwise sketches of their word shingles.

A document is a bag: every run of five words with the number of its occurrences as weight.
Weights are cut at 1, 2, 4, 8 ... For every shingle and every part below its weight a Poisson
process sends points, at a rate in proportion to the part's width; each point has a time, a
component of the signature and a height inside the part, and counts if the height is below
the weight. Components keep the least time. Two documents see the same points below the
lesser of their weights, so components agree with the probability of the weighted Jaccard
similarity. Processes run in order of time and end once they pass the largest component.

Signatures are cut into bands of 4 of 96 components: a pair at similarity 0.8 shares none of
the 24 with probability 3e-6. Pairs are then verified on the bags themselves.

Defined cases: documents without a word (null, empty or blank texts) are in no class but
their own; so are rows without doc_id, whose class is null. Texts of one to four words are one
shingle. Equal word sequences are one item,
told apart by 64-bit hashes. Repeated doc_ids are rows of the same document.
An empty table gives an empty one. Only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmeter.llm import near
from clickmeter.llm.common import list_array, mixed, pieces, text_bytes, written

COMPONENTS = 96
BAND_ROWS = 4
GOLDEN = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1


def _uniform(bits: np.ndarray) -> np.ndarray:
    return ((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def signatures(rows: np.ndarray, hashes: np.ndarray, weights: np.ndarray, n: int, size: int = COMPONENTS) -> np.ndarray:
    """n x size least times; a text without shingles keeps infinity."""
    least = np.full((n, size), np.inf)
    flat = least.reshape(-1)
    parts, low = [], 0
    while True:
        high = max(1, 2 * low)
        some = np.flatnonzero(weights > low)
        if not len(some):
            break
        seeds = mixed(hashes[some] + np.uint64(high * GOLDEN & MASK))
        parts.append((rows[some], seeds, weights[some], np.full(len(some), low), np.full(len(some), high - low)))
        low = high
    if not parts:
        return least
    row, seed, weight, low, width = (np.concatenate(x) for x in zip(*parts, strict=True))
    time = np.zeros(len(row))
    step = 0
    while len(row):
        step += 1
        bits = mixed(seed + np.uint64(step * GOLDEN & MASK))
        time = time - np.log(_uniform(bits)) / width
        other = mixed(bits ^ seed)
        component = (other % np.uint64(size)).astype(np.int64)
        height = low + _uniform(mixed(other)) * width
        counts = height < weight
        np.minimum.at(flat, (row * size + component)[counts], time[counts])
        alive = time <= least.max(axis=1)[row]
        row, seed, weight, low, width, time = (x[alive] for x in (row, seed, weight, low, width, time))
    return least


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_bytes(batch.column(1))
        for a, b in pieces(offsets):
            words, first = near.word_hashes(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            rows, hashes, weights = near.counted(*near.shingles(words, first))
            keys = near.band_keys(signatures(rows, hashes, weights, b - a).view(np.uint64), BAND_ROWS)
            some = np.flatnonzero(np.diff(first))
            item = near.sequence_hashes(words, first, near.STEP)[some].view(np.int64)
            bounds = np.arange(len(some) + 1) * keys.shape[1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(a + some)), pa.array(item), list_array(keys[some].reshape(-1), bounds)],
                names=["doc_id", "item", "bands"],
            )


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_bytes(batch.column(1))
        for a, b in pieces(offsets):
            words, first = near.word_hashes(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            rows, grams = near.numbered(*near.shingles(words, first))
            bounds = np.searchsorted(rows, np.arange(b - a + 1))
            found = pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), list_array(grams.view(np.int64), bounds)], names=["item", "grams"]
            )
            # Another text may have the same doc_id.
            own = near.sequence_hashes(words, first, near.STEP).view(np.int64) == found.column(0).to_numpy()
            yield found.filter(pa.array(own))


def classes(docs: DataFrame, ids: str = "doc_id", text: str = "text", threshold: float = near.THRESHOLD) -> DataFrame:
    """A row for each document: doc_id, text_id and class_id.

    text_id is the least doc_id with the same words, class_id the least doc_id of the class.
    """
    read = docs.select(F.col(ids).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sketches = written(
        read.where("doc_id is not null").mapInArrow(_sketches, "doc_id long, item long, bands array<long>"), "sketches"
    )
    items = sketches.groupBy("item").agg(F.min("doc_id").alias("text_id"), F.first("bands").alias("bands"))
    items = written(items, "items")

    def grams_of(wanted: DataFrame) -> DataFrame:
        rows = wanted.join(items.select("item", F.col("text_id").alias("doc_id")), "item")
        return rows.join(read, "doc_id").select("item", "text").mapInArrow(_grams, "item long, grams array<long>")

    known = near.links(items.select("item", "bands"), grams_of, threshold)
    texts = items.select("item", "text_id").join(known, "item", "left").withColumn("component", F.coalesce("component", "item"))
    least = texts.groupBy("component").agg(F.min("text_id").alias("class_id"))
    texts = texts.join(least, "component").select("item", "text_id", "class_id")
    own = sketches.select("doc_id", "item").join(texts, "item").groupBy("doc_id").agg(
        F.min("text_id").alias("text_id"), F.min("class_id").alias("class_id")
    )
    return read.select("doc_id").join(own, "doc_id", "left").select(
        "doc_id", F.coalesce("text_id", "doc_id").alias("text_id"), F.coalesce("class_id", "doc_id").alias("class_id")
    )


def kept(docs: DataFrame, ids: str = "doc_id", text: str = "text", threshold: float = near.THRESHOLD) -> DataFrame:
    """The documents without those whose class has a smaller doc_id; rows without doc_id stay."""
    gone = classes(docs, ids, text, threshold).where("doc_id <> class_id").select(F.col("doc_id").alias(ids)).distinct()
    return docs.join(gone.hint("merge"), ids, "left_anti")
