"""Removal of paragraphs and passages that other documents hold, by MinHash banding.

Paragraphs are lines of 20 words or more. Equal ones are one item; items get a MinHash
signature over runs of five words. Rows per band are fixed and the number of bands follows
from the threshold and the share of pairs that may be missed: 2 rows and 12 bands miss less
than 1e-5 of the pairs at similarity 0.8. Items that share a band are joined as in `near`,
verified by the exact Jaccard similarity of their runs, and clustered by components. Of each
cluster the paragraph that is first by (doc_id, place) stays.

A passage may also lie inside a longer paragraph. So the words of a document are cut into
short pieces where a word's hash is the least of its neighbourhood, wherever lines end. Of every
two neighbouring pieces the first document by doc_id that has them so is found. A run of pieces
goes if it has 16 words or more and one document, with a smaller doc_id, is the first for all its
pairs: text that earlier documents hold in bits only, each another one, stays.

Defined cases: a null text is empty; shorter lines are never paragraphs. Rows with the same
doc_id count as one document. Rows without doc_id are left out. An empty table gives an empty
one. Only the two named columns are read. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmeter.llm import near
from clickmeter.llm.common import BASE, BASE_INVERSE, among, flat, in_row, list_array, mixed, pieces, powers, text_bytes, word_spans, written

MIN_WORDS = 20
MIN_RUN = 16
RADIUS = 4
BAND_ROWS = 2
MISSED = 1e-5
NO_WORD = np.uint64(0xFFFFFFFFFFFFFFFF)
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, n_paragraphs long, n_removed_paragraphs long, kept_sha256 string"


def bands_for(threshold: float, rows: int = BAND_ROWS, missed: float = MISSED) -> int:
    """The fewest bands that miss at most this share of pairs at the threshold."""
    return math.ceil(math.log(missed) / math.log(1 - threshold**rows))


def line_offsets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where lines start (and the end), the text of each line and its place in the text."""
    starts = np.union1d(offsets[:-1][np.diff(offsets) > 0], np.flatnonzero(data == 10) + 1)
    starts = starts[starts < len(data)]
    text = np.searchsorted(offsets, starts, "right") - 1
    first = np.searchsorted(text, np.arange(len(offsets) - 1))
    return np.append(starts, len(data)), text, np.arange(len(starts)) - first[text]


def _lines(data: np.ndarray, offsets: np.ndarray):
    """Words of the lines that are paragraphs, with the text and the place of each."""
    bounds, text, place = line_offsets(data, offsets)
    words, first = near.word_hashes(data, bounds)
    long = np.diff(first) >= MIN_WORDS
    keep = np.repeat(long, np.diff(first))
    words = words[first[0] : first[-1]][keep] if len(words) else words
    sizes = np.diff(first)[long]
    first = np.concatenate([[0], np.cumsum(sizes)])
    items = near.sequence_hashes(words, first, near.STEP).view(np.int64)
    return words, first, text[long], place[long], items


def _paragraph_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_numpy()
        data, offsets = text_bytes(batch.column(1))
        for a, b in pieces(offsets):
            _, _, text, place, items = _lines(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            yield pa.RecordBatch.from_arrays([pa.array(ids[a + text]), pa.array(place), pa.array(items)], names=["doc_id", "place", "item"])


def _signature_rows(bands: int):
    seeds = mixed(np.arange(1, bands * BAND_ROWS + 1, dtype=np.uint64) * near.OTHER)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for a, b in pieces(offsets):
                words, first, _, _, items = _lines(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                rows, hashes = near.shingles(words, first)
                starts = np.searchsorted(rows, np.arange(len(items)))
                least = np.empty((len(items), len(seeds)), np.uint64)
                for k, seed in enumerate(seeds if len(items) else ()):
                    least[:, k] = np.minimum.reduceat((hashes ^ seed) * near.STEP, starts)
                keys = near.band_keys(least, BAND_ROWS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(items), list_array(keys.reshape(-1), np.arange(len(items) + 1) * bands)], names=["item", "bands"]
                )

    return run


def _gram_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct runs of five words of the wanted paragraphs of each document."""
    for batch in batches:
        wanted = batch.column("wanted")
        data, offsets = text_bytes(batch.column("text"))
        for a, b in pieces(offsets):
            words, first, text, _, items = _lines(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            rows, hashes, _ = near.counted(*near.shingles(words, first))
            bounds = np.searchsorted(rows, np.arange(len(items) + 1))
            keep = among(text, items, wanted.slice(a, b - a))
            _, at = np.unique(items, return_index=True)
            keep &= np.isin(np.arange(len(items)), at)
            found = pa.RecordBatch.from_arrays([pa.array(items), list_array(hashes.view(np.int64), bounds)], names=["item", "grams"])
            yield found.filter(pa.array(keep))


def short_pieces(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word, end and hash of the pieces between words with the least hash around."""
    n, texts = len(words), len(first) - 1
    text = np.repeat(np.arange(texts), np.diff(first))
    at = np.arange(n) + RADIUS * (text + 1)
    padded = np.full(n + RADIUS * (texts + 1) + RADIUS, NO_WORD, np.uint64)
    padded[at] = words
    around = np.lib.stride_tricks.sliding_window_view(padded, 2 * RADIUS + 1)[at - RADIUS]
    cut = np.flatnonzero(around.argmin(axis=1) == RADIUS)
    starts = np.union1d(cut, first[:-1][np.diff(first) > 0])
    ends = np.append(starts[1:], n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(mixed(words) * powers(BASE, n), out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * powers(BASE_INVERSE, n + 1)[starts] + (ends - starts).astype(np.uint64))
    return text[starts], starts, ends, hashes.view(np.int64)


def piece_pairs(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word, end and hash of every two neighbouring pieces."""
    text, starts, ends, hashes = short_pieces(words, first)
    if len(text) < 2:
        return text[:0], starts[:0], ends[:0], hashes[:0]
    pair = mixed(hashes[:-1].view(np.uint64) * near.STEP + hashes[1:].view(np.uint64)).view(np.int64)
    same = text[:-1] == text[1:]
    return text[:-1][same], starts[:-1][same], ends[1:][same], pair[same]


def _piece_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_numpy()
        data, offsets = text_bytes(batch.column(1))
        for a, b in pieces(offsets):
            words, first = near.word_hashes(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            text, _, _, hashes = piece_pairs(words, first)
            rows, hashes, _ = near.counted(text, hashes)
            yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(ids[a + rows])], names=["piece", "doc_id"])


def _holders(owner: np.ndarray, pairs: np.ndarray, known: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Whether a pair is known to an earlier document, and to which."""
    rows, entries = flat(known)
    if not len(entries) or not len(pairs):
        return np.zeros(len(pairs), bool), np.zeros(len(pairs), np.int64)
    keys = in_row(rows, entries.field("piece").to_numpy())
    order = np.argsort(keys)
    keys, low = keys[order], entries.field("low").to_numpy()[order]
    wanted = in_row(owner, pairs)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return keys[at] == wanted, low[at]


def _stripped(data: np.ndarray, offsets: np.ndarray, lines: pa.Array, known: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which bytes of a piece of texts go; paragraphs of each text and removed ones."""
    texts = len(offsets) - 1
    edge = np.zeros(len(data) + 1, np.int64)
    bounds, text, place = line_offsets(data, offsets)
    starts, ends, first = word_spans(data, offsets)
    long = np.diff(np.searchsorted(starts, bounds)) >= MIN_WORDS
    gone = long & among(text, place, lines)
    np.add.at(edge, bounds[:-1][gone], 1)
    np.add.at(edge, bounds[1:][gone], -1)
    if len(starts):
        words, first = near.word_hashes(data, offsets)
        owner, a, b, hashes = piece_pairs(words, first)
        again, holder = _holders(owner, hashes, known)
        # A run ends where a pair is new, another document is the first to have it, or the text ends.
        other = (owner[1:] != owner[:-1]) | (holder[1:] != holder[:-1])
        start, stop = again.copy(), again.copy()
        start[1:] &= ~again[:-1] | other
        stop[:-1] &= ~again[1:] | other
        a, b = a[start], b[stop]
        enough = b - a >= MIN_RUN
        np.add.at(edge, starts[a[enough]], 1)
        np.add.at(edge, ends[b[enough] - 1], -1)
    return np.cumsum(edge[:-1]) > 0, np.bincount(text[long], minlength=texts), np.bincount(text[gone], minlength=texts)


def _result_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        lines, known = batch.column("lines"), batch.column("known")
        rows = []
        for a, b in pieces(offsets):
            part, bounds = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            gone, counts, removed = _stripped(part, bounds, lines.slice(a, b - a), known.slice(a, b - a))
            for i in range(b - a):
                own, cut = part[bounds[i] : bounds[i + 1]], gone[bounds[i] : bounds[i + 1]]
                lost = int(np.count_nonzero(cut))
                spans = int(np.count_nonzero(cut[1:] & ~cut[:-1]) + cut[0]) if lost else 0
                kept = own[~cut] if lost else own
                rows.append((len(own), lost, spans, int(counts[i]), int(removed[i]), hashlib.sha256(kept.tobytes()).hexdigest()))
        *columns, digests = zip(*rows, strict=True) if rows else ((),) * 6
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns), pa.array(digests, pa.string())],
            names=[part.split(" ")[0] for part in RESULT.split(", ")],
        )


def _repeated_paragraphs(docs: DataFrame, threshold: float) -> DataFrame:
    """doc_id and the places of the paragraphs that go."""
    found = written(docs.mapInArrow(_paragraph_rows, "doc_id long, place long, item long"), "paragraphs")
    signed = docs.mapInArrow(_signature_rows(bands_for(threshold)), "item long, bands array<long>")
    items = written(signed.groupBy("item").agg(F.first("bands").alias("bands")), "signatures")
    firsts = written(found.groupBy("item").agg(F.min(F.struct("doc_id", "place")).alias("first")), "first-paragraphs")

    def grams_of(wanted: DataFrame) -> DataFrame:
        rows = wanted.join(firsts, "item").groupBy(F.col("first.doc_id").alias("doc_id")).agg(F.collect_set("item").alias("wanted"))
        return docs.join(rows, "doc_id").mapInArrow(_gram_rows, "item long, grams array<long>")

    known = near.links(items, grams_of, threshold)
    firsts = firsts.join(known, "item", "left").withColumn("component", F.coalesce("component", "item"))
    least = firsts.groupBy("component").agg(F.min("first").alias("least"))
    firsts = firsts.select("item", "component").join(least, "component").select("item", "least")
    gone = found.join(firsts, "item").where((F.col("doc_id") != F.col("least.doc_id")) | (F.col("place") != F.col("least.place")))
    return gone.groupBy("doc_id").agg(F.collect_set("place").alias("lines"))


def _repeated_pieces(docs: DataFrame) -> DataFrame:
    """doc_id and the pairs of pieces that an earlier document holds, with the first that does."""
    found = docs.mapInArrow(_piece_rows, "piece long, doc_id long")
    span = found.groupBy("piece").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    span = written(span.select("piece", "low"), "repeated-pieces")
    again = found.join(span.hint("shuffle_hash"), "piece").where("doc_id > low")
    return again.groupBy("doc_id").agg(F.collect_set(F.struct("piece", "low")).alias("known"))


def removals(docs: DataFrame, ids: str = "doc_id", text: str = "text", threshold: float = near.THRESHOLD) -> DataFrame:
    """A row for each document: bytes, removed bytes and runs, paragraphs, and the hash of what stays."""
    read = docs.select(F.col(ids).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).where("doc_id is not null")
    lines = written(_repeated_paragraphs(read, threshold), "removed-paragraphs")
    known = written(_repeated_pieces(read), "removed-pieces")
    rows = read.join(lines, "doc_id", "left").join(known, "doc_id", "left")
    return rows.select("doc_id", "text", "lines", "known").mapInArrow(_result_rows, RESULT)
