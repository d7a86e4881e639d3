"""Documents that hold benchmark items, by the q-gram lemma and banded alignment.

Both sides are lower-cased and white space is one blank. A probe of m characters that lies in
a text with at most e edits (e is a twentieth of m) shares m + 1 - q - q*e of its q-grams with
it, on at most e + 1 neighbouring diagonals (place in the text less place in the probe). Gram
hits are counted in bands of 2(e + 1) diagonals, each overlapping the next by half, so that
one band holds them all. A region whose count reaches the bound is aligned in its band, with
free ends in the text; it stays if the distance is at most e.

Items of up to 400 characters are a probe; longer ones are cut into probes of 400 that overlap
by half. One found probe counts.

With `passages`, as in the query and the pipeline, a passage of an item counts as well: every
item is cut into parts of 140 characters at a stride of 35, the last one at its end, each a
probe with its own e. So a copied run of 174 characters or more holds a whole part wherever it
starts, and is always found. The distance is that of the item or its probe of 400, and that
of the nearest part only if none of these is found. Without it only items as a whole, or
probes of 400, match.

Probes are sent to the executors in blocks of a fixed number of characters, each with a pass
over all documents. A benchmark of several blocks is worked off one block after the other: the
hits of one are written before the next is read, so the driver and the executors hold one at
a time. Equal grams in a row, as of repeated characters, are counted as runs.

Defined cases: null and empty texts or items match nothing, as do items too short for the
bound to be positive at e = 0 (under 10 characters). Equal items are reported each. Repeated
rows of a document or an item give one pair. Null ids are left out. Empty tables give an
empty result. Only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmeter.llm.common import first_of_runs, written

Q = 10
EDIT_SHARE = 20
PROBE = 400
PART = 140
STRIDE = 35
BLOCK_CHARS = 2_000_000
PIECE_CHARS = 1_000_000
FILTER_BITS = 24
CHUNK = 1_000_000
FACTOR = np.uint64(0x9E3779B97F4A7C15)
BASE, BASE_2, BASE_4 = (np.uint64(pow(0xD6E8FEB86659FD95, k, 1 << 64)) for k in (1, 2, 4))
HITS = "doc_id long, item_id long, part long, distance long, start long"


def normalised(text: str) -> str:
    return " ".join(text.lower().split())


def edits(m: int) -> int:
    """The edit budget of a probe: a twentieth of it, but small enough for a positive bound."""
    return max(0, min(m // EDIT_SHARE, m // Q - 1))


def _cut(text: str, size: int, step: int) -> list[str]:
    if len(text) <= size:
        return [text] if len(text) >= Q else []
    return [text[a : a + size] for a in range(0, len(text) - size, step)] + [text[-size:]]


def probes(text: str, passages: bool = False) -> list[tuple[bool, str]]:
    """Whether it is a part only, and the probe."""
    text = normalised(text)
    found = [(False, p) for p in _cut(text, PROBE, PROBE // 2)]
    if passages and len(text) > PART:
        found += [(True, p) for p in _cut(text, PART, STRIDE)]
    return found


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_hashes(chars: np.ndarray) -> np.ndarray:
    """A hash of every run of Q = 10 characters: 8 by doubling and 2 more."""
    n = len(chars) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    two = chars[:-1].astype(np.uint64) * BASE + chars[1:]
    four = two[:-2] * BASE_2 + two[2:]
    eight = four[:-4] * BASE_4 + four[4:]
    return (eight[:n] * BASE_2 + two[8 : 8 + n]) * FACTOR


class Probes:
    """An index of the grams of a block of probes."""

    def __init__(self, rows: list[tuple[int, bool, str]]):
        rows = sorted(rows, key=lambda row: row[1])  # parts come last, when their item may be known
        self.items = np.array([i for i, _, _ in rows], np.int64)
        self.parts = np.array([part for _, part, _ in rows], bool)
        self.chars = [codes(p) for _, _, p in rows]
        self.texts = [p for _, _, p in rows]
        self.sizes = np.array([len(c) for c in self.chars], np.int64)
        self.edits = np.array([edits(m) for m in self.sizes], np.int64)
        self.bounds = np.maximum(1, self.sizes + 1 - Q - Q * self.edits)
        grams = [gram_hashes(c) for c in self.chars]
        edges = np.concatenate([[0], np.cumsum([len(g) for g in grams])]).astype(np.int64)
        flat = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        run, length = _runs(flat, edges[:-1][np.diff(edges) > 0])
        probe = np.searchsorted(edges, run, "right") - 1
        order = np.argsort(flat[run], kind="stable")
        self.probe, self.place, self.length = probe[order], (run - edges[probe])[order], length[order]
        held = flat[run][order]
        first = first_of_runs(held)
        self.keys = held[first]
        self.first = np.append(first, len(held))
        self.longest = int(self.sizes.max(initial=0))
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self.keys >> np.uint64(64 - FILTER_BITS)] = True

    def regions(self, chars: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Text, probe and first diagonal of the bands that hold as many grams as the bound.

        The texts lie one behind the other in `chars`. Equal grams in a row are one run, in the
        text as in the probe; two runs meet on neighbouring diagonals, and how often in a band
        follows from their lengths. Runs are taken up to `CHUNK` meetings at a time, and counts
        of bands that lie behind are settled, so neither repetitive texts nor grams that many
        probes have make the counts many.
        """
        grams = gram_hashes(chars)
        at, length = _runs(grams, starts[starts < len(grams)])
        likely = self.filter[grams[at] >> np.uint64(64 - FILTER_BITS)]
        at, length = at[likely], length[likely]
        key = np.searchsorted(self.keys, grams[at])
        key[key == len(self.keys)] = 0
        real = self.keys[key] == grams[at] if len(self.keys) else np.zeros(len(at), bool)
        at, length, key = at[real], length[real], key[real]
        met = self.first[key + 1] - self.first[key] if len(at) else np.zeros(0, np.int64)
        total = np.cumsum(met)
        open_ = [np.zeros(0, np.int64)] * 4
        low = 0
        while low < len(at):
            done = total[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(total, done + CHUNK, "right")))
            part = slice(low, high)
            counts = self._counts(at[part], length[part], key[part], met[part], starts, ends)
            doc, probe, band, weight = (np.concatenate(x) for x in zip(open_, counts, strict=True))
            order = np.lexsort((band, probe, doc))
            doc, probe, band, weight = (x[order] for x in (doc, probe, band, weight))
            new = np.ones(len(doc), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (probe[1:] != probe[:-1]) | (band[1:] != band[:-1])
            first = np.flatnonzero(new)
            doc, probe, band, weight = doc[first], probe[first], band[first], np.add.reduceat(weight, first)
            width = self.edits[probe] + 1
            behind = np.ones(len(doc), bool) if high == len(at) else starts[doc] + (band + 2) * width + self.longest <= at[high]
            for i in np.flatnonzero(behind & (weight >= self.bounds[probe])):
                yield int(doc[i]), int(probe[i]), int(band[i] * width[i])
            open_ = [x[~behind] for x in (doc, probe, band, weight)]
            low = high

    def _counts(self, at, length, key, met, starts, ends) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Text, probe, band and number of meetings of these runs; each is in two bands."""
        entry = np.repeat(self.first[key] - (np.cumsum(met) - met), met) + np.arange(met.sum())
        at, length = np.repeat(at, met), np.repeat(length, met)
        probe, place, own = self.probe[entry], self.place[entry], self.length[entry]
        doc = np.searchsorted(ends, at, "right")
        width = self.edits[probe] + 1
        first = at - starts[doc] - (place + own - 1)  # the least diagonal
        band = np.floor_divide(first, width)
        weight = np.ones(len(at), np.int64)
        if (length > 1).any() or (own > 1).any():
            n = np.floor_divide(first + length + own - 2, width) - band + 1
            band = np.repeat(band - (np.cumsum(n) - n), n) + np.arange(n.sum())
            doc, probe, first, width, length, own = (np.repeat(x, n) for x in (doc, probe, first, width, length, own))
            upto = band * width - first
            weight = _meetings(upto + width, length, own) - _meetings(upto, length, own)
        return np.tile(doc, 2), np.tile(probe, 2), np.concatenate([band, band - 1]), np.tile(weight, 2)


def _runs(grams: np.ndarray, opens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal grams; a run does not go on over one of `opens`."""
    if not len(grams):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.ones(len(grams), bool)
    np.not_equal(grams[1:], grams[:-1], out=new[1:])
    new[opens] = True
    at = np.flatnonzero(new)
    return at, np.diff(np.append(at, len(grams)))


def _meetings(n: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many pairs of places in runs of lengths a and b lie on the first n diagonals that have any."""

    def sums(x: np.ndarray) -> np.ndarray:
        x = np.maximum(x, 0)
        return x * (x + 1) // 2

    n = np.clip(n, 0, a + b - 1)
    return sums(n) - sums(n - a) - sums(n - b)


def aligned(probe: np.ndarray, text: np.ndarray, low: int, width: int) -> tuple[int, int]:
    """Least distance of the probe to a part of the text, and where in the text it ends.

    Only diagonals from low to low + width - 1 are looked at.
    """
    far = len(probe) + len(text) + 1
    offsets = np.arange(width)
    at = low + offsets
    row = np.where((at >= 0) & (at <= len(text)), 0, far)
    for i, symbol in enumerate(probe):
        at = low + i + offsets  # place in the text of the character that diagonal k reads
        inside = (at >= 0) & (at < len(text))
        same = np.zeros(width, bool)
        same[inside] = text[at[inside]] == symbol
        step = np.where(inside, row + ~same, far)
        step[:-1] = np.minimum(step[:-1], row[1:] + 1)
        row = np.minimum.accumulate(step - offsets) + offsets
        row[(at + 1 < 0) | (at + 1 > len(text))] = far
    best = int(row.argmin())
    return int(row[best]), low + len(probe) + best


def _found(texts: list[str], index: Probes) -> Iterator[tuple[int, int, int, int, int]]:
    """Text, item, whether by a part only, distance and start, for texts that are handled together."""
    parts = [codes(t) for t in texts]
    sizes = np.array([len(p) for p in parts], np.int64)
    ends = np.cumsum(sizes + 1)
    starts = ends - sizes - 1
    whole = np.zeros(int(ends[-1]), np.uint32)
    for p, s in zip(parts, starts, strict=True):
        whole[s : s + len(p)] = p
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for d, p, low in index.regions(whole, starts, ends):
        item, budget, part = int(index.items[p]), int(index.edits[p]), int(index.parts[p])
        known = best.get((d, item))
        if known and (known[0] < part or known[:2] == (part, 0)):
            continue
        near = max(0, low - budget)
        exact = texts[d].find(index.texts[p], near, low + 3 * (budget + 1) + int(index.sizes[p]))
        if exact >= 0:
            distance, start = 0, exact
        else:
            distance, end = aligned(index.chars[p], parts[d], low - budget, 2 * (budget + 1) + 2 * budget)
            start = max(0, end - int(index.sizes[p]))
        if distance <= budget and (known is None or (part, distance, start) < known):
            best[d, item] = (part, distance, start)
    for (d, item), found in best.items():
        yield d, item, *found


def _scan(block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Probes(block.value)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = [normalised(t) if t else "" for t in batch.column(1).to_pylist()]
            rows, first = [], 0
            while first < len(texts):
                last, size = first, 0
                while last < len(texts) and (last == first or size + len(texts[last]) <= PIECE_CHARS):
                    size += len(texts[last])
                    last += 1
                rows += [(ids[first + d], *found) for d, *found in _found(texts[first:last], index)]
                first = last
            columns = zip(*rows, strict=True) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "item_id", "part", "distance", "start"])

    return run


def _probe_rows(passages: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (i, part, p)
                for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                if text
                for part, p in probes(text, passages)
            ]
            ids, parts, texts = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(parts, pa.bool_()), pa.array(texts, pa.string())], names=["item_id", "part", "probe"]
            )

    return run


def leaks(
    docs: DataFrame, benchmark: DataFrame, ids: str = "doc_id", text: str = "text", items: str = "item_id", item_text: str = "text", block_chars: int = BLOCK_CHARS, passages: bool = False
) -> DataFrame:
    """doc_id, item_id, least distance and where in the normalised text, for each pair that is found."""
    spark = docs.sparkSession
    read = docs.select(F.col(ids).cast("long").alias("doc_id"), F.col(text).alias("text")).where("doc_id is not null and text is not null")
    source = benchmark.select(F.col(items).cast("long").alias("item_id"), F.col(item_text).alias("text")).where("item_id is not null")
    wanted = source.mapInArrow(_probe_rows(passages), "item_id long, part boolean, probe string").distinct()
    total = wanted.agg(F.sum(F.length("probe"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_chars))
    if blocks > 1:
        wanted = written(wanted, "probes")
    found = None
    for k in range(blocks):
        own = wanted.where(F.pmod(F.xxhash64("item_id", "part", "probe"), F.lit(blocks)) == k).orderBy("item_id", "part", "probe")
        sent = spark.sparkContext.broadcast([tuple(r) for r in own.collect()])
        part = read.mapInArrow(_scan(sent), HITS)
        if blocks > 1:  # one block at a time is on its way
            part = written(part, "block-hits")
            sent.destroy()
        found = part if found is None else found.unionByName(part)
    return found.groupBy("doc_id", "item_id").agg(F.min(F.struct("part", "distance", "start")).alias("best")).select(
        "doc_id", "item_id", "best.distance", "best.start"
    )


def kept(docs: DataFrame, benchmark: DataFrame, ids: str = "doc_id", text: str = "text", passages: bool = False) -> DataFrame:
    """The documents without those that hold a benchmark item; rows without doc_id stay."""
    found = leaks(docs, benchmark, ids, text, passages=passages).select(F.col("doc_id").alias(ids)).distinct()
    return docs.join(found, ids, "left_anti")
