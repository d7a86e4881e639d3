"""From band keys to classes of near copies, shared by the operators that sketch texts.

Items are distinct texts. Items that share a band key are in a bucket. Two steps find all
classes without making the pairs of a bucket:

1. In every bucket each item is held against one centre, the item that meets most others over
   all its buckets. Pairs whose overlap is verified are links, and links make components.
2. What is left are items of buckets that hold several components. Grams are ordered by how
   many of these items have them. Two items can only reach the threshold if they share one of
   their rarest grams, as many as may differ and one more; they meet at the first one that
   both have, and what follows it bounds their overlap. Pairs of different components within
   that bound are verified. Grams of a common passage are not among the rarest.

A gram that occurs several times is numbered, so that overlaps of sets are those of multisets.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmeter.llm.common import SpanHashes, mixed, word_spans, written
from clickmeter.llm.components import components

WORDS = 5
THRESHOLD = 0.8
STEP = np.uint64(0x9FB21C651E98DF25)
OTHER = np.uint64(0xD1342543DE82EF95)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every word, and the first word of each text (one more at the end)."""
    starts, ends, first = word_spans(data, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), first
    return SpanHashes(data).of(starts, ends), first


def sequence_hashes(words: np.ndarray, first: np.ndarray, base: np.uint64) -> np.ndarray:
    """A hash of the words of each text in order; 0 for a text without words."""
    out = np.zeros(len(first) - 1, np.uint64)
    some = np.flatnonzero(np.diff(first))
    if len(some):
        place = np.arange(len(words)) - np.repeat(first[:-1], np.diff(first))
        powers = np.full(int(place.max()) + 1, base, np.uint64)
        powers[0] = 1
        np.cumprod(powers, out=powers)
        out[some] = mixed(np.add.reduceat(mixed(words ^ base) * powers[place], first[some]) + np.diff(first)[some].astype(np.uint64))
    return out


def shingles(words: np.ndarray, first: np.ndarray, width: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash of every run of `width` words; a shorter text is one run."""
    counts = np.diff(first)
    n = len(words)
    hashes = words.copy()
    for k in range(1, width):
        hashes[: n - k] = hashes[: n - k] * STEP + words[k:] if n > k else hashes[: n - k]
    row = np.repeat(np.arange(len(counts)), counts)
    whole = np.arange(n) + width <= np.repeat(first[1:], counts)
    short = np.flatnonzero((counts > 0) & (counts < width))
    extra = np.zeros(len(short), np.uint64)
    for i, t in enumerate(short):
        value = words[first[t]]
        for w in words[first[t] + 1 : first[t + 1]]:
            value = np.uint64((int(value) * int(STEP) + int(w)) & 0xFFFFFFFFFFFFFFFF)
        extra[i] = value ^ OTHER
    return np.append(row[whole], short), mixed(np.append(hashes[whole], extra))


def counted(rows: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text, in order of text, with how often they occur."""
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(new)
    return rows[at], hashes[at], np.diff(np.append(at, len(rows)))


def numbered(rows: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Grams in order of text, where the k-th occurrence of a shingle is a gram of its own."""
    rows, hashes, counts = counted(rows, hashes)
    again = np.repeat(np.arange(len(rows)), counts)
    k = np.arange(len(again)) - np.repeat(np.cumsum(counts) - counts, counts)
    grams = hashes[again]
    more = k > 0
    grams[more] = mixed(grams[more] + k[more].astype(np.uint64) * OTHER)
    return rows[again], grams


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """One key for every `rows` components of each signature (texts x components of 64 bits)."""
    n, size = signature.shape
    cut = signature.reshape(n, size // rows, rows)
    keys = np.broadcast_to(np.arange(1, size // rows + 1, dtype=np.uint64) * OTHER, cut.shape[:2]).copy()
    for k in range(rows):
        keys = mixed(keys * STEP + cut[:, :, k])
    return keys.view(np.int64)


def verified(pairs: DataFrame, grams: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose grams overlap by the threshold: shared / all, counted with repeats."""
    left = grams.select(F.col("item").alias("a"), F.col("grams").alias("ga"))
    right = grams.select(F.col("item").alias("b"), F.col("grams").alias("gb"))
    shared = F.size(F.array_intersect("ga", "gb"))
    rows = pairs.join(left, "a").join(right, "b").select("a", "b", shared.alias("s"), (F.size("ga") + F.size("gb")).alias("n"))
    return rows.where((F.col("s") > 0) & (F.col("s") >= threshold * (F.col("n") - F.col("s")))).select("a", "b")


def _stars(buckets: DataFrame, degrees: DataFrame) -> DataFrame:
    """Every item of a bucket with the centre of the bucket."""
    rows = buckets.join(degrees, "item")
    centre = rows.groupBy("bucket").agg(F.max(F.struct("degree", "item")).alias("c")).select("bucket", F.col("c.item").alias("b"))
    return buckets.join(centre, "bucket").where("item <> b")


def links(bands: DataFrame, grams_of, threshold: float = THRESHOLD) -> DataFrame:
    """item and component of all items that reach the threshold with another one.

    `bands` has item and an array of band keys, a row for each item. `grams_of` takes a frame
    of items and returns item and grams, an array without repeats.
    """
    rows = bands.select("item", F.explode("bands").alias("bucket"))
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    buckets = written(rows.join(sizes.hint("shuffle_hash"), "bucket"), "buckets")
    degrees = written(buckets.groupBy("item").agg(F.sum("n").alias("degree")), "degrees")
    grams = written(grams_of(degrees.select("item")), "grams")
    buckets = buckets.select("bucket", "item")

    pairs = _stars(buckets, degrees).select(F.col("item").alias("a"), "b").distinct()
    found = written(verified(pairs, grams, threshold), "links")
    known = components(found)

    left = _divided(buckets, known)
    more = written(verified(_rare_pairs(left, grams, threshold), grams, threshold), "links")
    return known if more.isEmpty() else components(found.unionByName(more))


def _divided(buckets: DataFrame, known: DataFrame) -> DataFrame:
    """The items of buckets that hold several components, with the component of each."""
    rows = buckets.join(known, "item", "left").withColumn("component", F.coalesce("component", "item"))
    several = rows.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    return rows.join(several.select("bucket"), "bucket", "left_semi").select("item", "component").distinct()


def _rare_pairs(items: DataFrame, grams: DataFrame, threshold: float) -> DataFrame:
    """Pairs of different components that share one of the rarest grams of both."""
    own = written(items.join(grams, "item"), "divided-items")
    flat = own.select("item", F.explode("grams").alias("gram"))
    counts = flat.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # A gram of one item is rarer than all that are shared and meets nothing.
    shared = flat.join(counts, "gram").groupBy("item").agg(F.array_sort(F.collect_list(F.struct("n", "gram"))).alias("shared"))
    size = F.size("grams")
    spare = size - F.ceil(threshold * size).cast("int") + 1 - (size - F.size("shared"))
    rare = own.join(shared, "item").where(spare > 0).select(
        "item",
        "component",
        size.alias("size"),
        F.size("shared").alias("known"),
        F.transform(F.slice("shared", F.lit(1), F.greatest(spare, F.lit(0))), lambda x: x["gram"]).alias("rare"),
    )
    left = rare.select("*", F.posexplode("rare").alias("at", "gram"))
    right = left.select(*(F.col(c).alias(f"{c}_b") for c in left.columns if c != "gram"), "gram")
    # A pair meets once, at the first gram that both have; what follows bounds their overlap.
    once = F.element_at(F.array_intersect("rare", "rare_b"), 1) == F.col("gram")
    rest = F.least(F.col("known") - F.col("at"), F.col("known_b") - F.col("at_b"))
    enough = rest * (1 + threshold) >= threshold * (F.col("size") + F.col("size_b")) - 1e-6
    other = (F.col("item") < F.col("item_b")) & (F.col("component") != F.col("component_b"))
    return left.join(right, "gram").where(other & enough & once).select(F.col("item").alias("a"), F.col("item_b").alias("b"))
