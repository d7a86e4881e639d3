"""Removal of byte strings that an earlier document holds, by suffix arrays of candidates.

1. Every string of `length` bytes has one anchor: of the grams inside it the one with the
   least hash, the leftmost of equals. Equal strings have equal anchors, so only anchors that
   two documents share can lead to a match. They are counted over the corpus by a grouping
   that combines before the shuffle.
2. The strings of one anchor occurrence overlap and make a snippet. Snippets that are equal
   byte by byte collapse to the first document that holds them; later documents lose all
   strings of such a snippet.
3. Different snippets with one anchor may still share strings. They are dealt by anchor into
   buckets of bounded size. In a bucket a Burrows-Wheeler transform is built, and common
   prefixes are derived by increasing value: a boundary between rows at one value is extended
   backwards by the symbols in front of it to boundaries at the next value. This stops at
   `length`; rows without a boundary share at least `length` bytes. An anchor with more
   snippets than a bucket may hold is resolved by grouping its strings themselves.
4. Each document gets back the snippets of which it is first, with the strings it loses; its
   other candidate snippets go whole. The removed runs follow from the text.

Exact copies of a text go first: all but the least doc_id lose every byte, if there are
`length` or more. Strings are judged on the input, so overlaps and removed bytes count.

Defined cases: a null text is empty. Texts shorter than `length` lose nothing. Rows with the
same doc_id do not remove each other; each row gets its own result. Rows without doc_id
neither lose nor remove anything. An empty table gives an
empty one. Only the two named columns are read, so other columns cannot clash. A text is
handled as a whole in one task; the rest in pieces of bounded size. Grams and texts are told
apart by 64 and 256-bit hashes, strings by their bytes.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmeter.llm.common import OF_ROW, SpanHashes, among, first_of_runs, flat, in_row, list_array, mixed, pieces, text_bytes, written

LENGTH = 50
GRAM = 20
BUCKET_BYTES = 2_000_000
TOGETHER = 1000  # snippets of a transform; small ones stay in a core's cache
NOTHING = np.zeros(0, np.int64)
LOST = "key long, first long, lost array<int>"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Of a piece of texts: row, hash, first string and number of strings of every anchor occurrence."""
    empty = np.zeros(0, np.int64)
    n = len(data) - length + 1
    if n <= 0:
        return empty, empty, empty, empty
    hashes = SpanHashes(data).windows(gram)
    if len(hashes) < n + length - gram:  # cannot happen; keeps the windows below in range
        raise AssertionError("gram longer than string")
    least = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    span, width = length - gram + 1, 1
    while width * 2 <= span:
        least = np.minimum(least[: len(least) - width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
    at = (least[:n] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    lengths = np.diff(offsets)
    valid = np.zeros(n + 1, np.int8)
    long = lengths >= length
    np.add.at(valid, offsets[:-1][long], 1)
    np.add.at(valid, np.minimum(offsets[1:][long] - length + 1, n), -1)
    starts = np.flatnonzero(np.cumsum(valid[:n]))
    runs = first_of_runs(at[starts])
    where = at[starts[runs]]
    first = starts[runs]
    count = np.diff(np.append(runs, len(starts)))
    rows = np.searchsorted(offsets, first, "right") - 1
    return rows, hashes[where].view(np.int64), first, count


def _sorted_unique(rows: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((rows, hashes))
    rows, hashes = rows[order], hashes[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    return rows[new], hashes[new]


def _anchor_rows(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            data, offsets = text_bytes(batch.column(1))
            for a, b in pieces(offsets):
                rows, hashes, _, _ = anchors(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], length, gram)
                rows, hashes = _sorted_unique(rows, hashes)
                yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(ids[a + rows])], names=["anchor", "doc_id"])

    return run


def _cut(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The bytes of spans, which may overlap."""
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    at = np.arange(bounds[-1]) + np.repeat(starts - bounds[:-1], sizes)
    return pa.Array.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data[at])]
    )


def _shared_anchors(data: np.ndarray, offsets: np.ndarray, shared: pa.Array, length: int, gram: int):
    """The anchor occurrences of the texts that are among the shared ones of their document."""
    rows, hashes, first, count = anchors(data, offsets, length, gram)
    mark = among(rows, hashes, shared)
    return rows[mark], hashes[mark], first[mark], count[mark]


def _snippet_rows(length: int, gram: int):
    """Of documents with the anchors they share: anchor, snippet and doc_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, shared = batch.column(0).to_numpy(), batch.column(2)
            data, offsets = text_bytes(batch.column(1))
            for a, b in pieces(offsets):
                own = data[offsets[a] : offsets[b]]
                rows, hashes, first, count = _shared_anchors(own, offsets[a : b + 1] - offsets[a], shared.slice(a, b - a), length, gram)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes), _cut(own, first, count + length - 1), pa.array(ids[a + rows])],
                    names=["anchor", "snippet", "doc_id"],
                )

    return run


def suffix_rows(symbols: np.ndarray, longest: int) -> np.ndarray:
    """Suffixes in order, each up to its separator 0; equal ones in order of their place.

    Sorting by 4 symbols and then doubling ends once `longest` symbols are compared.
    """
    n = len(symbols)
    padded = np.append(symbols, np.zeros(4, symbols.dtype)).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    alive = np.ones(n, np.uint64)
    for k in range(4):
        alive &= np.uint64(1) if k == 0 else (padded[k - 1 : n + k - 1] != 0).astype(np.uint64)
        key = (key << np.uint64(9)) | (padded[k : n + k] * alive)
    depth = 4
    left = np.zeros(n, np.int64)  # symbols up to and with the separator
    ends = np.flatnonzero(symbols == 0)
    left[:] = ends[np.searchsorted(ends, np.arange(n))] - np.arange(n) + 1
    while True:
        order = np.argsort(key, kind="stable")
        new = np.zeros(n, np.int64)
        new[1:] = key[order][1:] != key[order][:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new) + 1
        if depth >= longest or rank[order[-1]] == n:
            return order
        after = np.zeros(n, np.int64)
        far = left > depth
        after[far] = rank[np.flatnonzero(far) + depth]
        key = (rank.astype(np.uint64) << np.uint64(32)) | after.astype(np.uint64)
        depth *= 2


def row_groups(symbols: np.ndarray, length: int, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix rows, and for each row the number of its group: rows of a group share `length` symbols.

    `boundary[i]` holds once the common prefix of rows i-1 and i is known to be shorter than
    the value reached. Row x and the row before it with the same symbol in front lead to
    neighbours whose common prefix is one more than the least value between the two.
    """
    order = suffix_rows(symbols, longest)
    n = len(order)
    front = symbols[order - 1]
    by_symbol = np.argsort(front, kind="stable")  # the row reached by the i-th of these is i
    # A separator is a symbol of its own at each place: rows behind one are never extended.
    same = np.zeros(n, bool)
    same[1:] = (front[by_symbol][1:] == front[by_symbol][:-1]) & (front[by_symbol][1:] != 0)
    boundary = ~same
    reached = np.flatnonzero(same)
    x, before = by_symbol[reached], by_symbol[reached - 1]
    for _ in range(1, length):
        if not len(reached):
            break
        seen = np.cumsum(boundary)
        hit = seen[x] != seen[before]
        boundary[reached[hit]] = True
        stay = ~hit
        x, before, reached = x[stay], before[stay], reached[stay]
    return order, np.cumsum(boundary)


def lost_strings(symbols: np.ndarray, bounds: np.ndarray, firsts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Snippet and place of the strings that a snippet of an earlier document holds.

    Snippet i is symbols[bounds[i] : bounds[i + 1] - 1], and a separator 0 follows it.
    """
    order, group = row_groups(symbols, length, int(np.diff(bounds).max()))
    owner = np.searchsorted(bounds, order, "right") - 1
    valid = bounds[owner + 1] - 1 - order >= length
    order, group, owner = order[valid], group[valid], owner[valid]
    starts = first_of_runs(group)
    doc = firsts[owner]
    least = np.minimum.reduceat(doc, starts) if len(starts) else doc
    lost = doc > np.repeat(least, np.diff(np.append(starts, len(group))))
    return owner[lost], (order - bounds[owner])[lost]


def _with_separators(data: np.ndarray, offsets: np.ndarray, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of some snippets, bytes and one, each with a separator 0 behind it."""
    sizes = (offsets[1:] - offsets[:-1])[some]
    bounds = np.concatenate([[0], np.cumsum(sizes + 1)])
    at = np.arange(bounds[-1]) + np.repeat(offsets[some] - bounds[:-1], sizes + 1)
    at[bounds[1:] - 1] = 0
    symbols = data[at].astype(np.uint16) + 1
    symbols[bounds[1:] - 1] = 0
    return symbols, bounds


def _keys(anchor: np.ndarray, snippet: np.ndarray) -> np.ndarray:
    """One key of an anchor and the hash of a snippet."""
    return mixed(anchor.view(np.uint64) ^ mixed(snippet + OF_ROW))


def _snippet_hashes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    parts = [
        SpanHashes(data[offsets[a] : offsets[b]]).of(offsets[a:b] - offsets[a], offsets[a + 1 : b + 1] - offsets[a])
        for a, b in pieces(offsets)
    ]
    return np.concatenate([np.zeros(0, np.uint64), *parts])


def _may_share(data: np.ndarray, offsets: np.ndarray, some: np.ndarray, length: int) -> np.ndarray:
    """Of some snippets those with a string whose hash occurs twice; the others share none."""
    counts = (offsets[1:] - offsets[:-1])[some] - length + 1
    ends = np.cumsum(counts)
    starts = np.arange(ends[-1]) + np.repeat(offsets[some] - (ends - counts), counts)
    hashes = np.empty(len(starts), np.uint64)
    for a in range(0, len(starts), 1 << 16):
        part = starts[a : a + (1 << 16)]
        low = int(part.min())
        hashes[a : a + (1 << 16)] = SpanHashes(data[low : int(part.max()) + length]).windows(length)[part - low]
    order = np.argsort(hashes)
    ordered = hashes[order]
    again = np.zeros(len(order), bool)
    again[1:] = ordered[1:] == ordered[:-1]
    again[:-1] |= again[1:]
    return some[np.unique(np.searchsorted(ends, order[again], "right"))]


def _bucket(length: int):
    """Key, first document and lost strings of the snippets of a bucket.

    Snippets with an anchor of their own, or no string that may occur twice, lose nothing.
    """

    def run(rows: pa.Table) -> pa.Table:
        anchor, firsts = rows.column("anchor").to_numpy(), rows.column("first").to_numpy()
        order = np.argsort(anchor, kind="stable")  # an anchor's snippets stay together
        anchor, firsts = anchor[order], firsts[order]
        data, offsets = text_bytes(rows.column("snippet").combine_chunks().take(pa.array(order)))
        runs = first_of_runs(anchor)
        sizes = np.diff(np.append(runs, len(anchor)))
        some = np.flatnonzero(np.repeat(sizes > 1, sizes))
        some = _may_share(data, offsets, some, length) if len(some) else some
        owners, places = [NOTHING], [NOTHING]
        edges = first_of_runs(anchor[some])
        cuts = np.append(edges[first_of_runs(edges // TOGETHER)], len(some))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            part = some[a:b]
            owner, place = lost_strings(*_with_separators(data, offsets, part), firsts[part], length)
            owners.append(part[owner])
            places.append(place)
        owner, place = np.concatenate(owners), np.concatenate(places)
        by_owner = np.argsort(owner, kind="stable")
        bounds = np.searchsorted(owner[by_owner], np.arange(len(anchor) + 1))
        keys = _keys(anchor, _snippet_hashes(data, offsets))
        return pa.table({"key": keys.view(np.int64), "first": firsts, "lost": list_array(place[by_owner].astype(np.int32), bounds)})

    return run


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes = _snippet_hashes(*text_bytes(batch.column(1)))
        keys = _keys(batch.column(0).to_numpy(), hashes)
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), batch.column(2), batch.column(3)], names=["key", "first", "lost"])


def _removed_bytes(data: np.ndarray, offsets: np.ndarray, shared: pa.Array, own: pa.Array, lost: pa.Array, length: int, gram: int) -> np.ndarray:
    """Which bytes of a piece of texts lie in strings of earlier documents."""
    rows, anchor, first, count = _shared_anchors(data, offsets, shared, length, gram)
    end = first + count + length - 1
    edge = np.zeros(len(data) + 1, np.int64)
    if len(rows):
        key = _keys(anchor, SpanHashes(data).of(first, end))
        mine = among(rows, key, own)
        key = in_row(rows, key)
        np.add.at(edge, first[~mine], 1)
        np.add.at(edge, end[~mine], -1)
        owner, entries = flat(lost)
        if len(entries):
            known = in_row(owner, entries.field("key").to_numpy())
            order = np.argsort(known)
            bounds = entries.field("lost").offsets.to_numpy()
            places = entries.field("lost").values.to_numpy()
            at = np.minimum(np.searchsorted(known[order], key), len(known) - 1)
            hit = np.flatnonzero(known[order][at] == key)
            entry = order[at[hit]]
            sizes = bounds[entry + 1] - bounds[entry]
            at = np.arange(sizes.sum()) + np.repeat(bounds[entry] - (np.cumsum(sizes) - sizes), sizes)
            start = np.repeat(first[hit], sizes) + places[at]
            np.add.at(edge, start, 1)
            np.add.at(edge, start + length, -1)
    return np.cumsum(edge[:-1]) > 0


def _removed(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            copy = batch.column("copy").to_pylist()
            lists = [batch.column(c) for c in ("shared", "own", "lost")]
            data, offsets = text_bytes(batch.column("text"))
            sizes, removed, spans, digests = [], [], [], []
            for a, b in pieces(offsets):
                part, bounds = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                gone = _removed_bytes(part, bounds, *(x.slice(a, b - a) for x in lists), length, gram)
                for i in range(a, b):
                    text, cut = part[bounds[i - a] : bounds[i - a + 1]], gone[bounds[i - a] : bounds[i - a + 1]]
                    n = len(text)
                    if copy[i] and n >= length:
                        cut = np.ones(n, bool)
                    lost = int(np.count_nonzero(cut))
                    sizes.append(n)
                    removed.append(lost)
                    spans.append(int(np.count_nonzero(cut[1:] & ~cut[:-1]) + cut[0]) if lost else 0)
                    digests.append(hashlib.sha256(text[~cut].tobytes() if lost else text.tobytes()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (sizes, removed, spans)), pa.array(digests, pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return run


def removals(
    docs: DataFrame, ids: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """For each document: n_bytes, n_removed, n_spans and the hash of what is left."""
    docs = docs.select(F.col(ids).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    # Texts that an earlier document has whole.
    known = docs.where("doc_id is not null").select("doc_id", F.sha2("text", 256).alias("sha"), F.xxhash64("text").alias("key"))
    first = known.groupBy("sha").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    copies = (
        known.join(first, "sha").where("doc_id > first").groupBy("doc_id").agg(F.collect_set("key").alias("copies"))
    )

    found = docs.where("doc_id is not null").mapInArrow(_anchor_rows(length, gram), "anchor long, doc_id long")
    both = found.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    both = written(both.select("anchor"), "shared-anchors")
    shared = found.join(both.hint("shuffle_hash"), "anchor").groupBy("doc_id").agg(F.collect_set("anchor").alias("shared"))
    marks = written(
        shared.join(copies, "doc_id", "full").select("doc_id", "shared", F.coalesce("copies", F.array().cast("array<long>")).alias("copies")),
        "candidate-documents",
    )

    is_copy = F.coalesce(F.array_contains("copies", F.xxhash64("text")), F.lit(False))
    candidates = docs.join(marks, "doc_id").where(F.col("shared").isNotNull() & ~is_copy)
    snippets = candidates.select("doc_id", "text", "shared").mapInArrow(
        _snippet_rows(length, gram), "anchor long, snippet binary, doc_id long"
    )
    snippets = written(snippets.groupBy("anchor", "snippet").agg(F.min("doc_id").alias("first")), "snippets")

    sizes = snippets.groupBy("anchor").agg(F.sum(F.length("snippet")).alias("bytes"))
    large = written(sizes.where(F.col("bytes") > bucket_bytes).select("anchor"), "large-anchors")
    total = snippets.agg(F.sum(F.length("snippet"))).first()[0] or 0
    buckets = max(1, math.ceil(2 * total / bucket_bytes))
    hot = not large.isEmpty()
    normal = snippets.join(large, "anchor", "left_anti") if hot else snippets
    lost = (
        normal.withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets)))
        .groupBy("bucket")
        .applyInArrow(_bucket(length), LOST)
    )
    if hot:
        rest = _lost_by_grouping(snippets.join(large, "anchor", "left_semi"), length)
        lost = lost.unionByName(rest.mapInArrow(_keyed, LOST))
    some = F.when(F.size("lost") > 0, F.struct("key", "lost"))
    own = lost.groupBy(F.col("first").alias("doc_id")).agg(F.collect_list("key").alias("own"), F.collect_list(some).alias("lost"))
    own = written(own, "own-snippets")
    rows = docs.join(marks, "doc_id", "left").join(own, "doc_id", "left")
    return rows.select("doc_id", "text", is_copy.alias("copy"), "shared", "own", "lost").mapInArrow(_removed(length, gram), RESULT)


def _lost_by_grouping(snippets: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many snippets: equal strings meet by grouping."""
    strings = snippets.select(
        "anchor",
        "snippet",
        "first",
        F.explode(F.sequence(F.lit(0), F.length("snippet") - length)).alias("place"),
    ).withColumn("string", F.expr(f"substring(snippet, place + 1, {length})"))
    least = strings.groupBy("string").agg(F.min("first").alias("least"))
    lost = strings.join(least, "string").where("first > least")
    return snippets.join(
        lost.groupBy("anchor", "snippet").agg(F.collect_list("place").alias("lost")), ["anchor", "snippet"], "left"
    ).select("anchor", "snippet", "first", F.coalesce("lost", F.array().cast("array<int>")).alias("lost"))
