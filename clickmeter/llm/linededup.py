"""Removal of runs of lines that the corpus holds more than once.

Lines with a word are cut into chunks where their content says so: a rolling hash goes over the
hashes of a line and the one before it, and a chunk starts at a line whose value is less than
that of the line before and of the line behind. So a chunk has two lines at least and three on
average, and text put in front of a passage shifts no border behind its third line. Where the
value stays the same, as in a line repeated over and over, every second line starts a chunk.

Chunks of several lines are counted by a hash over their lines. Those whose hash occurs again
are cut out of the documents that hold them and grouped by their bytes, which combines equal
ones before the shuffle; the first by (doc_id, place) stays, every other goes. As chunks do not
overlap, what goes has one equal that stays as a whole.

A shared passage begins and ends inside of chunks. So a chunk that goes is a seed: lines next
to it go too as far as they equal, one by one, the lines next to the first equal chunk. That
holds for chunks of which there is one only, so that no other document relies on them, and only
lines count as equal that stay for certain: those of a chunk of which there is one only and whose
other neighbour is the text's end or such a chunk as well. What is reported as a removed chunk
is a run of removed lines.

Defined cases: a null text has no lines and stays null. A repeated line by itself stays, unless
it is next to a chunk that goes, as in the first; so may runs of up to five lines in which no
whole chunk lies. Blank lines before and behind a removed run stay, those inside go. Rows with
the same doc_id count as one document. Rows without doc_id are left as they are. An empty
table gives an empty one. Other columns are carried along whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmeter.llm.common import written

ROLL = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1
BLANK = " \t\n\x0b\x0c\r"
REPORT = "doc_id long, n_lines long, n_removed_lines long, n_removed_chunks long, kept_sha256 string"
CONTENTS = "hash long, content string, doc_id long, place long, left string, right string"


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def starts(hashes: list[int]) -> list[int]:
    """Where chunks start among lines of these hashes; the first and the last line stand with another."""
    n = len(hashes)
    rolled = [-1] + [(a * 3 + b) * ROLL & MASK for a, b in zip(hashes, hashes[1:], strict=False)] + [-1]
    out, level = [0] if n else [], 0
    for i in range(1, n):
        here, before, behind = rolled[i], rolled[i - 1], rolled[i + 1]
        if here != before:
            level = i
        if (here < before and here < behind) or (here == before == behind and (i - level) % 2 == 0):
            out.append(i)
    return out


def chunks(lines: list[str]) -> list[tuple[int, int, int | None]]:
    """Ranges of lines, without blank ones at the ends, and the hash of those with several lines with a word."""
    at = [i for i, line in enumerate(lines) if line.strip(BLANK)]
    hashes = [xxhash.xxh3_64_intdigest(lines[i].encode()) for i in at]
    first, out = starts(hashes), []
    for x, y in zip(first, [*first[1:], len(at)], strict=False):
        a, b = at[x], at[y - 1] + 1
        out.append((a, b, _signed(xxhash.xxh3_64_intdigest("\n".join(lines[a:b]).encode())) if y - x > 1 else None))
    return out


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [
            (i, h)
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for _, _, h in (chunks(text.split("\n")) if text else ())
            if h is not None
        ]
        ids, hashes = zip(*found, strict=True) if found else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hashes, pa.int64())], names=["doc_id", "hash"])


def repeated_chunks(text: str | None, again: set[int]) -> Iterator[tuple[int, str, int, str | None, str | None]]:
    """Hash, content, place, and the chunks next to it that stay for certain, of the repeated chunks."""
    if not text:
        return
    lines = text.split("\n")
    found = chunks(lines)

    def single(k: int) -> bool:
        return not 0 <= k < len(found) or found[k][2] not in again

    def content(k: int, beyond: int) -> str | None:
        if 0 <= k < len(found) and single(k) and single(beyond):
            return "\n".join(lines[found[k][0] : found[k][1]])
        return None

    for place, (a, b, h) in enumerate(found):
        if h in again:
            yield h, "\n".join(lines[a:b]), place, content(place - 1, place - 2), content(place + 1, place + 2)


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The chunks of documents whose hashes occur again."""
    for batch in batches:
        rows = []
        for i, text, again in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "again")), strict=True):
            rows += [(h, content, i, place, left, right) for h, content, place, left, right in repeated_chunks(text, set(again))]
        columns = zip(*rows, strict=True) if rows else [()] * 6
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names=["hash", "content", "doc_id", "place", "left", "right"])


def _alike(a: list[str], b: list[str]) -> int:
    """Lines that are equal from the start on."""
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def _stripped(text: str | None, again: list | None, first: list | None, edges: list | None) -> tuple[str | None, int, int]:
    """What stays of a text, removed lines, runs of removed lines."""
    if not again or not text:
        return text, 0, 0
    wanted, own, lines = set(again), {(x["place"], x["hash"]) for x in first or []}, text.split("\n")
    beside = {x["hash"]: (x["left"], x["right"]) for x in edges or []}
    found = chunks(lines)
    goes = [h in wanted and (k, h) not in own for k, (_, _, h) in enumerate(found)]
    cut: list[tuple[int, int]] = []
    for k, (a, b, h) in enumerate(found):
        if not goes[k]:
            continue
        left, right = beside.get(h, (None, None))
        if k and goes[k - 1]:
            a = found[k - 1][1]
        elif left is not None and k and found[k - 1][2] not in wanted:
            low, high, _ = found[k - 1]
            n = _alike(lines[low:high][::-1], left.split("\n")[::-1])
            a = high - n if n else a
        if right is not None and k + 1 < len(found) and found[k + 1][2] not in wanted:
            low, high, _ = found[k + 1]
            n = _alike(lines[low:high], right.split("\n"))
            b = low + n if n else b
        if cut and a <= cut[-1][1]:
            a, b = min(a, cut[-1][0]), max(b, cut[-1][1])
            cut.pop()
        cut.append((a, b))
    if not cut:
        return text, 0, 0
    kept, at = [], 0
    for a, b in cut:
        kept += lines[at:a]
        at = b
    kept += lines[at:]
    return "\n".join(kept), sum(b - a for a, b in cut), len(cut)


_MARKS = ("text", "again", "first", "edges")


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text, *marks in zip(*(batch.column(c).to_pylist() for c in _MARKS), strict=True):
            kept, lines, count = _stripped(text, *marks)
            rows.append((text.count("\n") + 1 if text else 0, lines, count, hashlib.sha256((kept or "").encode()).hexdigest()))
        n, lines, count, digest = zip(*rows, strict=True) if rows else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (n, lines, count)), pa.array(digest, pa.string())],
            names=["doc_id", "n_lines", "n_removed_lines", "n_removed_chunks", "kept_sha256"],
        )


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = [_stripped(text, *marks)[0] for text, *marks in zip(*(batch.column(c).to_pylist() for c in _MARKS), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(kept, pa.string())], names=["row", "kept"])


def _marked(docs: DataFrame) -> DataFrame:
    """Rows with doc_id and text, joined with the repeated chunks of the document, those it is first in, and what is next to the first."""
    known = docs.where("doc_id is not null")
    found = known.select("doc_id", "text").mapInArrow(_hashes, "doc_id long, hash long")
    repeated = found.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash")
    again = written(found.join(repeated, "hash").groupBy("doc_id").agg(F.collect_set("hash").alias("again")), "repeated-chunks")
    contents = known.select("doc_id", "text").join(again.hint("merge"), "doc_id").mapInArrow(_contents, CONTENTS)
    first = contents.groupBy("hash", "content").agg(F.min(F.struct("doc_id", "place", "left", "right")).alias("first"))
    first = written(first.select("hash", "first.*"), "first-chunks")
    beside = first.where("left is not null or right is not null").groupBy("hash").agg(F.min("left").alias("left"), F.min("right").alias("right"))
    holders = again.select("doc_id", F.explode("again").alias("hash"))
    edges = holders.join(beside.hint("merge"), "hash").groupBy("doc_id").agg(F.collect_list(F.struct("hash", "left", "right")).alias("edges"))
    edges = written(edges, "chunk-edges")
    own = first.groupBy("doc_id").agg(F.collect_list(F.struct("place", "hash")).alias("first"))
    marked = known
    for marks in (again, own, edges):
        marked = marked.join(marks.hint("merge"), "doc_id", "left")
    return marked


def report(docs: DataFrame, ids: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each document with doc_id: its lines, what was removed, the hash of what stays."""
    rows = _marked(docs.select(F.col(ids).cast("long").alias("doc_id"), F.col(text).alias("text")))
    return rows.select("doc_id", *_MARKS).mapInArrow(_report, REPORT)


def stripped(docs: DataFrame, ids: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows with the removed chunks taken out of the text; other columns stay as they are."""
    names = docs.columns
    row = F.struct(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)))
    rows = docs.select(F.col(ids).cast("long").alias("doc_id"), F.col(text).alias("text"), row.alias("row"))
    marked = _marked(rows)
    packed = rows.schema["row"].dataType
    kept = marked.mapInArrow(_texts, f"row {packed.simpleString()}, kept string")
    kept = kept.unionByName(rows.where("doc_id is null").select("row", F.col("text").alias("kept")))
    at = names.index(text)
    return kept.select(*(F.col("kept" if i == at else f"row.c{i}").alias(c) for i, c in enumerate(names)))
