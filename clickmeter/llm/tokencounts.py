"""Token counts of sections, from one encoding of the whole text.

A text is encoded once with a byte-level vocabulary. Tokens tile its bytes, so their lengths
give byte spans and, counting the bytes that begin a character, character spans; a token
inside a character spans that character. Sections are character ranges. Token spans are in
order, so the tokens of a section lie between two binary searches.

A token that crosses the border of a section is allocated by a rule:

* `start`: to the section that holds its first character;
* `majority`: to the section that holds more than half of its characters, or exactly half
  and its first;
* `share`: to every section in proportion to the characters it holds.

Defined cases: a null or empty text has no tokens; sections of it count 0. Ranges are cut at
the ends of the text; empty or reversed ones count 0, and so do sections of unknown documents.
Sections may overlap and repeat; each is counted alone. Repeated documents are counted each. Rows without doc_id are kept. An
empty table gives an empty one. Only the named columns are read. The vocabulary is a path
that every executor can read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


RULES = ("start", "majority", "share")
OUTSIDE = -1
COUNTS = "doc_id long, section long, start long, end long, n_tokens double, n_crossing long"
_LOADED: dict[tuple[str, str], tuple[tiktoken.Encoding, np.ndarray]] = {}


def loaded(path: str, pattern: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The encoding and the number of bytes of each token."""
    if (path, pattern) not in _LOADED:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            sizes[rank] = len(token)
        _LOADED[path, pattern] = tiktoken.Encoding("sections", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), sizes
    return _LOADED[path, pattern]


def token_spans(text: str, encoding: tiktoken.Encoding, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character and end of every token."""
    if not text:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ends = np.cumsum(sizes[encoding.encode_to_numpy(text, disallowed_special=())])
    starts = np.concatenate([[0], ends[:-1]])
    if len(text) == ends[-1]:
        return starts, ends
    begins = np.cumsum((np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80)
    return begins[starts] - 1, begins[ends - 1]


def line_sections(text: str) -> list[tuple[int, int, int]]:
    """Number, start and end of the lines, without their line ends."""
    out, at = [], 0
    for k, line in enumerate(text.split("\n") if text else ()):
        out.append((k, at, at + len(line)))
        at += len(line) + 1
    return out


def counted(first: np.ndarray, end: np.ndarray, start: np.ndarray, stop: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of the sections [start, stop) by the rule, and how many cross a border of each."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    low, high = np.searchsorted(first, start), np.searchsorted(first, np.maximum(start, stop))
    counts = (high - low).astype(np.float64)
    over_low = np.searchsorted(end, start, "right")  # tokens from here on end behind the start
    crossing = low - over_low
    over_high = np.searchsorted(end, stop, "right")
    some = (stop > start) & (len(first) > 0)
    inside = np.maximum(over_low, 0)
    out = np.maximum(over_high, inside)
    # Tokens that start in front, or that start inside and end behind; a token may do both.
    crossing = np.where(some, crossing + high - np.maximum(np.minimum(out, high), low), 0)
    if rule != "start":
        for k in np.flatnonzero(some & (crossing > 0)):
            a, b = start[k], stop[k]
            before = np.arange(over_low[k], low[k])
            behind = np.arange(max(min(out[k], high[k]), low[k]), high[k])
            held = [(np.minimum(end[i], b) - np.maximum(first[i], a)) / (end[i] - first[i]) for i in (before, behind)]
            if rule == "share":
                counts[k] += held[0].sum() - len(behind) + held[1].sum()
            else:
                counts[k] += (held[0] > 0.5).sum() - (held[1] < 0.5).sum()
    return np.where(some, counts, 0.0), crossing


def _rows(path: str, pattern: str, rule: str, given: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, sizes = loaded(path, pattern)
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            wanted = batch.column("sections").to_pylist() if given else None
            row, number, start, stop, counts, crossing = [], [], [], [], [], []
            for i, text in enumerate(texts):
                text = text or ""
                first, end = token_spans(text, encoding, sizes)
                own = [(x["section"], x["start"], x["end"]) for x in wanted[i] or ()] if given else line_sections(text)
                k = np.array([x[0] for x in own], np.int64)
                a, b = (np.clip(np.array([x[j] for x in own], np.int64), 0, len(text)) for j in (1, 2))
                n, c = counted(first, end, a, b, rule)
                if not given:  # lines do not overlap: what they don't get lies in line ends
                    k, a, b = np.append(k, OUTSIDE), np.append(a, 0), np.append(b, len(text))
                    n, c = np.append(n, len(first) - n.sum()), np.append(c, 0)
                for out, values in zip((number, start, stop, counts, crossing), (k, a, b, n, c), strict=True):
                    out.append(values)
                row.append(len(k))
            flat = [np.concatenate(x) if x else np.zeros(0) for x in (number, start, stop, counts, crossing)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.array(ids, object), row).tolist(), pa.int64()),
                    *(pa.array(x.astype(np.int64)) for x in flat[:3]),
                    pa.array(flat[3].astype(np.float64)),
                    pa.array(flat[4].astype(np.int64)),
                ],
                names=["doc_id", "section", "start", "end", "n_tokens", "n_crossing"],
            )

    return run


def section_tokens(
    docs: DataFrame, vocabulary: str, pattern: str, sections: DataFrame | None = None, rule: str = "start", ids: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, section, start, end, n_tokens and n_crossing.

    `sections` has doc_id, section, start and end; without it the lines of the text are its
    sections, and section -1 has the tokens that no line gets.
    """
    read = docs.select(F.col(ids).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    if sections is None:
        return read.mapInArrow(_rows(vocabulary, pattern, rule, False), COUNTS)
    rows = sections.select("doc_id", *(F.coalesce(F.col(c).cast("long"), F.lit(0)).alias(c) for c in ("section", "start", "end")))
    grouped = rows.groupBy("doc_id").agg(F.collect_list(F.struct("section", "start", "end")).alias("sections"))
    return grouped.join(read, "doc_id", "left").mapInArrow(_rows(vocabulary, pattern, rule, True), COUNTS)
