"""Alignment of two tokenizers over the same bytes, in Arrow.

A text with a blank in front is encoded by a byte-level vocabulary (A), the text itself by
a piece vocabulary (B), which adds the blank. Both tile the same bytes, so a token is the
range up to the byte where it ends.

Rows are gathered to blocks of about `BLOCK_BYTES`. In a block the lists of tokens are
flattened, their lengths summed up within each text, and the ends moved by where the text
starts in the block: one number, the document-end key, names an end of any text. A full
outer join (Acero) of the ends of A and B on that key, in order, gives

* groups: ends that both have cut a text into the smallest stretches that both tile;
* links: two tokens overlap in one range, and that range ends at one of the ends; so every
  end of the join is a link, of the tokens of A and B that hold the byte before it, which are
  the next ones that the join has at or behind it (nulls filled backwards).

How often a pair of ids is linked is counted in each block (`Table.group_by`) and the partial
counts are merged by Spark. A block lists a pair once, so a pair that stands in every text is
one row of a block, and no key holds many rows. The merged counts go back to the blocks by a
shuffle join, and a block adds them up over its own links, of which it has kept two or four bytes
each. Of the vocabulary's size is only the highest count of every id of B, which is broadcast.

Texts of characters that every version of Unicode classes alike are encoded by a quicker library
with A's vocabulary and pattern, since equal merges in equal order give equal tokens; tests hold
the two libraries against each other. All other texts go to the library of A's file.

Defined cases: a null or empty text has no tokens, nor has one whose joined tokens differ from
its bytes, as when the pieces write a character another way: all its numbers are 0 and
`groups_sha256` is empty. The strings of special tokens are plain text. Rows are told apart by
their place, so repeated rows and rows without doc_id each get a row. An empty table gives an
empty one. Only the two named columns are read. A text is handled whole; a block holds at
least one. The two files are paths that every executor can read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmeter.llm.common import written

BLOCK_BYTES = 2 << 20
BLOCK_ROWS = 1 << 14
BLANK = "▁"
#: Characters whose classes are the same in every version of Unicode that a library may have.
SETTLED = re.compile("[\t\n\r\x20-\x7e\xa0-\u024f]*")
PAIRS = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64())]))
ENCODED = pa.schema(
    [
        ("block", pa.int64()),
        ("doc_id", pa.int64()),
        ("n_a", pa.int64()),
        ("n_b", pa.int64()),
        ("n_groups", pa.int64()),
        ("n_links", pa.int64()),
        ("groups_sha256", pa.string()),
        ("links", pa.binary()),
        ("pairs", PAIRS),
    ]
)
ENCODED_DDL = (
    "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "links binary, pairs array<struct<a:int,b:int,n:long>>"
)
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def byte_letters() -> dict[str, int]:
    """The byte of each letter that a byte-level vocabulary is written in.

    Printable bytes of Latin 1 stand for themselves, the others for the letters from 256 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokenizers:
    """Both tokenizers, and of every id its bytes and its number as text."""

    def __init__(self, path_a: str, path_b: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        letters = byte_letters()
        with open(path_a, encoding="utf-8") as file:
            vocabulary = json.load(file)
        entries = {i: bytes(letters[c] for c in token) for token, i in vocabulary["model"]["vocab"].items()}
        words = {token: i for i, token in entries.items()}
        for added in vocabulary.get("added_tokens", ()):
            entries[added["id"]] = added["content"].encode()
            words.pop(entries[added["id"]], None)
        self.quick = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=words, special_tokens={})
        self.bytes_a = pa.array([entries.get(i, b"") for i in range(max(entries) + 1)], pa.large_binary())
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_b = pa.array([self._piece_bytes(i) for i in range(self.b.get_piece_size())], pa.large_binary())
        # An id inside its group, and as the last of it: of A, then of B.
        n, m = len(self.bytes_a), len(self.bytes_b)
        self.first_b = 2 * n
        self.written = pa.array([f"{i}{x}" for i in range(n) for x in ",|"] + [f"{i}{x}" for i in range(m) for x in ",;"], pa.large_string())

    def _piece_bytes(self, i: int) -> bytes:
        if self.b.is_byte(i):
            return bytes([int(self.b.id_to_piece(i)[3:5], 16)])
        return b"" if self.b.is_control(i) else self.b.id_to_piece(i).replace(BLANK, " ").encode()

    def encode(self, texts: list[str]) -> tuple[pa.ListArray, pa.ListArray]:
        a = [self.quick.encode_ordinary(" " + t) if SETTLED.fullmatch(t) else None for t in texts]
        rest = [i for i, ids in enumerate(a) if ids is None]
        for i, found in zip(rest, self.a.encode_batch_fast([" " + texts[i] for i in rest], add_special_tokens=False), strict=True):
            a[i] = found.ids
        return _lists(a), _lists(self.b.encode(texts, num_threads=1))


def _lists(ids: list[list[int]]) -> pa.LargeListArray:
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in ids], dtype=np.int64)]).astype(np.int64)
    values = np.fromiter(chain.from_iterable(ids), np.int32, int(bounds[-1]))
    return pa.LargeListArray.from_arrays(pa.array(bounds), pa.array(values))


def _content(taken: pa.Array) -> tuple[memoryview, np.ndarray]:
    """The joined bytes of a column and where its values start."""
    _, offsets, data = taken.buffers()
    return memoryview(data or b"").cast("B"), np.frombuffer(offsets, np.int64, len(taken) + 1, taken.offset * 8)


def _agreeing(lists: pa.Array, sizes: pa.Array, texts: list[bytes]) -> list[bool]:
    """Texts whose joined tokens are their bytes."""
    joined, at = _content(sizes.take(lists.flatten()))
    bounds = at[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
    return [joined[x:y] == text for x, y, text in zip(bounds, bounds[1:], texts, strict=False)]


def _ends(lists: pa.Array, sizes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The document-end key of every token: a sum of lengths that begins anew in each text."""
    parents = pc.list_parent_indices(lists).to_numpy()
    sums = np.cumsum(sizes[lists.flatten().to_numpy()])
    opens = lists.offsets.to_numpy()[:-1]
    before = np.concatenate([[0], sums])[opens]
    return sums - before[parents] + starts[parents]


class Block:
    """The alignment of some texts: numbers for each, the links in order, and their pairs."""

    def __init__(self, tokenizers: Tokenizers, texts: list[str | None]):
        n = len(texts)
        self.n_a = self.n_b = self.n_groups = self.n_links = np.zeros(n, np.int64)
        self.sha = [""] * n
        self.bounds, self.links = np.zeros(n + 1, np.int64), np.zeros(0, np.uint16)
        self.pairs = pa.table({"a": pa.array([], pa.int32()), "b": pa.array([], pa.int32()), "n": pa.array([], pa.int64())})
        chosen = [i for i, t in enumerate(texts) if t]
        if not chosen:
            return
        a, b = tokenizers.encode([texts[i] for i in chosen])
        expected = [b" " + texts[i].encode() for i in chosen]
        fine = [x and y for x, y in zip(_agreeing(a, tokenizers.bytes_a, expected), _agreeing(b, tokenizers.bytes_b, expected), strict=True)]
        if not all(fine):
            a, b = a.filter(pa.array(fine)), b.filter(pa.array(fine))
        rows = np.array(chosen)[fine]
        if len(rows):
            self._align(tokenizers, a, b, rows, np.array([len(x) for x in expected])[fine], n)

    def _align(self, tokenizers: Tokenizers, a: pa.Array, b: pa.Array, rows: np.ndarray, sizes: np.ndarray, n: int) -> None:
        stops = np.cumsum(sizes)
        lengths = [pc.binary_length(x).to_numpy().astype(np.int64) for x in (tokenizers.bytes_a, tokenizers.bytes_b)]
        ends = [_ends(x, size, stops - sizes) for x, size in zip((a, b), lengths, strict=True)]
        left = pa.table({"end": ends[0], "a": a.flatten()})
        right = pa.table({"end": ends[1], "b": b.flatten()})
        cuts = left.join(right, "end", join_type="full outer", use_threads=False).sort_by("end")
        at = cuts["end"].to_numpy()
        has_a, has_b = (cuts[x].is_valid().to_numpy() for x in "ab")
        link_a, link_b = (pc.fill_null_backward(cuts[x].combine_chunks()) for x in "ab")
        both = has_a & has_b

        # Numbers of a text are differences of running numbers at its end.
        last = np.searchsorted(at, stops) + 1
        running = [np.concatenate([[0], np.cumsum(x, dtype=np.int64)]) for x in (has_a, has_b, both)]
        of_rows = [np.diff(x[last], prepend=0) for x in running] + [np.diff(last, prepend=0)]
        self.n_a, self.n_b, self.n_groups, self.n_links = (np.zeros(n, np.int64) for _ in range(4))
        for out, values in zip((self.n_a, self.n_b, self.n_groups, self.n_links), of_rows, strict=True):
            out[rows] = values
        self.bounds = np.concatenate([[0], np.cumsum(self.n_links)])

        self._write_groups(tokenizers, cuts, has_a, has_b, both, rows, running, last)

        codes = pa.array(link_a.to_numpy().astype(np.int64) << 32 | link_b.to_numpy().astype(np.int64)).dictionary_encode()
        known = codes.dictionary.to_numpy()
        counted = pa.table({"pair": codes.indices}).group_by("pair", use_threads=False).aggregate([([], "count_all")]).sort_by("pair")
        self.pairs = pa.table(
            {"a": pa.array((known >> 32).astype(np.int32)), "b": pa.array((known & 0xFFFFFFFF).astype(np.int32)), "n": counted["count_all"].combine_chunks()}
        )
        self.links = codes.indices.to_numpy().astype(np.uint16 if len(known) <= 1 << 16 else np.uint32)

    def _write_groups(self, tokenizers, cuts, has_a, has_b, both, rows, running, last) -> None:
        """Hashes of the ids in order of group, tokenizer and place."""
        group = running[2][:-1]  # closed before the cut
        n_groups = int(running[2][-1])
        ids = [cuts[x].combine_chunks().drop_null().to_numpy() for x in "ab"]
        groups = [group[has_a], group[has_b]]
        per = [np.bincount(g, minlength=n_groups) for g in groups]
        upto = [np.cumsum(p) for p in per]
        order = np.empty(len(ids[0]) + len(ids[1]), np.int64)
        order[np.arange(len(ids[0])) + (upto[1] - per[1])[groups[0]]] = 2 * ids[0] + both[has_a]
        order[np.arange(len(ids[1])) + upto[0][groups[1]]] = tokenizers.first_b + 2 * ids[1] + both[has_b]
        text, at = _content(tokenizers.written.take(pa.array(order)))
        stops = at[(running[0] + running[1])[last]]
        for row, x, y in zip(rows.tolist(), np.concatenate([[0], stops[:-1]]).tolist(), stops.tolist(), strict=True):
            self.sha[row] = hashlib.sha256(text[x : y - 1]).hexdigest()

    def links_of(self, i: int) -> np.ndarray:
        return self.links[self.bounds[i] : self.bounds[i + 1]]

    def batch(self, number: int, ids: list[int | None]) -> pa.RecordBatch:
        n = len(ids)
        pairs = [None] * n
        pairs[0] = pa.array(self.pairs.to_struct_array().combine_chunks() if self.pairs.num_rows else [], PAIRS.value_type)
        lists = pa.ListArray.from_arrays(pa.array([0] + [len(pairs[0])] * n, pa.int32()), pairs[0])
        lists = pc.if_else(pa.array([True] + [False] * (n - 1)), lists, pa.scalar(None, PAIRS))
        columns = [np.full(n, number), None, self.n_a, self.n_b, self.n_groups, self.n_links]
        arrays = [pa.array(ids if x is None else x, pa.int64()) for x in columns]
        links = pa.array([self.links_of(i).tobytes() for i in range(n)], pa.binary())
        return pa.RecordBatch.from_arrays([*arrays, pa.array(self.sha, pa.string()), links, lists], schema=ENCODED)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """Ids and texts of the blocks; a batch may end or begin within one."""
    ids, texts, held = [], [], 0
    for batch in batches:
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            size = len(text or "")
            if ids and (held + size > BLOCK_BYTES or len(ids) >= BLOCK_ROWS):
                yield ids, texts
                ids, texts, held = [], [], 0
            ids.append(i)
            texts.append(text)
            held += size
    if ids:
        yield ids, texts


def _encoder(path_a: str, path_b: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = loaded(path_a, path_b, pattern)
        task = TaskContext.get().partitionId() << 32
        for number, (ids, texts) in enumerate(_gathered(batches)):
            whole = Block(tokenizers, texts).batch(task + number, ids)
            for start in range(0, whole.num_rows, 1024):
                yield whole.slice(start, 1024)

    return run


_LOADED: dict[tuple[str, str, str], Tokenizers] = {}


def loaded(*paths: str) -> Tokenizers:
    if paths not in _LOADED:
        _LOADED[paths] = Tokenizers(*paths)
    return _LOADED[paths]


def _summed(docs: pa.Table, known: pa.Table) -> pa.Table:
    """The rows of a block with the counts of its pairs added up over their links."""
    count = np.zeros(known.num_rows, np.int64)
    best = np.zeros(known.num_rows, np.int64)
    if known.num_rows:
        place = known["pair"].to_numpy()
        count[place], best[place] = known["count"].to_numpy(), known["is_best"].to_numpy()
    wide = np.uint16 if len(count) <= 1 << 16 else np.uint32
    links = [np.frombuffer(x, wide) for x in docs["links"].to_pylist()]
    sums = [pa.array([int(values[x].sum()) for x in links], pa.int64()) for values in (best, count)]
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    return pa.table([*(docs[x] for x in names), *sums, docs["groups_sha256"]], names=[*names, "n_best", "count_sum", "groups_sha256"])


def encoded(docs: DataFrame, path_a: str, path_b: str, pattern: str, ids: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each document with its links as places in the pairs of its block."""
    read = docs.select(F.col(ids).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return read.mapInArrow(_encoder(path_a, path_b, pattern), ENCODED_DDL)


def block_pairs(blocks: DataFrame) -> DataFrame:
    """block, pair (place in the block), a, b, n."""
    listed = blocks.where("pairs is not null").select("block", F.posexplode("pairs").alias("pair", "link"))
    return listed.select("block", "pair", "link.a", "link.b", "link.n")


def pair_counts(pairs: DataFrame) -> DataFrame:
    """a, b, count over all blocks, and if no other id of A is linked to b more often."""
    counts = written(pairs.groupBy("a", "b").agg(F.sum("n").alias("count")), "pair-counts")
    highest = counts.groupBy("b").agg(F.max("count").alias("highest"))  # as many rows as B has ids
    return counts.join(F.broadcast(highest), "b").select("a", "b", "count", (F.col("count") == F.col("highest")).cast("int").alias("is_best"))


def aligned(docs: DataFrame, path_a: str, path_b: str, pattern: str, ids: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of each row."""
    blocks = written(encoded(docs, path_a, path_b, pattern, ids, text), "aligned-blocks")
    pairs = block_pairs(blocks)
    known = pairs.drop("n").join(pair_counts(pairs).hint("merge"), ["a", "b"])
    known = known.select(F.col("block").alias("of_block"), "pair", "count", "is_best")
    return blocks.drop("pairs").groupBy("block").cogroup(known.groupBy("of_block")).applyInArrow(_summed, RESULT)
