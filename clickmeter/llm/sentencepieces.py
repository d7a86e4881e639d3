"""Encoding and decoding with a merge-type piece vocabulary.

The symbols of a stretch of text lie in a chain; an agenda ordered by score holds the
adjacent pairs whose union is a piece. The best pair, the leftmost of equals, is merged, and
its new neighbours enter the agenda. Characters that are no piece become byte pieces.

A text is cut where no piece can span the cut: before a blank that follows another character,
around line ends, and before punctuation that no piece has behind a letter or digit; the
last is read off the vocabulary. So a stretch occurs many times, and workers remember the recent ones
in two generations of bounded size, but for long ones. Every stretch that is not remembered is also encoded by
the sentencepiece library, in one call for each Arrow batch; where the two differ the
library's pieces are taken and `n_differing` counts them.

Defined cases: a null or empty text has the end id only. Very long texts and stretches cost
n log n. Repeated rows each get their row, an empty table gives an empty one. Only the two
named columns are read, so other columns cannot clash. The model is a parameter: a path that
every executor can read; it must keep blanks as they are and add one in front.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import string
from collections.abc import Iterator

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLANK = "▁"
REMEMBERED = 400_000
LONGEST = 64
SHORT = 40
NONE = float("inf")
DIGESTS = (
    "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, round_trip boolean, n_differing long"
)
PIECES = "doc_id long, ids array<int>, decoded string, n_differing long"


class Pieces:
    """A model with its agenda and what it remembers."""

    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        lib = self.library
        self.ids: dict[str, int] = {}
        self.cost: dict[str, float] = {}
        self.byte_ids = [0] * 256
        for i in range(lib.get_piece_size()):
            piece = lib.id_to_piece(i)
            if lib.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
            elif not (lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i)):
                self.ids[piece] = i
                self.cost[piece] = -lib.get_score(i)
        if any(BLANK in p.lstrip(BLANK) or ("\n" in p and p != "\n") for p in self.ids):
            raise ValueError("a piece spans a blank or a line end; texts can't be cut there")
        if lib.encode("  a", out_type=str)[0][:1] != BLANK or lib.decode(lib.encode("  a")) != "  a":
            raise ValueError("the model changes blanks")
        self.end = lib.eos_id()
        marks = re.escape(string.punctuation)
        stops = re.escape("".join(sorted(self._stops())))
        before_stop = f"{BLANK}*[^{BLANK}\n{marks}]+(?=[{stops}])|" if stops else ""
        self.cut = re.compile(f"{before_stop}{BLANK}*[^{BLANK}\n]+|{BLANK}+|\n")
        self.known = Remembered(self)

    def _stops(self) -> set[str]:
        """Punctuation that no piece has behind a character other than a blank or punctuation."""
        marks = set(string.punctuation)
        spanned = {b for p in self.ids for a, b in zip(p, p[1:], strict=False) if a != BLANK and a not in marks}
        return marks - spanned

    def merged(self, stretch: str) -> list[str]:
        """The symbols that are left when the agenda is empty.

        The agenda of a short stretch is a list in order of place, of a longer one a heap.
        """
        if len(stretch) > SHORT:
            return self._merged_long(stretch)
        symbols, cost = list(stretch), self.cost.get
        agenda = [cost(a + b, NONE) for a, b in zip(symbols, symbols[1:], strict=False)]
        while agenda:
            best = min(agenda)
            if best == NONE:
                break
            i = agenda.index(best)
            symbols[i] += symbols.pop(i + 1)
            del agenda[i]
            if i:
                agenda[i - 1] = cost(symbols[i - 1] + symbols[i], NONE)
            if i < len(agenda):
                agenda[i] = cost(symbols[i] + symbols[i + 1], NONE)
        return symbols

    def _merged_long(self, stretch: str) -> list[str]:
        symbols = list(stretch)
        n = len(symbols)
        cost = self.cost
        agenda = []
        for i in range(n - 1):
            union = symbols[i] + symbols[i + 1]
            if union in cost:
                agenda.append((cost[union], i, i + 1, union))
        if not agenda:
            return symbols
        heapq.heapify(agenda)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while agenda:
            _, left, right, union = heapq.heappop(agenda)
            if not symbols[left] or not symbols[right] or symbols[left] + symbols[right] != union:
                continue
            symbols[left], symbols[right] = union, ""
            behind, ahead = before[left], after[right]
            after[left] = ahead
            if ahead < n:
                before[ahead] = left
                longer = union + symbols[ahead]
                if longer in cost:
                    heapq.heappush(agenda, (cost[longer], left, ahead, longer))
            if behind >= 0:
                longer = symbols[behind] + union
                if longer in cost:
                    heapq.heappush(agenda, (cost[longer], behind, left, longer))
        return [s for s in symbols if s]

    def stretch_ids(self, stretch: str) -> list[int]:
        out = []
        for symbol in self.merged(stretch):
            found = self.ids.get(symbol)
            if found is None:
                out.extend(self.byte_ids[b] for b in symbol.encode())
            else:
                out.append(found)
        return out

    def by_library(self, stretches: list[str]) -> list[list[int]]:
        """The library puts a blank in front; a stretch without one follows a line end."""
        bare = [s[1:].replace(BLANK, " ") if s[0] == BLANK else "\n" + s for s in stretches]
        skip = len(self.library.encode("\n"))
        found = self.library.encode(bare, num_threads=1)
        return [
            ids[skip:] if s[0] != BLANK else ids or self.stretch_ids(s) for s, ids in zip(stretches, found, strict=True)
        ]

    def texts(self, texts: list[str | None]) -> list[tuple[bytes, int]]:
        """The decimal ids of each text, joined by blanks, and how many stretches differed."""
        known, find = self.known, self.cut.findall
        cut = [find(BLANK + t.replace(" ", BLANK)) if t else [] for t in texts]
        end = b"%d" % self.end
        joined = [b" ".join([*map(known.__getitem__, stretches), end]) for stretches in cut]
        wrong = known.checked()
        out = [(ids, 0) for ids in joined]
        if wrong:
            out = [
                (b" ".join([*map(known.__getitem__, stretches), end]), sum(s in wrong for s in stretches))
                for stretches in cut
            ]
        known.forget_long()
        return out


class Remembered(dict):
    """Decimal ids of recent stretches; at most two generations of REMEMBERED each and a batch.

    Stretches of over LONGEST characters seldom come again and are forgotten after their batch,
    so a worker remembers some hundred MB at most.
    """

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.old: dict[str, bytes] = {}
        self.new: dict[str, list[int]] = {}
        self.long: list[str] = []

    def __missing__(self, stretch: str) -> bytes:
        ids = self.old.get(stretch)
        if ids is None:
            self.new[stretch] = own = self.pieces.stretch_ids(stretch)
            ids = b" ".join(b"%d" % i for i in own)
        if len(stretch) > LONGEST:
            self.long.append(stretch)
        self[stretch] = ids
        return ids

    def forget_long(self) -> None:
        for stretch in self.long:
            self.pop(stretch, None)
        self.long = []

    def checked(self) -> set[str]:
        """Hold the stretches of this batch against the library; those that differ."""
        stretches = list(self.new)
        wrong = set()
        if stretches:
            for s, theirs in zip(stretches, self.pieces.by_library(stretches), strict=True):
                if self.new[s] != theirs:
                    wrong.add(s)
                    self[s] = b" ".join(b"%d" % i for i in theirs)
        self.new = {}
        if len(self) > REMEMBERED and not wrong:
            self.old = dict(self)
            self.clear()
        return wrong


_LOADED: dict[str, Pieces] = {}


def loaded(path: str) -> Pieces:
    if path not in _LOADED:
        _LOADED[path] = Pieces(path)
    return _LOADED[path]


def _digests(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = loaded(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            counts, ids_sha, decoded_sha, same, differ = [], [], [], [], []
            for text, (ids, wrong) in zip(texts, model.texts(texts), strict=True):
                numbers = list(map(int, ids.split()))
                decoded = model.library.decode(numbers)
                counts.append(len(numbers))
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                decoded_sha.append(hashlib.sha256(decoded.encode()).hexdigest())
                same.append(decoded == (text or ""))
                differ.append(wrong)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string()), pa.array(same, pa.bool_()), pa.array(differ, pa.int64())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "round_trip", "n_differing"],
            )

    return run


def _pieces(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = loaded(path)
        for batch in batches:
            encoded_, differ = zip(*model.texts(batch.column(1).to_pylist()), strict=True) if len(batch) else ((), ())
            found = [list(map(int, ids.split())) for ids in encoded_]
            decoded = pa.array(map(model.library.decode, found), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.int32())), decoded, pa.array(differ, pa.int64())],
                names=["doc_id", "ids", "decoded", "n_differing"],
            )

    return run


def _read(docs: DataFrame, ids: str, text: str) -> DataFrame:
    return docs.select(F.col(ids).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def encoded(docs: DataFrame, model: str, ids: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, the piece ids with the end id, the text decoded from them, and how many stretches differed."""
    return _read(docs, ids, text).mapInArrow(_pieces(model), PIECES)


def digests(docs: DataFrame, model: str, ids: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts and hashes of the ids and of the decoded text, without sending them on."""
    return _read(docs, ids, text).mapInArrow(_digests(model), DIGESTS)
