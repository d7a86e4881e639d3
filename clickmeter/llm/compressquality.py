"""Quality by compression: which of two dictionaries makes a text smaller.

One zstandard dictionary is built from texts labelled good, one from texts labelled bad. A
text is cut into pieces of `PIECE` bytes, so that its own beginning does not take the place of
the dictionary, and every piece of the whole text is compressed with each. With G and B the
sums of compressed bytes, the difference is B - G for each byte of text (and `OWN_BYTES`, so that
a few words don't tell much), above 0 where the good dictionary knows the text better. Text that
repeats itself needs no dictionary and gets a difference near 0, so (B + G) / 2 for each byte of
text goes along. A logistic curve over the
two, fitted on labelled documents that no dictionary has seen, makes them a probability.

What is learnt comes from a sample with fixed bounds: for each label the `DICTIONARY_DOCS`
documents of lowest hash, `SAMPLE_PIECES` pieces spread over each, go to the driver, and of
the next `FIT_DOCS` whole documents two numbers each. The share of the labels is counted over
all of them. The rest reads whole texts where they lie: one pass for the sample, one to score.

Defined cases: labels other than 0 and 1 and rows without id count for nothing, nor does a
document with both. Several texts of one labelled id are one sample, the least. With too few
texts to train on, their joined bytes are the dictionary. If a label has no document to fit on,
the documents of the dictionaries are taken, and if there is none, every score is the share of
label 1, with one row more of each. Repeated rows and rows without doc_id each get a row. A null
text counts as empty; an empty text is one empty piece. An empty table gives an empty one. Only
the named columns are read, and the id only to join labels: a score depends on the text alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmeter.llm.common import written

DICTIONARY_DOCS = 1000
FIT_DOCS = 2000
FIT_SHARE = 4  # of the labelled documents one in so many is for the curve
SPARE = 16  # so many times the documents wanted lie below the border
SAMPLE_PIECES = 8
PIECE = 2048
DICTIONARY_BYTES = 112_640
LEVEL = 3
SEGMENT = 500  # bytes that the dictionaries are put together from
OWN_BYTES = 64
FURTHEST = 0.3  # differences beyond are as good as this
STEPS = 50
RIDGE = 1e-2
GOOD_FROM = 0.3
HOLD_OUT = 5


def _pieces(text: bytes) -> list[bytes]:
    return [text[i : i + PIECE] for i in range(0, len(text), PIECE)] or [b""]


def _dictionary(samples: list[bytes]) -> bytes:
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=SEGMENT, d=8, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:] or b"\0" * 8


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(dictionary)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False)


@dataclass(frozen=True)
class Dictionaries:
    good: bytes
    bad: bytes

    def measure(self, texts: list[bytes | None]) -> np.ndarray:
        """The difference of compressed sizes and the compressed size for a byte, of each text."""
        good, bad = _compressor(self.good), _compressor(self.bad)
        out = np.zeros((len(texts), 2))
        for i, text in enumerate(texts):
            g = b = 0
            for piece in _pieces(text or b""):
                g += len(good.compress(piece))
                b += len(bad.compress(piece))
            n = len(text or b"")
            out[i] = np.clip((b - g) / (n + OWN_BYTES), -FURTHEST, FURTHEST), min((b + g) / 2 / max(n, 1), 1.0)
        return out


@dataclass(frozen=True)
class Model:
    dictionaries: Dictionaries
    constant: float
    weights: tuple[float, float]

    def score(self, measures: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.constant + measures @ np.array(self.weights))))


def calibrated(measures: np.ndarray, labels: np.ndarray, counts: tuple[int, int]) -> tuple[float, tuple[float, float]]:
    """The logistic curve (Newton steps), each label weighing as much as all its documents."""
    middle, spread = measures.mean(0), measures.std(0) + 1e-9
    x = np.c_[np.ones(len(measures)), (measures - middle) / spread]
    share = np.array(counts) / np.maximum(np.bincount(labels, minlength=2), 1)
    weight = share[labels] / share[labels].mean()
    w, ridge = np.zeros(3), RIDGE * np.eye(3)
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-x @ w))
        w += np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (weight * (labels - p)) - ridge @ w)
    slopes = w[1:] / spread
    return float(w[0] - slopes @ middle), (float(slopes[0]), float(slopes[1]))


def held_out(ids: str = "doc_id") -> Column:
    """Documents whose labels are not learnt from."""
    return F.coalesce(F.crc32(F.col(ids).cast("string")) % HOLD_OUT == 0, F.lit(False))


def _sample(docs: DataFrame, known: DataFrame, counts: dict[int, int]) -> DataFrame:
    """label, for_fit, text of the labelled documents of lowest hash.

    Hashes are spread evenly, so the lowest lie below a border that the counts tell; only
    those below it are put in order, a few thousand however many there are.
    """
    for_fit = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(FIT_SHARE)) == 0
    below = F.lit(False)
    for label, n in counts.items():
        share = min(1.0, SPARE * max(FIT_DOCS, DICTIONARY_DOCS) / n)
        below |= (F.col("label") == label) & (F.xxhash64("doc_id") <= min((1 << 63) - 1, int(-(1 << 63) + share * (1 << 64))))
    known = known.where(below)
    place = F.row_number().over(Window.partitionBy("label", "for_fit").orderBy(F.xxhash64("doc_id"), "doc_id"))
    chosen = known.withColumn("for_fit", for_fit).withColumn("place", place).where(f"place <= {max(FIT_DOCS, DICTIONARY_DOCS)}")
    chosen = chosen.where(f"for_fit or place <= {DICTIONARY_DOCS}").drop("place")
    # At most 2 * (DICTIONARY_DOCS + FIT_DOCS) rows of three small columns.
    rows = docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label", "for_fit").agg(F.min("text").alias("text"))
    return written(rows, "labelled-sample")


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Some pieces of each text."""
    for batch in batches:
        kept = []
        for text in batch.column("text").cast(pa.binary()).to_pylist():
            pieces = _pieces(text or b"")
            at = np.linspace(0, len(pieces) - 1, min(SAMPLE_PIECES, len(pieces))).astype(int)
            kept.append([pieces[i] for i in at])
        yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(kept, pa.list_(pa.binary()))], names=["label", "pieces"])


def _measured(dictionaries: Dictionaries):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = dictionaries.measure(batch.column("text").cast(pa.binary()).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("label"), *(pa.array(x) for x in found.T)], names=["label", "difference", "size"])

    return run


def fitted(docs: DataFrame, labels: DataFrame, ids: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """The model learnt from all given labels: leave out beforehand what it must not see."""
    read = docs.select(F.col(ids).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    known = (
        labels.select(F.col(ids).cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where("doc_id is not null and label in (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .where("label = other")
        .drop("other")
    )
    known = written(known, "known-labels")
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = _sample(read, known, counts)
    pieces = {0: [], 1: []}
    seen = rows.where("not for_fit").select("doc_id", "label", "text").sort("doc_id").drop("doc_id")
    for row in seen.mapInArrow(_spread, "label int, pieces array<binary>").collect():
        pieces[row["label"]] += [bytes(p) for p in row["pieces"]]
    dictionaries = Dictionaries(_dictionary(pieces[1]), _dictionary(pieces[0]))
    for chosen in ("for_fit", "true"):
        found = rows.where(chosen).select("label", "text").mapInArrow(_measured(dictionaries), "label int, difference double, size double")
        found = sorted(tuple(r) for r in found.collect())  # the fit does not depend on the order of tasks
        own = np.array([r[0] for r in found], int)
        if 0 < own.sum() < len(own):
            return Model(dictionaries, *calibrated(np.array([r[1:] for r in found]), own, (counts[0], counts[1])))
    share = (counts.get(1, 0) + 1) / (counts.get(0, 0) + counts.get(1, 0) + 2)
    return Model(dictionaries, float(np.log(share / (1 - share))), (0.0, 0.0))


def _scored(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.score(model.dictionaries.measure(batch.column("text").cast(pa.binary()).to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], names=["doc_id", "score"])

    return run


def scored(docs: DataFrame, model: Model, ids: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the score of every row."""
    read = docs.select(F.col(ids).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return read.mapInArrow(_scored(model), "doc_id long, score double")


def judged(docs: DataFrame, labels: DataFrame, ids: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """doc_id, held_out, score and predicted of every row; held-out labels are not learnt from."""
    model = fitted(docs, labels.where(~held_out(ids)), ids, text, label)
    return scored(docs, model, ids, text).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= GOOD_FROM).cast("int").alias("predicted")
    )
