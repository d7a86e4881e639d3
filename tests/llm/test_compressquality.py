"""The compression classifier: plain measures, held-out accuracy, odd tables."""

import random
import zlib

import numpy as np
import pytest
import zstandard
from conftest import FOLDER
from helpers import by_id, frame, prose

from clickmeter.llm import compressquality
from clickmeter.llm.common import prepare

LABELS = "doc_id long, quality int, toxic int"
LARGER = "/root/testdata/sf0.01"


def corpus(spark, n=300):
    random_ = random.Random(5)
    texts, labels = [], []
    for i in range(n):
        good = i % 4 > 0
        words = prose(random_, random_.choice([30, 120, 600]))
        texts.append(" ".join(words).capitalize() + "." if good else " | ".join(w.upper() + "$%" for w in words))
        labels.append((i, int(good), 0))
    return frame(spark, texts), spark.createDataFrame(labels, LABELS), texts, dict((i, q) for i, q, _ in labels)


def accuracy(rows, labels):
    held = [r for r in rows.values() if r["held_out"] and r["doc_id"] in labels]
    assert held
    return sum(r["predicted"] == labels[r["doc_id"]] for r in held) / len(held)


def test_measures_match_plain_compression():
    random_ = random.Random(1)
    samples = [" ".join(prose(random_, 60)).encode() for _ in range(200)]
    both = compressquality.Dictionaries(compressquality._dictionary(samples), compressquality._dictionary([s.upper() for s in samples]))
    texts = [samples[0], samples[0].upper(), b"", None, b"x" * 100_000, " ".join(prose(random_, 4000)).encode()]
    for text, (difference, size) in zip(texts, both.measure(texts), strict=True):
        sums = []
        for dictionary in (both.good, both.bad):
            packer = zstandard.ZstdCompressor(
                level=3, dict_data=zstandard.ZstdCompressionDict(dictionary), write_content_size=False, write_checksum=False, write_dict_id=False
            )
            sums.append(sum(len(packer.compress((text or b"")[i : i + 2048])) for i in range(0, max(1, len(text or b"")), 2048)))
        good, bad = sums
        assert difference == pytest.approx(np.clip((bad - good) / (len(text or b"") + 64), -0.3, 0.3))
        assert size == pytest.approx(min(1, (bad + good) / 2 / max(1, len(text or b""))))
    assert both.measure([samples[0]])[0, 0] > 0 > both.measure([samples[0].upper()])[0, 0]


def test_calibration_is_a_probability():
    random_ = np.random.default_rng(3)
    measures = np.c_[random_.normal(0, 0.1, 20_000), random_.uniform(0, 1, 20_000)]
    true = 1 / (1 + np.exp(-(0.5 + 20 * measures[:, 0] + measures[:, 1])))
    labels = (random_.uniform(size=20_000) < true).astype(int)
    counts = tuple(np.bincount(labels))
    constant, weights = compressquality.calibrated(measures, labels, counts)
    assert np.abs(compressquality.Model(None, constant, weights).score(measures) - true).max() < 0.05
    # A sample with as many of each label gives the same curve, as labels weigh what they count.
    n = min(counts)
    some = np.concatenate([np.flatnonzero(labels == k)[:n] for k in (0, 1)])
    constant, weights = compressquality.calibrated(measures[some], labels[some], counts)
    assert np.abs(compressquality.Model(None, constant, weights).score(measures) - true).max() < 0.08


def test_held_out_accuracy_on_given_documents(spark):
    docs, labels = (prepare(spark).read.parquet(f"{LARGER}/{t}.parquet") for t in ("documents", "labels"))
    rows = by_id(compressquality.judged(docs, labels))
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for i, r in rows.items())
    known = {r["doc_id"]: r["quality"] for r in labels.collect()}
    assert accuracy(rows, known) >= 0.95


def test_only_text_and_learnable_labels_count(spark):
    docs, labels, texts, known = corpus(spark)
    rows = by_id(compressquality.judged(docs, labels))
    assert accuracy(rows, known) > 0.95
    turned = spark.createDataFrame([(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, 1) for i, q in known.items()], LABELS)
    other = docs.selectExpr("doc_id", "text", "'xx' as lang", "'y' as source", "7 as score", "1 as label", "true as for_fit")
    again = by_id(compressquality.judged(other, turned))
    assert {i: r["score"] for i, r in rows.items()} == {i: r["score"] for i, r in again.items()}


def test_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(compressquality, "DICTIONARY_DOCS", 20)
    monkeypatch.setattr(compressquality, "FIT_DOCS", 30)
    docs, labels, _, known = corpus(spark)
    read = docs.unionByName(docs).select("doc_id", "text")
    counts = {k: sum(q == k for q in known.values()) for k in (0, 1)}
    found = compressquality._sample(read, labels.selectExpr("doc_id", "quality as label"), counts)
    n = {(r["label"], r["for_fit"]): r["n"] for r in found.groupBy("label", "for_fit").agg({"doc_id": "count"}).toDF("label", "for_fit", "n").collect()}
    assert n[1, False] == 20 and max(n.values()) <= 30
    assert accuracy(by_id(compressquality.judged(docs, labels)), known) > 0.9


def test_odd_tables(spark):
    texts = [None, "", "good words here", "good words here", "x" * 300_000]
    docs = frame(spark, texts, [1, 2, 3, 3, None])
    for labels in ([], [(1, 1, 0), (2, 1, 0), (None, 0, 0), (3, None, 0), (3, 5, 0)], [(1, 0, 0), (2, 1, 0), (3, 1, 0), (3, 0, 1)]):
        rows = compressquality.judged(docs, prepare(spark).createDataFrame(labels, LABELS)).collect()
        assert len(rows) == 5 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert compressquality.judged(docs.limit(0), spark.createDataFrame([], LABELS)).count() == 0
    one = {r["score"] for r in compressquality.judged(docs, spark.createDataFrame([(1, 0, 0), (2, 0, 0), (8, 0, 0)], LABELS)).collect()}
    assert len(one) == 1 and 0 < one.pop() < 0.5
