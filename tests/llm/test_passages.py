"""Passages copied out of benchmark items, wherever they start."""

import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from helpers import frame, prose
from test_texts import items

from clickmeter.llm import decontaminate


@pytest.mark.parametrize("words", [50, 330])
def test_copied_passages_are_found_at_every_offset(spark, words):
    random_ = random.Random(words)
    item = decontaminate.normalised(" ".join(prose(random_, words)))
    length = decontaminate.PART + decontaminate.STRIDE - 1
    offsets = range(0, len(item) - length + 1, 1 if words < 100 else 7)
    assert len(offsets) > 60
    texts = [f"{' '.join(prose(random_, 20))} {item[a : a + length]} {' '.join(prose(random_, 20))}" for a in offsets]
    texts += [" ".join(prose(random_, 80)) for _ in range(10)]
    found = decontaminate.leaks(frame(spark, texts), items(spark, ["other " * 9, item]), passages=True).collect()
    assert sorted((r["doc_id"], r["item_id"], r["distance"]) for r in found) == [(d, 1, 0) for d in range(len(offsets))]


def test_passages_have_their_own_edits(spark):
    random_ = random.Random(5)
    item = decontaminate.normalised(" ".join(prose(random_, 60)))

    def changed(text, step):
        return "".join("#" if k % step == 3 else c for k, c in enumerate(text))

    texts = [changed(item[40:240], 30), changed(item[40:240], 9), item]
    found = decontaminate.leaks(frame(spark, texts), items(spark, [item]), passages=True).collect()
    assert {r["doc_id"] for r in found} == {0, 2}
    kept = decontaminate.kept(frame(spark, texts).selectExpr("*", "1 as item_id"), items(spark, [item]), passages=True)
    assert {r["doc_id"] for r in kept.collect()} == {1}


def test_repeated_characters_stay_small():
    """An item and a long text of one character, or two in turn: counted as runs, or a part at a time."""
    for item, text in (("_" * 400, "_" * 300_000), ("ab" * 60, "ab" * 2000)):
        index = decontaminate.Probes([(7, part, p) for part, p in decontaminate.probes(item, True)])
        tracemalloc.start()
        found = list(decontaminate._found([text, "other text"], index))
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert [(d, i, distance) for d, i, _, distance, _ in found] == [(0, 7, 0)] and most < 400e6


@pytest.mark.parametrize("chunk", [1, 50, 10**6])
def test_regions_are_those_of_all_pairs_of_grams(monkeypatch, chunk):
    monkeypatch.setattr(decontaminate, "CHUNK", chunk)
    random_ = random.Random(chunk)
    for _ in range(60):
        letters = random_.choice(["a", "ab", "abc "])
        rows = [(i, False, "".join(random_.choice(letters) for _ in range(random_.randint(10, 70)))) for i in range(4)]
        texts = ["".join(random_.choice(letters) for _ in range(random_.randint(0, 120))) for _ in range(3)] + [rows[0][2] * 2]
        index = decontaminate.Probes(rows)
        expected = set()
        for d, text in enumerate(texts):
            for p, probe in enumerate(index.texts):
                width, counts = int(index.edits[p]) + 1, Counter()
                for at in range(len(text) - 9):
                    for place in range(len(probe) - 9):
                        if text[at : at + 10] == probe[place : place + 10]:
                            band = (at - place) // width
                            counts.update((band, band - 1))
                expected |= {(d, p, band * width) for band, n in counts.items() if n >= index.bounds[p]}
        whole = "\0".join(texts) + "\0"
        sizes = np.array([len(t) for t in texts])
        ends = np.cumsum(sizes + 1)
        assert set(index.regions(decontaminate.codes(whole), ends - sizes - 1, ends)) == expected


def test_a_benchmark_of_many_blocks_gives_the_same_pairs(spark):
    random_ = random.Random(2)
    leaks = [" ".join(prose(random_, 30)) for _ in range(12)]
    docs = frame(spark, [" ".join(prose(random_, 40)) + " " + x + " end" for x in leaks] + ["clean text"])
    one, many = (decontaminate.leaks(docs, items(spark, leaks), block_chars=n, passages=True) for n in (10**6, 500))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect())) and one.count() == 12
