"""Suffix, line and benchmark operators against plain versions."""

import hashlib
import random

import numpy as np
import pytest
from helpers import by_id, frame, prose
from test_line_runs import plain as plain_runs

from clickmeter.llm import decontaminate, linededup, suffixdedup


def removed(texts, ids, length=50):
    """Removed bytes of each text: strings that also start in a document with a smaller id."""
    first = {}
    data = [(t or "").encode() for t in texts]
    for i, b in zip(ids, data, strict=True):
        for k in range(len(b) - length + 1):
            s = b[k : k + length]
            first[s] = min(first.get(s, i), i)
    out = []
    for i, b in zip(ids, data, strict=True):
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if first[b[k : k + length]] < i:
                gone[k : k + length] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        spans = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(int)])) == 1))
        out.append((len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def overlapping(seed=2):
    random_ = random.Random(seed)
    base = [" ".join(prose(random_, 30)) for _ in range(8)]
    texts = []
    for _ in range(60):
        parts = [random_.choice(base) if random_.random() < 0.5 else " ".join(prose(random_, 10)) for _ in range(random_.randrange(1, 5))]
        text = "é\0 ".join(parts)
        cut = random_.randrange(len(text))
        texts.append(text[cut:] + text[: random_.randrange(len(text))])
    texts += [None, "", "a" * 49, "a" * 50, "a" * 51, "a" * 400, "ab" * 200, base[0], base[0], base[0][:50], base[0][1:51]]
    random_.shuffle(texts)
    return texts


@pytest.mark.parametrize("bucket_bytes", [suffixdedup.BUCKET_BYTES, 2000, 60])
def test_removed_strings_match_brute_force(spark, bucket_bytes):
    """Small buckets make every anchor with several snippets a hot one."""
    texts = overlapping()
    got = by_id(suffixdedup.removals(frame(spark, texts), bucket_bytes=bucket_bytes))
    expected = removed(texts, range(len(texts)))
    assert [tuple(got[i])[1:] for i in range(len(texts))] == expected


def test_removed_strings_of_equal_and_missing_ids(spark):
    text = "".join(prose(random.Random(1), 40))
    texts, ids = [text, text, text + "x", text[5:], text], [3, 3, 3, 9, None]
    rows = suffixdedup.removals(frame(spark, texts, ids)).collect()
    assert sorted((r["doc_id"], r["n_removed"]) for r in rows if r["doc_id"] is not None) == [(3, 0), (3, 0), (3, 0), (9, len(text) - 5)]
    assert [r["n_removed"] for r in rows if r["doc_id"] is None] == [0]
    assert suffixdedup.removals(frame(spark, texts, ids).limit(0)).count() == 0


def test_row_groups_share_the_length():
    random_ = random.Random(5)
    parts = ["".join(random_.choice("ab") for _ in range(random_.randrange(1, 60))) for _ in range(40)]
    symbols = np.concatenate([np.append(np.frombuffer(p.encode(), np.uint8).astype(np.uint16), 0) for p in parts])
    whole = symbols.tolist()
    order, group = suffixdedup.row_groups(symbols, 12, 61)
    keys = [tuple(whole[i : i + 12]) for i in order]
    for k in range(1, len(order)):
        together = keys[k] == keys[k - 1] and 0 not in keys[k] and len(keys[k]) == 12
        if 0 not in keys[k] or 0 not in keys[k - 1]:
            assert (group[k] == group[k - 1]) == together


def stripped(texts):
    """The texts without repeated chunks."""
    return plain_runs(texts)[0]


def lined(seed=6):
    random_ = random.Random(seed)
    lines = [" ".join(prose(random_, 6)) for _ in range(30)]
    texts = []
    for _ in range(50):
        at = random_.randrange(20)
        own = [" ".join(prose(random_, 5)) for _ in range(random_.randrange(4))]
        texts.append("\n".join(own + lines[at : at + random_.randrange(1, 12)] + own[::-1]))
    return texts + [None, "", "\n", "\n\n\n\n", "one", "same\n" * 500]


def test_line_chunks_match_plain_version(spark):
    texts = lined()
    docs = frame(spark, texts).selectExpr("*", "1 as again", "2 as first", "3 as row")
    got = by_id(linededup.stripped(docs))
    expected = stripped(texts)
    assert expected != texts
    assert [got[i]["text"] for i in range(len(texts))] == expected
    assert all(r["again"] == 1 and r["first"] == 2 and r["row"] == 3 for r in got.values())
    report = by_id(linededup.report(docs))
    assert [report[i]["kept_sha256"] for i in range(len(texts))] == [hashlib.sha256((t or "").encode()).hexdigest() for t in expected]


def test_lines_without_ids_and_empty_tables(spark):
    docs = frame(spark, ["a b\nc d\ne f\ng h"] * 3, ids=[None, 1, 1])
    assert {r["text"] for r in linededup.stripped(docs).where("doc_id is null").collect()} == {"a b\nc d\ne f\ng h"}
    assert linededup.stripped(docs.limit(0)).count() == 0
    assert linededup.report(docs.limit(0)).count() == 0


def distance(a, b):
    """Least edit distance of a to a part of b."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def items(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame(list(zip(ids, texts, strict=True)), "item_id long, text string")


@pytest.mark.parametrize("block", [decontaminate.BLOCK_CHARS, 150])
def test_leaks_match_brute_force(spark, block):
    random_ = random.Random(8)
    bench = [" ".join(prose(random_, n)) for n in (3, 12, 25, 25, 50)] + ["Ünï cödé " * 6]
    texts = []
    for k in range(40):
        probe = list(random_.choice(bench))
        budget = decontaminate.edits(len(decontaminate.normalised("".join(probe))))
        for _ in range(random_.choice([0, 1, budget, budget + 1, budget + 5])):
            at = random_.randrange(len(probe))
            probe[at : at + random_.randrange(2)] = random_.choice(["", "q", "z"])
        texts.append(" ".join(prose(random_, k)) + " " + "".join(probe).upper().replace(" ", "\n ") + " tail " * (k % 3))
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in decontaminate.leaks(frame(spark, texts), items(spark, bench), block_chars=block).collect()}
    expected = {}
    for d, text in enumerate(texts):
        for i, probe in enumerate(map(decontaminate.normalised, bench)):
            least = distance(probe, decontaminate.normalised(text))
            if least <= decontaminate.edits(len(probe)):
                expected[d, i] = least
    assert got == expected
    kept = decontaminate.kept(frame(spark, texts).selectExpr("*", "1 as item_id"), items(spark, bench))
    assert {r["doc_id"] for r in kept.collect()} == set(range(len(texts))) - {d for d, _ in expected}


def test_long_items_match_by_part(spark):
    random_ = random.Random(3)
    long = " ".join(prose(random_, 400))
    middle = decontaminate.normalised(long)[600:1100]
    got = decontaminate.leaks(frame(spark, ["start " + middle + " end", "other"]), items(spark, [long])).collect()
    assert [(r["doc_id"], r["item_id"], r["distance"]) for r in got] == [(0, 0, 0)]


def test_leaks_of_odd_rows(spark):
    probe = " ".join(prose(random.Random(2), 20))
    docs = frame(spark, [probe, probe, None, "", probe, "short"], ids=[1, 1, 2, 3, None, 4])
    bench = items(spark, [probe, probe, None, "", "tiny", probe], ids=[0, 1, 2, 3, 4, None])
    assert sorted((r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, bench).collect()) == [(1, 0), (1, 1)]
    assert decontaminate.leaks(docs.limit(0), bench).count() == 0
    assert decontaminate.leaks(docs, bench.limit(0)).count() == 0
    assert decontaminate.kept(docs, bench).count() == 4
