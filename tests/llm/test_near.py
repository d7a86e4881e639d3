"""Near copies of documents, repeated paragraphs, and components."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import WORD, by_id, frame, prose

from clickmeter.llm import bagminhash, near, paragraphs
from clickmeter.llm.common import text_bytes
from clickmeter.llm.components import components


def bag(text):
    words = WORD.findall(text or "")
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def similarity(a, b):
    shared = sum((a & b).values())
    return shared / (sum(a.values()) + sum(b.values()) - shared) if shared else 0.0


def expected_classes(texts, threshold=0.8):
    bags = [bag(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if bags[i] and bags[j] and similarity(bags[i], bags[j]) >= threshold:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))]


def edited(words, random_, n):
    out = list(words)
    for _ in range(n):
        out[random_.randrange(len(out))] = "edit" + str(random_.randrange(10**9))
    return out


def corpus(seed=3):
    random_ = random.Random(seed)
    texts = []
    for _ in range(12):
        base = prose(random_, random_.choice([12, 60, 200]))
        texts += [" ".join(base)] * random_.choice([1, 2])
        texts += [" ".join(edited(base, random_, random_.randrange(6))) for _ in range(random_.randrange(9))]
    filler = "so it goes on "
    texts += [filler * n + " ".join(prose(random_, 20)) for n in range(40, 60)]
    passage = prose(random_, 40)
    texts += [" ".join(prose(random_, 30) + passage + prose(random_, 30)) for _ in range(25)]
    texts += [None, "", " \n", "one two", "one two", "one  two", "one two three four"]
    random_.shuffle(texts)
    return texts


def test_classes_match_brute_force(spark):
    texts = corpus()
    got = by_id(bagminhash.classes(frame(spark, texts)))
    assert [got[i]["class_id"] for i in range(len(texts))] == expected_classes(texts)


def test_one_document_of_each_class_stays(spark):
    texts = corpus(5)
    docs = frame(spark, texts).selectExpr("*", "1 as item", "2 as class_id", "3 as bands")
    kept = bagminhash.kept(docs)
    assert kept.columns == docs.columns
    expected = {i for i, c in enumerate(expected_classes(texts)) if i == c}
    assert {r["doc_id"] for r in kept.collect()} == expected


def test_rows_without_or_with_equal_ids(spark):
    docs = frame(spark, ["a b c d e f"] * 3 + ["g h i j k l", "a b c d e f"], ids=[4, 4, None, 4, 2])
    rows = sorted(((r["doc_id"], r["class_id"]) for r in bagminhash.classes(docs).collect()), key=str)
    assert rows == sorted([(4, 2), (4, 2), (None, None), (4, 2), (2, 2)], key=str)
    assert bagminhash.classes(docs.limit(0)).count() == 0


def test_signatures_estimate_weighted_jaccard():
    random_ = np.random.default_rng(1)
    hashes = random_.integers(0, 2**63, 300).astype(np.uint64)
    a, b = random_.integers(0, 9, (2, 300))
    rows = np.repeat([0, 1], 300)
    weights = np.concatenate([a, b])
    some = weights > 0
    got = bagminhash.signatures(rows[some], np.tile(hashes, 2)[some], weights[some], 2, size=4096)
    assert abs((got[0] == got[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.03


def test_components_of_paths_and_hubs(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    frame_ = spark.createDataFrame(links, "a long, b long")
    got = {r["item"]: r["component"] for r in components(frame_).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}
    assert components(frame_.limit(0)).count() == 0


def test_bands_reach_the_recall_they_are_tuned_for():
    for threshold in (0.6, 0.8, 0.9):
        n = paragraphs.bands_for(threshold, 3, 1e-4)
        assert (1 - threshold**3) ** n <= 1e-4 < (1 - threshold**3) ** (n - 1)


def runs(text):
    words = WORD.findall(text)
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def removed_paragraphs(texts):
    """Of each document the lines of 20 words that are near an earlier one, by components."""
    lines = [
        (d, k, runs(line))
        for d, text in enumerate(texts)
        for k, line in enumerate((text or "").split("\n"))
        if len(WORD.findall(line)) >= 20
    ]
    root = list(range(len(lines)))
    for i in range(len(lines)):
        for j in range(i):
            a, b = lines[i][2], lines[j][2]
            if len(a & b) >= 0.8 * len(a | b):
                root = [min(root[i], root[j]) if r in (root[i], root[j]) else r for r in root]
    return Counter(lines[i][0] for i in range(len(lines)) if root[i] != i)


def test_paragraphs_match_brute_force(spark):
    random_ = random.Random(9)
    bases = [prose(random_, 40) for _ in range(6)]
    texts = []
    for _ in range(40):
        parts = [" ".join(edited(random_.choice(bases), random_, random_.randrange(3))) if random_.random() < 0.4 else " ".join(prose(random_, random_.randrange(5, 50))) for _ in range(4)]
        texts.append("\n".join(parts))
    texts += [None, "", "\n\n", texts[0]]
    got = by_id(paragraphs.removals(frame(spark, texts)))
    expected = removed_paragraphs(texts)
    assert {i: got[i]["n_removed_paragraphs"] for i in got} == {i: expected[i] for i in range(len(texts))}
    assert got[len(texts) - 4]["n_bytes"] == 0


@pytest.mark.parametrize("joint", [" ", "\n"])
def test_passages_inside_paragraphs_go_and_clean_texts_stay(spark, joint):
    random_ = random.Random(4)
    texts, planted = [], []
    for _ in range(8):
        passage = " ".join(prose(random_, 55))
        for _ in range(3):
            planted.append(len(texts))
            texts.append(joint.join([" ".join(prose(random_, 60)), passage, " ".join(prose(random_, 60))]))
    boilerplate = "all of these words stand in very many documents here"
    clean = [" ".join(prose(random_, 80)) + f"\n{boilerplate}\n" + " ".join(prose(random_, 40)) for _ in range(20)]
    got = by_id(paragraphs.removals(frame(spark, texts + clean)))
    for k, i in enumerate(planted):
        assert (got[i]["n_removed"] > 0) == (k % 3 > 0)
    for i in range(len(texts), len(texts) + len(clean)):
        assert got[i]["n_removed"] == 0
        assert got[i]["kept_sha256"] == hashlib.sha256(clean[i - len(texts)].encode()).hexdigest()


def piece_texts(text):
    """Words of a text and its pieces as ranges of words."""
    data, offsets = text_bytes(pa.array([text]))
    words, first = near.word_hashes(data, offsets)
    _, starts, ends, _ = paragraphs.short_pieces(words, first)
    return list(zip(starts.tolist(), ends.tolist(), strict=True))


def kept_of_passages(texts):
    """What stays when only passages go: runs of pieces of which one earlier text is the first to have every pair."""
    cut = [(WORD.findall(t), list(WORD.finditer(t)), piece_texts(t)) for t in texts]
    holder = {}
    for d, (words, _, parts) in enumerate(cut):
        for (a, m), (_, b) in zip(parts, parts[1:], strict=False):
            holder.setdefault((tuple(words[a:m]), tuple(words[m:b])), d)
    out, runs = [], []
    for d, (words, spans, parts) in enumerate(cut):
        gone, k = set(), 0
        held = [holder[tuple(words[a:m]), tuple(words[m:b])] for (a, m), (_, b) in zip(parts, parts[1:], strict=False)]
        while k < len(held):
            j = k
            while j + 1 < len(held) and held[j + 1] == held[k]:
                j += 1
            a, b = parts[k][0], parts[j + 1][1]
            if held[k] < d and b - a >= paragraphs.MIN_RUN:
                gone |= set(range(spans[a].start(), spans[b - 1].end()))
                runs.append((d, held[k], words[a:b]))
            k = j + 1
        out.append("".join(c for i, c in enumerate(texts[d]) if i not in gone))
    return out, runs


def test_passages_match_plain_loops(spark):
    """Short lines, so that no paragraph has a part in it; passages, and bits of other texts."""
    random_ = random.Random(11)
    bases = [prose(random_, 200) for _ in range(8)]
    texts = [" ".join(b) for b in bases]
    for _ in range(60):
        words = []
        for _ in range(random_.randrange(2, 8)):
            base, n = random_.choice(bases), random_.choice([3, 8, 14, 30, 60])
            at = random_.randrange(len(base) - n)
            words += base[at : at + n] if random_.random() < 0.7 else prose(random_, n)
        texts.append(" ".join(words))
    texts = ["\n".join(" ".join(t.split(" ")[i : i + 12]) for i in range(0, len(t.split(" ")), 12)) for t in texts]
    expected, runs = kept_of_passages(texts)
    got = by_id(paragraphs.removals(frame(spark, texts)))
    assert [got[i]["kept_sha256"] for i in range(len(texts))] == [hashlib.sha256(t.encode()).hexdigest() for t in expected]
    assert len(runs) > 60 and all(r["n_paragraphs"] == 0 for r in got.values())
    for d, e, words in runs:  # what goes stands in the one text it was first in
        assert " ".join(words) in " ".join(WORD.findall(texts[e])), (d, e)


def test_bits_of_many_documents_are_no_passage(spark):
    random_ = random.Random(13)
    others = [prose(random_, 100) for _ in range(8)]
    bits = " ".join(w for o in others for w in o[30:44])
    got = by_id(paragraphs.removals(frame(spark, [" ".join(o) for o in others] + [bits])))
    assert got[8]["n_removed"] == 0 and got[8]["n_bytes"] == len(bits)


def test_shingles_of_short_and_long_texts():
    words = np.arange(1, 13, dtype=np.uint64) * np.uint64(977)
    first = np.array([0, 0, 2, 12])
    rows, hashes = near.shingles(words, first)
    assert sorted(Counter(rows.tolist()).items()) == [(1, 1), (2, 6)]
    assert len(set(hashes.tolist())) == 7
