"""Alignment of two tokenizers against plain loops."""

import hashlib
import json
import random
from collections import Counter
from functools import cache

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from conftest import FOLDER
from helpers import frame
from tokenizers import Tokenizer

from clickmeter.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
FILES = (A, B, public_tokenizers.PATTERN)
ODD = [None, "", " ", "\n", "a", "  two  blanks ", "tab\tand\r\nlines\n\n", "<|endoftext|> </s> <s><unk><0x41>", "ends with ▁ a piece's blank", "é́ ﬁ½😀 字字 ñ", "\0 \x01", "a" * 3000]


@cache
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def tokens(text):
    """(id, bytes) of both tokenizers; none where they do not tile the text."""
    if not text:
        return [], []
    a, b = libraries()
    letters = alignment.byte_letters()
    left = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    right = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
    whole = (" " + text).encode()
    if b"".join(x for _, x in left) != whole or b"".join(x for _, x in right) != whole:
        return [], []
    return left, right


def spans(pieces):
    at, out = 0, []
    for i, content in pieces:
        out.append((i, at, at + len(content)))
        at += len(content)
    return out


def plain(texts):
    links, rows = [], []
    for text in texts:
        a, b = (spans(x) for x in tokens(text))
        cuts = sorted({y for _, _, y in a} & {y for _, _, y in b})
        groups = [
            "|".join(",".join(str(i) for i, _, y in side if low < y <= high) for side in (a, b)) for low, high in zip([0, *cuts], cuts, strict=False)
        ]
        found, first = [], 0
        for i, x, y in a:
            while first < len(b) and b[first][2] <= x:
                first += 1
            k = first
            while k < len(b) and b[k][1] < y:
                found.append((i, b[k][0]))
                k += 1
        links.append(found)
        rows.append([len(a), len(b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""])
    counts = Counter(x for found in links for x in found)
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    return [
        (n_a, n_b, n_groups, len(found), sum(counts[x] == best[x[1]] for x in found), sum(counts[x] for x in found), sha)
        for (n_a, n_b, n_groups, sha), found in zip(rows, links, strict=True)
    ]


def got(docs):
    rows = alignment.aligned(docs, *FILES).collect()
    return {r["doc_id"]: (r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups_sha256"]) for r in rows}


@pytest.mark.parametrize("size", [1, 400, 2 << 20])
def test_alignment_matches_plain_loops(spark, size):
    """In blocks of one text, of some, and of all."""
    texts = [r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("text").limit(40).collect()] + ODD * 2
    before, alignment.BLOCK_BYTES = alignment.BLOCK_BYTES, size
    try:  # the workers of a local session are forked and take the value along
        found = got(frame(spark, texts))
    finally:
        alignment.BLOCK_BYTES = before
    assert [found[i] for i in range(len(texts))] == plain(texts)


def test_random_characters(spark):
    random_ = random.Random(8)
    letters = "ab  \n\té😀\0theing字.,'1"
    texts = ["".join(random_.choice(letters) for _ in range(random_.choice([1, 5, 60]))) for _ in range(300)]
    found = got(frame(spark, texts))
    assert [found[i] for i in range(len(texts))] == plain(texts)


def test_blocks_hold_their_size(spark):
    ids, texts = zip(*[(i, "x" * 10) for i in range(100)], strict=True)
    batches = [pa.RecordBatch.from_pydict({"i": ids[k : k + 30], "t": texts[k : k + 30]}) for k in range(0, 100, 30)]
    alignment_bytes, alignment.BLOCK_BYTES = alignment.BLOCK_BYTES, 45
    try:
        blocks = list(alignment._gathered(iter(batches)))
    finally:
        alignment.BLOCK_BYTES = alignment_bytes
    assert [len(i) for i, _ in blocks] == [4] * 25


def test_odd_tables(spark):
    """Repeated rows, no doc_id, names that clash, an empty table, a long text, wide places."""
    docs = frame(spark, ["same text", "same text", "other"], [7, 7, None]).selectExpr("*", "1 as block", "'x' as links", "2 as pairs", "3 as n_best")
    rows = [(r["doc_id"], *tuple(r)[1:7]) for r in alignment.aligned(docs, *FILES).collect()]
    expected = [(i, *x[:6]) for i, x in zip([7, 7, None], plain(["same text", "same text", "other"]), strict=True)]
    assert sorted(rows, key=repr) == sorted(expected, key=repr)
    assert alignment.aligned(docs.limit(0), *FILES).count() == 0
    long = "".join(chr(0x4E00 + i % 20000) + " " for i in range(120_000))
    block = alignment.Block(alignment.loaded(*FILES), [long, "a"])
    assert block.n_links[0] > 0 and (block.links.dtype == "uint32") == (block.pairs.num_rows > 1 << 16)


def test_byte_letters_cover_the_vocabulary():
    vocabulary = json.load(open(A, encoding="utf-8"))["model"]["vocab"]
    assert len(set(alignment.byte_letters().values())) == 256
    assert {c for token in vocabulary if token != "<|endoftext|>" for c in token} <= set(alignment.byte_letters())


def test_both_libraries_of_a_agree_on_settled_characters():
    random_ = random.Random(1)
    settled = [chr(c) for c in range(0x250) if alignment.SETTLED.fullmatch(chr(c))]
    texts = ["".join(random_.choice(letters) for _ in range(random_.choice([2, 5, 40]))) for letters in (settled, "abct'sd 1.\n\t\xa0é") for _ in range(20_000)]
    texts += ["a" * 5000, " " * 5000, ".," * 2000]
    own = alignment.loaded(*FILES)
    expected = [x.ids for x in own.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
    assert own.encode(texts)[0].to_pylist() == expected
