"""Piece encoding, section counts, licences and tool calls."""

import hashlib
import json
import math
import random
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from conftest import FOLDER
from helpers import by_id, frame

from clickmeter.llm import licenses, sentencepieces, tokencounts, toolcalls

MODEL = public_tokenizers.path("piece_bpe_32k.model")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = [None, "", " ", "  a", "a\n\nb \n", "\t\0x", "▁ a▁b", "é́ ﬁ½😀 字字", "<s></s><unk><0x41>", "a" * 3000, "x y " * 2000, "it's 1,234.5%!", "\r\n .,;"]


def expected_digests(text):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    ids = library.encode(text or "", add_eos=True)
    digests = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), library.decode(ids))]
    return (len(ids), *digests)


def test_digests_match_the_library(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    texts = [r["text"] for r in docs.collect()] + ODD
    got = by_id(sentencepieces.digests(frame(spark, texts), MODEL))
    for i, text in enumerate(texts):
        assert tuple(got[i])[1:4] == expected_digests(text)
        assert got[i]["n_differing"] == 0


def test_random_characters_match_the_library(monkeypatch):
    """With a short memory and both kinds of agenda."""
    monkeypatch.setattr(sentencepieces, "REMEMBERED", 50)
    random_ = random.Random(3)
    letters = "ab  \n\t▁éß😀\0<0x1>theing字.,'"
    texts = ["".join(random_.choice(letters) for _ in range(random_.choice([3, 20, 200]))) for _ in range(3000)]
    for short in (0, 40):
        monkeypatch.setattr(sentencepieces, "SHORT", short)
        pieces = sentencepieces.Pieces(MODEL)
        for start in range(0, len(texts), 500):
            part = texts[start : start + 500]
            expected = pieces.library.encode(part, add_eos=True)
            assert [list(map(int, ids.split())) for ids, _ in pieces.texts(part)] == expected
        assert len(pieces.known) + len(pieces.known.old) < 6000  # a batch may bring that many


def test_a_differing_stretch_is_counted_and_the_library_wins(monkeypatch):
    pieces = sentencepieces.Pieces(MODEL)
    monkeypatch.setattr(pieces, "stretch_ids", lambda stretch: [7])
    [(ids, wrong)] = pieces.texts(["one two one"])
    assert list(map(int, ids.split())) == pieces.library.encode("one two one", add_eos=True)
    assert wrong == 3


def test_long_stretches_are_forgotten_after_their_batch():
    pieces = sentencepieces.Pieces(MODEL)
    random_ = random.Random(6)
    for _ in range(3):
        texts = ["".join(random_.choice("abcdefgh") for _ in range(300)) for _ in range(50)] + ["a short one"]
        expected = pieces.library.encode(texts, add_eos=True)
        assert [list(map(int, ids.split())) for ids, _ in pieces.texts(texts)] == expected
        assert all(len(s) <= sentencepieces.LONGEST for s in pieces.known) and len(pieces.known) == 3


def test_encoded_round_trip_and_empty_table(spark):
    docs = frame(spark, ODD).selectExpr("*", "1 as ids", "2 as decoded")
    got = by_id(sentencepieces.encoded(docs, MODEL))
    assert all(r["n_differing"] == 0 for r in got.values())
    assert all(got[i]["decoded"] == (t or "").replace("▁", " ") for i, t in enumerate(ODD))
    assert sentencepieces.encoded(docs.limit(0), MODEL).count() == 0


def spans(text):
    """Characters of the tokens, by decoding one after the other."""
    encoding, _ = tokencounts.loaded(VOCABULARY, public_tokenizers.PATTERN)
    out, at = [], 0
    owner = [k for k, c in enumerate(text) for _ in c.encode()]
    for token in encoding.encode_ordinary(text):
        n = len(encoding.decode_single_token_bytes(token))
        out.append((owner[at], owner[at + n - 1] + 1))
        at += n
    return out


def plain_count(tokens, start, stop, rule):
    total, crossing = 0.0, 0
    for a, b in tokens if stop > start else ():
        held = max(0, min(b, stop) - max(a, start)) / (b - a)
        crossing += 0 < held < 1
        inside = start <= a < stop
        total += {"start": inside, "share": held, "majority": held > 0.5 or (held == 0.5 and inside)}[rule]
    return total, crossing


@pytest.mark.parametrize("rule", tokencounts.RULES)
def test_sections_match_plain_counts(spark, rule):
    random_ = random.Random(5)
    texts = [t for t in ODD if t] + ["The quick brown fox jumps over the lazy dog — naïve café 字字😀😀."]
    sections = []
    for i, text in enumerate(texts):
        for k in range(25):
            a, b = random_.randrange(-2, len(text) + 2), random_.randrange(-2, len(text) + 4)
            sections.append((i, k, a, b))
    given = spark.createDataFrame(sections + [(999, 0, 0, 5), (None, 1, 0, 5)], "doc_id long, section long, start long, end long")
    rows = tokencounts.section_tokens(frame(spark, texts), VOCABULARY, public_tokenizers.PATTERN, given, rule).collect()
    got = {(r["doc_id"], r["section"]): (r["n_tokens"], r["n_crossing"]) for r in rows}
    assert len(got) == len(sections) + 2
    assert got[999, 0] == got[None, 1] == (0, 0)  # no such document
    for i, k, a, b in sections:
        n = len(texts[i])
        expected = plain_count(spans(texts[i]), min(max(a, 0), n), min(max(b, 0), n), rule)
        assert got[i, k] == pytest.approx(expected), (i, k, a, b)


def test_lines_share_out_all_tokens(spark):
    rows = tokencounts.section_tokens(frame(spark, ODD), VOCABULARY, public_tokenizers.PATTERN).collect()
    encoding, _ = tokencounts.loaded(VOCABULARY, public_tokenizers.PATTERN)
    for i, text in enumerate(ODD):
        own = [r for r in rows if r["doc_id"] == i]
        assert sum(r["n_tokens"] for r in own) == len(encoding.encode_ordinary(text or ""))
        assert len(own) == 1 + (text.count("\n") + 1 if text else 0)
    empty = tokencounts.section_tokens(frame(spark, ODD).limit(0), VOCABULARY, public_tokenizers.PATTERN)
    assert empty.count() == 0


def files(spark, rows):
    return spark.createDataFrame([(i, p, t) for i, (p, t) in enumerate(rows)], "doc_id long, path string, text string")


LONG = "plain words of a long program text " * 20


def test_licences_are_found_and_inherited(spark):
    rows = [
        ("/LICENSE", "Released under the MIT License."),
        ("/a/x.py", LONG),
        ("/a/b/COPYING", LONG + "\nThis work is licensed under the GNU General Public License, version 3."),
        ("/a/b/c/y.py", LONG),
        ("/a/b/c/z.py", "# SPDX-License-Identifier: Apache-2.0\n" + LONG),
        ("/a/b/other/COPYING", "Licensed under CC BY 4.0."),
        ("/a/b/other/LICENSE", "Licensed under CC BY-SA 4.0."),
        ("/a/b/other/w.py", None),
        (None, "Released under the MIT License."),
        (None, LONG),
        ("/a/v.py", "the general public of the world, under terms of this file"),
        ("/a/v.py", ""),
    ]
    got = by_id(licenses.scanned(files(spark, rows)))
    found = [(got[i]["licence"], got[i]["how"], got[i]["origin"]) for i in range(len(rows))]
    assert found == [
        ("MIT", "own", None),
        ("MIT", "inherited", ""),
        ("GPL-3.0", "own", None),
        ("GPL-3.0", "inherited", "/a/b"),
        ("Apache-2.0", "own", None),
        ("CC-BY-4.0", "own", None),
        ("CC-BY-SA-4.0", "own", None),
        ("CC-BY-4.0", "inherited", "/a/b/other"),
        ("MIT", "own", None),
        (None, "none", None),
        ("MIT", "inherited", ""),
        ("MIT", "inherited", ""),
    ]
    assert licenses.scanned(files(spark, rows).limit(0)).count() == 0


def cosine(scorer, words, template):
    """Of two bags of words, by the definition."""
    def weights(bag):
        known = {t: k * scorer.idf[t] for t, k in Counter(t for t in bag if t in licenses.VOCABULARY).items()}
        return known | {(i, t): scorer.rest for i, t in enumerate(bag) if t not in licenses.VOCABULARY}

    a, b = weights(words), weights(template)
    dot = sum(w * b.get(t, 0) for t, w in a.items())
    return dot / math.sqrt(sum(w * w for w in a.values()) * sum(w * w for w in b.values()))


def test_scores_are_the_best_cosines_of_all_stretches():
    """Against every stretch of every template's length, in texts of template words and others."""
    scorer = licenses.Scorer({licenses.LINES: 1000, "license": 3, "the": 400, "of": 300})
    random_ = random.Random(7)
    known = sorted(licenses.VOCABULARY)
    for _ in range(25):
        licence, text = random_.choice([t for t in licenses.TEMPLATES if len(t[1]) < 400])
        words = licenses.terms(text)
        for _ in range(random_.randrange(4)):
            words[random_.randrange(len(words))] = random_.choice([*known, "other", "house"])
        words = random_.choices(known + ["other"] * 50, k=20) + words + random_.choices(known, k=20)
        marked = [i for i, w in enumerate(words) if w in licenses.MARKS]
        found = []
        for name, template in licenses.TEMPLATES:
            bag = licenses.terms(template)
            spans = [range(i, min(i + len(bag), len(words))) for i in range(max(1, len(words) - len(bag) + 1))]
            found += [(round(cosine(scorer, [words[k] for k in span], bag), 6), name) for span in spans if any(i in span for i in marked)]
        score, best = scorer.best(" ".join(words))
        assert score >= max(found)[0] - 1e-6
    for licence, text in licenses.TEMPLATES:
        assert scorer.best(text)[0] == 1.0
    assert scorer.best("") == (0.0, "") and scorer.best("the the the house") == (0.0, "")


GPL_HEADER = """#!/usr/bin/env python
# tool.py - does something useful
# Copyright (C) 2011 Jane Doe <jane@example.org>
#
# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
#
# This program is distributed in the hope that it will be useful,
# but WITHOUT ANY WARRANTY; without even the implied warranty of
# MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
# GNU General Public License for more details.
import sys
"""
MPL_HEADER = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at https://mozilla.org/MPL/2.0/. */
int main() { return 0; }"""
APACHE_TITLE = """                                 Apache License
                           Version 2.0, January 2004
                        http://www.apache.org/licenses/

   TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"""


@pytest.mark.parametrize(
    ("text", "licence"),
    [
        (GPL_HEADER, "GPL-3.0"),
        (GPL_HEADER.replace("version 3", "version 2"), "GPL-2.0"),
        (MPL_HEADER, "MPL-2.0"),
        (APACHE_TITLE, "Apache-2.0"),
        ("Copyright (c) 2019 Acme Corp. Released under the MIT License. All rights reserved.", "MIT"),
        ("Copyright (c) 2020, Someone\nAll rights reserved.\n\n" + licenses.BSD_GRANT + "\n\n" + licenses.BSD_AS_IS + "\nIN NO EVENT SHALL", "BSD-2-Clause"),
        (licenses.BSD_GRANT + "\n" + licenses.BSD_NAMES + "\n" + licenses.BSD_AS_IS, "BSD-3-Clause"),
        ("MIT License\n\nCopyright (c) 2021 A B\n\n" + licenses.MIT_GRANT + "\n\n" + licenses.AS_IS, "MIT"),
        ("// SPDX-License-Identifier: GPL-2.0-only\nint x;", "GPL-2.0"),
        ("// SPDX-License-Identifier: BSD-3-Clause\nint x;", "BSD-3-Clause"),
        ("The driver showed a license issued in 2004, but the general public knew of no such version.", None),
        ("He asked permission to use the copy of the file under the terms that were provided.", None),
        ("A license is a permission; software is sold under many, and no two of them agree.", None),
    ],
)
def test_wordings_of_headers_and_licence_files(text, licence):
    counts = {licenses.LINES: 200_000, "the": 60_000, "of": 50_000, "and": 50_000, "to": 40_000, "in": 40_000, "is": 20_000, "for": 20_000}
    scorer = licenses.Scorer(counts, licenses.THRESHOLD)
    prose_ = "many words of some other text about the house and its garden in the rain " * 10
    for whole in (text, prose_ + "\n" + text + "\n" + prose_):
        score, found = scorer.best(whole)
        assert (found if score >= licenses.THRESHOLD else None) == licence, score


def test_a_long_text_of_marks_takes_its_length():
    scorer = licenses.Scorer({licenses.LINES: 10}, licenses.THRESHOLD)
    started = time.perf_counter()
    assert scorer.best("license permission " * 30_000)[0] < licenses.THRESHOLD
    assert time.perf_counter() - started < 20


def test_inheritance_matches_plain_walks(spark):
    """Random trees of directories with licence files, against walking up from every file."""
    random_ = random.Random(3)
    notices = [t for t in licenses.TEMPLATES if len(t[1]) < 90][:8]
    rows = []
    for i in range(150):
        folder_ = "".join(f"/{random_.choice('abc')}" for _ in range(random_.randrange(5)))
        kind = random_.random()
        text = random_.choice(notices)[1] if kind < 0.3 else LONG + random_.choice(notices)[1] if kind < 0.4 else LONG
        rows.append((f"{folder_}/{random_.choice(['LICENSE', 'x.py', f'f{i}.c'])}", text))
    got = by_id(licenses.scanned(files(spark, rows)))
    own = {i: (got[i]["licence"], got[i]["score"]) for i in got if got[i]["how"] == "own"}
    speaks = {}
    for i, (path, text) in enumerate(rows):
        if i in own and (path.endswith("/LICENSE") or len(text.split()) <= licenses.SHORT):
            speaks.setdefault(path.rpartition("/")[0], []).append((-own[i][1], path, own[i][0]))
    for i, (path, _) in enumerate(rows):
        if i in own:
            continue
        folder_ = path.rpartition("/")[0]
        while folder_ not in speaks and folder_:
            folder_ = folder_.rpartition("/")[0]
        expected = (min(speaks[folder_])[2], "inherited", folder_) if folder_ in speaks else (None, "none", None)
        assert (got[i]["licence"], got[i]["how"], got[i]["origin"]) == expected


def calls_of(spark, rows):
    schema = "conv_id long, position long, call_id string, name string, arguments string, needs array<string>"
    return spark.createDataFrame(rows, schema)


def results_of(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, position long, call_id string, content string")


SCHEMAS = {"add": {"properties": {"a": "number", "b": "integer", "tags": "array"}, "required": ["a"]}}


def test_calls_are_linked_ordered_and_checked(spark):
    calls = calls_of(
        spark,
        [
            (1, 0, "x", "add", '{"b": 2, "a": 1.5}', ["y"]),
            (1, 1, "y", "add", '{"a": true}', []),
            (1, 2, "z", "add", '{"b": 2.5, "c": "é"}', ["x", "gone", "x"]),
            (1, 3, "p", "add", '{"a": 1}', ["q"]),
            (1, 4, "q", "add", '{"a": 1}', ["p"]),
            (2, 0, "x", "add", "[1]", None),
            (2, 0, "x", "add", "[2]", None),
            (2, 5, "x", "add", "[0]", None),
            (2, 1, "w", "sub", None, []),
            (2, 2, "v", "add", "{broken", []),
            (None, 0, "x", "add", '{"a": 0}', []),
        ],
    )
    results = results_of(spark, [(1, 9, "x", "three"), (1, 8, "x", "two"), (1, 9, "nobody", "lost"), (2, 1, "y", None), (None, 1, "x", "n")])
    rows = toolcalls.linked(calls, results, SCHEMAS).collect()
    got = {(r["conv_id"], r["call_id"], r["kind"]): r for r in rows}
    assert len(rows) == len(got) == 12
    order = sorted((r["level"] is None, r["level"], r["position"], r["call_id"]) for r in rows if r["conv_id"] == 1 and r["level"] is not None and r["kind"] == "call")
    assert [x[3] for x in order] == ["y", "x", "z"]
    assert got[1, "p", "call"]["level"] is None and got[1, "p", "call"]["errors"] == ["circular"]
    assert got[1, "x", "call"]["json"] == '{"arguments":{"a":1.5,"b":2},"id":"x","name":"add","result":"two"}'
    assert got[1, "x", "call"]["valid"] and got[1, "y", "call"]["errors"] == ["a is no number"]
    assert got[1, "z", "call"]["errors"] == ["missing a", "b is no integer", "unknown c", "needs gone"]
    assert '"c":"é"' in got[1, "z", "call"]["json"]
    assert got[1, "nobody", "orphan"]["json"] == '{"id":"nobody","result":"lost"}'
    assert got[2, "x", "call"]["errors"] == ["arguments are no object"] and "[1]" in got[2, "x", "call"]["json"]
    assert got[2, "w", "call"]["errors"] == ["unknown tool"]
    assert got[2, "v", "call"]["errors"] == ["arguments are no JSON"]
    assert got[2, "y", "orphan"]["errors"] == ["result without call"]
    assert got[None, "x", "call"]["json"].endswith('"result":null}')
    assert toolcalls.linked(calls.limit(0), results.limit(0), SCHEMAS).count() == 0


def plain_links(turns):
    """(conv, call) -> level, errors, arguments, result of dialogues as tool use, by plain loops."""
    out = {}
    for conv in {t[0] for t in turns}:
        calls, answers = {}, {}
        own = sorted(t[1:] for t in turns if t[0] == conv)
        for turn, role, text in own:
            if role == "assistant":
                answers[f"turn-{turn - 1}"] = text
                continue
            body, kind, size = text or "", zlib.crc32((text or "").encode()) % 4, len(text or "") % 7
            needs, arguments = [], {} if text is None else {"instruction": text}
            if role == "user":
                before = [f"turn-{turn - 2}"] if turn >= 2 else []
                needs = [before, [f"turn-{turn + 2}"], before + (["turn-0"] if turn else []), []][kind]
                arguments = ({} if text is None else {"question": body}) | {"turn": turn if size else str(turn)} | ({"note": "more"} if size == 1 else {})
            calls[f"turn-{turn}"] = (turn, {"user": "ask", "system": "instruct"}.get(role, role), arguments, set(needs))
        level, todo = {}, dict(calls)
        while True:
            ready = [c for c, x in todo.items() if all(n in level or n not in calls for n in x[3])]
            if not ready:
                break
            for c in ready:
                level[c] = max([level[n] + 1 for n in todo[c][3] if n in calls], default=0)
                del todo[c]
        late = any(calls[n][0] >= x[0] for x in calls.values() for n in x[3] if n in calls)
        for c, (_, name, arguments, needs) in calls.items():
            errors = toolcalls.problems(arguments, toolcalls.DIALOGUE.get(name)) + [f"needs {n}" for n in sorted(needs - set(calls))]
            own_level = level.get(c) if late else 0
            out[conv, c] = (own_level, errors + ["circular"] * (own_level is None), arguments, answers.get(c))
        for c in set(answers) - set(calls):
            out[conv, c] = (0, ["result without call"], None, answers[c])
    return out


@pytest.mark.parametrize("group", [100_000, 6])
def test_dialogues_match_plain_loops(spark, monkeypatch, group):
    """With conversations as groups, and with those of some calls in rounds."""
    monkeypatch.setattr(toolcalls, "GROUP", group)
    given = spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text")
    turns = [tuple(r) for r in given.collect()]
    turns += [(10**6, 0, "system", "be good"), (10**6, 1, "user", "é?"), (10**6, 2, "assistant", "yes"), (10**6, 3, "user", None)]
    turns += [(10**6 + 1, 4, "assistant", "alone"), (10**6 + 2, 0, None, "x"), (10**6 + 2, 1, "tool", "y")]
    frame_ = spark.createDataFrame(turns, given.schema)
    rows = toolcalls.linked(*toolcalls.from_dialogues(frame_), toolcalls.DIALOGUE).collect()
    got = {}
    for r in rows:
        body = json.loads(r["json"])
        assert r["json"] == toolcalls.canonical(body) and r["valid"] == (not r["errors"])
        got[r["conv_id"], r["call_id"]] = (r["level"], r["errors"], body.get("arguments"), body["result"])
    assert len(got) == len(rows) and got == plain_links(turns)
    found = {e.split()[0] for r in rows for e in r["errors"]}
    assert {"circular", "missing", "needs", "unknown", "turn"} <= found and max(r["level"] or 0 for r in rows) > 1


def test_a_long_chain_out_of_order(spark):
    calls = calls_of(spark, [(1, i, f"c{i}", "add", '{"a": 1}', [f"c{i + 1}"] if i < 999 else []) for i in range(1000)])
    rows = toolcalls.linked(calls, results_of(spark, []), SCHEMAS).collect()
    assert sorted(r["level"] for r in rows) == list(range(1000)) and {(999 - r["position"]) == r["level"] for r in rows} == {True}


def test_counted_handles_no_tokens():
    none = np.zeros(0, np.int64)
    n, crossing = tokencounts.counted(none, none, np.array([0]), np.array([3]), "share")
    assert n.tolist() == [0] and crossing.tolist() == [0]
