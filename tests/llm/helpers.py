"""Frames and plain versions for the tests."""

from __future__ import annotations

import re

from clickmeter.llm.common import prepare

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, texts, ids=None):
    """Documents of the texts, numbered from 0."""
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in zip(ids, texts, strict=True)]
    return prepare(spark).createDataFrame(rows, DOCS)


def by_id(result, key="doc_id"):
    return {row[key]: row for row in result.collect()}


def prose(random, n):
    """n words that repeat little."""
    parts = ("ba", "do", "ke", "li", "mu", "no", "pa", "ri", "su", "te", "vo", "xi")
    return ["".join(random.choice(parts) for _ in range(random.randint(1, 4))) for _ in range(n)]
