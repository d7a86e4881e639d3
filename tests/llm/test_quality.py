import random
from collections import Counter
from pathlib import Path

import duckdb
import pytest
from conftest import FOLDER
from helpers import WORD, by_id, frame, prose

from clickmeter.llm import quality


def plain(text):
    """The counts of the base test."""
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = list(zip(words, words[1:], words[2:], strict=False))
    often = Counter(windows)
    covered = {k for i, w in enumerate(windows) if often[w] > 1 for k in (i, i + 1, i + 2)}
    n = len(words)
    return {
        "n_words": n,
        "word_chars": sum(map(len, words)),
        "n_symbols": sum((text or "").count(c) for c in "#*$%&|<>"),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "base_failed": n < 50 or 100 * len(covered) > 50 * n,
    }


CASES = [None, "", " \n\t", "a", "a b c a b c a b c", "a a a a a", "x\ny\nx\n\n\n", "é#|<>&  ü\x0b\x0cz", "l1\nl2\nl1 \nl2"]


def test_counts_of_odd_texts(spark):
    got = by_id(quality.verdicts(frame(spark, CASES)))
    for i, text in enumerate(CASES):
        expected = plain(text)
        assert {c: got[i][c] for c in expected} == expected
        assert not got[i]["kept"]


def test_counts_of_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = by_id(quality.verdicts(docs))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert set(got) == set(texts)
    for i, text in texts.items():
        expected = plain(text)
        assert {c: got[i][c] for c in expected} == expected
        assert not (got[i]["kept"] and got[i]["base_failed"])


def test_verdicts_agree_with_labels(spark):
    """No label is used to fit the rates; they are held against the verdicts afterwards."""
    folder = str(Path(FOLDER).parent / "sf0.01")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = quality.verdicts(spark.read.parquet(f"{folder}/documents.parquet")).join(labels, "doc_id").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1 and not r["base_failed"]]
    bad = [r["kept"] for r in rows if r["quality"] == 0 and not r["base_failed"]]
    assert sum(good) >= 0.98 * len(good)
    assert sum(bad) <= 0.05 * len(bad)


def test_kept_carries_all_columns_whatever_their_names(spark):
    random_ = random.Random(1)
    texts = [" ".join(prose(random_, 120)) + "." for _ in range(30)] + [None, "", "# " * 200, "a b c " * 80]
    docs = frame(spark, texts).selectExpr("*", "1 as votes", "2 as p_good", "3 as n_words", "4 as _text")
    kept = quality.kept(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert {r["doc_id"] for r in rows} == set(range(30))
    assert all(r["votes"] == 1 and r["p_good"] == 2 and r["n_words"] == 3 and r["_text"] == 4 for r in rows)


def test_repeated_rows_and_empty_table(spark):
    docs = frame(spark, ["a b", "a b"], ids=[7, 7])
    assert quality.verdicts(docs).count() == 2
    assert quality.verdicts(docs.limit(0)).count() == 0
    assert quality.kept(docs.limit(0)).count() == 0


@pytest.mark.parametrize("rounds", [0, 25])
def test_posteriors_are_probabilities(spark, rounds):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = quality.posteriors(quality.voted(quality.counted(docs)), rounds).collect()
    assert sum(r["n"] for r in rows) == docs.count()
    assert all(0 <= r["p_good"] <= 1 for r in rows)


def test_query_matches_sql(spark):
    from clickmeter.llm.oracle import ORACLE
    from clickmeter.llm.queries import QUERIES

    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    result = connection.execute(ORACLE["op1_quality_rules"])
    names = [c[0] for c in result.description]
    expected = sorted(result.fetchall())
    assert sorted(tuple(r) for r in QUERIES["op1_quality_rules"](spark, FOLDER).select(*names).collect()) == expected
