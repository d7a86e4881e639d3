"""The pipeline, stage by stage, against plain versions; and the registered queries."""

import hashlib
import random

import corpus_pipeline
import pytest
import sentencepiece
from conftest import FOLDER
from helpers import frame, prose
from test_near import expected_classes
from test_texts import items, stripped
from test_tokens import MODEL

from __spark_entry__ import oracle_sql, queries
from clickmeter.llm.decontaminate import normalised
from clickmeter.llm.queries import QUERIES


def test_every_operator_is_registered():
    names = [n for n in queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in queries() and set(QUERIES) <= set(queries())
    assert "op1_quality_rules" in oracle_sql() and "pipeline" not in oracle_sql()


@pytest.fixture
def corpus(spark, tmp_path):
    random_ = random.Random(12)
    leak = " ".join(prose(random_, 30)) + "."
    shared = "\n".join(" ".join(prose(random_, 9)) + "." for _ in range(14))

    def text(n=150):
        words = prose(random_, n)
        return "\n".join(" ".join(words[i : i + 12]).capitalize() + "." for i in range(0, n, 12))

    clean = [text() for _ in range(40)]
    near = clean[3].split(" ")
    near[20] = "other"
    texts = clean + ["word " * 200, None, "", "# $ % " * 100, " ".join(near), "Much " + clean[5], text() + " " + leak + " " + text()]
    texts += [text(60) + "\n" + shared + "\n" + text(60) for _ in range(3)]
    frame(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    items(spark, [leak]).write.parquet(str(tmp_path / "benchmark.parquet"))
    return texts, leak, str(tmp_path)


def test_stages_match_plain_versions(spark, corpus):
    texts, leak, folder = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        stage(spark, docs, folder).write.parquet(f"{folder}/stage-{number}")
        docs = spark.read.parquet(f"{folder}/stage-{number}")
        assert docs.columns == list(corpus_pipeline.COLUMNS)
        assert docs.where("n_chars <> char_length(text)").count() == 0
        kept[number] = (before, {r["doc_id"]: r["text"] for r in docs.collect()})

    before, after = kept[0]
    assert set(after) == set(range(len(texts))) - {40, 41, 42, 43}
    before, after = kept[1]
    ids = sorted(before)
    expected = dict(zip(ids, stripped([before[i] for i in ids]), strict=True))
    assert after == {i: t for i, t in expected.items() if t.strip() and 5 * len(t) >= len(before[i])}
    assert after != before
    before, after = kept[2]
    ids = sorted(before)
    assert set(after) == {i for k, i in enumerate(ids) if expected_classes([before[i] for i in ids])[k] == k}
    before, after = kept[3]
    assert set(after) == {i for i, t in before.items() if normalised(leak) not in normalised(t)}
    assert set(before) - set(after) == {46}

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert {r["doc_id"]: (r["ids"], r["decoded_sha256"]) for r in rows} == {
        i: (library.encode(t, add_eos=True), hashlib.sha256(t.encode()).hexdigest()) for i, t in after.items()
    }
    assert all(r["n_tokens"] == len(r["ids"]) for r in rows)


def test_run_gives_the_rows_of_the_stages(spark, corpus):
    _, _, folder = corpus
    rows = corpus_pipeline.run(spark, folder).collect()
    assert len(rows) == len({r["doc_id"] for r in rows}) > 30


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_run_over_whole_tables(spark, name):
    frame_ = queries()[name](spark, FOLDER)
    rows = frame_.collect()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    one_each = {"op1", "op3", "op4", "op6", "op7", "op8", "op9"}
    if name.split("_")[0] in one_each:
        assert sorted(r["doc_id"] for r in rows) == list(range(docs))
    assert rows


def test_empty_tables_pass_through_every_stage(spark, corpus):
    _, _, folder = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0
