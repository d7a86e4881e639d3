"""The trie of conversation prefixes against plain loops."""

import hashlib
import random
import re
import zlib

import duckdb
import pytest
from conftest import FOLDER
from helpers import WORD

from __spark_entry__ import oracle_sql, queries
from clickmeter.llm import prefixtrie
from clickmeter.llm.common import prepare

TURNS = "conv_id long, turn long, role string, text string"


def plain(rows):
    """Rows are (conv_id, turn, role, text) with no equal turns in a conversation."""
    own = {}
    for conv, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own.setdefault(conv, []).append((role or "", text or ""))
    rebuilt = {}
    for conv in own:
        h = zlib.crc32(str(conv).encode()) % 4
        rebuilt[conv] = tuple(own.get(conv - conv % 20, [])[:h] + own[conv][h:])
    members = {}
    for conv, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(conv)
    children = {}
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)
    saved, leaves = {}, {}
    for path in sorted(members, key=len, reverse=True):
        below = children.get(path, [])
        words = len(re.findall(WORD, path[-1][1])) if path else 0
        saved[path] = (len(members[path]) - 1) * words + sum(saved[p] for p in below)
        leaves[path] = sum(leaves[p] for p in below) if below else 1
    return sorted(
        (
            min(convs),
            len(path),
            min(members[path[:-1]]) if path else -1,
            len(convs),
            len(children.get(path, [])),
            leaves[path],
            saved[path],
            hashlib.sha256(",".join(str(c) for c in sorted(convs) if len(rebuilt[c]) == len(path)).encode()).hexdigest(),
        )
        for path, convs in members.items()
    )


def got(frame):
    out = prefixtrie.nodes(frame).collect()
    return sorted((r[0], r[1], -1 if r[2] is None else r[2], *tuple(r)[3:]) for r in out)


def dialogues(random_, n):
    """Few different turns, so that prefixes are shared; some conversations are long, some ids missing."""
    rows = []
    for conv in random_.sample(range(2 * n), n):
        for turn in range(random_.choice([1, 2, 3, 3, 4, 8, 40])):
            role = random_.choice(["user", "user", None])
            rows.append((conv, turn if turn else None, role, random_.choice(["one two", "one two", "one", "", None, " x\ty\n z"])))
    return rows


@pytest.mark.parametrize(("shard", "bits"), [(1 << 17, 2048), (37, 8), (5, 2)])
def test_nodes_match_plain_loops(spark, monkeypatch, shard, bits):
    """In one shard and in many that cut conversations."""
    monkeypatch.setattr(prefixtrie, "SHARD_ROWS", shard)
    monkeypatch.setattr(prefixtrie, "BITS", bits)
    rows = dialogues(random.Random(4), 60)
    assert got(prepare(spark).createDataFrame(rows, TURNS)) == plain(rows)


def test_one_conversation_over_many_shards_with_a_copy(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "SHARD_ROWS", 50)
    rows = [(c, t, "user", f"turn {t % 7}") for c in (3, 5) for t in range(300)] + [(5, 300, "user", "more"), (40, 0, "user", "a"), (41, 0, "x", "b")]
    assert got(prepare(spark).createDataFrame(rows, TURNS)) == plain(rows)


def test_many_equal_conversations_and_turnless_ones(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "BITS", 16)
    rows = [(c, t, "user", "same words") for c in range(200) for t in range(3)]
    rows += [(c, 0, "user", "lost") for c in range(221, 240)]  # their family's first is absent
    assert got(prepare(spark).createDataFrame(rows, TURNS)) == plain(rows)


def test_given_conversations(spark):
    frame = spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text")
    assert got(frame) == plain([tuple(r) for r in frame.collect()])


def test_odd_tables(spark):
    """No conversation, null ids, names that clash, negative ids, repeated rows, a long text."""
    empty = prepare(spark).createDataFrame([], TURNS)
    assert got(empty) == []
    assert got(spark.createDataFrame([(None, 1, "user", "x")], TURNS)) == []
    clash = spark.createDataFrame([(1, 1, "u", "x " * 200_000), (-3, 0, "u", "y")], TURNS).selectExpr("*", "1 as depth", "2 as shard", "3 as row")
    assert got(clash) == plain([(1, 1, "u", "x " * 200_000), (-3, 0, "u", "y")])
    twice = spark.createDataFrame([(20, 1, "u", "x")] * 40 + [(20, 1, "u", "y")] * 2, TURNS)
    assert len(got(twice)) == 43


def test_registered_query_matches_its_sql(spark):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW conversations AS SELECT * FROM '{FOLDER}/conversations.parquet'")
    result = connection.execute(oracle_sql()["op12_prefix_trie"])
    names = [c[0] for c in result.description]
    frame = queries()["op12_prefix_trie"](spark, FOLDER).select(*names)
    assert sorted((tuple(r) for r in frame.collect()), key=repr) == sorted(result.fetchall(), key=repr)
