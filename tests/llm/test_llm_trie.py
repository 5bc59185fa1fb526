"""The prefix trie against a plain one, and against its SQL."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from conftest import ordered
from oracle_check import connect, differences

from pairloom.llm import prefix_trie, queries

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain_trie(rows):
    own: dict = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    members: dict = {}
    ends: dict = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        path = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
        ends.setdefault(path, []).append(c)
    out = []
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below if not any(len(m) > len(n) and m[: len(n)] == n for m in below)]
        saved = sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n)
        ids = ",".join(map(str, sorted(ends.get(node, []))))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(convs), len(node), parent, len(convs), len(children), len(leaves), saved,
                    hashlib.sha256(ids.encode()).hexdigest()))
    return out


def frame_of(spark, rows):
    wide = [(*r, "clash", 1.5, [1]) for r in rows]
    names = "conv_id long, turn long, role string, text string, d string, n_convs double, up array<int>"
    return spark.createDataFrame(wide, names).repartition(3)


def random_rows(seed, longest):
    rng = random.Random(seed)
    rows = []
    for c in [*range(0, 30), *range(100, 112), *range(305, 318), -3, -100, -107, 700]:
        for turn in range(rng.randint(1, longest)):
            text = rng.choice(["a", "b", "é中\U0001F600", "", None]) if turn < 6 else rng.choice("xy") * turn
            rows.append((c, rng.choice([turn, turn, None]), rng.choice(["user", None, ""]), text))
    rows += rows[:5] + [(None, 1, "user", "lost"), (None, None, None, None)]
    return rows


@pytest.mark.parametrize("seed,longest,height", [(1, 7, 8), (2, 20, 3), (3, 9, 1), (4, 5, 2)])
def test_random_conversations(spark, seed, longest, height):
    rows = random_rows(seed, longest)
    found = prefix_trie.trie(frame_of(spark, rows), height)
    assert found.columns == COLUMNS
    assert ordered(found.collect()) == ordered(plain_trie(rows))


def test_ties_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK_IDS", 2)
    rows = [(c, 1, "user", "z" * 50_000) for c in range(1000, 1040)] + [(c, 1, "user", "a") for c in range(1000, 1040)]
    assert ordered(prefix_trie.trie(frame_of(spark, rows)).collect()) == ordered(plain_trie(rows))


def test_conversations_without_turns(spark):
    rows = [(c, 0, "user", "only one") for c in range(1, 60)]  # their family's first one is absent
    found = plain_trie(rows)
    assert ordered(prefix_trie.trie(frame_of(spark, rows)).collect()) == ordered(found)
    assert found[0][7] != hashlib.sha256().hexdigest()


def test_empty_table(spark):
    assert prefix_trie.trie(frame_of(spark, [(1, 1, "a", "b")]).filter("conv_id = 2")).count() == 0


def test_query_and_sql(spark):
    con = connect(SF_DIR)
    found = queries.op12_conversation_prefix_trie(spark, SF_DIR)
    assert differences(found, con, prefix_trie.ORACLE_SQL) == []
