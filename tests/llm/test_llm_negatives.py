"""Hard negatives against a plain search, and against their SQL."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from oracle_check import connect, differences

from pairloom.llm import hard_negatives as hn
from pairloom.llm import queries

SF_DIR = "/root/testdata/sf0.001"


def plain_mined(rows):
    good = {}
    for vec_id, label, v in rows:
        if vec_id is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = int(math.fmod(label + 1, 10)) if vec_id % 7 == 0 else label
        good[(vec_id, label, tuple(math.floor(256 * x) for x in v))] = None
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for vec_id, label, v in good:
        if vec_id % 100:
            continue
        others = sorted((-dot(v, w), i, m) for i, m, w in good if i != vec_id)
        for s, p, _ in [o for o in others if o[2] == label][:5]:
            fits = [(t, n) for t, n, m in others if m != label and 80 * -s <= 100 * -t <= 100 * -s][:5]
            out += [(vec_id, p, r, n, -s, -t) for r, (t, n) in enumerate(fits, 1)]
    return sorted(out)


def frame_of(spark, rows):
    wide = [(*r, "clash", 1.5, [1]) for r in rows]
    return spark.createDataFrame(wide, "vec_id long, label int, embedding array<double>, rank string, score double, v array<int>").repartition(3)


def found(spark, rows):
    return sorted(map(tuple, hn.mined(frame_of(spark, rows)).collect()))


def random_rows(seed, n, size, labels):
    rng = random.Random(seed)
    rows = [(i * 5, rng.randrange(labels), [round(rng.gauss(0.1, 0.4), 2) for _ in range(size)]) for i in range(n)]
    rows += rows[:20]  # repeated rows
    rows += [(1, None, [0.1] * size), (2, 1, None), (3, 1, [None] * size), (4, 1, [math.nan] * size), (6, 1, [math.inf] * size),
             (None, 1, [0.2] * size), (8, 1, []), (9, 2, [0.5]), (-100, 0, [0.4] * size)]
    rows += [(10_000 + i, i % 3, [0.25] * size) for i in range(150)]  # copies of one vector
    return rows


@pytest.mark.parametrize("seed,n,size,labels", [(1, 300, 3, 2), (2, 400, 8, 10), (3, 60, 1, 3)])
def test_random_vectors(spark, monkeypatch, seed, n, size, labels):
    monkeypatch.setattr(hn, "TREE_ROWS", 64)
    monkeypatch.setattr(hn, "BLOCK", 7)
    rows = random_rows(seed, n, size, labels)
    assert found(spark, rows) == plain_mined(rows)


def test_very_large_components(spark):
    rows = [(i * 25, i % 2, [(-1) ** i * 3e9 + i * 1e7, 1e10 / (i + 1)]) for i in range(30)]
    want = plain_mined(rows)
    cut = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
    assert [r[:4] for r in found(spark, rows)] == [r[:4] for r in want]
    assert found(spark, rows) == [(*r[:4], cut(r[4]), cut(r[5])) for r in want]


def test_empty_table(spark):
    assert hn.mined(frame_of(spark, [(1, 1, [0.5])]).filter("vec_id = 2")).count() == 0
    assert found(spark, [(100, 1, [0.5])]) == []


def test_boxes_hold_their_rows():
    rng = np.random.default_rng(1)
    x = rng.integers(-50, 50, (3000, 6)).astype(float)
    tree = hn.Tree(np.arange(3000), np.zeros(3000), x, [2, 0, 1])
    anchor = rng.integers(-9, 9, 6).astype(float)
    scores = tree.x @ anchor
    for level in range(len(tree.levels)):
        width = hn.LEAF_ROWS * hn.FANOUT**level
        least, most = tree.bounds(level, slice(0, None), np.maximum(anchor, 0), np.minimum(anchor, 0))
        for i, (a, b) in enumerate(zip(least, most)):
            part = scores[i * width : (i + 1) * width]
            assert a <= part.min() and part.max() <= b
    assert len(tree.levels[-1][0]) == 1


def test_search_prunes_boxes(monkeypatch):
    """On rows that lie in tiles, most leaves are never scored."""
    rng = np.random.default_rng(2)
    x = np.round(rng.uniform(-100, 100, (20_000, 2)))
    tree = hn.Tree(np.arange(20_000), np.zeros(20_000), x, [0, 1])
    offered = []
    best = hn.Best(-1, 0, True, 5)
    monkeypatch.setattr(best, "offer", lambda *a, own=best.offer: (offered.append(1), own(*a)))
    anchor = np.array([3.0, -2.0])
    tree.search(anchor, [best])
    want = sorted(zip((-(tree.x @ anchor)).tolist(), tree.ids.tolist()))[:5]
    assert best.rows == want and len(offered) < len(tree.levels[0][0]) / 10


def test_query_and_sql(spark):
    assert differences(queries.op11_hard_negative_mining(spark, SF_DIR), connect(SF_DIR), hn.ORACLE_SQL) == []
