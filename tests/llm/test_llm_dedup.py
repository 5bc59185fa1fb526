"""Substring dedup, SimHash groups and components against plain versions."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import plain
import pyarrow as pa
import pytest
from conftest import ODD, ordered
from pyspark.sql import functions as F

from pairloom.llm import passages, simhash
from pairloom.llm.components import components
from pairloom.llm.words import utf8

OUT = ["doc_id", "n_words", "n_removed", "kept_sha256"]


def removed(frame, rows, window, gram):
    return ordered(passages.without_repeats(frame(rows), window, gram).select(*OUT).collect())


@pytest.mark.parametrize("seed,hot", [(1, 100), (2, 3), (3, 1)])
def test_random_texts(frame, monkeypatch, seed, hot):
    monkeypatch.setattr(passages, "HOT_SEGMENTS", hot)
    rng = random.Random(seed)
    words = ["a", "b", "c", "dé", "e\x1cf"][: 1 + seed]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 40)))) for i in range(60)]
    rows += [(3, rows[3][1])] * 3 + [(None, rows[5][1]), (901, "x " * 60)]
    assert removed(frame, rows, 7, 3) == ordered(plain.kept_words(rows, 7))


def test_odd_rows(frame):
    assert removed(frame, ODD, 35, 9) == ordered(plain.kept_words(ODD, 35))


def test_small_shards(frame, monkeypatch):
    monkeypatch.setattr(passages, "SHARD_CHARS", 50)
    monkeypatch.setattr(passages, "BUCKET_CHARS", 300)
    rng = random.Random(5)
    parts = [" ".join(f"p{k}w{i}" for i in range(12)) for k in range(6)]
    rows = [(i, " ".join(rng.choice(parts) for _ in range(4)) + f" own{i}") for i in range(30)]
    assert removed(frame, rows, 7, 3) == ordered(plain.kept_words(rows, 7))


def test_long_passage_in_many_documents(frame):
    passage = " ".join(f"shared{i}" for i in range(60))
    rows = [(i, f"start{i} of{i} {passage} end{i}") for i in range(40)] + [(100, "nothing of it " * 3)]
    out = {r[0]: r[2] for r in removed(frame, rows, 35, 9)}
    assert out == {**{i: 60 for i in range(40)}, 100: 0}


def licence_rows():
    passage = " ".join(f"licence{i}" for i in range(24))
    long = " ".join(f"notice{i}" for i in range(36))
    around = lambda i, side: " ".join(f"{side}{i}x{j}" for j in range(40))
    rows = [(i, f"{around(i, 'a')} {passage} {around(i, 'b')}") for i in range(80)]
    rows += [(200 + i, f"{around(i, 'd')} {long} {around(i, 'e')}") for i in range(80)]
    return rows + [(100, f"{around(100, 'c')} {passage}")] * 2


def test_hot_anchors_are_counted_by_window(frame, monkeypatch):
    monkeypatch.setattr(passages, "HOT_SEGMENTS", 10)
    rows = licence_rows()
    assert removed(frame, rows, 35, 9) == ordered(plain.kept_words(rows, 35))


def test_automaton_finds_the_other_occurrences(frame, monkeypatch):
    """Without it, at most the copy that was compiled could be covered."""

    class Blind:
        def __init__(self, *kind):
            pass

        add_word = make_automaton = get = lambda self, *key: None
        iter = lambda self, text: ()

    passage = " ".join(f"shared{i}" for i in range(60))
    texts = pa.array([f"start{i} of{i} {passage} end{i}" for i in range(4)])
    words = passages.split(*utf8(texts))
    owner, anchor, digest, *_ = passages.segments_of(words, 35, 9)
    counts = Counter(zip(anchor.tolist(), digest.tolist()))
    wanted = [(a, d, None) for (a, d), n in counts.items() if n > 1]
    wanted = pa.table([pa.array(c) for c in zip(*wanted)], names=["anchor", "digest", "windows"])
    _, gone = passages.covered(texts, wanted, 35, 9)
    per_text = np.add.reduceat(gone.astype(int), words.first[:-1])
    assert len(set(per_text.tolist())) == 1 and per_text[0] >= 35
    monkeypatch.setattr(passages.ahocorasick, "Automaton", Blind)
    assert not passages.covered(texts, wanted, 35, 9)[1].any()


def test_unlike_windows_with_one_hash_stay_apart(monkeypatch):
    class Alike(passages.Runs):
        def hashes(self, a, b):
            return np.zeros(len(a), dtype=np.uint64)

    monkeypatch.setattr(passages, "Runs", Alike)
    texts = pa.array(["a b c d", "b c d e", "x y z"])
    assert passages.repeated_windows(texts, np.array([1, 1, 1]), 3) == [[1, 2], [0, 1], []]
    assert passages.repeated_windows(texts, np.array([1, 1, 2]), 3) == [[1, 2], [0, 1], [0, 1]]


def test_empty_tables(frame, spark):
    none = frame([(1, "x")]).filter("doc_id < 0")
    assert passages.without_repeats(none).count() == 0
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.one_of_each(none).count() == 0
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def grouped(df):
    rows = simhash.near_duplicates(df)
    return ordered(rows.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0"), "component_id").collect())


def test_simhash_groups(frame):
    rng = random.Random(4)
    base = [f"w{rng.randint(0, 500)}" for _ in range(300)]
    rows = list(ODD)
    for i in range(60):
        words = list(base)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = f"v{rng.randint(0, 50)}"
        rows.append((100 + i, " ".join(words).upper() if i % 3 else " ".join(words)))
    want = plain.near_groups(rows)
    assert grouped(frame(rows)) == ordered(want)
    assert len({c for _, _, c in want if c is not None and c >= 100}) < 30  # there are links


def test_links_at_the_bound(spark):
    rng = random.Random(9)
    values = []
    for _ in range(40):
        v = rng.getrandbits(64)
        values.append(v)
        for d in (1, 2, 3, 4):
            w = v
            for b in rng.sample(range(64), d):
                w ^= 1 << b
            values.append(w)
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    values = sorted({*values, 0, 7, (1 << 64) - 1})
    fps = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    got = {frozenset((r.a, r.b)) for r in simhash.links(fps).collect()}
    want = {
        frozenset((signed(a), signed(b))) for i, a in enumerate(values) for b in values[i + 1 :] if (a ^ b).bit_count() <= 3
    }
    assert got == want


def test_exploded_halves_are_never_broadcast(spark, tmp_path):
    """Spark sizes them as if each row stayed one row, so it would send them however many they are."""
    spark.range(1, 2_000).selectExpr("id AS fp").write.parquet(f"{tmp_path}/fps")
    found = simhash.links(spark.read.parquet(f"{tmp_path}/fps"))
    pairs = {frozenset(r) for r in found.collect()}
    assert len(pairs) == sum((a ^ b).bit_count() <= 3 for a in range(1, 2_000) for b in range(1, a))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_one_of_each_group_stays(frame):
    rows = [(5, "one two three four"), (4, "ONE two three four"), (4, "ONE two three four"), (9, "something else entirely"),
            (None, "one two three four"), (None, "only without id"), (7, None), (8, "")]
    df = frame(rows)
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns
    assert ordered(kept.select("doc_id", "text").collect()) == ordered(
        [(4, "ONE two three four"), (9, "something else entirely"), (None, "only without id"), (7, None)]
    )


def test_one_of_each_equals_plain_groups(frame):
    rng = random.Random(6)
    base = [f"w{rng.randint(0, 3_000)}" for _ in range(400)]
    odd = [r for r in ODD if r != (8, "beta")]  # else two groups have one least id
    rows = [*odd, *[(100 + i, " ".join(rng.choice(base) for _ in range(50))) for i in range(40)]]
    for i in range(60):
        words = list(base)
        words[rng.randrange(400)] = f"v{i % 9}"
        rows.append((200 + i, " ".join(words)))
    groups: dict = {}
    for (doc_id, _), (_, _, root) in zip(rows, plain.near_groups(rows)):
        if doc_id is not None:
            groups.setdefault(root, set()).add(doc_id)
    kept = [r.doc_id for r in simhash.one_of_each(frame(rows)).collect()]
    assert sorted(kept) == sorted(min(g) for g in groups.values())
    assert len(kept) < len({d for d, _ in rows}) - 20


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(0, 120)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5), (1, 0)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(121)}, **{1000 + i: 1000 for i in range(200)}}
