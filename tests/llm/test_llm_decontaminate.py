from __future__ import annotations

import random

import numpy as np
import plain
import pyarrow as pa
from conftest import LONG, ODD
from hypothesis import given, settings
from hypothesis import strategies as st

from pairloom.llm import decontaminate as d


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.lists(st.integers(0, 3), max_size=14))
def test_myers_is_the_edit_distance(passage, text):
    assert d.myers(passage, text)[0] == plain.edit_distance_within(passage, text)


def test_pieces_cover_a_passage():
    for n in range(8, 25):
        pieces = d.passages_of(1, np.arange(n, dtype=np.uint64))[0].pieces()
        assert [a for a, _ in pieces[1:]] == [b for _, b in pieces[:-1]] and pieces[-1][1] == n
        assert min(b - a for a, b in pieces) >= 4


def item(seed, n):
    rng = random.Random(seed)
    return [f"k{rng.randint(0, 10_000)}" for _ in range(n)]


def found(frame, docs, items):
    bench = frame([]).sparkSession.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id): r.distance for r in d.contaminated(frame(docs), bench).collect()}


def test_verbatim_edited_partial_and_clean(frame):
    a, b = item(1, 40), item(2, 15)
    edited = list(a)
    for i in (3, 11, 19, 27, 35):
        edited[i] = "other"
    inserted = b[:5] + ["more"] + b[5:]
    docs = [
        (1, "before " * 5 + " ".join(a) + " after" * 9),
        (2, " ".join(w.upper() + "!!" for w in b)),
        (3, "x, " + " -- ".join(edited)),
        (4, " ".join(inserted)),
        (5, "long " * 30 + " ".join(a[:30])),
        (6, " ".join(item(3, 200))),
        (7, " ".join(a[:10])),
        (8, " ".join(reversed(a))),
        (1, "a second row of the same id"),
        *[(100 + (x or 0), t) for x, t in ODD],
    ]
    items = [(10, " ".join(a)), (11, " ".join(b)), (11, " ".join(b)), (12, None), (13, ""), (14, "too short"), (None, " ".join(a))]
    assert found(frame, docs, items) == {(1, 10): 0, (2, 11): 0, (3, 10): 3, (4, 11): 1, (5, 10): 0}


def test_words_of_any_script():
    texts = ["Die «Häuser» – É_2,x…", "東京は、人工知能（ＡＩ）です。abc中", None, "ภาษา ไทย", "한국어 문장", "", "\U00020000𝔸b’s"]
    words = d.normal_words(pa.array(texts))
    got = [bytes(words.data[a:b]).decode() for a, b in zip(words.starts, words.ends)]
    parts = [got[a:b] for a, b in zip(words.first, words.first[1:])]
    assert parts == [["die", "häuser", "é", "2", "x"], [*"東京は人工知能", "ａｉ", "で", "す", "abc", "中"], [], [*"ภาษาไทย"],
                     ["한국어", "문장"], [], ["\U00020000", "𝔸b", "s"]]


def test_short_items_and_scripts_without_spaces(frame):
    chinese = "第一次世界大战结束于哪一年？请从下列选项中选择正确的答案。"
    docs = [(1, "so What is, the capital: of France"), (2, "what is the big capital of france"), (3, "前文没有空格" + chinese + "后文"),
            (4, "第一次世界大战结束于那一年请从下列选项中选择正确的答案"), (5, "别的文字" * 20), (6, "wordy zebra"), (7, "zebra zebra")]
    items = [(20, "What is the capital of France?"), (21, chinese), (22, "zebra"), (23, "？！"), (24, "没有空格")]
    assert found(frame, docs, items) == {(1, 20): 0, (3, 21): 0, (4, 21): 1, (6, 22): 0, (7, 22): 0, (3, 24): 0}


def test_equals_a_search_of_all_places(frame):
    rng = random.Random(3)
    words = [f"v{i}" for i in range(30)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(6, 60)))) for i in range(12)]
    docs = []
    for i in range(40):
        w = rng.choice(items)[1].split()
        for _ in range(rng.randint(0, 8)):
            w[rng.randrange(len(w))] = rng.choice(words)
        docs.append((i, " ".join(rng.choice(words) for _ in range(20)) + " " + " ".join(w)))
    want = set()
    for item_id, text in items:
        for p in d.passages_of(item_id, np.array([hash(w) & (1 << 60) - 1 for w in text.split()], dtype=np.uint64)):
            for doc_id, doc in docs:
                if plain.edit_distance_within(p.words.tolist(), [hash(w) & (1 << 60) - 1 for w in doc.split()]) <= p.budget:
                    want.add((doc_id, item_id))
    assert set(found(frame, docs, items)) == want


def test_blocks_of_items_and_empty_tables(frame, monkeypatch):
    a, b, c = (" ".join(item(s, 20)) for s in (1, 2, 3))
    docs, items = [(1, a), (2, b), (3, LONG + " " + c)], [(1, a), (2, b), (3, c)]
    monkeypatch.setattr(d, "BLOCK_ITEMS", 1)
    assert found(frame, docs, items) == {(1, 1): 0, (2, 2): 0, (3, 3): 0}
    assert found(frame, docs, [(None, None)]) == {}
    assert found(frame, [], items) == {}


def test_clean_keeps_rows_as_they_are(frame):
    a = " ".join(item(1, 30))
    df = frame([(1, a), (2, "clean"), (2, "clean"), (None, None), (3, "x " + a.upper())])
    bench = df.sparkSession.createDataFrame([(1, a)], "item_id long, text string")
    out = d.clean(df, bench)
    assert out.schema == df.schema
    assert sorted(map(str, out.collect())) == sorted(map(str, df.filter("doc_id = 2 or doc_id is null").collect()))
