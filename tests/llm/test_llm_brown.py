"""Class-based language-model scores against plain counts."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import plain
import pytest
from conftest import ODD
from pyspark.sql import functions as F

from pairloom.llm import brown


def tokens_of(text):
    return plain.WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def outside(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def likelihood(bigrams, own):
    """Of class bigrams, without what the classes do not change."""
    size = max(own) + 1
    pairs = np.zeros((size, size))
    np.add.at(pairs, (np.array(own)[:, None], np.array(own)[None, :]), bigrams)
    f = lambda x: sum(v * math.log(v) for v in np.ravel(x) if v > 0)
    return f(pairs) - f(pairs.sum(axis=1)) - f(pairs.sum(axis=0))


def test_gains_are_differences_of_likelihood():
    rng = np.random.default_rng(3)
    bigrams = rng.integers(0, 6, (9, 9)).astype(float)
    own = [0, 1, 2, 3, 1, 2, 3, 1, 2]
    for w in range(1, 9):
        member = np.eye(4)[own]
        member[w] = 0
        apart = bigrams - np.diag(np.diag(bigrams))
        clusters = brown.Clusters(np.eye(4)[own].T @ bigrams @ np.eye(4)[own])
        after, before = apart[w] @ member, apart[:, w] @ member
        clusters.add(own[w], after, before, bigrams[w, w], sign=-1)
        gain = clusters.gains(after, before, bigrams[w, w])
        want = [likelihood(bigrams, [*own[:w], g, *own[w + 1 :]]) for g in (1, 2, 3)]
        assert np.allclose(np.diff(gain[1:]), np.diff(want))


def test_exchange_ends_where_no_move_helps():
    rng = np.random.default_rng(5)
    bigrams = rng.poisson(1.5, (25, 25)).astype(float)
    own, clusters = brown.exchanged(bigrams, n_classes=4)
    own = own.tolist()
    best = likelihood(bigrams, own)
    assert best >= likelihood(bigrams, [0, *(1 + np.arange(24) % 4)])
    for w in range(1, 25):
        for g in range(1, 5):
            assert likelihood(bigrams, [*own[:w], g, *own[w + 1 :]]) <= best + 1e-6
    member = np.eye(5)[own]
    assert np.allclose(clusters.pairs, member.T @ bigrams @ member) and np.allclose(clusters.left, clusters.pairs.sum(axis=1))


def test_words_that_behave_alike_share_a_class():
    rng = random.Random(8)
    kinds = [[f"{k}{i}" for i in range(6)] for k in "abc"]
    index = {w: 1 + i for i, w in enumerate(w for kind in kinds for w in kind)}
    bigrams = np.zeros((19, 19))
    for _ in range(3000):
        row = [0, *(index[rng.choice(kind)] for kind in kinds), 0]
        for a, b in zip(row, row[1:]):
            bigrams[a, b] += 1
    own, _ = brown.exchanged(bigrams, n_classes=3)
    assert [len({own[index[w]] for w in kind}) for kind in kinds] == [1, 1, 1] and len(set(own)) == 4


def plain_scores(rows, model):
    """By the classes of ``model``, with all counts taken anew."""
    train = [tokens_of(t) for d, t in rows if d is not None and not outside(d)]
    counts = Counter(w for words in train for w in words)
    ends, total = len(train), sum(counts.values()) + len(train)
    different = len(counts) + (1 if train else 0)
    shape = 1 + brown.CLASSES
    own = {w: int(model.class_of[i]) for w, i in ((w.decode(), i) for w, i in model.known.items())}
    kind = lambda w: own[w] if w in own else shape + brown.shape_of(w.encode())
    row = lambda words: [0, *map(kind, words), 0]
    pairs = Counter(p for words in train for p in zip(row(words), row(words)[1:]))
    size = model.n_classes
    left, right = Counter(), Counter()
    for (a, b), n in pairs.items():
        left[a] += n
        right[b] += n
    words_in = Counter(kind(w) for w in counts)
    out = []
    for doc_id, text in rows:
        words = tokens_of(text)
        base = sum(math.log10((counts[w] + 1) / (total + different + 1)) for w in words)
        base += math.log10((ends + 1) / (total + different + 1))
        score = 0.0
        for a, b in zip(row(words), row(words)[1:]):
            share = (right[b] + 1) / (total + size)
            score += math.log10((pairs[a, b] + size * share) / (left[a] + size))
        for w in words:
            k = kind(w)
            score += math.log10(counts[w] / right[k] if k < shape else (counts[w] + 1) / (right[k] + words_in[k] + 1))
        known = sum(w in counts for w in words) + (ends > 0)
        out.append((doc_id, outside(doc_id), len(words) + 1, known, total, base, score, 10 ** (-score / (len(words) + 1))))
    return out


def close(found, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[5], 4))
    found, want = sorted(map(tuple, found), key=key), sorted(want, key=key)
    assert [r[:5] for r in found] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in found], [r[5:] for r in want], rtol=1e-9)


def model_of(df):
    rows = df.select("doc_id", F.col("text").cast("binary").alias("text"), brown.held_out(F.col("doc_id")).alias("held_out"))
    counts = brown.word_counts(brown.learned_from(rows).select("text"))
    model = brown.listed_words(counts)
    return brown.trained(brown.learned_from(brown.encoded(rows, model)).select("symbols"), model, counts)


@pytest.mark.parametrize("listed,exchanged,stepped", [(brown.LISTED, 1 << 10, 1 << 13), (60, 20, 40), (30, 80, 90)])
def test_scores(frame, monkeypatch, listed, exchanged, stepped):
    for name, value in (("LISTED", listed), ("EXCHANGED", exchanged), ("STEPPED", stepped)):
        monkeypatch.setattr(brown, name, value)
    rng = random.Random(2)
    words = ["The", "the", "a", "x1", "--", "é", "中文", "l" * 150, "longer-word", "averyverylongword"] + [f"w{i}" for i in range(120)]
    weights = [1 / (1 + i) for i in range(len(words))]
    rows = [(i, " ".join(rng.choices(words, weights, k=rng.randint(0, 40)))) for i in range(80)] + ODD
    rows += [(9, "only held out words here"), (16, None), (30, "  ")]  # some of them with remainder 2
    rows += [(d, "unseen_word unseen_word x") for d in range(300, 320) if outside(d)]
    df = frame(rows)
    model = model_of(df)
    assert len(model.known) <= listed
    close(brown.scored(df).collect(), plain_scores(rows, model))


def test_every_listed_word_is_placed_by_all_its_neighbours(frame, monkeypatch):
    """Words far behind the clustered ones, and next to such words only, take the step too."""
    monkeypatch.setattr(brown, "EXCHANGED", 5)
    monkeypatch.setattr(brown, "STEPPED", 7)
    rng = random.Random(6)
    kinds = [[f"{k}{i}" * (1 + i % 3) for i in range(12)] for k in "pqr"]
    rows = [(i, " ".join([*(rng.choice(kind) for kind in kinds), *(["twice"] * (i % 3)), "x1", "--"])) for i in range(150)]
    model = model_of(frame(rows))
    train = [[0, *(model.known[w.encode()] for w in tokens_of(t)), 0] for d, t in rows if not outside(d)]
    words = {i: w for w, i in model.known.items()}
    begin = lambda s: s if s <= 5 else 6 + brown.shape_of(words[s])
    bigrams = np.zeros((6 + brown.SHAPES,) * 2)
    pairs = Counter(p for row in train for p in zip(row, row[1:]))
    for (a, b), n in pairs.items():
        bigrams[begin(a), begin(b)] += n
    own, clusters = brown.exchanged(bigrams, fixed=brown.SHAPES)
    moved = 0
    for s in words:
        if s > 5:
            after, before, itself = np.zeros(model.n_classes), np.zeros(model.n_classes), pairs[s, s]
            for (a, b), n in pairs.items():
                after[own[begin(b)]] += n * (a == s != b)
                before[own[begin(a)]] += n * (b == s != a)
            assert model.class_of[s] == brown.one_step(clusters, own[begin(s)], after, before, itself)
            moved += model.class_of[s] <= brown.CLASSES
    assert moved > 20
    rows += [(900 + i, "p0 never_seen twice twice") for i in range(20)]
    close(brown.scored(frame(rows)).collect(), plain_scores(rows, model_of(frame(rows))))


def test_words_that_tasks_do_not_know_are_placed_too(frame, monkeypatch):
    """Behind the words that every task knows, each other word takes the step, by all its neighbours."""
    for name, value in (("KNOWN", 15), ("EXCHANGED", 5), ("STEPPED", 7)):
        monkeypatch.setattr(brown, name, value)
    rng = random.Random(6)
    kinds = [[f"{k}{i}" * (1 + i % 3) for i in range(12)] for k in "pqr"]
    rows = [(i, " ".join([*(rng.choice(kind) for kind in kinds), *(["twice"] * (i % 3)), "x1", "--"])) for i in range(150)]
    rows += [(300 + i, f"{'é' * 600}{i % 2} twice once{i} {'z' * 2000} {'z' * 2000}") for i in range(9)] + ODD[:5] + [(None, "p0 q0")]
    model = model_of(frame(rows))
    assert len(model.known) <= 15
    train = [tokens_of(t) for d, t in rows if d is not None and not outside(d)]
    counts = Counter(w for words in train for w in words)
    clustered = list(model.known)[:5]
    begin = lambda w: 0 if w is None else 1 + clustered.index(w.encode()) if w.encode() in clustered else 6 + brown.shape_of(w.encode())
    pairs = Counter(p for words in train for p in zip([None, *words], [*words, None]))
    bigrams = np.zeros((6 + brown.SHAPES,) * 2)
    for (a, b), n in pairs.items():
        bigrams[begin(a), begin(b)] += n
    own, clusters = brown.exchanged(bigrams, fixed=brown.SHAPES)
    after, before = ({w: np.zeros(model.n_classes) for w in counts} for _ in range(2))
    for (a, b), n in pairs.items():
        if a != b and a is not None:
            after[a][own[begin(b)]] += n
        if a != b and b is not None:
            before[b][own[begin(a)]] += n
    place = {w: int(own[begin(w)]) for w in counts}
    for w in counts:
        if w.encode() not in clustered:
            place[w] = brown.one_step(clusters, place[w], after[w], before[w], pairs[w, w])
    assert all(place[w.decode()] == model.class_of[i] for w, i in model.known.items())
    others = [w for w in counts if w.encode() not in model.known]
    assert sum(place[w] <= brown.CLASSES for w in others) > 10 and any(pairs[w, w] for w in others)
    every = {w.encode(): i for i, w in enumerate(place)}
    whole = SimpleNamespace(known=every, class_of=list(place.values()), n_classes=model.n_classes)
    close(brown.scored(frame(rows)).collect(), plain_scores(rows, whole))


def test_many_steps_are_single_steps(monkeypatch):
    monkeypatch.setattr(brown, "CLASSES", 6)
    rng = np.random.default_rng(4)
    size, words = 1 + 6 + brown.SHAPES, 400
    own = rng.integers(7, size, words)
    word = np.repeat(np.arange(words), 4)
    place = np.concatenate([rng.choice(2 * size + 1, 4, replace=False) for _ in range(words)])
    n = rng.integers(1, 9, len(word)).astype(float)
    pairs = rng.integers(30, 300, (size, size)).astype(float)
    clusters = brown.Clusters(pairs)
    found = brown.many_steps(clusters, own, word, place, n)
    for w in range(words):
        counts = np.zeros(2 * size + 1)
        counts[place[word == w]] = n[word == w]
        assert found[w] == brown.one_step(clusters, own[w], counts[:size], counts[size:-1], counts[-1])
    assert 50 < (found <= 6).sum()


def test_nothing_to_learn_from(frame):
    held = [(d, "some words") for d in range(100) if outside(d)] + [(None, "others")]
    found = brown.scored(frame(held)).collect()
    assert len(found) == len(held) and {(r.train_tokens, r.n_known, r.base_score) for r in found} == {(0, 0, 0.0)}
    assert all(math.isfinite(r.score) for r in found)


def test_empty_table(frame):
    assert brown.scored(frame([(1, "x")]).filter("doc_id < 0")).count() == 0


def test_held_out_text_is_less_surprising_than_shuffled_text(spark):
    """The model has learned order: the same words in another order are less likely."""
    rng = random.Random(4)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("lang = 'en'").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.text]
    mixed = [(d, " ".join(rng.sample(t.split(), len(t.split())))) for d, t in rows if outside(d)]
    names = "doc_id long, text string"
    first = {r.doc_id: r for r in brown.scored(spark.createDataFrame(rows, names)).collect()}
    train = [r for r in rows if not outside(r[0])]
    other = {r.doc_id: r for r in brown.scored(spark.createDataFrame(train + mixed, names)).collect()}
    held = [d for d, _ in mixed]
    assert held and sum(first[d].score for d in held) > sum(other[d].score for d in held)
    assert sum(first[d].score for d in held) > sum(first[d].base_score for d in held)
