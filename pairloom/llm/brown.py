"""Language-model scores by Brown's class-based bigrams.

The most frequent words are dealt to classes by exchange clustering: each word in turn moves to the class that gains
most likelihood of the class bigrams, until none moves. All other words take one such step each, out of the classes by
shape where words begin. Both count every neighbour: those that are in no class yet count for the class of their shape. A
token's probability is that of its class after the class before, times that of the word in its class. All counts are taken
over all training texts; what the driver and the broadcast hold is bounded by the constants below, whatever the corpus:
words that tasks do not know are placed and looked up by joins.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.shared import dropped, written
from pairloom.llm.words import chunks

FOLDS, HELD_OUT = 7, 2
END = " "  # no word holds a space
SHAPES = 5
LISTED = 1 << 62  # words that leave the class of their shape, the most frequent ones: as it is, all
KNOWN = (1 << 16) - 1 - SHAPES  # words that every task knows: with the end and the shapes, symbols have 16 bits
KNOWN_BYTES = 1000  # a longer word is placed and looked up by join
EXCHANGED = 1 << 10  # words clustered by full exchange; one step places each further one
STEPPED = 1 << 13  # known words that a task places at a time
CLASSES = 64
MAX_SWEEPS = 20
COUNTED_WORDS = 400_000  # different words that a task counts before it sends them on
PAIRS = 1 << 20  # pairs that a task holds before it counts them

SYMBOL, ORDER = np.dtype("<u2"), np.dtype("<i4")
_DIGIT, _LETTER = re.compile(rb"[0-9]"), re.compile(rb"[A-Za-z\x80-\xff]")


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves the remainder HELD_OUT; false for null."""
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def words_of(text: bytes | None) -> list[bytes]:
    """Runs of bytes other than space and 0x09 to 0x0D, A-Z in lower case."""
    return (text or b"").lower().split()


def shape_of(word: bytes) -> int:
    if _DIGIT.search(word):
        return 0
    if not _LETTER.search(word):
        return 1
    return 2 + (len(word) > 6) + (len(word) > 12)


@dataclass
class Model:
    """Symbols are 0 for the end, 1 and on for known words, and behind them one for each shape. ``known`` holds the
    words that every task knows, ``counts`` and ``class_of`` go by symbol, ``least`` is the level of frequency from which
    on other words are placed too, ``shape_words`` how many different words the class of each shape has."""

    known: dict[bytes, int]
    counts: np.ndarray
    class_of: np.ndarray
    n_tokens: int
    n_words: int
    least: int
    clusters: Clusters | None = None
    shape_words: np.ndarray | None = None
    begin: np.ndarray | None = None  # classes by symbol when all but the clustered words are in those of their shapes

    @property
    def n_classes(self) -> int:
        return 1 + CLASSES + SHAPES

    def symbols(self, texts: list[bytes | None]) -> tuple[list[bytes], list[Counter], list[bytes]]:
        """The symbols of each text with the end behind them, its words that are not known, and which of these stand at
        the places of shapes, in order."""
        rows, others, order = [], [], []
        get, first_shape = self.known.get, len(self.known) + 1
        for text in texts:
            words = words_of(text)
            found = list(map(get, words))
            missing: Counter = Counter()
            places: list[int] = []
            if None in found:
                missing = Counter(w for w, s in zip(words, found) if s is None)
                number = {w: i for i, w in enumerate(missing)}
                places = [number[w] for w, s in zip(words, found) if s is None]
                shapes = {w: first_shape + shape_of(w) for w in missing}
                found = [shapes[w] if s is None else s for w, s in zip(words, found)]
            found.append(0)
            rows.append(np.array(found, dtype=SYMBOL).tobytes())
            others.append(missing)
            order.append(np.array(places, dtype=ORDER).tobytes())
        return rows, others, order

    def listed_sums(self, row: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Over the symbols of each text, from ``at`` on: known ones, their base score, and the sum of log10 of their counts."""
        listed = np.append(np.ones(len(self.known) + 1, dtype=bool), np.zeros(SHAPES, dtype=bool))
        base = np.where(listed, np.log10((self.counts + 1) / (self.n_tokens + self.n_words + 1)), 0.0)
        own = np.where(listed, np.log10(np.where(self.class_of > CLASSES, self.counts + 1, np.maximum(self.counts, 1))), 0.0)
        own[0] = 0.0
        known = (listed & (self.counts > 0)).astype(np.int64)
        return tuple(np.add.reduceat(x[row], at) if len(at) else at for x in (known, base, own))


def joined(rows: list[bytes]) -> np.ndarray:
    """Rows of symbols on end, with an end before the first one too."""
    return np.append(0, np.frombuffer(b"".join(rows), dtype=SYMBOL)).astype(np.int64)


def word_counts(texts: DataFrame) -> DataFrame:
    """``word``, ``n`` over all rows; END counts the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def batch_of() -> pa.RecordBatch:
            names = pa.array(list(counts), pa.binary()).cast(pa.string())
            return pa.record_batch([names, pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

        for batch in chunks(batches):
            for text in batch.column("text").to_pylist():
                counts.update(words_of(text))
            counts[END.encode()] += batch.num_rows
            if len(counts) > COUNTED_WORDS:
                yield batch_of()
                counts.clear()
        if counts:
            yield batch_of()

    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _level(n: str = "n") -> Column:
    return F.floor(F.log2(n) * 8).cast("int")


def _least(words: DataFrame, most: int) -> int:
    """The lowest level of frequency of which, with all above, there are no more than ``most`` words."""
    levels = words.groupBy(_level().alias("level")).count().collect()  # one row for each eighth of a power of two
    least, held = 0, 0
    for row in sorted(levels, key=lambda r: -r["level"]):
        if held + row["count"] > most:
            return row["level"] + 1
        least, held = row["level"], held + row["count"]
    return min(least, 0)


def listed_words(counts: DataFrame) -> Model:
    """The most frequent words, at most KNOWN (and LISTED): those from the lowest level of frequency that holds no more."""
    words = counts.filter(F.col("word") != END)
    short = words.filter(F.octet_length("word") <= KNOWN_BYTES)
    total = counts.agg(F.sum("n"), F.count("n"), F.max(F.when(F.col("word") == END, F.col("n")))).first()
    rows = short.filter(_level() >= _least(short, min(KNOWN, LISTED))).collect()
    rows.sort(key=lambda r: (-r["n"], r["word"]))
    known = {r["word"].encode(): i + 1 for i, r in enumerate(rows)}
    n = np.array([total[2] or 0, *(r["n"] for r in rows), *[0] * SHAPES], dtype=np.float64)
    own = np.zeros(len(n), dtype=np.int64)
    return Model(known, n, own, total[0] or 0, total[1] or 0, _least(words, LISTED))


def _pairs(learned: DataFrame, keys: Callable[[np.ndarray, np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """How often each number below ``size`` comes of ``keys(left, right)`` over all neighbouring symbols of ``learned``.
    Each task sends the numbers it met once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, held, waiting = np.zeros(size, dtype=np.int64), 0, []
        for batch in chunks(batches, "symbols"):
            row = joined(batch.column("symbols").to_pylist())
            waiting.append(keys(row[:-1], row[1:]))
            held += len(waiting[-1])
            if held > PAIRS:
                counts += np.bincount(np.concatenate(waiting), minlength=size)
                waiting, held = [], 0
        counts += np.bincount(np.concatenate([*waiting, np.zeros(0, dtype=np.int64)]), minlength=size)
        at = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(at.astype(np.int32)), pa.array(counts[at])], names=["key", "n"])

    found = learned.mapInArrow(run, "key int, n long").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size)
    out[found.column("key").to_numpy()] = found.column("n").to_numpy()
    return out


def _contexts(learned: DataFrame, first: int, code: np.ndarray, size: int) -> DataFrame:
    """``symbol``, ``place``, ``n``: how often each listed symbol from ``first`` on has each ``code`` behind it (places
    below ``size``), before it (the next ``size``) and itself behind it (the last place)."""
    listed, sides = len(code) - SHAPES, 2 * size + 1

    def counted(waiting: list[np.ndarray]) -> pa.RecordBatch:
        keys, n = np.unique(np.concatenate([*waiting, np.zeros(0, dtype=np.int64)]), return_counts=True)
        columns = [pa.array((keys // sides).astype(np.int32)), pa.array((keys % sides).astype(np.int32)), pa.array(n.astype(np.int64))]
        return pa.record_batch(columns, names=["symbol", "place", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting = 0, []
        for batch in chunks(batches, "symbols"):
            row = joined(batch.column("symbols").to_pylist())
            a, b = row[:-1], row[1:]
            left, right = (a >= first) & (a < listed), (b >= first) & (b < listed)
            twice = left & (a == b)
            left, right = left & ~twice, right & ~twice
            waiting += [a[left] * sides + code[b[left]], b[right] * sides + size + code[a[right]], a[twice] * sides + 2 * size]
            held += sum(map(len, waiting[-3:]))
            if held > PAIRS:
                yield counted(waiting)
                held, waiting = 0, []
        yield counted(waiting)

    ddl = "symbol int, place int, n long"
    return learned.mapInArrow(run, ddl).groupBy("symbol", "place").agg(F.sum("n").alias("n"))


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


class Clusters:
    """Class bigram counts ``pairs`` with their sums, and what a word adds to their likelihood in each class. Class 0 is
    the end, alone."""

    def __init__(self, pairs: np.ndarray):
        self.pairs = pairs
        self.left, self.right = pairs.sum(axis=1), pairs.sum(axis=0)

    def gains(self, after: np.ndarray, before: np.ndarray, itself: float) -> np.ndarray:
        """``after`` and ``before`` count the classes on both sides of a word that is in no class."""
        pairs, own = self.pairs, np.arange(len(self.pairs))
        gain = (_xlogx(pairs + after) - _xlogx(pairs)).sum(axis=1)
        gain += (_xlogx(pairs + before[:, None]) - _xlogx(pairs)).sum(axis=0)
        diagonal = pairs[own, own]
        gain += _xlogx(diagonal + after + before + itself) + _xlogx(diagonal)
        gain -= _xlogx(diagonal + after) + _xlogx(diagonal + before)
        left, right = self.left + before, self.right + after  # the word's neighbours keep their totals in any class
        gain -= _xlogx(left + after.sum() + itself) - _xlogx(left)
        gain -= _xlogx(right + before.sum() + itself) - _xlogx(right)
        return gain

    def add(self, to: int, after: np.ndarray, before: np.ndarray, itself: float, sign: int = 1) -> None:
        self.pairs[to] += sign * after
        self.pairs[:, to] += sign * before
        self.pairs[to, to] += sign * itself
        self.left += sign * before
        self.right += sign * after
        self.left[to] += sign * (after.sum() + itself)
        self.right[to] += sign * (before.sum() + itself)


def exchanged(
    bigrams: np.ndarray, n_classes: int = CLASSES, sweeps: int = MAX_SWEEPS, fixed: int = 0
) -> tuple[np.ndarray, Clusters]:
    """The class of each word, from its bigram counts; word 0 is the end and stays alone in class 0, and so do the last
    ``fixed`` ones, in classes behind the others."""
    n = len(bigrams) - fixed
    own = np.concatenate([[0], 1 + np.arange(n - 1) % n_classes, 1 + n_classes + np.arange(fixed)])
    member = np.eye(1 + n_classes + fixed)[own]
    clusters = Clusters(member.T @ bigrams @ member)
    itself = np.diag(bigrams).copy()
    apart = bigrams - np.diag(itself)
    for _ in range(sweeps):
        moved = 0
        for w in range(1, n):
            after, before = apart[w] @ member, apart[:, w] @ member
            clusters.add(own[w], after, before, itself[w], sign=-1)
            gain = clusters.gains(after, before, itself[w])
            gain[0] = -np.inf
            gain[1 + n_classes :] = -np.inf
            best = int(gain.argmax())
            if gain[best] <= gain[own[w]] + 1e-9:
                best = own[w]
            clusters.add(best, after, before, itself[w])
            if best != own[w]:
                member[w, own[w]], member[w, best] = 0, 1
                own[w] = best
                moved += 1
        if not moved:
            break
    return own, clusters


def encoded(rows: DataFrame, model: Model) -> DataFrame:
    """Each row of ``doc_id``, ``held_out``, ``text`` as ``symbols``, with its words that are not known in ``others``,
    their places in ``order``, and a number of its own."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("word", pa.string()), ("n", pa.int64()), ("shape", pa.int32())]))
        for batch in chunks(batches):
            symbols, others, order = shared.value.symbols(batch.column("text").to_pylist())
            listed = [[{"word": w.decode(), "n": n, "shape": shape_of(w)} for w, n in c.items()] for c in others]
            columns = [batch.column("doc_id"), batch.column("held_out"), pa.array(symbols, pa.binary())]
            columns += [pa.array(listed, kind), pa.array(order, pa.binary())]
            yield pa.record_batch(columns, names=["doc_id", "held_out", "symbols", "others", "order"])

    ddl = "doc_id long, held_out boolean, symbols binary, others array<struct<word: string, n: long, shape: int>>, order binary"
    return written(rows.mapInArrow(run, ddl).withColumn("row", F.monotonically_increasing_id()), "symbols")


def learned_from(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("doc_id").isNotNull() & ~F.col("held_out"))


def one_step(clusters: Clusters, own: int, after: np.ndarray, before: np.ndarray, itself: float) -> int:
    """The class to which a word of class ``own`` moves: the one that gains most, if that is more than where it is."""
    clusters.add(own, after, before, itself, sign=-1)
    gain = clusters.gains(after, before, itself)
    clusters.add(own, after, before, itself)
    best = 1 + int(gain[1 : 1 + CLASSES].argmax())
    return best if gain[best] > gain[own] + 1e-9 else own


def _placed(contexts: DataFrame, clusters: Clusters, class_of: np.ndarray, first: int, listed: int) -> np.ndarray:
    """The classes of the symbols from ``first`` to ``listed``, each by one step from the same ``clusters``."""
    shared = contexts.sparkSession.sparkContext.broadcast((clusters, class_of.copy()))
    size = len(clusters.pairs)

    def run(table: pa.Table) -> pa.Table:
        clusters, class_of = shared.value
        symbols, at = np.unique(table.column("symbol").to_numpy(), return_inverse=True)
        places, n = table.column("place").to_numpy(), table.column("n").to_numpy().astype(np.float64)
        order = np.argsort(at, kind="stable")
        cuts = np.searchsorted(at[order], np.arange(len(symbols) + 1))
        found = np.zeros(len(symbols), dtype=np.int32)
        for i, symbol in enumerate(symbols):
            rows, counts = order[cuts[i] : cuts[i + 1]], np.zeros(2 * size + 1)
            counts[places[rows]] = n[rows]
            found[i] = one_step(clusters, class_of[symbol], counts[:size], counts[size:-1], counts[-1])
        return pa.table({"symbol": pa.array(symbols.astype(np.int32)), "class": pa.array(found)})

    blocks = contexts.groupBy(F.floor(F.col("symbol") / STEPPED).alias("block"))
    out = class_of[first:listed].copy()
    moved = blocks.applyInArrow(run, "symbol int, class int").toArrow()
    out[moved.column("symbol").to_numpy() - first] = moved.column("class").to_numpy()
    return out


def trained(learned: DataFrame, model: Model, counts: DataFrame) -> Model:
    """``model`` with the classes of known words, from the ``symbols`` of all rows to learn from and their
    ``word_counts``; all other words are in the classes of their shapes."""
    size, listed = model.n_classes, len(model.known) + 1
    n = min(listed, EXCHANGED + 1)
    shapes = [shape_of(w) for w in list(model.known)[n - 1 :]]
    begin = np.concatenate([np.arange(n), n + np.array(shapes, dtype=np.int64), n + np.arange(SHAPES)])
    wide = n + SHAPES
    bigrams = _pairs(learned, lambda a, b: begin[a] * wide + begin[b], wide * wide).reshape(wide, wide)
    own, model.clusters = exchanged(bigrams, CLASSES, fixed=SHAPES)
    model.class_of[:] = model.begin = own[begin]
    if listed > n:
        contexts = _contexts(learned, n, model.begin, size)
        model.class_of[n:listed] = _placed(contexts, model.clusters, model.begin, n, listed)
    model.shape_words = _shape_words(counts, {w for w, i in model.known.items() if model.class_of[i] <= CLASSES})
    return model


def _other_contexts(learned: DataFrame, code: np.ndarray, size: int) -> DataFrame:
    """``word``, ``shape``, ``place``, ``n`` of the words that are not known, with places as in ``_contexts``."""
    first, sides = len(code) - SHAPES, 2 * size + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "symbols"):
            row = joined(batch.column("symbols").to_pylist())
            word = np.full(len(row), -1, dtype=np.int64)
            words, number = _words_of(batch)
            word[row >= first] = number
            a, b, x, y = row[:-1], row[1:], word[:-1], word[1:]
            twice = (x >= 0) & (x == y)
            left, right = (x >= 0) & ~twice, (y >= 0) & ~twice
            keys = [x[left] * sides + code[b[left]], y[right] * sides + size + code[a[right]], x[twice] * sides + 2 * size]
            keys, n = np.unique(np.concatenate(keys), return_counts=True)
            columns = [words.take(pa.array(keys // sides)), pa.array((keys % sides).astype(np.int32)), pa.array(n.astype(np.int64))]
            yield pa.record_batch(columns, names=["word", "place", "n"])

    rows = learned.select("symbols", "others", "order").mapInArrow(run, "word string, place int, n long")
    return rows.repartition("word").groupBy("word", "place").agg(F.sum("n").alias("n"))


def _words_of(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray]:
    """The different words of ``others`` in all rows, and the number of that at each place of a shape."""
    lists = batch.column("others")
    flat = pc.struct_field(pc.list_flatten(lists), "word").dictionary_encode()
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    at, numbers = np.cumsum(sizes) - sizes, flat.indices.to_numpy(zero_copy_only=False)
    order = [np.frombuffer(o, dtype=ORDER) for o in batch.column("order").to_pylist()]
    places = np.concatenate([o + begin for o, begin in zip(order, at)]) if order else np.zeros(0)
    return flat.dictionary, numbers[places.astype(np.int64)]


def many_steps(clusters: Clusters, own: np.ndarray, word: np.ndarray, place: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``one_step`` of each word of class ``own``, all of them classes of shapes, from the ``place`` and ``n`` of its
    contexts; ``word`` goes up. Only what a word changes is computed, for all words at once."""
    pairs, size, rows = clusters.pairs, len(clusters.pairs), np.arange(len(own))
    after, before, itself = np.zeros((len(own), size)), np.zeros((len(own), size)), np.zeros(len(own))
    sides = (place < size), (place >= size) & (place < 2 * size), place == 2 * size
    after[word[sides[0]], place[sides[0]]] = n[sides[0]]
    before[word[sides[1]], place[sides[1]] - size] = n[sides[1]]
    itself[word[sides[2]]] = n[sides[2]]
    gain, stay = np.zeros((len(own), size)), np.zeros(len(own))
    for side, beside, matrix, shift in ((sides[0], before, pairs.T, 0), (sides[1], after, pairs, size)):
        w, k, m = word[side], place[side] - shift, n[side]
        if not len(w):
            continue
        cells = matrix[k]  # of each class with the neighbour's class
        same = k == own[w]
        cells[same] -= beside[w[same]]  # the word has left that class
        starts = np.flatnonzero(np.append(True, w[1:] != w[:-1]))
        gain[w[starts]] += np.add.reduceat(_xlogx(cells + m[:, None]) - _xlogx(cells), starts, axis=0)
        held = np.where(same, 0.0, _xlogx(cells[np.arange(len(w)), own[w]]))
        left = np.where(same, 0.0, _xlogx(cells[np.arange(len(w)), own[w]] - m))
        stay += np.bincount(w, weights=held - left, minlength=len(own))
    diagonal = pairs.diagonal()
    gain += _xlogx(diagonal + after + before + itself[:, None]) + _xlogx(diagonal)
    gain -= _xlogx(diagonal + after) + _xlogx(diagonal + before)
    mine = diagonal[own]
    stay += _xlogx(mine) - _xlogx(mine - after[rows, own] - before[rows, own] - itself)
    for total, more in ((clusters.left, after.sum(axis=1) + itself), (clusters.right, before.sum(axis=1) + itself)):
        gain -= _xlogx(total + more[:, None]) - _xlogx(total)
        stay -= _xlogx(total[own]) - _xlogx(total[own] - more)
    best = 1 + gain[:, 1 : 1 + CLASSES].argmax(axis=1)
    return np.where(gain[rows, best] > stay + 1e-9, best, own)


def _others_placed(contexts: DataFrame, model: Model) -> DataFrame:
    """``word``, ``c``, ``class`` of the words with ``contexts``, each by one step from the clusters of ``model``."""
    shared = contexts.sparkSession.sparkContext.broadcast(model.clusters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(shared.value.pairs)
        for batch in batches:
            lists = batch.column("contexts")
            flat = pc.list_flatten(lists)
            word = np.repeat(np.arange(batch.num_rows), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            place = pc.struct_field(flat, "place").to_numpy().astype(np.int64)
            n = pc.struct_field(flat, "n").to_numpy().astype(np.float64)
            follows = (place < size) | (place == 2 * size)  # every occurrence has one word or end behind it
            count = np.bincount(word[follows], weights=n[follows], minlength=batch.num_rows)
            own = np.array([1 + CLASSES + shape_of(w.encode()) for w in batch.column("word").to_pylist()], dtype=np.int64)
            found = many_steps(shared.value, own, word, place, n)
            columns = [batch.column("word"), *(pa.array(x.astype(np.int64)) for x in (count, own, found))]
            yield pa.record_batch(columns, names=["word", "c", "own", "found"])

    each = contexts.groupBy("word").agg(F.collect_list(F.struct("place", "n")).alias("contexts"))
    found = each.mapInArrow(run, "word string, c long, own long, found long")
    placed = F.when(_level("c") >= model.least, F.col("found")).otherwise(F.col("own")).cast("int")
    return written(found.select("word", "c", placed.alias("class")), "placed")


def _classed(parts: DataFrame, placed: DataFrame, model: Model) -> DataFrame:
    """Each row with the classes of its tokens as ``symbols``, known tokens, base score, and ``own``: the sum of log10 of the
    counts of its words, one more in the classes of shapes. No join is a broadcast: Spark sizes rows as if ``posexplode`` made
    one of each."""
    shared = parts.sparkSession.sparkContext.broadcast(model)
    each = parts.select("row", F.posexplode("others").alias("i", "o")).select("row", "i", "o.*").join(placed.hint("merge"), "word", "left")
    each = each.withColumn("c", F.coalesce("c", F.lit(0)))
    each = each.withColumn("class", F.coalesce("class", F.col("shape") + F.lit(1 + CLASSES)))
    counted = F.when(F.col("class") > CLASSES, F.col("c") + 1).otherwise(F.col("c"))
    more = each.groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("more_known"),
        F.sum(F.col("n") * F.log10((F.col("c") + 1) / F.lit(float(model.n_tokens + model.n_words + 1)))).alias("more_base"),
        F.sum(F.col("n") * F.log10(counted)).alias("more_own"),
        F.collect_list(F.struct("i", "class")).alias("classes"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in chunks(batches, "symbols"):
            texts = batch.column("symbols").to_pylist()
            row = joined(texts)[1:]
            tokens = np.array([len(t) // SYMBOL.itemsize for t in texts], dtype=np.int64)
            sums = model.listed_sums(row, np.cumsum(tokens) - tokens)
            out = model.class_of[row]
            lists = batch.column("classes")
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            begin, flat = np.cumsum(sizes) - sizes, pc.list_flatten(lists)
            found = np.zeros(int(sizes.sum()), dtype=np.int64)
            found[np.repeat(begin, sizes) + pc.struct_field(flat, "i").to_numpy()] = pc.struct_field(flat, "class").to_numpy()
            order = [np.frombuffer(o, dtype=ORDER) + at for o, at in zip(batch.column("order").to_pylist(), begin)]
            if order:
                out[row > len(model.known)] = found[np.concatenate(order)]
            data, size = out.astype(SYMBOL).tobytes(), SYMBOL.itemsize
            ends = np.cumsum(tokens)
            symbols = pa.array([data[(e - t) * size : e * size] for e, t in zip(ends.tolist(), tokens.tolist())], pa.binary())
            more = [pc.fill_null(batch.column(f"more_{c}"), 0).to_numpy(zero_copy_only=False) for c in ("known", "base", "own")]
            kinds = (pa.int64(), pa.float64(), pa.float64())
            columns = [batch.column("doc_id"), batch.column("held_out"), symbols, pa.array(tokens)]
            columns += [pa.array(a + b, t) for a, b, t in zip(sums, more, kinds)]
            yield pa.record_batch(columns, names=["doc_id", "held_out", "symbols", "n_tokens", "known", "base", "own"])

    ddl = "doc_id long, held_out boolean, symbols binary, n_tokens long, known long, base double, own double"
    return written(parts.drop("others").join(more.hint("merge"), "row", "left").mapInArrow(run, ddl), "classes")


def _shape_words(counts: DataFrame, classed: set[bytes]) -> np.ndarray:
    """How many different words have each shape, without those in classes of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shapes = Counter(shape_of(w) for w in batch.column("word").to_pylist() if w not in classed and w != END.encode())
            yield pa.record_batch([pa.array(list(shapes), pa.int32()), pa.array(list(shapes.values()), pa.int64())], names=["s", "n"])

    words = counts.select(F.col("word").cast("binary").alias("word")).mapInArrow(run, "s int, n long")
    out = np.zeros(SHAPES)
    for row in words.groupBy("s").agg(F.sum("n").alias("n")).collect():
        out[row["s"]] = row["n"]
    return out


def scored(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` (unigrams, one added to each
    count), ``score`` (log10 probability of the text by the class model) and ``perplexity`` of every row.

    Null and blank texts are the end alone. Rows without a doc_id are scored, never learned from; repeated rows count
    each. Without any training text, all words have the probability of an unseen one. Equal counts are listed in the
    order of their words. Whole texts are read; an empty table gives no rows; other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    rows = rows.withColumn("held_out", held_out(F.col("doc_id")))
    counts = written(word_counts(learned_from(rows).select("text")), "words")
    model = listed_words(counts)
    parts = encoded(rows, model)
    model = trained(learned_from(parts).select("symbols"), model, counts)
    placed = _others_placed(_other_contexts(learned_from(parts), model.begin, model.n_classes), model)
    moved = placed.filter(F.col("class") <= CLASSES).select("word")
    model.shape_words -= _shape_words(moved, set())
    classes = _classed(parts, placed, model)
    dropped(parts, placed, counts)

    size = model.n_classes
    pairs = _pairs(learned_from(classes).select("symbols"), lambda a, b: a * size + b, size * size).reshape(size, size)
    tokens = pairs.sum(axis=0)
    share = (tokens + 1) / (pairs.sum() + size)
    forward = np.log10((pairs + size * share) / (pairs.sum(axis=1, keepdims=True) + size))
    in_class = np.concatenate([np.maximum(tokens[: 1 + CLASSES], 1), tokens[1 + CLASSES :] + model.shape_words + 1])
    in_class[0] = 1  # the end is all of its class
    step = forward - np.log10(in_class)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "symbols"):
            row = joined(batch.column("symbols").to_pylist())
            tokens = batch.column("n_tokens").to_numpy()
            at = np.cumsum(tokens) - tokens
            score = np.add.reduceat(step[row[:-1], row[1:]], at) if len(at) else np.zeros(0)
            score += batch.column("own").to_numpy()
            columns = [batch.column(c) for c in ("doc_id", "held_out", "n_tokens", "known", "base")] + [pa.array(score)]
            yield pa.record_batch(columns, names=["doc_id", "held_out", "n_tokens", "known", "base", "score"])

    ddl = "doc_id long, held_out boolean, n_tokens long, known long, base double, score double"
    return classes.mapInArrow(run, ddl).select(
        "doc_id",
        "held_out",
        "n_tokens",
        F.col("known").alias("n_known"),
        F.lit(int(model.n_tokens)).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"),
        "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
