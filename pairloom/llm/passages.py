"""Substring dedup with repeated-phrase automata.

A window is ``WINDOW`` consecutive words of one document. Each window has an anchor: the run of ``GRAM`` words in
it whose hash is smallest, which depends on nothing but the window's words, so equal windows have equal anchors at
equal places. Neighbouring windows with the same anchor form a segment. Only segments whose anchor also stands
elsewhere can hold a repeated window, and only where an anchor has several different segments do windows have to be
compared: one copy of each such segment is cut, and its repeated windows are confirmed on the words.

The different texts are dealt to buckets. Each bucket learns which confirmed passages its texts hold, compiles one
copy of each into an Aho-Corasick automaton, and streams all its texts through it: what the automaton finds is covered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.shared import dropped, written
from pairloom.llm.words import WORD_BASES, Runs, Words, chunks, split, utf8, word_hashes

WINDOW = 35
GRAM = 9
HOT_SEGMENTS = 100  # different segments of one anchor, beyond which its windows are counted one by one over the cluster
SHARD_CHARS = 1 << 20  # of segments whose windows are confirmed together
SHARD_WINDOWS = 20_000  # compared word by word at once
BUCKET_CHARS = 1 << 20  # of texts that one automaton serves
SYMBOLS = 256  # the automaton reads one symbol for each word; what it finds is compared word by word

TEXT = ["h1", "h2"]
SEGMENT = ["anchor", "digest"]  # hashes of the anchor and of the whole segment, 128 bits together


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text).alias("h1"),
        F.xxhash64(F.lit(1), text).alias("h2"),
        text.alias("text"),
    )


def _texts(keyed: DataFrame) -> DataFrame:
    """Each different text with its number of rows and its bucket; the number of buckets grows with the texts."""
    texts = keyed.groupBy(*TEXT).agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("places"))
    texts = written(texts.withColumn("chars", F.char_length("text")), "texts")
    buckets = 1 + (texts.agg(F.sum("chars")).first()[0] or 0) // BUCKET_CHARS
    return texts.withColumn("bucket", F.pmod("h1", F.lit(buckets)))


def _leftmost_least(values: np.ndarray, span: int) -> np.ndarray:
    """For each i, the first position of the least of ``values[i : i + span]``, by doubling."""
    at, width = np.arange(len(values)), 1
    while width < span:
        step = min(width, span - width)
        left, right = at[:-step], at[step:]
        at = np.where(values[left] <= values[right], left, right)
        width += step
    return at


def segments_of(words: Words, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Text number, anchor, digest, first word and number of windows of each segment."""
    n = len(words)
    if n < window:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(5))
    hashes = word_hashes(words)
    runs = [Runs(hashes, base) for base in WORD_BASES]
    i = np.arange(n - gram + 1)
    grams = runs[0].hashes(i, i + gram)
    text = words.text_of()
    place = _leftmost_least(grams, window - gram + 1)
    starts = np.flatnonzero(text[: len(place)] == text[window - 1 :])  # windows within one text
    anchored = place[starts]
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (anchored[1:] != anchored[:-1]) | (text[starts[1:]] != text[starts[:-1]])
    head = np.flatnonzero(new)
    first, n_windows = starts[head], np.diff(np.append(head, len(starts)))
    digest = runs[1].hashes(first, first + n_windows + window - 1)
    return text[first], grams[anchored[head]].view(np.int64), digest.view(np.int64), first, n_windows


def _segments(texts: DataFrame, window: int, gram: int) -> DataFrame:
    """In which buckets each different segment stands, and how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            owner, anchor, digest, _, _ = segments_of(split(*utf8(batch.column("text"))), window, gram)
            own = (batch.column(c).take(pa.array(owner)) for c in ("bucket", "places"))
            yield pa.record_batch([*own, pa.array(anchor), pa.array(digest)], names=["bucket", "places", *SEGMENT])

    found = texts.select("bucket", "places", "text").mapInArrow(run, "bucket long, places long, anchor long, digest long")
    return found.groupBy("bucket", *SEGMENT).agg(F.sum("places").alias("places"))


def _found(wanted: pa.Table, anchor: np.ndarray, digest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the first segment of each row of ``wanted``: its place among the segments, and the row."""
    rows = {k: i for i, k in enumerate(zip(*(wanted.column(c).to_pylist() for c in SEGMENT)))}
    at = np.flatnonzero(np.isin(anchor, wanted.column("anchor").to_numpy()))
    hits = [(rows.pop(k), i) for i, k in zip(at.tolist(), zip(anchor[at].tolist(), digest[at].tolist())) if k in rows]
    found = np.array(hits, dtype=np.int64).reshape(-1, 2)
    return found[:, 1], found[:, 0]


def _cut(texts: DataFrame, wanted: DataFrame, window: int, gram: int) -> DataFrame:
    """One copy of the words of each ``wanted`` segment, from a text of its bucket."""

    def run(texts: pa.Table, wanted: pa.Table) -> pa.Table:
        words = split(*utf8(texts.column("text").combine_chunks() if wanted.num_rows else pa.array([], pa.string())))
        _, anchor, digest, first, n = segments_of(words, window, gram)
        at, row = _found(wanted, anchor, digest)
        data, starts, ends = words.data.tobytes(), words.starts.tolist(), words.ends.tolist()
        spans = zip(first[at].tolist(), (first[at] + n[at] + window - 1).tolist())
        cut = [b" ".join(data[starts[i] : ends[i]] for i in range(a, b)).decode() for a, b in spans]
        rows = wanted.take(pa.array(row)).select([*SEGMENT, "places", "segments"])
        return rows.append_column("words", pa.array(cut, pa.string()))

    both = texts.select("bucket", "text").groupBy("bucket").cogroup(wanted.groupBy("bucket"))
    return both.applyInArrow(run, "anchor long, digest long, places long, segments long, words string")


def repeated_windows(texts: pa.Array, places: np.ndarray, window: int) -> list[list[int]]:
    """For each text, the stretches [a, b, a, b, ...] of windows whose words start more than once in ``texts``, where
    each text counts ``places`` times. Equal hashes propose, words decide."""
    words = split(*utf8(texts))
    starts = np.flatnonzero(words.text_of()[: max(0, len(words) - window + 1)] == words.text_of()[window - 1 :])
    text = words.text_of()[starts] if len(words) else starts
    data = words.data.tobytes()
    known: dict[bytes, int] = {}
    spans = zip(words.starts.tolist(), words.ends.tolist())
    ids = np.array([known.setdefault(data[a:b], len(known)) for a, b in spans], dtype=np.int64)
    hashes = Runs(ids.astype(np.uint64), WORD_BASES[0]).hashes(starts, starts + window)
    _, first, kind = np.unique(hashes, return_index=True, return_inverse=True)
    inside = np.arange(window)
    unlike = np.zeros(len(starts), dtype=bool)
    for at in range(0, len(starts), SHARD_WINDOWS):
        part = slice(at, at + SHARD_WINDOWS)
        unlike[part] = (ids[starts[part, None] + inside] != ids[starts[first[kind[part]], None] + inside]).any(axis=1)
    for k in np.unique(kind[unlike]):  # different words with one hash
        of = np.flatnonzero(kind == k)
        _, apart = np.unique(ids[starts[of, None] + inside], axis=0, return_inverse=True)
        kind[of] = kind.max() + 1 + apart.ravel()
    again = np.bincount(kind, weights=places[text])[kind] > 1 if len(kind) else unlike
    per_text = np.split(again, np.searchsorted(text, np.arange(1, len(texts))))
    return [stretches(x) for x in per_text]


def stretches(marked: np.ndarray) -> list[int]:
    """Begin and end, on end, of each run of true values."""
    return np.flatnonzero(np.diff(np.concatenate([[False], marked, [False]]).astype(np.int8))).tolist()


def _confirmed(cut: DataFrame, window: int) -> DataFrame:
    """Stretches of repeated windows in the segments of anchors that few different segments share, which are brought
    together and compared."""

    def flush(shard: list[tuple]) -> pa.RecordBatch:
        spans = repeated_windows(pa.array([s[3] for s in shard]), np.array([s[2] for s in shard]), window)
        kept = [(s[0], s[1], x) for s, x in zip(shard, spans) if x]
        columns = list(zip(*kept)) or [[]] * 3
        kinds = [pa.int64()] * 2 + [pa.list_(pa.int32())]
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=[*SEGMENT, "windows"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in [*SEGMENT, "places", "words"])):
                if size > SHARD_CHARS and row[0] != shard[-1][0]:
                    yield flush(shard)
                    shard, size = [], 0
                shard.append(row)
                size += len(row[3])
        if shard:
            yield flush(shard)

    few = cut.filter(F.col("segments") <= HOT_SEGMENTS).select(*SEGMENT, "places", "words")
    return few.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, "anchor long, digest long, windows array<int>")


def _counted(cut: DataFrame, window: int) -> DataFrame:
    """The same for anchors that many different segments share: each window is counted by the 128-bit digest of its
    words, with map-side combination, so neither the anchor nor a window ever has all its rows in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for a, d, places, text in zip(*(batch.column(c).to_pylist() for c in [*SEGMENT, "places", "words"])):
                words = text.encode().split(b" ")
                for i in range(len(words) - window + 1):
                    rows.append((a, d, places, i, hashlib.md5(b" ".join(words[i : i + window])).digest()))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
            columns = list(zip(*rows)) or [[]] * 5
            names = [*SEGMENT, "places", "i", "window"]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    many = cut.filter(F.col("segments") > HOT_SEGMENTS).select(*SEGMENT, "places", "words").repartition(*SEGMENT)
    each = many.mapInArrow(run, "anchor long, digest long, places long, i int, window binary")
    counts = each.groupBy("window").agg(F.sum("places").alias("n")).filter("n > 1").select("window")
    kept = each.select(*SEGMENT, "i", "window").join(written(counts, "windows"), "window")
    kept = kept.groupBy(*SEGMENT).agg(F.sort_array(F.collect_set("i")).alias("at"))
    heads = F.filter("at", lambda x: ~F.array_contains("at", x - 1))
    tails = F.filter("at", lambda x: ~F.array_contains("at", x + 1))
    spans = F.flatten(F.zip_with(heads, tails, lambda a, b: F.array(a, b + 1)))
    return kept.select(*SEGMENT, spans.alias("windows"))


def covered(texts: pa.Array, wanted: pa.Table, window: int, gram: int) -> tuple[Words, np.ndarray]:
    """The words of all texts, and which of them passages of ``wanted`` cover: for each segment the stretches of its
    windows that repeat, all of it where they are null.

    The first copy of each passage is compiled; the automaton finds it wherever else it stands.
    """
    words = split(*utf8(texts))
    gone = np.zeros(len(words) + 1, dtype=np.int64)
    _, anchor, digest, first, n = segments_of(words, window, gram)
    at, row = _found(wanted, anchor, digest)
    if not len(at):
        return words, gone[:-1] > 0
    data = words.data.tobytes()
    known: dict[bytes, int] = {}
    spans = zip(words.starts.tolist(), words.ends.tolist())
    ids = [known.setdefault(data[a:b], len(known)) for a, b in spans]
    symbols = (np.array(ids, dtype=np.int64) % SYMBOLS).tolist()
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    listed = wanted.column("windows").to_pylist()
    for begin, count, r in zip(first[at].tolist(), n[at].tolist(), row.tolist()):
        within = [0, count] if listed[r] is None else listed[r]
        for a, b in zip(within[::2], within[1::2]):
            a, b = begin + a, begin + b + window - 1
            alike = automaton.get(key := tuple(symbols[a:b]), None)
            if alike is None:
                automaton.add_word(key, (b - a, {tuple(ids[a:b])}))
            else:
                alike[1].add(tuple(ids[a:b]))
    automaton.make_automaton()
    for i in range(len(words.first) - 1):
        base, end = int(words.first[i]), int(words.first[i + 1])
        if end - base < window:
            continue
        for last, (size, passages) in automaton.iter(tuple(symbols[base:end])):
            b = base + last + 1
            if tuple(ids[b - size : b]) in passages:
                gone[b - size] += 1
                gone[b] -= 1
    return words, np.cumsum(gone)[:-1] > 0


def _streamed(texts: DataFrame, wanted: DataFrame, window: int, gram: int) -> DataFrame:
    """What is left of each different text once the passages of its bucket are found in it."""

    def run(texts: pa.Table, wanted: pa.Table) -> pa.Table:
        words, gone = covered(texts.column("text").combine_chunks(), wanted, window, gram)
        data, starts, ends = words.data.tobytes(), words.starts, words.ends
        rows = []
        for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
            at = a + np.flatnonzero(~gone[a:b])
            kept = b" ".join([data[s:e] for s, e in zip(starts[at].tolist(), ends[at].tolist())])
            rows.append((b - a, b - a - len(at), hashlib.sha256(kept).hexdigest(), kept.decode()))
        names = ["n_words", "n_removed", "kept_sha256", "kept_text"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
        out = texts.select(TEXT)
        for name, column, kind in zip(names, list(zip(*rows)) or [[]] * 4, kinds):
            out = out.append_column(name, pa.array(column, kind))
        return out

    both = texts.select("bucket", *TEXT, "text").groupBy("bucket").cogroup(wanted.groupBy("bucket"))
    return both.applyInArrow(
        run, "h1 long, h2 long, n_words long, n_removed long, kept_sha256 string, kept_text string"
    )


def passages_of(texts: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``bucket``, ``anchor``, ``digest`` of the segments that hold repeated windows, and ``windows``: the stretches of
    these, or null for all windows of the segment."""
    segments = written(_segments(texts, window, gram), "segments")
    different = segments.groupBy(*SEGMENT).agg(F.sum("places").alias("places"), F.min("bucket").alias("bucket"))
    different = written(different, "different")
    anchors = different.groupBy("anchor").agg(F.sum("places").alias("all"), F.count(F.lit(1)).alias("segments"))
    anchors = written(anchors.filter("all > 1").select("anchor", "segments"), "anchors")
    candidates = written(different.join(anchors, "anchor"), "candidates")
    dropped(different, anchors)
    mixed = candidates.filter("segments > 1")
    cut = written(_cut(texts, mixed.select("bucket", *SEGMENT, "places", "segments"), window, gram), "cut")
    whole = candidates.filter("places > 1").select(*SEGMENT, F.lit(None).cast("array<int>").alias("windows"))
    part = _confirmed(cut, window).unionByName(_counted(cut, window)).join(whole.select(*SEGMENT), SEGMENT, "left_anti")
    confirmed = written(whole.unionByName(part), "confirmed")
    dropped(cut, candidates)
    return segments.select("bucket", *SEGMENT).join(confirmed, SEGMENT)


def without_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Documents without the words that repeated windows cover.

    A window whose words also start anywhere else, in the same or another row, is repeated; all its words go.
    Windows are judged on the input. One row per input row: ``doc_id``, ``n_words``, ``n_removed``,
    ``kept_sha256`` and ``kept_text`` (kept words joined by one space). Null or blank text has no words; texts
    shorter than a window stay whole. Repeated rows repeat each other's windows. An empty table gives no rows; other
    columns are not read.
    """
    keyed = _keyed(docs)
    texts = _texts(keyed)
    kept = _streamed(texts, passages_of(texts, window, gram), window, gram)
    return keyed.select("doc_id", *TEXT).join(kept, TEXT).drop(*TEXT)
