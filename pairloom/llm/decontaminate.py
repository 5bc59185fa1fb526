"""Benchmark decontamination: pigeonhole edit matching over words.

A benchmark item is searched as passages of ``PASSAGE`` words that overlap by half, so that a document that holds
only a part of it is found too. A passage with an error budget of k is split into k + 1 pieces: a place where it
stands with at most k word edits holds one piece unchanged. Documents are scanned for the pieces by rolling hashes;
each hit is verified with Myers' bit-parallel distance on the words around it.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.shared import dropped, written
from pairloom.llm.words import WORD_BASES, Runs, Words, chunks, utf8, word_hashes

PASSAGE = 24
ERRORS_PER_WORD = 1 / 6
MIN_WORDS = 8  # items of fewer words match only whole and unchanged
BLOCK_ITEMS = 20_000  # items compiled and sent to the tasks at once; more are searched in further passes

#: Letters, digits and marks make words, by code point; case and punctuation do not count. Letters of scripts that
#: are written without spaces are words of their own.
IN_WORD, APART, ALONE = 0, 1, 2
UNSPACED = [(0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF), (0x1A20, 0x1AAF), (0x3005, 0x3007),
            (0x3031, 0x312F), (0x31A0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0xA4CF), (0xA980, 0xA9DF), (0xA9E0, 0xA9FF),
            (0xAA60, 0xAADF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1AFF0, 0x1B16F), (0x20000, 0x3FFFF)]
KINDS = np.zeros(0x110000, dtype=np.uint8)
for _a, _b in UNSPACED:
    KINDS[_a : _b + 1] = ALONE
KINDS[[i for i in range(len(KINDS)) if unicodedata.category(chr(i))[0] in "PSZ" or unicodedata.category(chr(i)) == "Cc"]] = APART
KINDS[0x200B] = APART  # a space without width

MATCH_DDL = "doc_id long, item_id long, distance int, budget int, first_word int, last_word int"


def normal_words(texts: pa.Array) -> Words:
    data, at = utf8(pc.utf8_lower(pc.fill_null(texts, "")))
    kind = KINDS[:256][data]
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        size = 2 + (data[lead] >= 0xE0) + (data[lead] >= 0xF0)
        point = (data[lead] & (0x7F >> size)).astype(np.int64)
        for i in range(1, 4):
            more = np.flatnonzero(size > i)
            point[more] = point[more] << 6 | data[lead[more] + i] & 0x3F
        for i in range(4):
            more = np.flatnonzero(size > i)
            kind[lead[more] + i] = KINDS[point[more]]
    inner = kind != APART
    new = np.ones(len(data) + 1, dtype=bool)  # no word goes on over here
    new[1:-1] = ~(inner[1:] & inner[:-1]) | (((kind[1:] == ALONE) | (kind[:-1] == ALONE)) & (data[1:] & 0xC0 != 0x80))
    new[at] = True
    starts = np.flatnonzero(inner & new[:-1])
    ends = np.flatnonzero(inner & new[1:]) + 1
    return Words(data, starts, ends, np.searchsorted(starts, at))


@dataclass
class Passage:
    item_id: int
    words: np.ndarray  # hashes
    budget: int

    def pieces(self) -> list[tuple[int, int]]:
        """budget + 1 word ranges of nearly equal length that make up the passage."""
        cuts = [len(self.words) * i // (self.budget + 1) for i in range(self.budget + 2)]
        return list(zip(cuts, cuts[1:]))


def passages_of(item_id: int, words: np.ndarray) -> list[Passage]:
    if len(words) < MIN_WORDS:
        return [Passage(item_id, words, 0)] if len(words) else []
    starts = [0] if len(words) <= PASSAGE else [*range(0, len(words) - PASSAGE, PASSAGE // 2), len(words) - PASSAGE]
    parts = [words[s : s + PASSAGE] for s in starts]
    return [Passage(item_id, p, int(len(p) * ERRORS_PER_WORD)) for p in parts]


class Pieces:
    """Hashes of all pieces of some passages, by length, each with its passage and place in it."""

    def __init__(self, passages: list[Passage]):
        self.passages = passages
        found: dict[int, list[tuple[int, int, int]]] = {}
        for number, passage in enumerate(passages):
            runs = Runs(passage.words, WORD_BASES[0])
            for a, b in passage.pieces():
                digest = int(runs.hashes(np.array([a]), np.array([b]))[0])
                found.setdefault(b - a, []).append((digest, number, a))
        self.by_length = {}
        for length, rows in found.items():
            rows.sort()
            digests, numbers, places = (np.array(c, dtype=k) for c, k in zip(zip(*rows), (np.uint64, np.int64, np.int64)))
            filled = np.zeros(1 << 20, dtype=bool)  # by the low bits: most words are told to be no piece at once
            filled[digests & np.uint64(len(filled) - 1)] = True
            self.by_length[length] = digests, numbers, places, filled

    def hits(self, hashes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Word positions, passage numbers and where in the passage the piece begins."""
        runs = Runs(hashes, WORD_BASES[0])
        for length, (digests, numbers, places, filled) in self.by_length.items():
            i = np.arange(max(len(hashes) - length + 1, 0))
            own = runs.hashes(i, i + length)
            i = np.flatnonzero(filled[own & np.uint64(len(filled) - 1)])
            a, b = np.searchsorted(digests, own[i], "left"), np.searchsorted(digests, own[i], "right")
            n = b - a
            rows = np.repeat(a, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            yield np.repeat(i, n), numbers[rows], places[rows]


def myers(passage: list[int], text: list[int]) -> tuple[int, int]:
    """Least edit distance of ``passage`` to a run of ``text``, and the first end at which it is reached.

    Rows of the distance table are bits of one integer, as in Myers (1999); the start of the run is free.
    """
    m = len(passage)
    masks: dict[int, int] = {}
    for i, word in enumerate(passage):
        masks[word] = masks.get(word, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, distance = full, 0, m
    best = (m, 0)
    for end, word in enumerate(text, 1):
        equal = masks.get(word, 0)
        diagonal = ((((equal & plus) + plus) ^ plus) | equal | minus) & full
        up, down = (minus | ~(diagonal | plus)) & full, plus & diagonal
        distance += bool(up & top) - bool(down & top)
        up, down = up << 1 & full, down << 1 & full
        plus, minus = (down | ~((equal | minus) | up)) & full, up & (equal | minus)
        if distance < best[0]:
            best = (distance, end)
    return best


def matches_in(words: Words, pieces: Pieces) -> dict[tuple[int, int], tuple[int, int, int, int]]:
    """(text number, item_id): least distance, its budget, first and last word in the text of the matched run."""
    hashes = word_hashes(words)
    text_of = words.text_of()
    tried: set[tuple[int, int]] = set()
    whole: set[tuple[int, int]] = set()  # texts and passages without a budget: the first place is enough
    out: dict[tuple[int, int], tuple[int, int, int, int]] = {}
    for positions, numbers, places in pieces.hits(hashes):
        for position, number, place in zip(positions.tolist(), numbers.tolist(), places.tolist()):
            start = position - place
            if (start, number) in tried:
                continue
            tried.add((start, number))
            passage, text = pieces.passages[number], int(text_of[position])
            if (text, number) in whole:
                continue
            k, begin = passage.budget, int(words.first[text])
            a = max(start - k, begin)
            b = min(start + len(passage.words) + k, int(words.first[text + 1]))
            distance, end = myers(passage.words.tolist(), hashes[a:b].tolist())
            if distance <= k:
                run = (distance, k, max(start, begin) - begin, a + end - 1 - begin)
                key = (text, passage.item_id)
                out[key] = min(out.get(key, run), run)
                if not k:
                    whole.add((text, number))
    return out


def _blocks(benchmark: DataFrame) -> Iterator[list[Passage]]:
    """Passages of all items, BLOCK_ITEMS items at a time."""
    items = benchmark.filter("item_id is not null and text is not null").select("item_id", "text").distinct()
    n = max(1, -(-items.count() // BLOCK_ITEMS))
    for block in range(n):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block).collect()
        words = normal_words(pa.array([r.text for r in rows], pa.string()))
        hashes = word_hashes(words)
        yield [p for i, r in enumerate(rows) for p in passages_of(r.item_id, hashes[words.first[i] : words.first[i + 1]])]


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of ``docs`` and item that it holds a passage of: ``doc_id``, ``item_id``, the least
    ``distance`` in words, its ``budget``, and the run of the document, ``first_word`` (exact but for the edits) to
    ``last_word``.

    Words are runs of letters and digits, in lower case; of scripts without spaces, single letters. Items of under
    MIN_WORDS words are searched whole, without edits; items without words match nothing; rows with a null doc_id are searched like any other; repeated items count once, repeated
    documents each. The benchmark is the query set: BLOCK_ITEMS items at a time are sent to the tasks, in as many
    passes over ``docs`` as it takes. Long texts are searched whole. Other columns are not read.
    """
    parts = [_scan(docs, passages) for passages in _blocks(benchmark)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no passage of ``benchmark``, all columns unchanged; matching as above. Each row
    is judged where it is read, so nothing is shuffled. What a pass leaves is written for the next one: a task of all
    passes would have a Python worker with compiled pieces for each."""
    blocks = _blocks(benchmark)
    out, last = _without(docs, next(blocks)), None
    for passages in blocks:
        kept = written(out, "decontaminated")
        if last is not None:
            dropped(last)
        out, last = _without(kept, passages), kept
    return out


def _without(docs: DataFrame, passages: list[Passage]) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(passages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(sent.value)
        for batch in chunks(batches):
            keep = np.ones(batch.num_rows, dtype=bool)
            keep[[text for text, _ in matches_in(normal_words(batch.column("text")), pieces)]] = False
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


def _scan(docs: DataFrame, passages: list[Passage]) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(passages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(sent.value)
        for batch in chunks(batches):
            found = matches_in(normal_words(batch.column("text")), pieces)
            ids = batch.column("doc_id").to_pylist()
            rows = [(ids[text], item, *run) for (text, item), run in sorted(found.items())]
            if rows:
                kinds = [pa.int64()] * 2 + [pa.int32()] * 4
                names = ["doc_id", "item_id", "distance", "budget", "first_word", "last_word"]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, MATCH_DDL)
