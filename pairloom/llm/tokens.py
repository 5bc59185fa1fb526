"""Token ids of whole texts, with the ids of what the splitting rule makes of them kept between texts.

``word_bpe_49k.json`` lower-cases, splits into units (runs of letters, single digits, contractions, runs of anything
else) and encodes each unit alone. In texts of ASCII and Latin-1 letters, which no normalization changes but for their
case, the same rule is applied here to the bytes of many texts at a time. Arrow numbers the distinct units, so each is
looked up once for all its places, and only units not seen before are encoded. In other texts the ids of white-space
separated words are kept, as the rule never looks across white space.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

KNOWN = 200_000  # words in each of two generations per worker, about 40 MB each; half of the units, about 4 MB
ID = np.dtype("<u4")
SPECIAL = "<|"  # a text that names a special token is left to the tokenizer

SIMPLE = re.compile("[\t\n\x0b\x0c\r\x20-\x7eÀ-ÖØ-öø-ÿ]*+")
#: The tokenizer's splitting rule, for the bytes of lower-case texts of these letters. Letters beyond ASCII
#: have two bytes.
SPACE, LETTER, DIGIT, OTHER = range(4)
KIND = np.full(256, OTHER, dtype=np.uint8)
KIND[[0, 9, 10, 11, 12, 13, 32]] = SPACE  # 0 ends a text
KIND[48:58] = DIGIT
KIND[97:123] = KIND[128:] = LETTER
APOSTROPHE = ord("'")
SHORT, LONG = list(b"stmd"), [b"re", b"ve", b"ll"]  # what an apostrophe takes with it

#: How a byte-level model writes each byte as a character (fixed by such tokenizers): printable ones stand for themselves.
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_LEVEL = dict(zip([*PRINTABLE, *sorted(set(range(256)) - {*PRINTABLE})], [*PRINTABLE, *range(256, 256 + 68)]))
BYTE_LEVEL[ord(" ")] = " "  # between units

_open: dict[str, Words] = {}


def units(texts: list[str]) -> tuple[pa.LargeStringArray, np.ndarray]:
    """The units of all texts in their order, and for each text the number of units up to its end. Texts are of
    SIMPLE's letters in lower case."""
    data = np.frombuffer("\0".join([*texts, "", ""]).encode(), dtype=np.uint8)
    kind = KIND[data]
    begins = np.ones(len(data) + 1, dtype=bool)
    begins[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
    mark = np.flatnonzero((data == APOSTROPHE) & begins[:-1])
    one, two = data[mark + 1], data[mark + 2]
    short = np.isin(one, SHORT)
    long = np.any([(one == x) & (two == y) for x, y in LONG], axis=0)
    begins[mark[short | long] + 1] = False
    begins[mark[short] + 2] = True
    begins[mark[long] + 3] = True
    inner = kind != SPACE
    begins[:-1] &= inner
    offsets = np.append(np.flatnonzero(begins[:-1][inner]), np.count_nonzero(inner))
    found = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(data[inner]))
    return found, np.cumsum(begins[:-1])[np.flatnonzero(data == 0)[: len(texts)]]


class Known:
    """Ids by word. What was not used for long is forgotten: if there are too many, the older half goes, and
    what is used again comes back from it."""

    def __init__(self):
        self.now: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def unknown(self, wanted: set[str]) -> set[str]:
        new = wanted.difference(self.now)
        if new and len(self.now) > KNOWN:
            self.older, self.now = self.now, {}
            new = wanted
        if new:
            older = self.older
            again = {w: older[w] for w in new if w in older}
            self.now.update(again)
            new = new.difference(again)
        return new


class Units:
    """Ids by unit, as arrays, so that many units are looked up at a time. If there are too many, those not used for the
    longest are forgotten."""

    def __init__(self):
        self.units = pa.array([], pa.large_string())
        self.ids = np.empty(0, ID)  # of all units, on end
        self.sizes = np.empty(0, np.int64)
        self.used = np.empty(0, np.int64)  # the last call that wanted the unit
        self.calls = 0

    def places(self, wanted: pa.LargeStringArray, encode: Callable[[list[str]], list[list[int]]]) -> tuple[np.ndarray, ...]:
        """For each of the distinct units ``wanted``, where its ids begin in ``ids`` and how many there are."""
        self.calls += 1
        if len(self.units) > 2 * KNOWN:
            self._forget()
        at = pc.index_in(wanted, value_set=self.units).fill_null(-1).to_numpy().astype(np.int64)
        new = at < 0
        if new.any():
            units = wanted.filter(pa.array(new))
            found = encode(units.to_pylist())
            at[new] = np.arange(len(self.units), len(self.units) + len(units))
            self.units = pa.concat_arrays([self.units, units])
            self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(found), ID)])
            self.sizes = np.concatenate([self.sizes, np.fromiter(map(len, found), np.int64)])
            self.used = np.concatenate([self.used, np.empty(len(units), np.int64)])
        self.used[at] = self.calls
        return (np.cumsum(self.sizes) - self.sizes)[at], self.sizes[at]

    def _forget(self) -> None:
        keep = np.zeros(len(self.units), dtype=bool)
        keep[np.argsort(self.used, kind="stable")[-KNOWN:]] = True
        self.units = self.units.filter(pa.array(keep))
        self.ids = self.ids[np.repeat(keep, self.sizes)]
        self.sizes, self.used = self.sizes[keep], self.used[keep]


class Words:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.n_ids = max(vocabulary.values()) + 1
        self.model = self.tokenizer.model
        self.units, self.words = Units(), Known()

    def ids(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        simple = [SIMPLE.fullmatch(t) is not None and SPECIAL not in t for t in texts]
        by_unit = iter(self._by_unit([t.lower() for t, s in zip(texts, simple) if s]))
        by_word = iter(self._by_word([t for t, s in zip(texts, simple) if not s]))
        return [next(by_unit if s else by_word) for s in simple]

    def _by_unit(self, texts: list[str]) -> list[bytes]:
        found, last = units(texts)
        numbered = found.dictionary_encode()
        starts, sizes = self.units.places(numbered.dictionary, self._encode_units)
        number = numbered.indices.to_numpy()
        counts = sizes[number]
        ends = np.cumsum(counts)
        shift = starts[number] - (ends - counts)  # from an id's place to that of the unit's known id
        ids = self.units.ids[np.arange(counts.sum()) + np.repeat(shift, counts)].tobytes()
        cuts = [0, *(np.append(0, ends)[last] * ID.itemsize).tolist()]
        return [ids[a:b] for a, b in zip(cuts, cuts[1:])]

    def _by_word(self, texts: list[str]) -> list[bytes]:
        parts = [[w.decode() for w in t.encode().split()] for t in texts]
        self._learn_words(list(self.words.unknown(set().union(*parts))))
        return [b"".join(map(self.words.now.__getitem__, p)) for p in parts]

    def _learn_words(self, new: list[str]) -> None:
        self.words.now.update((w, ids.tobytes()) for w, ids in zip(new, self._encode(new)))

    def _encode_units(self, new: list[str]) -> list[list[int]]:
        written = " ".join(new).encode().decode("latin-1").translate(BYTE_LEVEL).split()
        return [[x.id for x in self.model.tokenize(w)] for w in written]

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False) if texts else []
        return [np.array(x.ids, dtype=ID) for x in found]


def words(path: str) -> Words:
    """The tokenizer of this worker; it stays open between tasks."""
    if path not in _open:
        _open[path] = Words(path)
    return _open[path]
