"""Packing along a space-filling curve.

A document's tokens are counted into hashed buckets; a fixed random matrix projects that vector to a few dimensions,
which are cut into cells of equal share and numbered along the Hilbert curve. Documents are range-sorted by that
number, so neighbours in a sequence are alike, and laid end to end into sequences.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.shared import written
from pairloom.llm.tokens import ID, words
from pairloom.llm.words import grouped, mixed

SEQUENCE = 4096
END_ID = 2
DIMENSIONS = 4
CELL_BITS = 8
BUCKETS = 4096
SEED = 20
ROWS_OUT = 20_000
GROUP_BYTES = 1 << 22  # of text, whose distinct units are looked up together
RANGE_IDS = 1 << 24  # in the part of the curve that a task packs

PIECE_DDL = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, curve long"
)


def projection(n_ids: int) -> np.ndarray:
    """Row i: where a token with id i pulls its document, by the hashed bucket of the id."""
    matrix = np.random.default_rng(SEED).standard_normal((BUCKETS, DIMENSIONS)).astype(np.float32)
    return matrix[(mixed(np.arange(n_ids, dtype=np.uint64)) % np.uint64(BUCKETS)).astype(np.int64)]


def tokenized(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id``, ``ids`` (little-endian 16-bit, or 32-bit for a larger vocabulary; END_ID last), their number and
    the projected coordinates of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = words(tokenizer)
        pull = projection(known.n_ids)
        kind = narrow(known.n_ids)
        last = np.array([END_ID], dtype=ID).tobytes()
        for batch in grouped(batches, GROUP_BYTES):
            found = known.ids([t or "" for t in batch.column("text").to_pylist()])
            sizes = np.array([len(x) // ID.itemsize + 1 for x in found])
            ids = np.frombuffer(last.join([*found, b""]), dtype=ID)
            ends = np.cumsum(sizes)
            place = np.add.reduceat(pull[ids], ends - sizes, axis=0, dtype=np.float64) / sizes[:, None]
            stored = ids.astype(kind).tobytes()
            cuts = [0, *(ends * kind.itemsize).tolist()]
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    pa.array([stored[a:b] for a, b in zip(cuts, cuts[1:])], pa.binary()),
                    pa.array(sizes),
                    *(pa.array(place[:, d]) for d in range(DIMENSIONS)),
                ],
                names=["doc_id", "ids", "doc_tokens", *(f"x{d}" for d in range(DIMENSIONS))],
            )

    coordinates = ", ".join(f"x{d} double" for d in range(DIMENSIONS))
    ddl = f"doc_id long, ids binary, doc_tokens long, {coordinates}"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, ddl)


def narrow(n_ids: int) -> np.dtype:
    return np.dtype("<u2") if n_ids <= 1 << 16 else ID


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points with integer coordinates below 2**bits, by Skilling (2004): undo the
    turns of each level from the highest bit down, then Gray-decode, then interleave the bits."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for i in range(n):
            turned = (x[i] >> level & 1).astype(bool)
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(turned, low, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[n - 1] >> level & 1, (1 << level) - 1, 0)
    x ^= flip
    out = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            out = out << 1 | x[i] >> level & 1
    return out


def on_curve(rows: DataFrame) -> tuple[DataFrame, int]:
    """``curve``: the Hilbert number of each row. Cells hold equal shares of a normal spread around the mean of all
    documents; the outermost cells are open. And the number of all ids."""
    axes = [f"x{d}" for d in range(DIMENSIONS)]
    spread = rows.agg(*(f(c) for c in axes for f in (F.avg, F.stddev_pop)), F.sum("doc_tokens")).first()
    means = np.array([spread[2 * d] or 0.0 for d in range(DIMENSIONS)])
    sizes = np.array([spread[2 * d + 1] or 1.0 for d in range(DIMENSIONS)])

    @F.pandas_udf("long")
    def number(*place: pd.Series) -> pd.Series:
        z = (np.column_stack([p.to_numpy() for p in place]) - means) / sizes
        share = 1 / (1 + np.exp(-1.702 * z))  # close to the normal distribution function
        cells = np.minimum((share * (1 << CELL_BITS)).astype(np.int64), (1 << CELL_BITS) - 1)
        return pd.Series(hilbert(cells, CELL_BITS))

    return rows.withColumn("curve", number(*axes)), spread[-1] or 0


def sequences_of(documents: Iterator[tuple], kind: np.dtype) -> Iterator[tuple]:
    """Pieces (doc_id, start, length, crc32, doc_tokens, sequence, offset, curve) of (doc_id, ids, curve) laid end to
    end. The last tokens, too few for a whole sequence, go into sequences of powers of two, so nothing is padded."""
    waiting: deque[list] = deque()
    held, sequence = 0, 0

    def cut(length: int) -> Iterator[tuple]:
        nonlocal held, sequence
        offset = 0
        while offset < length:
            piece = waiting[0]
            doc_id, ids, curve, start = piece
            n = min(len(ids) - start, length - offset)
            crc = zlib.crc32(ids[start : start + n].astype(ID).tobytes())
            yield doc_id, start, n, crc, len(ids), sequence, offset, curve
            offset += n
            piece[3] += n
            if piece[3] == len(ids):
                waiting.popleft()
        held -= length
        sequence += 1

    for doc_id, ids, curve in documents:
        waiting.append([doc_id, np.frombuffer(ids, dtype=kind), curve, 0])
        held += len(waiting[-1][1])
        while held >= SEQUENCE:
            yield from cut(SEQUENCE)
    while held:
        yield from cut(1 << (held.bit_length() - 1))


def packed(docs: DataFrame, tokenizer: str) -> DataFrame:
    """One row per piece of a document in a sequence, for all rows of ``docs``.

    ``start`` counts the document's ids before the piece, ``ids_crc32`` is over its little-endian 32-bit ids,
    ``doc_tokens`` counts the ids with the closing one, ``offset`` is the piece's place in its sequence, ``curve``
    the document's number along the curve. Every id lies in one piece; sequences are full, or a power of two long.
    Null and empty texts have the closing id alone. Repeated rows are packed each. Documents longer than a
    sequence run on in the next ones. Each task packs its own range of the curve and numbers its sequences from
    its partition on, so no task waits for another. An empty table gives no rows; other columns are not read.
    """
    rows = written(tokenized(docs, tokenizer), "tokens")
    placed, n_ids = on_curve(rows.withColumn("h", F.xxhash64("ids")))
    order = ["curve", "doc_id", "h"]
    dealt = placed.select(*order, "ids").repartitionByRange(1 + n_ids // RANGE_IDS, *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = narrow(words(tokenizer).n_ids)
        first = TaskContext.get().partitionId() << 40
        documents = (
            row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "ids", "curve")))
        )
        names = [c.split()[0] for c in PIECE_DDL.split(", ")]
        rows: list[tuple] = []

        def batch_of() -> pa.RecordBatch:
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
            columns[5] = pa.array([first + x for x in columns[5].to_pylist()], pa.int64())
            return pa.record_batch(columns, names=names)

        for piece in sequences_of(documents, kind):
            rows.append(piece)
            if len(rows) == ROWS_OUT:
                yield batch_of()
                rows = []
        if rows:
            yield batch_of()

    return dealt.mapInArrow(run, PIECE_DDL)
