"""SimHash near-duplicates by multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.components import components
from pairloom.llm.shared import carried, dropped, written
from pairloom.llm.words import ASCII_LOWER, chunks, joined, split, utf8

HALF_BITS = 32
MAX_DISTANCE = 3
RADIUS = MAX_DISTANCE // 2  # two halves that differ in 3 bits together: one of them in 1 bit at most


def simhashes(texts: pa.Array, shingle_words: int) -> np.ndarray:
    """64-bit fingerprints of texts: a bit is set if it is set in over half the shingle hashes."""
    data, at = utf8(texts)
    words = joined(split(ASCII_LOWER[data], at))
    n_words = np.diff(words.first)
    n_shingles = np.where(n_words == 0, 0, np.maximum(n_words - shingle_words + 1, 1))
    last = np.cumsum(n_shingles)
    begin = np.repeat(words.first[:-1] - (last - n_shingles), n_shingles) + np.arange(last[-1] if len(last) else 0)
    end = np.minimum(begin + shingle_words, np.repeat(words.first[1:], n_shingles))
    buffer, digest = words.data.tobytes(), xxhash.xxh64_intdigest
    spans = zip(words.starts[begin].tolist(), words.ends[end - 1].tolist())
    hashes = np.fromiter((digest(buffer[s:e], 42) for s, e in spans), dtype=np.uint64, count=len(begin))
    out = np.zeros(len(n_words), dtype=np.uint64)
    full = np.flatnonzero(n_shingles)
    if len(full):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts = np.add.reduceat(bits, (last - n_shingles)[full], axis=0, dtype=np.int64)
        on = 2 * counts > n_shingles[full, None]
        out[full] = np.packbits(on, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def fingerprints(docs: DataFrame, shingle_words: int = 3) -> DataFrame:
    """``doc_id``, ``text_hash`` and ``fp`` (the 64 bits as a signed long) of every row; null or blank text has
    fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            fp = pa.array(simhashes(batch.column("text"), shingle_words).view(np.int64))
            columns = [batch.column("doc_id"), batch.column("text_hash"), fp]
            yield pa.record_batch(columns, names=["doc_id", "text_hash", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(run, "doc_id long, text_hash long, fp long")


def links(fps: DataFrame) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints ``fp`` that differ in at most 3 bits.

    Each fingerprint is stored under both of its 32-bit halves. Of two halves that differ in one bit, the
    one without the bit reaches the other, so a fingerprint asks for its half and for its half with each
    unset bit set. What the table returns is verified over all 64 bits inside the join, so only links leave it.

    The join is never a broadcast: Spark sizes rows as if ``explode`` made one of each, and would send all questions, 17 of
    each half on average, through the driver.
    """
    low = F.col("fp").bitwiseAND(F.lit((1 << HALF_BITS) - 1))
    high = F.shiftrightunsigned("fp", HALF_BITS)
    sides = F.array(F.struct(F.lit(0).alias("side"), low.alias("half")), F.struct(F.lit(1).alias("side"), high.alias("half")))
    stored = fps.select("fp", F.explode(sides).alias("s")).select("fp", "s.side", "s.half")
    ball = F.expr(
        f"""concat(array(half), transform(
              filter(sequence(0, {HALF_BITS - 1}), i -> (shiftrightunsigned(half, i) & 1L) = 0L),
              i -> half | shiftleft(1L, i)))"""
    )
    asked = stored.select(F.col("fp").alias("a"), "side", F.col("half").alias("own"), F.explode(ball).alias("half"))
    found = stored.withColumnRenamed("fp", "b").hint("merge").join(asked.hint("merge"), ["side", "half"])
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_DISTANCE
    once = (F.col("own") != F.col("half")) | (F.col("a") < F.col("b"))
    return found.filter(near & once).select("a", "b")


def grouped(docs: DataFrame, shingle_words: int = 3) -> tuple[DataFrame, DataFrame]:
    """All rows of ``fingerprints``, and the ``root`` of each different ``fp``: equal for all that links connect.

    Documents with the same fingerprint are one node, so copies are never paired.
    """
    prints = written(fingerprints(docs, shingle_words), "fingerprints")
    nodes = written(prints.select("fp").distinct(), "distinct-fingerprints")
    roots = written(components(links(nodes)), "roots")
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = written(rooted.select("fp", F.coalesce("root", "fp").alias("root")), "rooted")
    dropped(nodes, roots)
    return prints, rooted


def near_duplicates(docs: DataFrame, shingle_words: int = 3) -> DataFrame:
    """One row per document: ``doc_id``, ``fp``, ``component_id`` (the smallest doc_id reached by links).

    Rows repeated in ``docs`` stay repeated. A null doc_id takes part, but is a component_id only where its component
    has no other. Empty tables give empty results; other columns of ``docs`` are not read.
    """
    prints, rooted = grouped(docs, shingle_words)
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least")).join(rooted, "fp")
    least = written(least.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    named = written(rooted.join(least, "root").select("fp", "component_id"), "components")
    dropped(least, rooted)
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, shingle_words: int = 3) -> DataFrame:
    """One row of each group of documents that links connect, all columns unchanged: that with the smallest doc_id;
    rows without one come last; among equal ids the one whose text hash is smallest.

    Texts without words have one fingerprint and are alike. Of repeated rows one stays. An empty table gives no rows.
    """
    prints, rooted = grouped(docs, shingle_words)
    row = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    least = written(prints.groupBy("fp").agg(F.min(row).alias("row")), "least")
    best = least.join(rooted, "fp").groupBy("root").agg(F.min("row").alias("best")).select("best.*")
    key = [F.coalesce("doc_id", F.lit(-1)).alias("_doc"), F.xxhash64("doc_id", "text_hash").alias("_hash")]
    best = written(best.select(*key), "best")
    dropped(prints, rooted, least)
    key = [F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash")]
    key = [F.coalesce(key[0], F.lit(-1)).alias("_doc"), F.xxhash64(*key).alias("_hash")]
    rows = docs.select(*key, *carried(tuple(docs.columns))).join(best, ["_doc", "_hash"], "left_semi")
    return rows.dropDuplicates(["_doc", "_hash"]).select(*carried(tuple(docs.columns), back=True))
