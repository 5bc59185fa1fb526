"""Document fingerprints: bottom-k sketches of shingle hashes, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

K = 256
SHINGLE_WORDS = 5
HASHES = float(2**64)
LEAST_HASH = float(-(2**63))

BUCKET_ROWS = 2_000
GROUP = 100  # bucket bounds are searched in two steps of at most so many: 10,000 buckets at most
NULL_SLICES = 64


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def sketch(words: Column, k: int = K, shingle_words: int = SHINGLE_WORDS) -> Column:
    """The k smallest different hashes of the shingles of an array of words, in order.

    Fewer words than a shingle are one shingle, no words are none. ``words`` must be a column of its own, or it is
    split anew for each shingle.
    """
    at = F.sequence(F.lit(0), F.size(words) - shingle_words)
    hashes = F.transform(at, lambda i: F.xxhash64(*(words[i + j] for j in range(shingle_words))))
    short = F.array(F.xxhash64(F.array_join(words, " ")))
    none = F.array().cast("array<bigint>")
    every = F.when(F.size(words) >= shingle_words, hashes).when(F.size(words) > 0, short).otherwise(none)
    return F.slice(F.sort_array(F.array_distinct(every)), 1, k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the shingles of both; any two parts of a corpus merge, in any order."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Number of different shingles: exact below k, else estimated from the k-th smallest hash."""
    share = (F.element_at(a, k).cast("double") - LEAST_HASH + 1) / HASHES
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard likeness, 0 to 1; 1 for two empty texts, 0 for an empty and another one."""
    both = merged(a, b, k)
    shared = F.size(F.array_intersect(F.array_intersect(a, b), both))
    return F.when(F.size(both) == 0, F.lit(1.0)).otherwise(shared / F.size(both))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has too; 1 for an empty ``a``."""
    both = distinct_shingles(merged(a, b, k), k) * resemblance(a, b, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), both / distinct_shingles(a, k)))


def printed(a: Column) -> Column:
    return F.array_join(F.transform(a, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def _bounds(docs: DataFrame) -> list[int]:
    """Values of doc_id, falling, between which there are about BUCKET_ROWS rows (more if there are very many)."""
    n = docs.count()
    m = min(max(1, n // BUCKET_ROWS), GROUP * GROUP)
    shares = F.array(*(F.lit(i / m) for i in range(1, m))) if m > 1 else None
    if shares is None:
        return []
    row = docs.agg(F.percentile_approx("doc_id", shares, 10 * m).alias("q")).first()
    return sorted(set(row.q or []), reverse=True)


def _bucket(doc_id: Column, text_hash: Column, bounds: list[int]) -> Column:
    """Number of the range of falling doc_id; rows without one come last, by ranges of their text's hash."""
    groups = [bounds[i : i + GROUP] for i in range(0, len(bounds), GROUP)]
    slices = F.floor((text_hash.cast("double") - LEAST_HASH) / HASHES * NULL_SLICES).cast("int")
    last = F.lit(len(bounds) + 1) + slices
    if not groups:
        return F.when(doc_id.isNull(), last).otherwise(F.lit(0))
    longs = lambda xs: F.array(*(F.lit(x).cast("long") for x in xs))
    whole = F.size(F.filter(longs([g[-1] for g in groups]), lambda b: doc_id < b))
    part = F.element_at(F.array(*(longs(g) for g in groups)), F.least(whole, F.lit(len(groups) - 1)) + 1)
    within = F.size(F.filter(part, lambda b: doc_id < b))
    found = F.when(whole == len(groups), F.lit(len(bounds))).otherwise(whole * GROUP + within)
    return F.when(doc_id.isNull(), last).otherwise(found)


def with_next(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and ``next_text``: that of the document with the next smaller doc_id, after the last one
    that of the first.

    Ranges of doc_id are sorted apart from one another. Each range also gets the first row of the range behind it,
    so that its last row finds its neighbour; there is one such row per range. Rows with the same doc_id, or
    without one, which come last, follow each other by a hash of their text. Null texts read as empty.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    bounds = _bounds(docs.select(F.col("doc_id").cast("long").alias("doc_id")))
    rows = rows.withColumn("h", F.xxhash64("text")).withColumn("falling", F.bitwise_not("doc_id"))
    rows = rows.withColumn("bucket", _bucket(F.col("doc_id"), F.col("h"), bounds))
    order = F.struct("falling", "h")
    heads = rows.groupBy("bucket").agg(F.min(order).alias("o")).select("bucket", "o.falling", "o.h")
    behind = W.orderBy("bucket")
    heads = heads.withColumn("before", F.coalesce(F.lag("bucket").over(behind), F.max("bucket").over(W.partitionBy())))
    copies = rows.join(
        heads.select("bucket", F.col("falling").alias("f"), F.col("h").alias("g"), "before"), "bucket"
    ).filter(F.col("f").eqNullSafe(F.col("falling")) & (F.col("g") == F.col("h")))
    copies = copies.dropDuplicates(["bucket"]).select("doc_id", "text", "h", "falling", F.col("before").alias("bucket"))
    every = rows.withColumn("copy", F.lit(0)).unionByName(copies.withColumn("copy", F.lit(1)))
    return every.withColumn("next_text", F.lead("text").over(in_order()))


def in_order() -> W:
    return W.partitionBy("bucket").orderBy("copy", F.col("falling").asc_nulls_last(), "h")


def compared(docs: DataFrame) -> DataFrame:
    """Fingerprints of all texts and of their edited forms, and how like they look.

    The last half of the code points of the edited text, rounded down, is replaced by as many of the beginning of
    the next document. Equal texts have equal fingerprints: the printed sketch. Besides the likenesses, estimated
    number of different shingles and share of them that the edited text keeps. Rows repeated in ``docs`` stay; null
    and empty texts have an empty fingerprint; an empty table gives no rows; other columns are not read.
    """
    rows = with_next(docs).withColumn("words", words_of(F.col("text")))
    rows = rows.withColumn("sketch", sketch(F.col("words"))).drop("words")
    rows = rows.withColumn("next_sketch", F.lead("sketch").over(in_order())).filter("copy = 0")
    n = F.char_length("text")
    cut = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next_text", F.lit(1), cut))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "sketch", "next_sketch")
    rows = rows.withColumn("words", words_of(F.col("edited")))
    rows = rows.withColumn("edited_sketch", sketch(F.col("words")))
    a, b = F.col("sketch"), F.col("edited_sketch")
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        printed(a).alias("fingerprint"),
        printed(b).alias("edited_fingerprint"),
        resemblance(a, b).alias("near_edited"),
        resemblance(a, F.col("next_sketch")).alias("near_next"),
        distinct_shingles(a).alias("n_shingles"),
        containment(a, b).alias("kept_share"),
    )
