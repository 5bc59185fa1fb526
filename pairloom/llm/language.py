"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.shared import dropped, written
from pairloom.llm.words import chunks

GRAMS = (1, 2, 3)
BUCKET_BITS = 14
BUCKETS = 1 << BUCKET_BITS
SMOOTHING = 0.5
FOLDS, HELD_OUT = 4, 2
MAX_LANGUAGES = 1_000  # bounds the broadcast matrix at 130 MB
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)
UNKNOWN = "und"


@cache
def letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def grams(texts: pa.Array) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """For each length of n-grams, their buckets text by text and how many each text has; which texts have a letter.

    Texts are lower-cased; runs of anything but letters count as one space, also before and after the text, so
    n-grams know where words begin and end.
    """
    lower = pc.utf8_lower(pc.fill_null(texts, ""))
    code = np.frombuffer("".join(lower.to_pylist()).encode("utf-32-le"), dtype=np.uint32)
    sizes = pc.utf8_length(lower).to_numpy(zero_copy_only=False).astype(np.int64)
    n = len(sizes)
    ends = np.cumsum(sizes)
    letter = letters()[code]
    has_letter = np.zeros(n, dtype=bool)
    owner = np.repeat(np.arange(n), sizes)
    has_letter[owner[letter]] = True
    # one space before and one behind each text, then runs of spaces are cut to one
    code = np.where(letter, code, 32)
    places = np.column_stack([ends - sizes, ends]).ravel()
    code, owner = np.insert(code, places, 32), np.insert(owner, places, np.repeat(np.arange(n), 2))
    keep = np.ones(len(code), dtype=bool)
    keep[1:] = (code[1:] != 32) | (code[:-1] != 32) | (owner[1:] != owner[:-1])
    code, owner = code[keep].astype(np.uint64), owner[keep]
    out = []
    for size in GRAMS:
        m = max(len(code) - size + 1, 0)
        h = np.full(m, size, dtype=np.uint64)
        for j in range(size):
            h += code[j : m + j] * np.uint64(MULTIPLIERS[j])
        h = (h ^ (h >> np.uint64(29))) * np.uint64(MULTIPLIERS[0])
        inside = owner[:m] == owner[len(owner) - m :]
        buckets = (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)[inside]
        out.append((buckets, np.bincount(owner[:m][inside], minlength=n)))
    return out, has_letter


def held_out(doc_id: Column, folds: int = FOLDS, fold: int = HELD_OUT) -> Column:
    """Whether crc32 of the id as text leaves the remainder ``fold``; false for null."""
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string")) % folds == fold, F.lit(False))


def trained(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in order, and the log-probability of each bucket in each of them.

    Counts are taken over all documents with a language that are not held out. Every language has the same prior.
    """
    known = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in chunks(batches):
            langs = pc.dictionary_encode(batch.column("lang"))
            code = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            own = np.zeros(len(langs.dictionary) * BUCKETS, dtype=np.int64)
            for buckets, sizes in grams(batch.column("text"))[0]:
                own += np.bincount(np.repeat(code, sizes) * BUCKETS + buckets, minlength=len(own))
            for lang, part in zip(langs.dictionary.to_pylist(), own.reshape(-1, BUCKETS)):
                counts[lang] = counts.get(lang, 0) + part
        for lang, own in counts.items():
            at = np.flatnonzero(own)
            names = pa.array([lang] * len(at), pa.string())
            yield pa.record_batch([names, pa.array(at.astype(np.int32)), pa.array(own[at])], names=["lang", "bucket", "n"])

    parts = known.select("lang", "text").mapInArrow(run, "lang string, bucket int, n long")
    total = written(parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "grams")
    if (found := total.agg(F.countDistinct("lang")).first()[0]) > MAX_LANGUAGES:
        raise ValueError(f"{found} languages; {MAX_LANGUAGES} at most make a model")
    rows = total.toPandas()
    dropped(total)
    langs = sorted(rows["lang"].unique())
    counts = np.zeros((len(langs), BUCKETS))
    counts[rows["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(dtype=int), rows["bucket"]] = rows["n"]
    counts += SMOOTHING
    return langs, np.log(counts / counts.sum(axis=1, keepdims=True))


def posterior(texts: pa.Array, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best language and its probability for each text, and whether it has a letter.

    A text's n-grams are a sparse row of bucket numbers; its log-probabilities are sums of the rows they pick.
    """
    found, has_letter = grams(texts)
    sums = np.zeros((len(table), len(texts)))
    for buckets, sizes in found:
        full = np.flatnonzero(sizes)
        if len(full):
            starts = (np.cumsum(sizes) - sizes)[full]
            for i, row in enumerate(table):
                sums[i, full] += np.add.reduceat(row[buckets], starts)
    sums -= sums.max(axis=0)
    shares = np.exp(sums)
    shares /= shares.sum(axis=0)
    best = shares.argmax(axis=0)
    return best, shares[best, np.arange(len(texts))], has_letter


def predicted(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` (the probability of that language) of every row.

    Null texts, texts without a letter, and all texts where no language was learned are ``und`` with score 0. Equal
    probabilities go to the first language by name. Rows without a doc_id are predicted, never learned from. Texts
    are read whole; repeated rows stay and count each; an empty table gives no rows; other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"))
    langs, table = trained(docs)
    model = docs.sparkSession.sparkContext.broadcast((langs, table))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, table = model.value
        for batch in chunks(batches):
            if langs:
                best, score, known = posterior(batch.column("text"), table)
                names = np.where(known, np.array(langs, dtype=object)[best], UNKNOWN)
                score = np.where(known, score, 0.0)
            else:
                names, score = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            columns = [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(score)]
            yield pa.record_batch(columns, names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
