"""Quality classifier: regularised quadratic discriminant over document statistics.

Each class is a normal distribution of transformed statistics. Its covariance is shrunk towards that of both classes
together and towards a sphere, so rare classes and statistics that hardly vary stay well-conditioned. A score is the
probability of label 1 from the difference of the two log-densities; the densities come from Mahalanobis distances
with Cholesky factors that are inverted once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.shared import dropped, written
from pairloom.llm.words import chunks, split, utf8, word_hashes

THRESHOLD = 0.3
FOLDS, HELD_OUT = 5, 0
SHRINK_TO_BOTH = 0.1
SHRINK_TO_SPHERE = 0.01

PUNCTUATION, SYMBOLS = b".,;:'\"()-", b"#$%&*+/<=>@[\\]^_`{|}~"
#: Shares of bytes: capitals, digits, punctuation, exclamation and question marks, bars, other symbols.
BYTE_CLASSES = [
    bytes(range(65, 91)),
    bytes(range(48, 58)),
    PUNCTUATION,
    b"!?",
    b"|",
    SYMBOLS.replace(b"|", b""),
]
WORD_STATISTICS = 5
N_STATISTICS = len(BYTE_CLASSES) + WORD_STATISTICS
#: Counts are shared out over a few more units than there are, so that short texts look usual and not extreme.
MORE_BYTES, MORE_WORDS = 100, 20


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of transformed statistics per text, all finite; null and empty texts have those of no words."""
    data, at = utf8(texts)
    sizes = np.diff(at)

    def per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return (sums[bounds[1:]] - sums[bounds[:-1]]).astype(np.float64)

    out = np.zeros((len(sizes), N_STATISTICS))
    for i, members in enumerate(BYTE_CLASSES):
        flag = np.zeros(256, dtype=np.uint8)
        flag[list(members)] = 1
        out[:, i] = np.sqrt(per_text(flag[data], at) / (sizes + MORE_BYTES))
    words = split(data, at)
    n = np.diff(words.first).astype(np.float64)
    hashes, owner = word_hashes(words), words.text_of()
    again = np.zeros(len(words), dtype=np.uint8)
    again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    order = np.lexsort((hashes, owner))
    repeated = np.zeros(len(words), dtype=np.uint8)
    repeated[1:] = (hashes[order][1:] == hashes[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    length = np.concatenate([[0], np.cumsum(words.ends - words.starts)])
    characters = (length[words.first[1:]] - length[words.first[:-1]]).astype(np.float64)
    odd = np.zeros(256, dtype=np.uint8)
    odd[list(SYMBOLS + b"!?")] = 1
    marked = odd[data[np.maximum(words.ends - 1, 0)]] if len(words) else np.zeros(0, np.uint8)
    k = len(BYTE_CLASSES)
    out[:, k] = np.sqrt(per_text(again, words.first) / (n + MORE_WORDS))
    out[:, k + 1] = per_text(repeated, words.first) / (n + MORE_WORDS) / np.log(n + np.e)
    out[:, k + 2] = np.log((characters + 5 * MORE_WORDS) / (n + MORE_WORDS))
    out[:, k + 3] = np.sqrt(per_text(marked, words.first) / (n + MORE_WORDS))
    out[:, k + 4] = np.log1p(n)
    return out


def held_out(doc_id: Column, folds: int = FOLDS, fold: int = HELD_OUT) -> Column:
    """Whether crc32 of the id as text leaves the remainder ``fold``; false for null."""
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string")) % folds == fold, F.lit(False))


@dataclass
class Gaussian:
    log_prior: float
    mean: np.ndarray
    whiten: np.ndarray  # inverse of the Cholesky factor of the covariance
    log_size: float  # log of the factor's determinant

    def log_density(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) @ self.whiten.T
        return self.log_prior - self.log_size - 0.5 * np.einsum("ij,ij->i", z, z)


@dataclass
class Model:
    """Two Gaussians, or the constant score of a training set with one class or none."""

    good: Gaussian | None
    bad: Gaussian | None
    constant: float = 0.5

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.good is None or self.bad is None:
            return np.full(len(x), self.constant)
        difference = self.bad.log_density(x) - self.good.log_density(x)
        return 1 / (1 + np.exp(np.clip(difference, -700, 700)))


def fitted(moments: dict[int, tuple[float, np.ndarray, np.ndarray]]) -> Model:
    """From count, sum and sum of outer products of each class."""
    moments = {label: m for label, m in moments.items() if m[0] > 0}
    if len(moments) < 2:
        return Model(None, None, float(next(iter(moments))) if moments else 0.5)
    means = {label: s / n for label, (n, s, _) in moments.items()}
    own = {label: q / n - np.outer(means[label], means[label]) for label, (n, _, q) in moments.items()}
    total = sum(n for n, _, _ in moments.values())
    both = sum(moments[label][0] / total * own[label] for label in moments)
    scale = np.sqrt(np.diag(both).clip(1e-12))
    found = {}
    for label, (n, _, _) in moments.items():
        cov = (1 - SHRINK_TO_BOTH) * own[label] + SHRINK_TO_BOTH * both
        cov = (1 - SHRINK_TO_SPHERE) * cov + SHRINK_TO_SPHERE * np.diag(scale**2)
        factor = np.linalg.cholesky(cov)
        log_size = float(np.log(np.diag(factor)).sum())
        found[label] = Gaussian(float(np.log(n / total)), means[label], np.linalg.inv(factor), log_size)
    return Model(found[1], found[0])


def described(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the statistics ``x`` of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            x = statistics(batch.column("text"))
            flat = pa.ListArray.from_arrays(np.arange(0, x.size + 1, N_STATISTICS, dtype=np.int32), pa.array(x.ravel()))
            yield pa.record_batch([batch.column("doc_id"), flat], names=["doc_id", "x"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, x array<double>")


def trained(rows: DataFrame, labels: DataFrame) -> Model:
    """The model of the labelled rows of ``rows`` that are not held out: all of them, by moments summed in Spark."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    known = known.filter("label in (0, 1)")
    learned = rows.filter(~held_out(F.col("doc_id"))).select("doc_id", "x").join(known, "doc_id").select("label", "x")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((2, N_STATISTICS + 1, N_STATISTICS + 1))
        for batch in batches:
            for label, part in batch.groupby("label"):
                x = np.column_stack([np.ones(len(part)), np.stack(part["x"])])
                sums[label] += x.T @ x
        label, i, j = np.nonzero(sums)
        yield pd.DataFrame({"label": label, "i": i, "j": j, "value": sums[label, i, j]})

    parts = learned.mapInPandas(run, "label int, i int, j int, value double")
    total = np.zeros((2, N_STATISTICS + 1, N_STATISTICS + 1))
    for r in parts.groupBy("label", "i", "j").agg(F.sum("value").alias("value")).collect():
        total[r.label, r.i, r.j] = r.value
    return fitted({k: (total[k, 0, 0], total[k, 0, 1:], total[k, 1:, 1:]) for k in (0, 1)})


def scored(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (0 to 1, higher where label 1 is likelier) and ``predicted`` of every row.

    Learned from all rows of ``labels`` with quality 0 or 1 whose document is not held out; a document that is
    labelled twice counts twice. Only texts make scores. Null and empty texts get the score of a text without
    words; a null doc_id is scored, never learned. With one class the score is that class, without any label 0.5.
    Repeated rows stay; an empty table gives no rows; other columns are not read.
    """
    rows = written(described(docs), "statistics")
    model = trained(rows, labels)

    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(model.scores(np.stack(x)) if len(x) else [])

    out = rows.withColumn("score", score("x"))
    predicted = (F.col("score") >= threshold).cast("int").alias("predicted")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted)


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, all columns unchanged. It learns as ``scored``.

    Statistics are written before they are learned from: a task that makes them and sums them has two Python workers,
    which executors keep for all later stages."""
    rows = written(described(docs), "statistics")
    model = trained(rows, labels)
    dropped(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            yield batch.filter(pa.array(model.scores(statistics(batch.column("text"))) >= threshold))

    return docs.mapInArrow(run, docs.schema)
