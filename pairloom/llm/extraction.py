"""HTML extraction: a linear-chain conditional random field over the leaf blocks of a page."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.dom import Block, blocks
from pairloom.llm.layouts import labelled_pages
from pairloom.llm.words import chunks

TRAINING_PAGES = 1000
MOST_BLOCKS = 60  # longer training pages are left out
ROUNDS = 120
RATE = 0.3
PENALTY = 3e-5  # squared weights, per training block
LEAST_PAGES = 3  # a feature that fewer training pages have is left out


CONTAINERS = frozenset("article aside body dialog div footer form header main menu nav section".split())


def features(found: list[Block]) -> list[list[str]]:
    """What each block shows: its open ancestors, their names, and the look of its text and of its neighbours'."""
    looks = [_look(b) for b in found]
    out = []
    for i, (block, look) in enumerate(zip(found, looks)):
        own = ["bias", f"tag:{block.tags[-1] if block.tags else ''}", f"in-body:{len(block.tags) <= 3}", f"unnamed:{not block.names}"]
        own.append(f"path:{'>'.join(block.tags[-2:])}")
        own += [f"in:{t}" for t in set(block.tags)]
        own += [f"named:{n}" for n in block.names]
        own += [f"nearest:{n}" for n in block.nearest]
        own.append(f"inner:{next((t for t in reversed(block.tags) if t in CONTAINERS), '')}")
        own += look
        own += [f"before:{x}" for x in looks[i - 1]] if i else ["first"]
        own += [f"behind:{x}" for x in looks[i + 1]] if i + 1 < len(found) else ["last"]
        out.append(own)
    return out


def _look(block: Block) -> list[str]:
    text = block.text
    size = min(int(math.log2(len(text))), 10)
    linked = min(int(4 * block.link_chars / len(text)), 4)
    look = [f"size:{size}", f"linked:{linked}"]
    if block.hidden:
        look.append("hidden")
    if text[-1] in ".!?…":
        look.append("ends")
    if "©" in text:
        look.append("copyright")
    return look


@dataclass
class Chain:
    """Weights of the two labels' difference, and scores of label pairs; label 1 is main text."""

    weights: dict[str, float]
    pairs: np.ndarray

    def labels(self, found: list[Block]) -> list[int]:
        """The likeliest labelling as a whole, by Viterbi."""
        get = self.weights.get
        (a, b), (c, d) = self.pairs.tolist()
        zero = one = 0.0
        back: list[tuple[int, int]] = []
        for i, names in enumerate(features(found)):
            emit = 0.0
            for name in names:
                emit += get(name, 0.0)
            if i:
                from_zero, from_one = int(one + c > zero + a), int(one + d > zero + b)
                zero, one = (one + c if from_zero else zero + a), (one + d if from_one else zero + b)
                back.append((from_zero, from_one))
            one += emit
        label = int(one > zero)
        out = [label]
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return out[::-1] if found else []


def aligned(found: list[Block], main: list[str]) -> list[int]:
    """Labels of a page's blocks, of which those in ``main`` are main text, in the same order."""
    out, at = [], 0
    for block in found:
        hit = at < len(main) and block.text == main[at]
        out.append(int(hit))
        at += hit
    return out


def marginals(emit: np.ndarray, real: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of chains of blocks (pages, places, labels), of which the first ``real`` ones are there: the probability of label 1
    at each place, and the logarithm of that of each pair of labels at neighbouring places. By forward and backward sums."""
    n, t, _ = emit.shape
    alpha, beta = np.zeros((n, t, 2)), np.zeros((n, t, 2))
    alpha[:, 0] = emit[:, 0]
    for j in range(1, t):
        moved = np.logaddexp(alpha[:, j - 1, :1] + pairs[0], alpha[:, j - 1, 1:] + pairs[1])
        alpha[:, j] = np.where(real[:, j, None], moved + emit[:, j], alpha[:, j - 1])
    for j in range(t - 2, -1, -1):
        ahead = emit[:, j + 1] + beta[:, j + 1]
        moved = np.logaddexp(ahead[:, :1] + pairs[:, 0], ahead[:, 1:] + pairs[:, 1])
        beta[:, j] = np.where(real[:, j + 1, None], moved, 0)
    whole = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])[:, None]
    share = np.exp(alpha[:, :, 1] + beta[:, :, 1] - whole)
    return share, alpha[:, :-1, :, None] + pairs + (emit + beta)[:, 1:, None, :] - whole[:, :, None, None]


def trained(pages: list[tuple[str, list[str]]]) -> Chain:
    """Fit by the gradient of the penalised likelihood, with expectations from the forward-backward algorithm.

    All pages go through it together, padded to the longest: the loop is over places, not over pages.
    """
    parsed = [(found, aligned(found, main)) for found, main in ((blocks(p), m) for p, m in pages)]
    parsed = [(found, labels) for found, labels in parsed if 0 < len(found) <= MOST_BLOCKS]
    named = [features(found) for found, _ in parsed]
    seen: dict[str, int] = {}
    for page in named:
        for name in {x for block in page for x in block}:
            seen[name] = seen.get(name, 0) + 1
    index = {name: i for i, name in enumerate(sorted(n for n, k in seen.items() if k >= LEAST_PAGES))}
    n, t = len(parsed), max(len(found) for found, _ in parsed)
    y, real = np.zeros((n, t), dtype=np.int64), np.zeros((n, t), dtype=bool)
    for i, (_, labels) in enumerate(parsed):
        y[i, : len(labels)], real[i, : len(labels)] = labels, True
    flat = np.zeros((int(real.sum()), len(index)), dtype=np.float32)
    for row, block in enumerate(block for page in named for block in page):
        flat[row, [index[name] for name in block if name in index]] = 1
    weights, pairs = np.zeros(len(index), dtype=np.float32), np.zeros((2, 2))
    squares, pair_squares = np.full(len(index), 1e-8, dtype=np.float32), np.full((2, 2), 1e-8)
    step = real[:, 1:]
    seen_pairs = np.array([[(step & (y[:, :-1] == a) & (y[:, 1:] == b)).sum() for b in (0, 1)] for a in (0, 1)])
    for _ in range(ROUNDS):
        emit = np.zeros((n, t, 2))
        emit[real, 1] = flat @ weights
        share, joint = marginals(emit, real, pairs)
        gradient = (y[real] - share[real]).astype(np.float32) @ flat - PENALTY * len(flat) * weights
        pair_gradient = seen_pairs - np.exp(joint[step]).sum(axis=0) - PENALTY * len(flat) * pairs
        squares += gradient**2
        pair_squares += pair_gradient**2
        weights += RATE * gradient / np.sqrt(squares)
        pairs += RATE * pair_gradient / np.sqrt(pair_squares)
    return Chain({name: float(weights[i]) for name, i in index.items()}, pairs)


@cache
def default_chain() -> Chain:
    return trained(labelled_pages(TRAINING_PAGES))


def main_text(chain: Chain, page: str) -> str:
    found = blocks(page)
    return "\n".join(b.text for b, label in zip(found, chain.labels(found)) if label)


def extracted(pages: DataFrame, chain: Chain | None = None) -> DataFrame:
    """``page_id``, ``url``, ``text`` (main blocks joined by line feeds) and ``n_chars`` of every row of ``pages``.

    ``chain`` is trained on labelled pages, by default on TRAINING_PAGES of ``layouts``. Whole pages are read. Null
    or empty html, and pages without main text, give an empty text; broken markup is read as far as it goes.
    Repeated rows stay; an empty table gives no rows; other columns are not read.
    """
    model = pages.sparkSession.sparkContext.broadcast(chain or default_chain())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "html"):
            texts = [main_text(model.value, page or "") for page in batch.column("html").to_pylist()]
            columns = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.record_batch(
                [batch.column("page_id"), batch.column("url"), *columns], names=["page_id", "url", "text", "n_chars"]
            )

    rows = pages.select(F.col("page_id").cast("long"), "url", "html")
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
