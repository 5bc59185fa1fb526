"""Hard negatives by best-first search in STR-packed R-trees.

Rows are sorted into slabs by the widest coordinate and these into tiles by the next one; a task packs its tiles into
R-trees by further coordinates. A box gives each coordinate's product with an anchor an interval, and so the inner
product of all rows below it. For each anchor a queue yields the box with the highest bound first; boxes that miss every
score window, or that lie strictly below the worst of the best rows so far, are pruned. Tasks keep what they found from
tree to tree and send only their best rows for each anchor.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.shared import written

SCALE = 256
ANCHOR_EVERY, SHIFTED_EVERY, LABELS = 100, 7, 10
POSITIVES, NEGATIVES = 5, 5
TREE_ROWS = 1 << 14
LEAF_ROWS, FANOUT = 128, 16
PACKED_BY = 4  # coordinates that a task sorts by
BLOCK = 4096  # anchors that every task holds at once
EXACT = 1 << 53  # integers below are exact in floating point


def usable(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vec_id``, ``label`` and ``v`` (integers) of rows that take part; equal rows stand once."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col(vector).alias("v"))
    rows = rows.filter("vec_id is not null and label is not null").filter(F.forall("v", finite))
    label = F.when(F.col("vec_id") % SHIFTED_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    whole = F.transform("v", lambda x: F.floor(SCALE * x.cast("double")))
    return rows.select("vec_id", label.alias("label"), whole.alias("v")).distinct()


@dataclass
class Space:
    """What all trees share: the number of coordinates, the widest ones first, and the kind of number that is exact."""

    size: int
    widest: list[int]
    kind: type

    def matrix(self, listed: list[list[int]]) -> np.ndarray:
        """Shorter vectors end in zeros."""
        out = np.zeros((len(listed), self.size), dtype=self.kind)
        for row, v in zip(out, listed):
            row[: len(v)] = v
        return out


def _vectors(column: pa.Array) -> list[np.ndarray]:
    values, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [values[a:b] for a, b in zip(offsets, offsets[1:])]


def measured(rows: DataFrame) -> tuple[Space, int]:
    """The space of all rows, and how many there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in batches:
            for v in _vectors(batch.column("v")):
                part, x = sums.setdefault(len(v), [0, np.zeros((3, len(v)))]), v.astype(float)
                part[0] += 1
                part[1] = np.stack([part[1][0] + x, part[1][1] + x * x, np.maximum(part[1][2], abs(x))])
        out = [(d, n, *parts[:, d]) for n, parts in sums.values() for d in range(parts.shape[1])]
        kinds = [pa.int32(), pa.int64()] + [pa.float64()] * 3
        columns = list(zip(*out)) or [[]] * 5
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=["d", "n", "s", "q", "m"])

    each = rows.select("v").mapInArrow(run, "d int, n long, s double, q double, m double")
    total = each.groupBy("d").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"), F.max("m").alias("m"))
    found = total.collect()
    n = rows.count()
    spread = {r["d"]: r["q"] / n - (r["s"] / n) ** 2 for r in found}
    size = max(spread, default=-1) + 1
    most = max((r["m"] for r in found), default=0.0)
    widest = sorted(range(size), key=lambda d: (-spread[d], d))
    return Space(size, widest, np.float64 if most * most * max(size, 1) < EXACT else object), n


def tiled(rows: DataFrame, space: Space, n: int) -> DataFrame:
    """Rows in tiles: slabs by the widest coordinate, cut by the next one. Equal vectors are dealt by their ids, so no
    tile grows with the copies of one vector."""
    tiles = max(1, math.ceil(n / TREE_ROWS))
    slabs = math.ceil(math.sqrt(tiles))
    coordinate = lambda i: F.coalesce(F.get("v", F.lit(space.widest[i])), F.lit(0)) if i < space.size else F.lit(0)
    cut = rows.withColumn("a", coordinate(0)).withColumn("b", coordinate(1)).withColumn("h", F.xxhash64("vec_id"))
    cut = written(cut.repartitionByRange(slabs, "a", "h").withColumn("slab", F.spark_partition_id()), "slabs")
    return written(cut.repartitionByRange(tiles, "slab", "b", "h").select("vec_id", "label", "v"), "tiles")


def packed_order(x: np.ndarray, by: list[int], leaf: int = LEAF_ROWS) -> np.ndarray:
    """Order of rows in leaves: sorted by a coordinate, cut into slabs, each of them packed by the others."""
    order = np.argsort(x[:, by[0]], kind="stable")
    leaves = math.ceil(len(x) / leaf)
    if len(by) == 1 or leaves <= 1:
        return order
    slab = leaf * math.ceil(leaves / math.ceil(leaves ** (1 / len(by))))
    parts = [order[a : a + slab] for a in range(0, len(order), slab)]
    return np.concatenate([part[packed_order(x[part], by[1:], leaf)] for part in parts])


class Tree:
    """``levels`` hold (low, high) corners of the boxes, leaves first; box i covers FANOUT boxes of the level below,
    or LEAF_ROWS rows, from i times as many on."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, by: list[int]):
        order = packed_order(x, by[:PACKED_BY]) if by else np.arange(len(x))
        self.ids, self.labels, self.x = ids[order], labels[order], x[order]
        low = high = self.x
        self.levels, width = [], LEAF_ROWS
        while not self.levels or len(low) > 1:
            at = np.arange(0, len(low), width)
            low, high, width = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), FANOUT
            self.levels.append((low, high))

    def bounds(self, level: int, part: slice, up: np.ndarray, down: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and most that the inner product can be in some boxes of a level."""
        low, high = (side[part] for side in self.levels[level])
        return low @ up + high @ down, high @ up + low @ down

    def search(self, anchor: np.ndarray, best: list[Best]) -> None:
        """Offers rows to ``best``, box by box from the highest bound down."""
        up, down = np.maximum(anchor, 0), np.minimum(anchor, 0)
        top = len(self.levels) - 1
        queue: list[tuple] = []

        def push(level: int, part: slice) -> None:
            least, most = self.bounds(level, part, up, down)
            for i, (a, b) in enumerate(zip(least.tolist(), most.tolist()), part.start):
                if any(w.wants(a, b) for w in best):
                    heapq.heappush(queue, (-b, level, i, a))

        push(top, slice(0, 1))
        while queue:
            most, level, i, least = heapq.heappop(queue)
            if not any(w.wants(least, -most) for w in best):
                if all(-most < w.floor for w in best):
                    break  # and so are all the others
                continue
            if level:
                push(level - 1, slice(i * FANOUT, min((i + 1) * FANOUT, len(self.levels[level - 1][0]))))
                continue
            rows = slice(i * LEAF_ROWS, (i + 1) * LEAF_ROWS)
            scores = self.x[rows] @ anchor
            for w in best:
                w.offer(scores, self.ids[rows], self.labels[rows])


class Best:
    """The best ``k`` rows for one anchor within a score window, of its own label or of others."""

    def __init__(self, vec_id: int, label: int, same: bool, k: int, low: float = -math.inf, high: float = math.inf):
        self.vec_id, self.label, self.same, self.k = vec_id, label, same, k
        self.floor, self.high = low, high
        self.rows: list[tuple] = []  # (-score, id), best first

    def wants(self, least: float, most: float) -> bool:
        return least <= self.high and most >= self.floor

    def offer(self, scores: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        fits = (scores >= self.floor) & (scores <= self.high) & ((labels == self.label) == self.same) & (ids != self.vec_id)
        at = np.flatnonzero(fits)
        if len(at):
            new = zip((-scores[at]).tolist(), ids[at].tolist())
            self.rows = heapq.nsmallest(self.k, [*self.rows, *new])
            if len(self.rows) == self.k:
                self.floor = max(self.floor, -self.rows[-1][0])


def _searched(tiles: DataFrame, space: Space, asked: list[tuple], k: int) -> DataFrame:
    """The best rows of the whole table for each of ``asked``: (vector, vec_id, label, same label or others, windows).
    Columns ``anchor`` and ``window`` (their places), ``vec_id``, ``score``; ``rank`` from 1."""
    shared = tiles.sparkSession.sparkContext.broadcast(asked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = space.matrix([a[0] for a in shared.value])
        best = [[Best(vec_id, label, same, k, *w) for w in windows] for _, vec_id, label, same, windows in shared.value]
        waiting, held = [], 0

        def search() -> None:
            table = pa.Table.from_batches(waiting).combine_chunks()
            x = space.matrix(_vectors(table.column("v").combine_chunks()))
            tree = Tree(table.column("vec_id").to_numpy(), table.column("label").to_numpy(), x, space.widest[2:] or space.widest)
            for anchor, windows in zip(anchors, best):
                if windows:
                    tree.search(anchor, windows)

        for batch in batches:
            for at in range(0, batch.num_rows, TREE_ROWS):
                waiting.append(batch.slice(at, TREE_ROWS))
                held += waiting[-1].num_rows
                if held >= TREE_ROWS:
                    search()
                    waiting, held = [], 0
        if held:
            search()
        rows = [(i, j, v, Decimal(int(-s))) for i, ws in enumerate(best) for j, w in enumerate(ws) for s, v in w.rows]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.decimal128(38)]
        columns = list(zip(*rows)) or [[]] * 4
        names = ["anchor", "window", "vec_id", "score"]
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    found = tiles.mapInArrow(run, "anchor int, window int, vec_id long, score decimal(38,0)")
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _long(score: Column) -> Column:
    """The score, or the nearest number of 64 bits."""
    return F.greatest(F.least(score, F.lit(Decimal(2**63 - 1))), F.lit(Decimal(-(2**63)))).cast("long")


def window_of(positive: int) -> tuple[int, int]:
    """Scores from 80 to 100 of a hundred parts of the positive's."""
    return -(-4 * positive // 5), positive


def mined(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``: the first
    negatives within the score window of each positive of each anchor.

    Rows without a vec_id or label, and vectors that are null or hold a null or non-finite component, take no part. Rows
    equal in id, label and vector stand once; an id with several of them is several rows, none of which is another row
    to the others. Shorter vectors end in zeros. Ties go to the smaller vec_id. Positives with a negative score have an
    empty window. Scores beyond 64 bits (of up to 38 digits) are compared
    exactly and returned as the nearest number of 64 bits. An empty table gives no
    rows; other columns are not read. Anchors are asked block by block, all rows in each.
    """
    spark = vectors.sparkSession
    rows = written(usable(vectors, vector), "vectors")
    space, n = measured(rows)
    tiles = tiled(rows, space, n)
    anchors = tiles.filter(F.col("vec_id") % ANCHOR_EVERY == 0)
    blocks = max(1, math.ceil(anchors.count() / BLOCK))
    block = F.pmod(F.xxhash64("vec_id", "label", "v"), F.lit(blocks))
    out = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    for i in range(blocks):
        asked = anchors.filter(block == i).collect()
        if not asked:
            continue
        whole = [(a["v"], a["vec_id"], a["label"], True, [(-math.inf, math.inf)]) for a in asked]
        positives: dict[int, list] = {}
        for r in _searched(tiles, space, whole, POSITIVES).orderBy("anchor", "rank").collect():
            positives.setdefault(r["anchor"], []).append((r["vec_id"], int(r["score"])))
        ids = enumerate(a["vec_id"] for a in asked)
        pairs = [(j, w, a, p, Decimal(s)) for j, a in ids for w, (p, s) in enumerate(positives.get(j, []))]
        windows = [
            (a["v"], a["vec_id"], a["label"], False, [window_of(s) for _, s in positives.get(j, [])]) for j, a in enumerate(asked)
        ]
        named = spark.createDataFrame(pairs, "anchor int, window int, anchor_id long, positive_id long, positive_score decimal(38,0)")
        found = _searched(tiles, space, windows, NEGATIVES).join(named, ["anchor", "window"])
        scores = [_long(F.col("positive_score")).alias("positive_score"), _long(F.col("score")).alias("negative_score")]
        columns = ["anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), *scores]
        out = out.unionByName(written(found.select(columns), "mined"))
    return out


ORACLE_SQL = """
WITH good AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scores AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, r.vec_id, r.label, list_inner_product(a.v, r.v)::BIGINT AS score
  FROM good a JOIN good r ON r.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0
),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id, (row_number() OVER w)::INT AS rank, s.vec_id AS negative_id, p.positive_score,
  s.score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND s.label <> s.anchor_label
  AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER w <= 5
"""
