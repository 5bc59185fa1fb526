"""The prefix trie of conversations, rolled up in bands of depth.

A node is a distinct sequence of first turns, known by a 128-bit hash that a running window builds along each
conversation. Nodes explode only to their ancestors within a band of fixed height, which sums every band at once. Then
the totals of the band roots, complete from the deepest band up, are added to the nodes of the band above: one round
per band, and only roots move.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.shared import written

FAMILY = 100  # conversations that share the first turns of one of them
MOST_SHARED = 5
BAND_HEIGHT = 32
KEY = ["d", "x1", "x2"]
CHUNK_IDS = 10_000
SUMS = ["n_children", "n_leaves", "saved_tokens"]


def _shared(conv_id: Column) -> Column:
    """How many first turns a conversation takes from the first of its family."""
    return (F.crc32(conv_id.cast("string")) % (MOST_SHARED + 1)).cast("int")


def numbered(turns: DataFrame) -> DataFrame:
    """Turns as place ``p`` in their conversation, two hashes of role and text, and the text's code points.

    Equal turn numbers are ordered by role and text. A conversation's turns are sorted by one task, which spills.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    placed = rows.filter("conv_id is not null").withColumn("p", F.row_number().over(order).cast("long"))
    return placed.select(
        "conv_id",
        "p",
        F.xxhash64("role", "text").alias("k1"),
        F.xxhash64(F.lit(7), "text", "role").alias("k2"),
        F.char_length("text").cast("long").alias("chars"),
    )


def rebuilt(places: DataFrame, convs: DataFrame) -> DataFrame:
    """The turns of each rebuilt conversation at depth ``d``: the first of its family's first, then its own others.

    ``places`` comes from ``numbered``, ``convs`` has one row per conversation with ``n`` turns.
    """
    base = (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base")
    h = _shared(F.col("conv_id")).alias("h")
    heads = places.filter(F.col("p") <= MOST_SHARED).filter(F.col("conv_id") % FAMILY == 0)
    heads = heads.select(F.col("conv_id").alias("base"), F.col("p").alias("d"), "k1", "k2", "chars")
    taken = convs.select("conv_id", base, h).filter("h > 0").join(heads, "base").filter("d <= h")
    lengths = convs.filter(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    own = places.select("*", base, h).filter("p > h").join(lengths, "base", "left")
    own = own.withColumn("d", F.least("h", F.coalesce("base_n", F.lit(0))) + F.col("p") - F.col("h"))
    columns = ["conv_id", "d", "k1", "k2", "chars"]
    return taken.select(columns).unionByName(own.select(columns))


def _prefixes(rows: DataFrame, height: int) -> DataFrame:
    """For each turn the hash of all turns up to it, its ancestors ``up`` to the top of its parent's band, and whether
    it is the last one."""
    order = Window.partitionBy("conv_id").orderBy("d")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({f"x{i}": F.bit_xor(F.xxhash64("d", f"k{i}")).over(so_far) for i in (1, 2)})
    before = F.collect_list(F.struct(*KEY)).over(order.rowsBetween(-height, -1))
    top = F.floor((F.col("d") - 1) / height) * height
    root = F.array(F.struct(F.lit(0).cast("long").alias("d"), *(F.lit(0).cast("long").alias(x) for x in KEY[1:])))
    up = F.concat(F.when(top == 0, root).otherwise(F.slice(root, 1, 0)), F.filter(before, lambda x: x["d"] >= top))
    last = F.lead("d").over(order).isNull()
    return rows.select("conv_id", *KEY, "chars", up.alias("up"), last.alias("last"))


def ends_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ascending, comma-joined conv_ids of each node's ends. Sorted ranges become pieces of text first,
    so the ids of a node that everyone ends at are sorted by many tasks and only hashed, piece by piece, by one."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK_IDS):
                part = batch.slice(at, CHUNK_IDS)
                key = np.column_stack([part.column(c).to_numpy() for c in KEY])
                starts = np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(axis=1)))
                ids = part.column("conv_id").to_pylist()
                cuts = [*starts.tolist(), len(ids)]
                texts = [",".join(map(str, ids[a:b])) for a, b in zip(cuts, cuts[1:])]
                columns = [part.column(c).take(pa.array(starts)) for c in [*KEY, "conv_id"]]
                yield pa.record_batch([*columns, pa.array(texts, pa.string())], names=[*KEY, "first", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, hashlib.sha256()
        kinds = [pa.int64()] * 3 + [pa.string()]
        names = [*KEY, "ends_sha256"]
        for batch in batches:
            done = []
            for *k, ids in zip(*(batch.column(c).to_pylist() for c in [*KEY, "ids"])):
                if k != key:
                    if key:
                        done.append((*key, digest.hexdigest()))
                    key, digest = k, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.encode())
            columns = list(zip(*done)) or [[]] * 4
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)
        if key:
            yield pa.record_batch([pa.array([x], t) for x, t in zip([*key, digest.hexdigest()], kinds)], names=names)

    order = [*KEY, "conv_id"]
    cut = ends.select(order).repartitionByRange(*order).sortWithinPartitions(*order)
    cut = cut.mapInArrow(pieces, "d long, x1 long, x2 long, first long, ids string")
    cut = cut.repartition(*KEY).sortWithinPartitions(*KEY, "first")
    return cut.mapInArrow(hashed, "d long, x1 long, x2 long, ends_sha256 string")


def _added(values: DataFrame) -> DataFrame:
    """``n_leaves`` and ``saved_tokens`` of rows, summed into each of their ancestors ``up``."""
    each = values.select(F.explode("up").alias("node"), "n_leaves", "saved_tokens")
    return each.groupBy("node").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")).select(
        "node.*", "n_leaves", "saved_tokens"
    )


def rolled_up(nodes: DataFrame, height: int) -> DataFrame:
    """Totals of what lies below nodes, from ``nodes`` with their own values and ``up``; nodes without any may lack."""
    in_band = written(_added(nodes.filter(F.col("d") % height != 0)), "in-band")
    deepest = nodes.agg(F.max("d")).first()[0] or 0
    if deepest < height:
        return in_band
    below = [F.col(c).alias(f"below_{c}") for c in SUMS[1:]]
    roots = nodes.filter((F.col("d") % height == 0) & (F.col("d") > 0)).select(*KEY, "up", *SUMS[1:])
    roots = _with_below(roots.join(in_band.select(*KEY, *below), KEY, "left"))
    roots = written(roots.repartitionByRange("d").sortWithinPartitions("d"), "band-roots")  # a round reads its own depth
    sums, received = in_band, None
    for top in range(deepest // height * height, 0, -height):
        whole = roots.filter(F.col("d") == top)
        if received is not None:
            more = received.filter(F.col("d") == top).select(*KEY, *below)
            whole = _with_below(whole.join(more, KEY, "left"))
        received = written(_added(whole), "received")
        sums = sums.unionByName(received)
    return sums


def _with_below(nodes: DataFrame) -> DataFrame:
    """The sums of nodes with those that were joined to them."""
    return nodes.select(*KEY, "up", *((F.col(c) + F.coalesce(f"below_{c}", F.lit(0))).alias(c) for c in SUMS[1:]))


def trie(turns: DataFrame, height: int = BAND_HEIGHT) -> DataFrame:
    """One row per node: ``conv_id`` (its smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` and ``ends_sha256``.

    Rows without a conv_id take no part; null turns come first, null role or text is empty, turns with one number are
    ordered by role and text, and a repeated row is a turn of its own. A conversation whose rebuilt form has no turn
    ends at the root. An empty table has no nodes, not even the root. Other columns are not read. ``height`` changes
    nothing but the number of rounds and how far rows explode.
    """
    places = written(numbered(turns), "turns")
    convs = written(places.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")), "conversations")
    rows = written(_prefixes(rebuilt(places, convs), height), "prefixes")
    nodes = rows.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), F.min("chars").alias("chars"), F.any_value("up").alias("up")
    )
    at_root = [F.lit(0).cast("long").alias(c) for c in KEY]
    none = F.array().cast("array<struct<d:bigint,x1:bigint,x2:bigint>>").alias("up")
    root = convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).filter("n_convs > 0")
    nodes = nodes.unionByName(root.select(*at_root, "n_convs", "conv_id", F.lit(0).cast("long").alias("chars"), none))
    nodes = written(nodes, "nodes")

    children = nodes.filter("d > 0").groupBy(F.get("up", F.size("up") - 1).alias("node"))
    children = children.agg(F.count(F.lit(1)).alias("n_children")).select("node.*", "n_children")
    nodes = nodes.join(children, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    leaf = (F.col("n_children") == 0).cast("long").alias("n_leaves")
    saved = ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens")
    own = written(nodes.select(*KEY, "conv_id", "n_convs", "up", "n_children", leaf, saved), "own")

    turnless = convs.join(rows.select("conv_id").distinct(), "conv_id", "left_anti").select(*at_root, "conv_id")
    ends = rows.filter("last").select(*KEY, "conv_id").unionByName(turnless)
    parents = own.select(*(F.col(c).alias(f"p_{c}") for c in KEY), F.col("conv_id").alias("parent_conv_id"))
    named = own.select("*", *(F.get("up", F.size("up") - 1)[c].alias(f"p_{c}") for c in KEY))
    named = named.join(parents, [f"p_{c}" for c in KEY], "left")
    columns = ["conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    part = lambda df: df.select(
        *KEY, *(F.col(c) if c in df.columns else F.lit(None).cast("string" if "sha" in c else "long").alias(c) for c in columns)
    )
    parts = part(named).unionByName(part(rolled_up(own, height))).unionByName(part(ends_digests(ends)))
    total = parts.groupBy(*KEY).agg(*(F.sum(c).alias(c) if c in SUMS else F.max(c).alias(c) for c in columns))
    nothing = F.lit(hashlib.sha256().hexdigest())
    return total.select(
        "conv_id", F.col("d").alias("depth"), *columns[1:-1], F.coalesce("ends_sha256", nothing).alias("ends_sha256")
    )


ORACLE_SQL = """
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
  FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (
  SELECT conv_id, count(*) AS n, conv_id - conv_id % 100 AS base,
    xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(conv_id::VARCHAR, ''),
      lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
      lambda a, x: xor(xor(a, x) >> 1, (xor(a, x) & 1) * 3988292384))) % 6 AS h
  FROM turns GROUP BY conv_id
),
rebuilt AS (
  SELECT c.conv_id, t.p AS d, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.p <= c.h
  UNION ALL
  SELECT c.conv_id, least(c.h, coalesce(b.n, 0)) + t.p - c.h, t.role, t.text
  FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.p > c.h LEFT JOIN convs b ON b.conv_id = c.base
),
paths AS (
  SELECT conv_id, d, length(text) AS chars,
    string_agg(md5(role || chr(1) || text), '/') OVER (PARTITION BY conv_id ORDER BY d ROWS UNBOUNDED PRECEDING) AS path
  FROM rebuilt
  UNION ALL
  SELECT conv_id, 0, 0, '' FROM convs
),
lengths AS (SELECT conv_id, max(d) AS n FROM paths GROUP BY conv_id),
nodes AS (
  SELECT d, path, min(p.conv_id) AS conv_id, count(*) AS n_convs, min(chars) AS chars,
    sha256(coalesce(string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id) FILTER (l.n = d), '')) AS ends_sha256
  FROM paths p JOIN lengths l ON p.conv_id = l.conv_id GROUP BY d, path
),
pairs AS (
  SELECT DISTINCT a.d, a.path, b.d AS below_d, b.path AS below FROM paths a JOIN paths b ON a.conv_id = b.conv_id AND b.d >= a.d
),
children AS (SELECT d, path, count(*) AS n FROM pairs WHERE below_d = d + 1 GROUP BY d, path),
own AS (
  SELECT n.*, coalesce(c.n, 0) AS n_children, (n_convs - 1) * chars AS saved
  FROM nodes n LEFT JOIN children c ON n.d = c.d AND n.path = c.path
),
sums AS (
  SELECT p.d, p.path, count(*) FILTER (o.n_children = 0) AS n_leaves, sum(o.saved) AS saved
  FROM pairs p JOIN own o ON o.d = p.below_d AND o.path = p.below GROUP BY p.d, p.path
),
parents AS (
  SELECT p.below_d AS d, p.below AS path, n.conv_id FROM pairs p JOIN nodes n ON n.d = p.d AND n.path = p.path
  WHERE p.below_d = p.d + 1
)
SELECT o.conv_id, o.d::BIGINT AS depth, a.conv_id AS parent_conv_id, o.n_convs, o.n_children::BIGINT AS n_children,
  s.n_leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, o.ends_sha256
FROM own o JOIN sums s ON o.d = s.d AND o.path = s.path LEFT JOIN parents a ON a.d = o.d AND a.path = o.path
"""
