"""Connected components by alternating star contraction, for graphs of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.shared import dropped, written


def components(links: DataFrame) -> DataFrame:
    """Columns ``node``, ``root`` for all nodes of ``links`` (columns a, b): root is the smallest node reached.

    Each round hangs the neighbours of a node on the smallest one, first the larger neighbours, then the
    smaller ones; both are a minimum with map-side combination and a join that adaptive execution can split,
    as every round is written to the shared folder. A node's neighbours never meet in one list. The rounds
    grow with the logarithm of the longest chain. No links, no rows; loops and repeated links are harmless.
    """
    links = written(links.filter("a <> b").select("a", "b").distinct(), "links")
    while True:
        large, least = _star(links, larger=True)
        large = written(large, "large-star")
        dropped(least)
        small, least = _star(large, larger=False)
        small = written(small, "small-star")
        same = _mark(small) == _mark(links)
        dropped(least, large, links)
        if same:
            break
        links = small
    roots = small.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _star(links: DataFrame, larger: bool) -> tuple[DataFrame, DataFrame]:
    """The new links, and the written table of least neighbours that they read."""
    a, b = F.greatest("a", "b"), F.least("a", "b")
    down = links.select(a.alias("u"), b.alias("v"))
    if larger:
        both = down.unionByName(links.select(b.alias("u"), a.alias("v")))
        least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        hung = both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        least = written(down.groupBy("u").agg(F.min("v").alias("m")), "least")
        hung = down.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        hung = hung.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return hung.filter("a <> b").distinct(), least


def _mark(links: DataFrame) -> tuple:
    marked = links.select(F.xxhash64("a", "b").cast("decimal(38,0)").alias("h"))
    return tuple(marked.agg(F.count("h"), F.sum("h")).first())
