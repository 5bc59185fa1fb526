"""Lookup joins that stay balanced when few keys hold most rows.

Adaptive execution splits a skewed partition of a sort-merge join only if both inputs come straight
from a shuffle. Lookups that were aggregated on the join key do not, so hot keys are salted here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000
NULL_SLOTS = 1 << 16  # rows without a key meet no lookup row, so they may go anywhere
SLOTS = "_slots"


def shuffled(lookup: DataFrame) -> DataFrame:
    """``lookup`` for a join that is never a broadcast, as it grows with the data.

    Spark would decide by the compressed bytes of files, scaled to the columns that are read, and passes over what an
    explode adds: it sends tables of many times its threshold through the driver, several at a time.
    """
    return lookup.hint("merge")


def slots(rows: Column, hot_rows: int = HOT_ROWS) -> Column:
    """Tasks over which the rows of a hot key are dealt: as many as keep each at ``hot_rows``."""
    return F.ceil(rows / hot_rows).cast("int")


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Values of ``key`` on more than ``hot_rows`` rows, at most rows / hot_rows of them, and their slots."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    return counts.filter(F.col("_rows") > hot_rows).select(key, slots(F.col("_rows"), hot_rows).alias(SLOTS))


def spread_join(
    df: DataFrame, lookup: DataFrame, key: str, spread_by: list[str], hot: DataFrame, how: str = "left"
) -> DataFrame:
    """Join ``lookup`` on ``key``, with the rows of each hot key spread over its slots.

    ``hot`` comes from ``hot_keys``: it has at most rows / hot_rows rows, so it is broadcast. Only the lookup rows
    of hot keys are repeated, once per slot. Rows with a NULL key find no lookup row and are spread as well. The
    salt is a hash of ``spread_by``, so a task that runs again yields the same rows.
    """
    marked = F.broadcast(hot.select(key, SLOTS))
    many = F.when(F.col(key).isNull(), F.lit(NULL_SLOTS)).otherwise(F.coalesce(SLOTS, F.lit(1)))
    salted = df.join(marked, key, "left").withColumn("_salt", F.pmod(F.xxhash64(*spread_by), many).cast("int"))
    numbers = F.sequence(F.lit(0), F.coalesce(SLOTS, F.lit(1)) - 1)
    repeated = lookup.join(marked, key, "left").withColumn("_salt", F.explode(numbers))
    return salted.drop(SLOTS).join(shuffled(repeated.drop(SLOTS)), [key, "_salt"], how).drop("_salt")


def sparse_lookup(df: DataFrame, lookup: DataFrame, key: str, spread_by: str) -> DataFrame:
    """Left join on a key that is NULL on most rows.

    The second condition repeats the first one, but hashes rows without a key by ``spread_by``, so
    they do not meet in one task.
    """
    left, right = df.alias("l"), shuffled(lookup).alias("r")
    matches = (F.col(f"l.{key}") == F.col(f"r.{key}")) & (
        F.coalesce(F.col(f"l.{key}"), F.col(f"l.{spread_by}")) == F.col(f"r.{key}")
    )
    added = [F.col(f"r.{c}") for c in lookup.columns if c != key]
    return left.join(right, matches, "left").select("l.*", *added)
