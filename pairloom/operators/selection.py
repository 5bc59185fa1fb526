"""Exact middle values of groups too large for one task.

A value's bits, ordered as the values are, are narrowed down digit by digit: each round counts the measurements of every
digit that still fits, over all tasks, and keeps the digit that holds the wanted rank. What is brought together per
group and rank is a histogram of one digit, whatever the group holds.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType

from pairloom.sinks.staging import stage

DIGIT_BITS = 16
DIGITS = 64 // DIGIT_BITS
SIGN = -(1 << 63)


def ordered_bits(values: np.ndarray) -> np.ndarray:
    """Integers in the order of the values; the function is its own inverse on their bits."""
    bits = values.view(np.int64)
    return np.where(bits < 0, bits ^ np.int64((1 << 63) - 1), bits)


@F.pandas_udf(LongType())
def _to_bits(values: pd.Series) -> pd.Series:
    return pd.Series(ordered_bits(values.to_numpy(dtype=np.float64) + 0.0))  # one zero


@F.pandas_udf(DoubleType())
def _from_bits(bits: pd.Series) -> pd.Series:
    return pd.Series(ordered_bits(bits.to_numpy(dtype=np.int64)).view(np.float64))


def middle_values(cells: DataFrame, group: str, value: str, counts: Mapping[str, str]) -> DataFrame:
    """One row per ``group`` with ``lower_<name>`` and ``upper_<name>`` for each name of ``counts``: the two middle ones
    of the values, each taken as often as the column ``counts[name]`` says. Their mean is the median; with an odd number
    they are the same value. NULL where nothing is counted, and NULL values are not.

    ``cells`` is read once for each of the four digits and once for the totals, so stage it.
    """
    counted = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(f"_n_{name}") for name, c in counts.items()]
    rows = cells.filter(F.col(value).isNotNull()).select(F.col(group).alias("_group"), F.col(value).alias("_value"), *counted)
    rows = stage(rows.withColumn("_bits", _to_bits("_value").bitwiseXOR(F.lit(SIGN))).drop("_value"), "ordered").frame
    totals = rows.groupBy("_group").agg(*(F.sum(f"_n_{name}").alias(name) for name in counts))
    wanted = [
        F.struct(F.lit(f"{side}_{name}").alias("target"), rank.cast("long").alias("rank"), F.col(name).alias("n"))
        for name in counts
        for side, rank in (("lower", F.floor((F.col(name) + 1) / 2)), ("upper", F.floor(F.col(name) / 2) + 1))
    ]
    state = totals.select("_group", F.explode(F.array(*wanted)).alias("w")).select("_group", "w.target", "w.rank", "w.n")
    state = stage(state.filter("n > 0").select("_group", "target", "rank", F.lit(0).cast("long").alias("prefix")), "ranks").frame
    for i in range(DIGITS):
        state = stage(_narrowed(rows, state, i, list(counts)), "ranks").frame
    found = state.withColumn("_found", _from_bits(F.col("prefix").bitwiseXOR(F.lit(SIGN))))
    names = [f"{side}_{name}" for name in counts for side in ("lower", "upper")]
    middle = found.groupBy("_group").agg(*(F.max(F.when(F.col("target") == n, F.col("_found"))).alias(n) for n in names))
    return totals.select("_group").join(middle, "_group", "left").withColumnRenamed("_group", group)


def _narrowed(rows: DataFrame, state: DataFrame, digit: int, names: list[str]) -> DataFrame:
    """The state with one more digit of each prefix, and the rank within it."""
    done = DIGIT_BITS * digit
    own = F.shiftrightunsigned("_bits", 64 - done) if done else F.lit(0).cast("long")
    next_digit = F.shiftrightunsigned("_bits", 64 - done - DIGIT_BITS).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1))
    rows = rows.select("*", own.alias("prefix"), next_digit.alias("digit"))
    n = F.lit(None).cast("long")
    for name in names:
        n = F.when(F.col("target").endswith(f"_{name}"), F.col(f"_n_{name}")).otherwise(n)
    key = ["_group", "target"]
    hist = rows.join(state, ["_group", "prefix"]).groupBy(*key, "rank", "prefix", "digit").agg(F.sum(n).alias("n"))
    upto = F.sum("n").over(Window.partitionBy(*key).orderBy("digit").rowsBetween(Window.unboundedPreceding, 0))
    holds = hist.withColumn("upto", upto).filter(F.col("upto") >= F.col("rank"))
    least = holds.groupBy(*key).agg(F.min(F.struct("digit", "upto", "n", "rank", "prefix")).alias("s"))
    prefix: Column = F.shiftleft("s.prefix", DIGIT_BITS).bitwiseOR(F.col("s.digit"))
    return least.select(*key, (F.col("s.rank") - F.col("s.upto") + F.col("s.n")).alias("rank"), prefix.alias("prefix"))
