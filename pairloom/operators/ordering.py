"""Places of rows in a total order."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.sinks.staging import stage

ROW_BITS = 33  # of an increasing id: the row's place in its partition


def positions(df: DataFrame, order: list[str], position: str = "position") -> DataFrame:
    """``df`` with the place of each row, from 1, in the order of the columns ``order`` (NULLs first).

    Rows are dealt to sorted ranges. Only the sizes of these come to the driver, one number each; a row's place is its
    place in the range behind the sizes of all ranges before. No task sees more than its range. Rows that are equal in
    all of ``order`` follow each other in any order, which is fixed once they are staged.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    placed = stage(ranged.withColumns({"_range": F.spark_partition_id(), "_place": place}), "ranges").frame
    sizes = {r["_range"]: r["n"] for r in placed.groupBy("_range").agg(F.max("_place").alias("n")).collect()}
    ranges = sorted(sizes)
    before = accumulate((sizes[r] + 1 for r in ranges), initial=0)
    offsets = df.sparkSession.createDataFrame(list(zip(ranges, before)), "_range int, _before long")
    found = placed.join(F.broadcast(offsets), "_range")
    return found.withColumn(position, F.col("_before") + F.col("_place") + 1).drop("_range", "_place", "_before")
