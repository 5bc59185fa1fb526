from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pairloom.operators.enrich import enrich_by_key, per_batch
from pairloom.operators.joins import hot_keys, sparse_lookup, spread_join


def skewed(spark):
    """1200 rows; key 7 holds a third, NULL some more, 3 has no lookup row."""
    return spark.range(1200).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, 7)
        .when(F.col("id") % 11 == 0, F.lit(None))
        .otherwise(F.col("id") % 5 + 1)
        .cast("long")
        .alias("key"),
    )


def lookup(spark):
    return spark.createDataFrame([(k, f"name {k}") for k in (1, 2, 4, 5, 7, 9)], "key BIGINT, name STRING")


@pytest.mark.parametrize("how", ["left", "inner"])
def test_spread_join_equals_plain_join(spark, how):
    df, names = skewed(spark), lookup(spark)
    hot = hot_keys(df, "key", 300)
    assert [r.key for r in hot.collect()] == [7]
    got = spread_join(df, names, "key", ["id"], hot, how)
    want = df.join(names, "key", how)
    assert got.columns == want.columns
    assert sorted(got.collect(), key=repr) == sorted(want.collect(), key=repr)
    assert [r["_slots"] for r in hot.collect()] == [2]
    small = spread_join(df, names, "key", ["id"], hot_keys(df, "key"), how)
    assert sorted(small.collect(), key=repr) == sorted(want.collect(), key=repr)


def test_hot_rows_are_spread(spark):
    """Shuffled joins: the rows of the hot key end up in several partitions."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df, names = skewed(spark), lookup(spark)
        joined = spread_join(df, names, "key", ["id"], hot_keys(df, "key", 50))
        parts = joined.filter(F.col("key") == 7).select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert parts > 2


def test_sparse_lookup_equals_left_join(spark):
    df, names = skewed(spark), lookup(spark)
    got = sparse_lookup(df, names, "key", "id").select("id", "key", "name")
    want = df.join(names, "key", "left").select("id", "key", "name")
    assert sorted(got.collect(), key=repr) == sorted(want.collect(), key=repr)


def test_enrich_computes_once_per_distinct_key(spark):
    rows = [(i, "same text" if i % 3 else f"text {i}") for i in range(300)] + [(300, None)]
    df = spark.createDataFrame(rows, "id BIGINT, text STRING")
    seen = spark.sparkContext.accumulator(0)

    def length(texts):
        seen.add(len(texts))
        return texts.str.len().to_frame("n")

    for hot_rows in (50, 10_000):
        seen.value = 0
        got = enrich_by_key(df, "text", per_batch("text", length, "n BIGINT"), ["id"], hot_rows).collect()
        assert {r.id: r.n for r in got} == {i: None if t is None else len(t) for i, t in rows}
        assert len(got) == len(rows)
        assert seen.value == 101
