"""Results kept from run to run: computed keys, and bitmaps of ids."""

from __future__ import annotations

import os
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from pairloom.operators import enrich, stats
from pairloom.operators.joins import NULL_SLOTS, hot_keys, spread_join
from pairloom.operators.quality import repeated_keys


def lengths(key="k"):
    return enrich.per_batch(key, lambda keys: pd.DataFrame({"n": keys.str.len()}), "n BIGINT")


def frame(spark, keys):
    return spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id long, k string")


def run(spark, keys, path, compute=None, **more):
    found, computed = enrich.enrich_with_store(frame(spark, keys), "k", compute or lengths(), "n BIGINT", path, ["id"], **more)
    return [(r.k, r.n) for r in found.orderBy("id").collect()], computed


def test_only_new_keys_are_computed(spark, tmp_path):
    path = str(tmp_path / "store")
    want = lambda keys: [(k, None if k is None else len(k)) for k in keys]
    first, more = ["a", "bb", "a", None, "", "é" * 2000], ["bb", "ccc", "dddd", "ccc", None]
    assert run(spark, first, path) == (want(first), 4)
    assert run(spark, first, path) == (want(first), 0)
    assert run(spark, more, path, hot_rows=1) == (want(more), 2)
    assert run(spark, [], path) == ([], 0)


def test_parts_are_merged_and_a_failed_run_leaves_none(spark, tmp_path):
    path = str(tmp_path / "store")

    def fails(keys):
        return keys.withColumn("n", F.raise_error(F.lit("stop")).cast("bigint"))

    for i in range(4):
        assert run(spark, [f"k{i}", "same"], path, most_parts=2)[1] == (2 if i == 0 else 1)
    with pytest.raises(Exception, match="stop"):
        run(spark, ["other"], path, fails)
    assert run(spark, ["k0", "k1", "k2", "k3", "same"], path)[1] == 0
    listed = len(enrich._listed(spark, path))
    assert listed <= 2 and enrich.drop_unlisted(spark, path) and enrich.drop_unlisted(spark, path) == []
    assert len([f for f in os.listdir(path) if f.startswith("part-")]) == listed
    assert run(spark, ["k0", "same", "other"], path)[1] == 1


def test_functions_get_keys_by_bytes(spark):
    """Long keys come in parts of few bytes, whatever the rows of a batch; no key is lost, other kinds of keys work."""
    keys = [chr(97 + i % 26) * 300_000 + str(i) for i in range(40)]
    most = enrich.per_batch("k", lambda k: pd.DataFrame({"n": k.str.len(), "held": [int(k.str.len().sum())] * len(k)}), "n BIGINT, held BIGINT")
    found = most(frame(spark, keys).coalesce(1).select("k")).collect()
    assert sorted(r.k for r in found) == sorted(keys) and all(r.n == len(r.k) for r in found)
    assert max(r.held for r in found) < 2 * enrich.PART_BYTES < sum(map(len, keys))
    twice = enrich.per_batch("id", lambda k: pd.DataFrame({"d": k * 2}), "d BIGINT")
    assert sorted((r.id, r.d) for r in twice(frame(spark, "abc").select("id")).collect()) == [(0, 0), (1, 2), (2, 4)]


def test_unions_of_bitmaps(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, -5, rng.randint(0, 100_000)]), rng.randint(0, 40), rng.choice("abc")) for _ in range(3000)]
    df = spark.createDataFrame(rows, "x long, y int, kind string")
    subsets = {k: F.col("kind") == k for k in "abc"} | {"small": F.col("y") < 7, "none": F.lit(False)}
    releases = [stats.distinct_bitmaps(df.filter(c), ["x", "y"], subsets) for c in ("y % 2 = 0", "y % 2 = 1 or kind = 'a'")]
    unions = {"a": ["a"], "a or b": ["a", "b"], "b or small": ["b", "small"], "nothing": ["none"], "all": list("abc")}
    found = {(r.column, r.union_type): r.counts for r in stats.union_counts(releases[0].unionByName(releases[1]), unions).collect()}
    holds = {"a": lambda r: r[2] == "a", "a or b": lambda r: r[2] in "ab", "b or small": lambda r: r[2] == "b" or r[1] < 7, "all": lambda r: True}
    want = {(c, u): len({r[i] for r in rows if f(r) and r[i] is not None and r[i] >= 0}) for i, c in enumerate("xy") for u, f in holds.items()}
    assert found == want
    assert stats.union_counts(stats.distinct_bitmaps(df.limit(0), ["x"], subsets), unions).count() == 0


def test_rows_without_a_key_spread_and_hot_keys_follow_their_count(spark):
    rows = [(i, None if i % 2 else 1 if i % 3 else i) for i in range(2000)]
    df, lookup = spark.createDataFrame(rows, "id long, k int"), spark.createDataFrame([(1, "one"), (6, "six")], "k int, v string")
    hot = hot_keys(df, "k", 100)
    assert [(r.k, r._slots) for r in hot.collect()] == [(1, 7)]
    for how in ("left", "inner"):
        found = spread_join(df, lookup, "k", ["id"], hot, how).select("id", "v")
        assert sorted(found.collect()) == sorted(df.join(lookup, "k", how).select("id", "v").collect(), key=lambda r: r.id)
    assert NULL_SLOTS > 1000


def test_repeated_keys(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k long")
    b = spark.createDataFrame([("x",), ("y",)], "name string")
    found = repeated_keys({"a": (a, "k"), "b": (b, "name"), "c": (b.limit(0), "name")})
    assert {r["check"]: r.violations for r in found.collect()} == {"a": 2, "b": 0, "c": 0}
