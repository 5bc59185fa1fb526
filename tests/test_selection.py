"""Selected medians and positions against plain ones."""

from __future__ import annotations

import os
import random
import statistics

import numpy as np
import pytest
from hand_tables import compounds, curated, hand_tables, measurements, targets
from pyspark.sql import functions as F

from pairloom.config import PairConfig
from pairloom.operators.ordering import positions
from pairloom.operators.selection import middle_values, ordered_bits
from pairloom.plans import pair_table
from pairloom.plans.publish import write_artifact


def test_bits_are_in_the_order_of_the_values():
    values = np.array([-np.inf, -1e300, -2.5, -1e-310, 0.0, 5e-324, 1.0, 1.0000000000000002, 7.5, 1e300, np.inf])
    bits = ordered_bits(values)
    assert (np.diff(bits) > 0).all() and (ordered_bits(bits).view(np.float64) == values).all()


def cells_of(spark, groups):
    rows = [(g, v, n, m) for g, cells in groups.items() for v, n, m in cells]
    return spark.createDataFrame(rows, "g string, v double, n long, m long").repartition(4)


def middles(values):
    return (statistics.median_low(values), statistics.median_high(values)) if values else (None, None)


@pytest.mark.parametrize("seed", [1, 2])
def test_middle_values(spark, seed):
    rng = random.Random(seed)
    groups = {
        "odd and even": [(rng.choice([-1, 1]) * rng.random() * 10 ** rng.randint(-12, 12), rng.randint(0, 3), rng.randint(0, 2)) for _ in range(400)],
        "ties": [(v, rng.randint(1, 50), 1) for v in (-1.5, 0.0, -0.0, 2.25)],
        "one": [(7.0, 1, 0)],
        "two": [(7.0, 1, 0), (8.0, 1, 2)],
        "uncounted": [(3.0, 0, 0), (None, 4, 4)],
        "neighbours": [(1.0 + i * 2.0**-52, 1, i % 2) for i in range(101)],
        "limits": [(float("inf"), 1, 1), (float("-inf"), 1, 1), (1e308, 1, 1), (-1e308, 2, 1)],
    }
    found = {r.g: r for r in middle_values(cells_of(spark, groups), "g", "v", {"n": "n", "m": "m"}).collect()}
    for g, cells in groups.items():
        n = [v for v, k, _ in cells if v is not None for _ in range(k)]
        m = [v for v, _, k in cells if v is not None for _ in range(k)]
        assert (found[g].lower_n, found[g].upper_n, found[g].lower_m, found[g].upper_m) == (*middles(n), *middles(m)), g


def test_empty_cells(spark):
    assert middle_values(cells_of(spark, {"x": [(1.0, 1, 1)]}).filter("g = 'y'"), "g", "v", {"n": "n"}).count() == 0


def test_selected_medians_equal_ranked_ones(spark):
    rng = random.Random(3)
    rows = [(1, 5, rng.randint(0, 900) / 100, rng.choice("BF"), rng.choice([None, "V600E"]), 2000 + i % 9) for i in range(120)]
    rows += [(2, 5, 6.5), (2, 5, 6.5), (2, 5, 7.0), (3, 6, 4.0, "F", None, 1999)]
    tables = hand_tables(spark, **compounds(1, 2, 3, phase={1: 4.0}), **targets(5, 6), **measurements(*rows), **curated((1, 5), (3, 5)))
    ranked, selected = (
        pair_table.universe(tables, PairConfig(hot_values=k)).orderBy("parent_molregno", "tid", "mutation").collect() for k in (None, 2)
    )
    near = lambda rows: [tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in rows]
    assert near(ranked) == near(selected) and len(ranked) == 5
    pairs = pair_table.measured_pairs(tables, PairConfig(hot_values=2)).filter("parent_molregno = 1 and mutation is null").collect()
    values = [r[2] for r in rows if r[0] == 1 and r[4] is None]
    assert pairs[0].potency_median_BF == pytest.approx(statistics.median(values)) and pairs[0].potency_max_BF == max(values)


def test_positions(spark, monkeypatch):
    rng = random.Random(1)
    rows = [(rng.choice([None, *range(300)]), rng.choice(["b", "a", None, "ä", "Z"]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "a int, b string, id long").repartition(7)
    found = positions(df, ["a", "b"]).orderBy("position").collect()
    assert [r.position for r in found] == list(range(1, 3001)) and {r.id for r in found} == set(range(3000))
    key = lambda x: (x is not None, x if x is not None else 0)
    text = lambda x: (x is not None, (x or "").encode())
    want = sorted(((r[0], r[1]) for r in rows), key=lambda r: (key(r[0]), text(r[1])))
    assert [(r.a, r.b) for r in found] == want
    assert positions(df.filter("id < 0"), ["a"]).count() == 0


def test_parts_of_an_artifact_are_in_order(spark, tmp_path):
    names = "cpd_target_pair_mutation string, DTI string, parent_molregno long, tid long, cpd_target_pair string, tid_mutation string"
    rows = [(f"{i * 37 % 1000}_{i}", "D_DT", i, i, "x", "y") for i in range(5000)]
    df = spark.createDataFrame(rows, names).repartition(5)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else so few rows are written as one part
    try:
        write_artifact(df, str(tmp_path / "out"), ";")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    parts = sorted(f for f in os.listdir(tmp_path / "out") if f.endswith(".csv"))
    keys = [line.split(";")[0] for p in parts for line in (tmp_path / "out" / p).read_text().splitlines()[1:]]
    assert len(parts) > 1 and keys == sorted(r[0] for r in rows)
