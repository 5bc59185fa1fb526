"""Rows that do not fit are kept apart, with the reason."""

from __future__ import annotations

import json
import math
import os
import re
from collections import Counter

import pytest
from hand_tables import compounds, curated, hand_tables, measurements, targets

from pairloom.config import OutputConfig, PairConfig
from pairloom.plans.publish import publish, read_release, release_name
from pairloom.schema import INPUT_DDL
from pairloom.sinks.staging import stage
from pairloom.sources import read_tables_dealt, rejects

DDL = "id BIGINT, small INT, number DOUBLE, flag BOOLEAN, day DATE, name STRING"


def dealt(spark, rows, source="id string, small string, number string, flag string, day string, name string"):
    out = rejects.deal(spark.createDataFrame(rows, source), DDL, "t")
    return out.accepted.collect(), sorted(((r.column, r.reason, r.value) for r in out.rejected.collect()), key=str), out


def test_text(spark):
    good = [("1", "7.0", "1e3", "true", "2024-02-29", ""), ("9223372036854775807", " 5 ", "-0", "no", None, "null"), (None,) * 6]
    bad = [
        ("x", "1.5", "1,5", "maybe", "2024-02-30", "a"),
        ("9223372036854775808", "2147483648", "1", "1", "2024-01-01", "b"),
        ("", "nan", "", "", "", "c"),
    ]
    accepted, rejected, out = dealt(spark, good + bad)
    assert out.accepted.schema.simpleString() == spark.createDataFrame([], DDL).schema.simpleString()
    assert sorted(map(str, accepted)) == sorted(map(str, spark.createDataFrame(
        [(1, 7, 1000.0, True, __import__("datetime").date(2024, 2, 29), ""), (2**63 - 1, 5, -0.0, False, None, "null"), (None,) * 6], DDL
    ).collect()))
    assert rejected == sorted([
        ("id", "no number", "x"), ("small", "not whole", "1.5"), ("number", "no number", "1,5"), ("flag", "no boolean", "maybe"),
        ("day", "no date", "2024-02-30"), ("id", "out of range", "9223372036854775808"), ("small", "out of range", "2147483648"),
        ("id", "no number", ""), ("small", "not whole", "nan"), ("number", "no number", ""), ("flag", "no boolean", ""), ("day", "no date", ""),
    ], key=str)
    rows = [json.loads(r.row) for r in out.rejected.filter("value = 'x'").collect()]
    assert rows == [dict(zip(["id", "small", "number", "flag", "day", "name"], bad[0]))]


def test_numbers(spark):
    source = "id double, small long, number float, flag boolean, day date, name int"
    rows = [(1.0, 5, 1.5, True, None, 3), (1.5, 2**31, 2.0, None, None, None), (math.nan, 1, None, None, None, None), (math.inf, 1, None, None, None, None), (1e300, 1, None, None, None, None)]
    accepted, rejected, _ = dealt(spark, rows, source)
    assert [tuple(r) for r in accepted] == [(1, 5, 1.5, True, None, "3")]
    assert [(c, r) for c, r, _ in rejected] == sorted([("id", "not whole"), ("id", "not whole"), ("id", "out of range"), ("id", "out of range"), ("small", "out of range")], key=str)


ODD = [
    "", " ", "5", " 5 ", "\t-5\n", "+5", "\x7f5\x7f", "\x005", "--5", "+", "5-", "007", "0" * 30 + "7", "7.0", "7.", ".5", "-.0", "1e3", "1E+2", "1e",
    "5d", "5F", "0x1p3", "0xAP0", "NaN", "nan", " NAN ", "inf", "+Inf", "-infinity", "INFINITY", "infinit", "fat", "12 kg", "1,5", "unknown", "n/a",
    "\u0665", "\u20285", "5\u2028", "5\u00a0", "2147483647", "2147483648", "-2147483648", "-2147483649", "99999999999", "9223372036854775807",
    "-9223372036854775808", "9223372036854775808", "-9223372036854775809", "9999999999999999999", "1" * 25, "9007199254740993", "9007199254740993.0",
    "32768", "-32768", "128", "1e400", "4.9e-400", "1e38", "1e39",
]


@pytest.mark.parametrize("kind", ["BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT"])
def test_odd_texts_are_read_as_by_casts(spark, kind):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "n INT, id STRING")
    out = rejects.deal(rows, f"n INT, id {kind}", "t")
    cast = f"try_cast(id AS {kind})"
    if kind not in ("DOUBLE", "FLOAT"):
        number = "try_cast(id AS DOUBLE)"
        cast = f"coalesce({cast}, CASE WHEN {number} % 1 = 0 AND {number} >= -9223372036854775808D AND {number} < 9223372036854775808D THEN try_cast({number} AS {kind}) END)"
    want = {r.n: str(r.x) for r in rows.selectExpr("n", f"{cast} AS x").collect() if r.x is not None}
    assert {r.n: str(r.id) for r in out.accepted.collect()} == want
    lost = {r.value: r.reason for r in out.rejected.collect()}
    assert lost.keys() == {t for i, t in enumerate(ODD) if i not in want}
    if kind == "INT":
        assert (lost["99999999999"], lost["1e39"], lost["inf"], lost[".5"], lost["nan"], lost["fat"], lost["12 kg"]) == (
            "out of range", "out of range", "out of range", "not whole", "not whole", "no number", "no number",
        )


def test_a_value_is_cast_once(spark, monkeypatch):
    plans = []

    def seen(df, name):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return stage(df, name)

    monkeypatch.setattr(rejects, "stage", seen)
    dealt(spark, [("1", "7.0", "1e3", "true", "2024-02-29", ""), ("x",) * 6])
    casts = Counter(re.findall(r"cast\((\w+)#\d+ as (\w+)\)", plans[0]))
    assert casts["small", "double"] == casts["small", "bigint"] == casts["id", "double"] == casts["number", "double"] == 1
    assert max(casts.values()) == 1


def test_no_rows_and_missing_columns(spark):
    accepted, rejected, out = dealt(spark, [])
    assert accepted == rejected == [] and rejects.reject_counts(out.rejected).count() == 0
    with pytest.raises(ValueError, match="lacks the columns"):
        rejects.deal(spark.range(1), DDL, "t")


@pytest.mark.parametrize("source", ["csv", "json"])
def test_publish_goes_on_without_rejected_rows(spark, tmp_path, source):
    tables = hand_tables(
        spark, **compounds(1, 2, phase={1: 4.0}), **targets(5), **measurements((1, 5, 5.0), (2, 5, 6.0)), **curated((1, 5))
    )
    for name in INPUT_DDL:
        writer = tables[name].write
        (writer.option("header", True) if source == "csv" else writer).format(source).save(f"{tmp_path}/in/{name}")
    with open(f"{tmp_path}/in/activities/part-more.{source}", "w") as more:
        if source == "csv":
            more.write("molregno,assay_id,doc_id,potency,potential_duplicate,standard_relation,data_validity_comment\n")
            more.write("1,0,0,high,0,=,\n1,0,0,5.5,0.5,=,\n1,0\n")
        else:
            more.write('{"molregno": 1, "assay_id": 0, "doc_id": 0, "potency": "high"}\n{"molregno": 1, "potential_duplicate": 0.5}\n{"molreg\n')
    read = read_tables_dealt(spark, f"{tmp_path}/in", source, **({"header": "true"} if source == "csv" else {}))
    cfg, out = PairConfig(min_pairs_bf=1, min_pairs_b=1), OutputConfig(str(tmp_path / "out"), release="r1")
    publish(read, cfg, out)
    name = release_name(cfg, out)
    paths = read_release(spark, out.path, name)
    full = spark.read.options(header=True, sep=";").csv(paths[f"{name}_full_dataset"]).collect()
    assert sorted((r.cpd_target_pair, r.potency_mean_BF) for r in full) == [("1_5", "5.0"), ("2_5", "6.0")]
    found = spark.read.options(header=True, sep=";", escape='"').csv(paths[f"{name}_rejected"]).collect()
    assert sorted((r.table, r.column or "", r.reason) for r in found) == [
        ("activities", "", "malformed record"), ("activities", "potency", "no number"), ("activities", "potential_duplicate", "not whole"),
    ]
    assert os.path.isdir(paths[f"{name}_rejected"])
