"""Rules that the test tables do not exercise, on hand-written rows."""

from __future__ import annotations

import math

import pytest
from hand_tables import compounds, curated, hand_tables, measurements, targets
from pyspark.sql import functions as F

from pairloom import schema as s
from pairloom.config import PairConfig
from pairloom.functions.text import pair_keys
from pairloom.operators import cleaning, known, quality, stats, subsets
from pairloom.operators.targets import class_hierarchy, target_classes
from pairloom.plans import pair_table

CFG = PairConfig(min_pairs_bf=2, min_pairs_b=2)


def rows_by_key(df):
    return {r[s.ROW_KEY]: r.asDict() for r in df.withColumns(pair_keys()).collect()}


def test_repeated_measurements_count(spark):
    tables = hand_tables(
        spark, **compounds(1), **targets(5), **measurements((1, 5, 5.0), (1, 5, 5.0), (1, 5, 8.0))
    )
    row = pair_table.measured_pairs(tables, CFG).first()
    assert row[s.value_column("mean", "BF")] == pytest.approx(6.0)
    assert row[s.value_column("median", "BF")] == 5.0
    assert pair_table.activity_rows(tables, CFG).count() == 3


def test_median_of_an_even_group_is_the_midpoint(spark):
    tables = hand_tables(
        spark, **compounds(1), **targets(5), **measurements(*[(1, 5, v) for v in (4.0, 5.0, 7.0, 9.5)])
    )
    assert pair_table.measured_pairs(tables, CFG).first()[s.value_column("median", "BF")] == 6.0


def test_assay_subsets(spark):
    """B counts for both subsets, F for one, other types for none."""
    tables = hand_tables(
        spark,
        **compounds(1, 2),
        **targets(5),
        **measurements(
            (1, 5, 5.0, "B", None, 2010), (1, 5, 7.0, "F", None, 2001), (1, 5, 9.0, "A", None, 1990), (2, 5, 9.0, "A", None, 1990)
        ),
    )
    rows = rows_by_key(pair_table.measured_pairs(tables, CFG))
    assert set(rows) == {"1_5"}
    row = rows["1_5"]
    assert (row[s.value_column("mean", "BF")], row[s.value_column("mean", "B")]) == (6.0, 5.0)
    assert (row[s.value_column("max", "BF")], row[s.value_column("max", "B")]) == (7.0, 5.0)
    assert (row[s.first_year_column("BF")], row[s.first_year_column("B")]) == (2001, 2010)


def test_validity_rules(spark):
    parts = compounds(1) | targets(5, 6) | measurements(*[(1, 5, 5.0)] * 6, (1, 6, 5.0))
    for i, change in enumerate(
        [
            {"potency": None},
            {"potential_duplicate": 1},
            {"standard_relation": ">"},
            {"data_validity_comment": "no"},
            {"standard_relation": None},
        ]
    ):
        parts["activities"][i] |= change
    tables = hand_tables(spark, **parts)
    cfg = PairConfig(excluded_tids=(6,))
    assert pair_table.activity_rows(tables, cfg).count() == 1
    assert pair_table.activity_rows(tables, PairConfig(excluded_tids=())).count() == 2


def test_target_type_ignores_case(spark):
    tables = hand_tables(
        spark,
        **compounds(1),
        **targets(5, 6, types={5: "Single Protein", 6: "ORGANISM"}),
        **measurements((1, 5, 5.0), (1, 6, 5.0)),
    )
    assert [r.tid for r in pair_table.activity_rows(tables, CFG).collect()] == [5]


def test_source_restriction_and_missing_documents(spark):
    parts = compounds(1) | targets(5) | measurements(*[(1, 5, 5.0)] * 3)
    parts["docs"] = [{"doc_id": 0, "year": 2000, "src_id": 1}, {"doc_id": 1, "year": 1990, "src_id": 37}]
    tables = hand_tables(spark, **parts)
    assert pair_table.activity_rows(tables, CFG).count() == 1
    rows = pair_table.activity_rows(tables, PairConfig(literature_only=False))
    assert sorted((r.year for r in rows.collect()), key=repr) == [1990, 2000, None]


def test_salt_forms_count_for_their_parent(spark):
    tables = hand_tables(
        spark,
        **compounds(1, 2, phase={1: 4.0, 2: 1.0}, parents={2: 1}),
        **targets(5),
        **measurements((1, 5, 5.0), (2, 5, 7.0)),
        **curated((2, 5)),
    )
    rows = rows_by_key(pair_table.universe(tables, CFG))
    assert set(rows) == {"1_5"}
    assert rows["1_5"][s.INTERACTION] == "D_DT"
    assert rows["1_5"][s.value_column("mean", "BF")] == 6.0


def test_class_ignores_mutation_but_presence_does_not(spark):
    """(1, 5) is known; only (1, 5, V600E) is measured: both rows are there, both with the known class."""
    tables = hand_tables(
        spark,
        **compounds(1, 2, phase={1: 2.0}),
        **targets(5),
        **measurements((1, 5, 5.0, "F", "V600E", 2000), (2, 5, 6.0)),
        **curated((1, 5)),
    )
    rows = rows_by_key(pair_table.universe(tables, CFG))
    assert set(rows) == {"1_5", "1_5_V600E", "2_5"}
    flags = [known.IN_KNOWN_MUTATION, known.IN_KNOWN, known.KEEP_BINDING, s.INTERACTION]
    assert [rows["1_5"][f] for f in flags] == [True, True, True, "C2_DT"]
    assert [rows["1_5_V600E"][f] for f in flags] == [False, True, False, "C2_DT"]
    assert [rows["2_5"][f] for f in flags] == [False, False, True, "DT"]
    assert rows["1_5"][s.value_column("mean", "BF")] is None


def test_empty_mutation_is_not_a_missing_one(spark):
    tables = hand_tables(
        spark, **compounds(1), **targets(5), **measurements((1, 5, 5.0, "B", "", 2000), (1, 5, 7.0)), **curated((1, 5))
    )
    rows = rows_by_key(pair_table.universe(tables, CFG))
    assert set(rows) == {"1_5", "1_5_"}
    assert rows["1_5"][known.IN_KNOWN_MUTATION] and not rows["1_5_"][known.IN_KNOWN_MUTATION]


def test_known_pairs_bypass_the_activity_filters(spark):
    tables = hand_tables(
        spark,
        **compounds(1),
        **targets(5, 22226, types={5: "ORGANISM"}),
        **measurements((1, 5, 5.0), (1, 22226, 5.0)),
        **curated((1, 5), (1, 22226)),
    )
    rows = rows_by_key(pair_table.universe(tables, PairConfig()))
    assert {k: r[s.value_column("mean", "BF")] for k, r in rows.items()} == {"1_5": None, "1_22226": None}


def test_expansion_is_one_hop(spark):
    """Family 10 -> protein 11 -> equivalent protein 12: a pair on 10 reaches 11, not 12."""
    tables = hand_tables(
        spark,
        **compounds(1),
        **targets(10, 11, 12, 13, types={10: "PROTEIN FAMILY", 13: "ORGANISM"}),
        target_relations=[
            {"tid": 10, "relationship": "SUPERSET OF", "related_tid": 11},
            {"tid": 11, "relationship": "EQUIVALENT TO", "related_tid": 12},
            {"tid": 10, "relationship": "EQUIVALENT TO", "related_tid": 12},
            {"tid": 11, "relationship": "SUPERSET OF", "related_tid": 12},
            {"tid": 10, "relationship": "SUPERSET OF", "related_tid": 13},
        ],
        **curated((1, 10)),
    )
    assert sorted(r.tid for r in pair_table.expanded_known_pairs(tables).collect()) == [10, 11]


@pytest.mark.parametrize(
    "phase, name",
    [(4.0, "D_DT"), (3.0, "C3_DT"), (2.0, "C2_DT"), (1.0, "C1_DT"), (0.5, "C0_DT"), (-1.0, "C0_DT"), (None, "C0_DT")],
)
def test_class_by_phase(spark, phase, name):
    tables = hand_tables(
        spark, **compounds(1, phase={1: phase}), **targets(5, 6), **measurements((1, 6, 5.0)), **curated((1, 5))
    )
    rows = rows_by_key(pair_table.universe(tables, CFG))
    assert {k: r[s.INTERACTION] for k, r in rows.items()} == {"1_5": name, "1_6": "NDT"}
    assert set(rows_by_key(pair_table.related_pairs(tables, CFG))) == {"1_5"}


def test_organism_null_text(spark):
    parts = compounds(1, 2) | targets(5, organism="null") | measurements((1, 5, 5.0)) | curated((2, 5))
    tables = hand_tables(spark, **parts)
    assert pair_table.activity_rows(tables, CFG).first().organism == "null"
    full = pair_table.full_table(pair_table.core(tables, CFG), tables, CFG)
    assert [r.organism for r in full.collect()] == [None, None]


def test_structures(spark):
    """No structure and mixtures are dropped; an empty text stays and becomes NULL."""
    parts = compounds(1, 2, 3, 4) | targets(5) | curated(*[(i, 5) for i in (1, 2, 3, 4)])
    texts = {1: "CCO", 2: "C.C", 3: "", 4: None}
    parts["compound_structures"] = [{"molregno": i, s.SMILES: t} for i, t in texts.items()]
    tables = hand_tables(spark, **parts)
    full = pair_table.full_table(pair_table.core(tables, CFG), tables, CFG)
    assert {r[s.PARENT]: r[s.SMILES] for r in full.collect()} == {1: "CCO", 3: None}


def test_full_schema(spark):
    tables = hand_tables(spark, **compounds(1), **targets(5), **curated((1, 5)))
    full = pair_table.full_table(pair_table.core(tables, PairConfig()), tables, PairConfig())
    assert len(full.columns) == 78
    assert full.columns[72:] == ["BF_100", "BF_100_c_dt_d_dt", "BF_100_d_dt", "B_100", "B_100_c_dt_d_dt", "B_100_d_dt"]
    clean = pair_table.clean_table(pair_table.core(tables, PairConfig()), tables, PairConfig())
    assert clean.columns == full.columns[:72]
    with pytest.raises(ValueError, match="surplus_column"):
        cleaning.clean(clean.withColumn("surplus_column", F.lit(1)), s.result_ddl())


def test_efficiency(spark):
    parts = compounds(1, 2) | targets(5) | measurements((1, 5, 6.0), (2, 5, 6.0)) | curated((1, 5))
    parts["compound_properties"][1] |= {"psa": 0.0, "heavy_atoms": 0, "mw_freebase": 0.0, "alogp": None}
    tables = hand_tables(spark, **parts)
    full = {r[s.PARENT]: r for r in pair_table.clean_table(pair_table.core(tables, CFG), tables, CFG).collect()}
    assert [full[1][c] for c in ("LE_BF", "BEI_BF", "SEI_BF", "LLE_BF")] == [
        round(6 / 20 * 2.303 * 298 * 0.00199, 4), 24.0, 15.0, 4.5,
    ]
    assert [full[2][c] for c in ("LE_B", "BEI_B", "SEI_B", "LLE_B")] == [None] * 4


def test_rounding_is_half_even_on_the_binary_value(spark):
    df = spark.createDataFrame([(0.00125, 0.00125), (5.00125, 0.5), (-0.00375, float("nan"))], "x DOUBLE, max_phase DOUBLE")
    got = cleaning.clean(df, "x DOUBLE, max_phase DOUBLE").collect()
    assert [r.x for r in got] == [0.0012, 5.0012, -0.0038]
    assert [r.max_phase for r in got] == [0.00125, 0.5, None]


def class_tables(spark, names, component_class):
    """``names``: class id -> (parent, name); ``component_class``: target -> class ids."""
    return hand_tables(
        spark,
        protein_classification=[
            {"protein_class_id": i, "parent_id": p, "class_level": 0, "pref_name": n} for i, (p, n) in names.items()
        ],
        component_class=[
            {"component_id": t, "protein_class_id": c} for t, classes in component_class.items() for c in classes
        ],
        component_sequences=[{"component_id": t} for t in component_class],
        target_components=[{"tid": t, "component_id": t} for t in component_class],
    )


def test_hierarchy_of_any_depth(spark):
    names = {0: (None, "root")} | {i: (i - 1, f"n{i}") for i in range(1, 13)} | {50: (0, "a|b"), 51: (50, "leaf")}
    rows = {r.protein_class_id: r for r in class_hierarchy(class_tables(spark, names, {})).collect()}
    assert 0 not in rows and len(rows) == 14
    assert rows[12].names == "root|" + "|".join(f"n{i}" for i in range(1, 13))
    assert (rows[12].l1, rows[12].l2) == ("n1", "n2")
    assert (rows[1].l1, rows[1].l2) == ("n1", None)
    assert (rows[51].l1, rows[51].l2) == ("a|b", "leaf")


def test_hierarchy_of_500_levels_and_cycles(spark):
    names = {0: (None, "root")} | {i: (i - 1, f"n{i}") for i in range(1, 501)} | {900: (901, "orphan")}
    rows = {r.protein_class_id: r for r in class_hierarchy(class_tables(spark, names, {})).collect()}
    assert len(rows) == 500 and rows[500].names.count("|") == 500 and rows[500].l2 == "n2"
    with pytest.raises(ValueError, match="cycle"):
        class_hierarchy(class_tables(spark, {0: (None, "root"), 1: (2, "a"), 2: (1, "b")}, {}))


def test_distinct_counts_of_many_subsets(spark):
    df = spark.range(200).withColumn("k", F.col("id") % 50)
    rows = stats.distinct_counts(df, ["k"], {f"s{i}": F.col("k") < i for i in range(130)}).collect()
    assert {r.subset_type: r.counts for r in rows} == {f"s{i}": min(i, 50) for i in range(130)}


def test_target_labels(spark):
    names = {
        0: (None, "root"),
        1: (0, "Unclassified protein"),
        2: (0, "Enzyme"),
        3: (0, "Channel"),
        4: (2, "Kinase"),
        5: (2, "Unclassified protein"),
    }
    labels = target_classes(
        class_tables(spark, names, {10: [1], 11: [1, 2], 12: [3, 2, 1], 13: [4, 5], 14: [0], 15: [4, 4]})
    )
    got = {r.tid: (r.target_class_l1, r.target_class_l2) for r in labels.collect()}
    assert got == {
        10: ("Unclassified protein", None),
        11: ("Enzyme", None),
        12: ("Channel|Enzyme", None),
        13: ("Enzyme", "Kinase|Unclassified protein"),
        15: ("Enzyme", "Kinase"),
    }


def flag_frame(spark, rows):
    ddl = (
        "parent_molregno BIGINT, tid_mutation STRING, DTI STRING, keep_for_binding BOOLEAN, "
        f"{s.value_column('mean', 'BF')} DOUBLE, {s.value_column('mean', 'B')} DOUBLE"
    )
    return spark.createDataFrame(rows, ddl)


@pytest.mark.parametrize("hot_rows", [1, 2, 1000])
def test_subset_flags(spark, hot_rows):
    """Group 5: two measured rows each way, but its known pair is outside the binding scope.
    Group 6: one measured row only. Group 7: enough for BF alone, with a drug."""
    df = flag_frame(
        spark,
        [
            (1, "5", "DT", True, 5.0, 5.0),
            (2, "5", "DT", True, 6.0, 6.0),
            (3, "5", "C1_DT", False, 6.0, None),
            (1, "6", "D_DT", True, 5.0, 5.0),
            (2, "6", "DT", True, None, None),
            (1, "7", "D_DT", True, 5.0, None),
            (2, "7", "DT", False, 5.0, None),
        ],
    )
    flagged = subsets.subset_flags(df, CFG, hot_rows=hot_rows)
    names = s.flag_columns("BF", 2) + s.flag_columns("B", 2)
    got = {(r.parent_molregno, r.tid_mutation): [int(r[n]) for n in names] for r in flagged.collect()}
    assert got == {
        (1, "5"): [1, 1, 0, 1, 0, 0],
        (2, "5"): [1, 1, 0, 1, 0, 0],
        (3, "5"): [1, 1, 0, 0, 0, 0],
        (1, "6"): [0] * 6,
        (2, "6"): [0] * 6,
        (1, "7"): [1, 1, 1, 0, 0, 0],
        (2, "7"): [1, 1, 1, 0, 0, 0],
    }


def test_subset_columns(spark):
    tables = hand_tables(spark, **compounds(1), **targets(5), **measurements((1, 5, 5.0)), **curated((1, 5)))
    full = pair_table.full_table(pair_table.core(tables, CFG), tables, CFG)
    for suffix, other in (("BF", "B"), ("B", "BF")):
        names = subsets.subset(full, suffix).columns
        assert len(names) == 72 - 9
        assert s.value_column("mean", suffix) in names and s.value_column("mean", other) not in names
        assert f"LE_{other}" not in names and not any(n.startswith(("B_", "BF_")) for n in names)


def test_hot_pairs_give_the_same_table(spark):
    """Salted lookups against plain ones, on the whole test tables."""
    from pairloom.plans.queries import CONFIG
    from pairloom.sources.fixture_views import fixture_tables

    tables = fixture_tables(spark, "/root/testdata/sf0.001")
    pairs = pair_table.core(tables, CONFIG)
    plain = pair_table.full_table(pairs, tables, CONFIG)
    salted = pair_table.full_table(pairs, tables, CONFIG, hot_rows=5)
    assert plain.count() > 100
    assert quality.bag_difference(plain, salted).isEmpty()


def test_measures_against_pandas(spark):
    """Random rows: mean, maximum, median and first year of each pair."""
    import random

    import pandas as pd

    rng = random.Random(3)
    rows = [
        (rng.randint(1, 3), rng.randint(5, 7), rng.randint(400, 1100) / 100, rng.choice("BF"), rng.choice([None, "V6E"]), rng.randint(1990, 2020))
        for _ in range(400)
    ]
    tables = hand_tables(spark, **compounds(1, 2, 3), **targets(5, 6, 7), **measurements(*rows))
    got = rows_by_key(pair_table.measured_pairs(tables, CFG))
    frame = pd.DataFrame(rows, columns=["c", "t", "v", "kind", "m", "y"])
    for suffix, kinds in (("BF", "BF"), ("B", "B")):
        for (c, t, m), group in frame[frame.kind.isin(list(kinds))].groupby(["c", "t", "m"], dropna=False):
            row = got[f"{c}_{t}" + ("" if m is None or m != m else f"_{m}")]
            assert math.isclose(row[s.value_column("mean", suffix)], group.v.mean())
            assert row[s.value_column("max", suffix)] == group.v.max()
            assert math.isclose(row[s.value_column("median", suffix)], group.v.median())
            assert row[s.first_year_column(suffix)] == group.y.min()
            assert row[s.first_measured_year_column(suffix)] == group.y.min()
