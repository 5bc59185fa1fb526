"""Small input tables written by hand."""

from __future__ import annotations

from pairloom.schema import INPUT_DDL, columns_of
from pairloom.sources import Tables


def hand_tables(spark, **rows: list[dict]) -> Tables:
    """Tables with the given rows; columns left out are NULL, tables left out are empty."""

    def load(name):
        columns = columns_of(INPUT_DDL[name])
        data = [tuple(row.get(c) for c in columns) for row in rows.get(name, [])]
        assert all(set(row) <= set(columns) for row in rows.get(name, []))
        return spark.createDataFrame(data, INPUT_DDL[name])

    return Tables(load)


def compounds(*ids: int, phase: dict[int, float] | None = None, parents: dict[int, int] | None = None) -> dict:
    """Dictionary, hierarchy, structures and properties of plain compounds."""
    phase, parents = phase or {}, parents or {}
    return {
        "molecule_dictionary": [{"molregno": i, "public_id": f"C{i}", "max_phase": phase.get(i)} for i in ids],
        "molecule_hierarchy": [{"molregno": i, "parent_molregno": parents.get(i, i)} for i in ids],
        "compound_properties": [
            {"molregno": i, "mw_freebase": 250.0, "alogp": 1.5, "psa": 40.0, "heavy_atoms": 20} for i in ids
        ],
        "compound_structures": [{"molregno": i, "canonical_smiles": "CCO"} for i in ids],
    }


def targets(*ids: int, types: dict[int, str] | None = None, **columns) -> dict:
    types = types or {}
    return {
        "target_dictionary": [
            {"tid": i, "public_id": f"T{i}", "pref_name": f"target {i}", "target_type": types.get(i, "SINGLE PROTEIN")}
            | columns
            for i in ids
        ]
    }


def measurements(*rows: tuple) -> dict:
    """Activities, assays, variants and documents from (compound, target, value[, type, mutation, year])."""
    activities, assays, variants, docs = [], [], [], []
    for i, row in enumerate(rows):
        molregno, tid, value, kind, mutation, year = (*row, *("B", None, 2000)[len(row) - 3 :])
        activities.append(
            {
                "molregno": molregno,
                "assay_id": i,
                "doc_id": i,
                "potency": value,
                "potential_duplicate": 0,
                "standard_relation": "=",
            }
        )
        assays.append({"assay_id": i, "assay_type": kind, "tid": tid, "variant_id": None if mutation is None else i})
        if mutation is not None:
            variants.append({"variant_id": i, "mutation": mutation})
        docs.append({"doc_id": i, "year": year, "src_id": 1})
    return {"activities": activities, "assays": assays, "variant_sequences": variants, "docs": docs}


def curated(*pairs: tuple[int, int]) -> dict:
    return {"drug_mechanism": [{"molregno": m, "tid": t, "disease_efficacy": 1} for m, t in pairs]}
