"""Names, types and order of the columns that the operators read and return."""

from __future__ import annotations

# ---------------------------------------------------------------------------
# The input tables with the columns that are read.
# ---------------------------------------------------------------------------
INPUT_DDL = {
    "activities": (
        "molregno BIGINT, assay_id BIGINT, doc_id BIGINT, potency DOUBLE, potential_duplicate INT, "
        "standard_relation STRING, data_validity_comment STRING"
    ),
    "molecule_hierarchy": "molregno BIGINT, parent_molregno BIGINT",
    "molecule_dictionary": (
        "molregno BIGINT, public_id STRING, pref_name STRING, max_phase DOUBLE, first_approval INT, usan_year INT, "
        "black_box_warning INT, prodrug INT, oral INT, parenteral INT, topical INT"
    ),
    "assays": "assay_id BIGINT, assay_type STRING, tid BIGINT, variant_id BIGINT",
    "variant_sequences": "variant_id BIGINT, mutation STRING",
    "target_dictionary": "tid BIGINT, public_id STRING, pref_name STRING, target_type STRING, organism STRING",
    "docs": "doc_id BIGINT, year INT, src_id INT",
    "drug_mechanism": "molregno BIGINT, tid BIGINT, disease_efficacy INT",
    "target_relations": "tid BIGINT, relationship STRING, related_tid BIGINT",
    "compound_records": "doc_id BIGINT, molregno BIGINT",
    "compound_properties": (
        "molregno BIGINT, mw_freebase DOUBLE, alogp DOUBLE, hba INT, hbd INT, psa DOUBLE, rtb INT, ro3_pass STRING, "
        "num_ro5_violations INT, cx_most_apka DOUBLE, cx_most_bpka DOUBLE, cx_logp DOUBLE, cx_logd DOUBLE, "
        "molecular_species STRING, full_mwt DOUBLE, aromatic_rings INT, heavy_atoms INT, qed_weighted DOUBLE, "
        "mw_monoisotopic DOUBLE, full_molformula STRING, hba_lipinski INT, hbd_lipinski INT, "
        "num_lipinski_ro5_violations INT"
    ),
    "compound_structures": (
        "molregno BIGINT, standard_inchi STRING, standard_inchi_key STRING, canonical_smiles STRING"
    ),
    "atc_classification": "level1 STRING, level1_description STRING, level5 STRING",
    "molecule_atc_classification": "molregno BIGINT, level5 STRING",
    "protein_classification": "protein_class_id BIGINT, parent_id BIGINT, class_level INT, pref_name STRING",
    "component_class": "component_id BIGINT, protein_class_id BIGINT",
    "component_sequences": "component_id BIGINT",
    "target_components": "tid BIGINT, component_id BIGINT",
}


def columns_of(ddl: str) -> list[str]:
    return [part.split()[0] for part in ddl.split(", ")]


# ---------------------------------------------------------------------------
# The columns of the result, in order.
# ---------------------------------------------------------------------------
COMPOUND_DDL = (
    "parent_molregno BIGINT, parent_public_id STRING, parent_pref_name STRING, max_phase DOUBLE, first_approval INT, "
    "usan_year INT, black_box_warning INT, prodrug INT, oral INT, parenteral INT, topical INT"
)
TARGET_DDL = (
    "tid BIGINT, mutation STRING, target_public_id STRING, target_pref_name STRING, target_type STRING, "
    "organism STRING"
)
KEY_DDL = "tid_mutation STRING, cpd_target_pair STRING, cpd_target_pair_mutation STRING"
AGGREGATE_DDL = (
    "potency_mean_BF DOUBLE, potency_max_BF DOUBLE, potency_median_BF DOUBLE, "
    "first_publication_cpd_target_pair_BF INT, first_publication_cpd_target_pair_w_potency_BF INT, "
    "potency_mean_B DOUBLE, potency_max_B DOUBLE, potency_median_B DOUBLE, "
    "first_publication_cpd_target_pair_B INT, first_publication_cpd_target_pair_w_potency_B INT"
)
INTERACTION_DDL = "therapeutic_target BOOLEAN, DTI STRING"
FIRST_PUBLICATION_DDL = "first_publication_cpd INT"
PROPERTY_DDL = INPUT_DDL["compound_properties"].removeprefix("molregno BIGINT, ")
STRUCTURE_DDL = INPUT_DDL["compound_structures"].removeprefix("molregno BIGINT, ")
EFFICIENCY_DDL = (
    "LE_B DOUBLE, BEI_B DOUBLE, SEI_B DOUBLE, LLE_B DOUBLE, LE_BF DOUBLE, BEI_BF DOUBLE, SEI_BF DOUBLE, LLE_BF DOUBLE"
)
LABEL_DDL = "atc_level1 STRING, target_class_l1 STRING, target_class_l2 STRING"
DESCRIPTOR_DDL = (
    "ring_count INT, num_heteroatoms INT, aromatic_atoms INT, aromatic_c INT, aromatic_n INT, aromatic_hetero INT"
)
MEMBERSHIP_DDL = "pair_mutation_in_dm_table BOOLEAN, pair_in_dm_table BOOLEAN, keep_for_binding BOOLEAN"

# Names used on their own.
VALUE = "potency"
PARENT = "parent_molregno"
TID = "tid"
MUTATION = "mutation"
SMILES = "canonical_smiles"
INTERACTION = "DTI"
ROW_KEY = "cpd_target_pair_mutation"
SUFFIXES = ("BF", "B")  # binding and functional assays; binding assays alone
KNOWN_CLASSES = ("D_DT", "C3_DT", "C2_DT", "C1_DT", "C0_DT")
DRUG_CLASS = "D_DT"
COMPARATOR_CLASS = "DT"
OTHER_CLASS = "NDT"

PAIR = [PARENT, TID]
PAIR_MUTATION = [PARENT, TID, MUTATION]


def value_column(measure: str, suffix: str) -> str:
    return f"{VALUE}_{measure}_{suffix}"


def first_year_column(suffix: str) -> str:
    return f"first_publication_cpd_target_pair_{suffix}"


def first_measured_year_column(suffix: str) -> str:
    return f"first_publication_cpd_target_pair_w_potency_{suffix}"


def flag_columns(suffix: str, min_pairs: int) -> list[str]:
    """Enough pairs; of these, with a known pair; of these, with a drug pair."""
    return [f"{suffix}_{min_pairs}", f"{suffix}_{min_pairs}_c_dt_d_dt", f"{suffix}_{min_pairs}_d_dt"]


def result_ddl(descriptors: bool = False) -> str:
    """The clean pair table, without subset flags."""
    parts = [
        COMPOUND_DDL, TARGET_DDL, KEY_DDL, AGGREGATE_DDL, INTERACTION_DDL, FIRST_PUBLICATION_DDL,
        PROPERTY_DDL, STRUCTURE_DDL, EFFICIENCY_DDL, LABEL_DDL,
    ]
    if descriptors:
        parts.append(DESCRIPTOR_DDL)
    return ", ".join([*parts, MEMBERSHIP_DDL])


def full_ddl(min_pairs_bf: int, min_pairs_b: int, descriptors: bool = False) -> str:
    """The clean pair table followed by the six subset flags."""
    flags = flag_columns("BF", min_pairs_bf) + flag_columns("B", min_pairs_b)
    return ", ".join([result_ddl(descriptors), *(f"{name} BOOLEAN" for name in flags)])
