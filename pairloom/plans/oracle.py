"""The expected results as SQL over the test tables, for DuckDB.

The SQL is written from the definitions (two aggregations and a join, IN lists, one COUNT(DISTINCT) per
cell, correlated subset levels), not from the Spark plans, so that it checks their rewrites too.
"""

from __future__ import annotations

from pairloom import schema as s
from pairloom.schema import columns_of
from pairloom.sources.fixture_views import duckdb_views

MIN_PAIRS = 20

PROPERTIES = columns_of(s.PROPERTY_DDL) + columns_of(s.STRUCTURE_DDL)
COMPOUND = columns_of(s.COMPOUND_DDL)
TARGET = ["target_public_id", "target_pref_name", "target_type", "organism"]
AGGREGATES = columns_of(s.AGGREGATE_DDL)
EFFICIENCIES = columns_of(s.EFFICIENCY_DDL)
DESCRIPTORS = columns_of(s.DESCRIPTOR_DDL)
FLAGS = s.flag_columns("BF", MIN_PAIRS) + s.flag_columns("B", MIN_PAIRS)


def rounded(expression: str) -> str:
    return f"round_even({expression} * 10000, 0) / 10000"


def in_list(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def listed(columns, alias: str = "") -> str:
    return ", ".join(f"{alias}{c}" for c in columns)


def cleaned(ddl: str) -> str:
    """Select list with empty text as NULL and doubles rounded."""
    out = []
    for part in ddl.split(", "):
        name, kind = part.split()
        if kind == "STRING":
            out.append(f"nullif({name}, '') AS {name}")
        elif kind == "DOUBLE" and name != "max_phase":
            out.append(f"{rounded(name)} AS {name}")
        else:
            out.append(name)
    return ", ".join(out)


def union_select() -> str:
    unions = {
        "known": ("DT", "D_DT"),
        "late": ("D_DT", "C3_DT", "C2_DT"),
        "early": ("C1_DT", "C0_DT"),
        "any": ("DT", "D_DT", "C0_DT", "C1_DT", "C2_DT", "C3_DT"),
    }
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{name}' AS union_type, count(DISTINCT {c}) AS counts FROM flagged "
        f"WHERE DTI IN {in_list(classes)} HAVING count(*) > 0"
        for c in ("parent_molregno", "tid")
        for name, classes in unions.items()
    )


def round_listed(columns) -> str:
    return ", ".join(f"{rounded(c)} AS {c}" for c in columns)


def pair_side(suffix: str, types: str, source: str) -> str:
    value, year = s.VALUE, "year"
    return f"""
SELECT parent_molregno, tid, mutation, avg({value}) AS {s.value_column("mean", suffix)},
 max({value}) AS {s.value_column("max", suffix)}, median({value}) AS {s.value_column("median", suffix)},
 min({year}) AS {s.first_year_column(suffix)},
 min({year}) FILTER ({value} IS NOT NULL) AS {s.first_measured_year_column(suffix)}
FROM {source} WHERE assay_type IN {types} GROUP BY parent_molregno, tid, mutation"""


def text_keys(alias: str) -> str:
    p, t, m = f"{alias}.parent_molregno", f"{alias}.tid", f"{alias}.mutation"
    return f"""concat_ws('_', {t}, {m}) AS tid_mutation, concat_ws('_', {p}, {t}) AS cpd_target_pair,
 concat_ws('_', {p}, {t}, {m}) AS cpd_target_pair_mutation"""


def efficiency(suffix: str) -> str:
    mean = s.value_column("mean", suffix)
    return f"""{mean} / nullif(heavy_atoms, 0) * (2.303::DOUBLE * 298 * 0.00199::DOUBLE) AS LE_{suffix},
 {mean} * 1000 / nullif(mw_freebase, 0) AS BEI_{suffix}, {mean} * 100 / nullif(psa, 0) AS SEI_{suffix},
 {mean} - alogp AS LLE_{suffix}"""


def sub(pattern: str, text: str) -> str:
    return f"regexp_replace({text}, '{pattern}', '', 'g')"


def n(pattern: str, text: str) -> str:
    return f"len(regexp_extract_all({text}, '{pattern}'))"


BRACKETED = r"\[[0-9]*"


def smiles_select(smiles: str = "canonical_smiles") -> str:
    plain = sub(r"\[[^\]]*\]", smiles)
    organic = sub("Cl|Br", plain)
    aromatic = f"{n('[bcnops]', organic)} + {n(BRACKETED + '[a-z]', smiles)}"
    carbon = f"{n('c', organic)} + {n(BRACKETED + 'c', smiles)}"
    nitrogen = f"{n('n', organic)} + {n(BRACKETED + 'n', smiles)}"
    bracket = "\\["
    hetero = f"{n('Cl|Br|[BNOPSFIbnops]', plain)} + {n(bracket, smiles)} - {n(BRACKETED + '[CcH][^a-z]', smiles)}"
    counts = {
        "ring_count": f"{n('%[0-9][0-9]|[0-9]', plain)} // 2",
        "num_heteroatoms": hetero,
        "aromatic_atoms": aromatic,
        "aromatic_c": carbon,
        "aromatic_n": nitrogen,
        "aromatic_hetero": f"({aromatic}) - ({carbon})",
    }
    return ", ".join(f"CAST({e} AS INTEGER) AS {c}" for c, e in counts.items())


def level_ctes(suffix: str) -> dict[str, str]:
    """Targets of the three subset levels of an assay subset, step by step."""
    rows = "clean" if suffix == "BF" else "(SELECT * FROM clean WHERE keep_for_binding)"
    mean = s.value_column("mean", suffix)
    return {
        f"rows_{suffix}": f"SELECT * FROM {rows}",
        f"enough_{suffix}": f"""
SELECT tid_mutation FROM rows_{suffix} WHERE {mean} IS NOT NULL GROUP BY tid_mutation HAVING count(*) >= {MIN_PAIRS}""",
        f"known_{suffix}": f"""
SELECT DISTINCT tid_mutation FROM rows_{suffix}
WHERE tid_mutation IN (SELECT tid_mutation FROM enough_{suffix}) AND DTI IN {in_list(s.KNOWN_CLASSES)}""",
        f"drug_{suffix}": f"""
SELECT DISTINCT tid_mutation FROM rows_{suffix}
WHERE tid_mutation IN (SELECT tid_mutation FROM enough_{suffix}) AND DTI = 'D_DT'""",
    }


def flag_select(suffix: str) -> str:
    scope = "true" if suffix == "BF" else "keep_for_binding"
    names = s.flag_columns(suffix, MIN_PAIRS)
    return ", ".join(
        f"{scope} AND tid_mutation IN (SELECT tid_mutation FROM {level}_{suffix}) AS {name}"
        for level, name in zip(("enough", "known", "drug"), names)
    )


COMPOUND_SELECT = "molregno AS parent_molregno, public_id AS parent_public_id, pref_name AS parent_pref_name, " + listed(
    COMPOUND[3:]
)

CTES = {
    # measurements
    "valid_assay": """
SELECT assay_id, assay_type, tid, mutation FROM assays LEFT JOIN variant_sequences USING (variant_id)
WHERE tid IN (SELECT tid FROM target_dictionary WHERE contains(upper(target_type), 'PROTEIN') AND tid <> 22226)""",
    "measured": """
SELECT h.parent_molregno, x.tid, x.mutation, x.assay_type, a.potency, d.year, d.src_id
FROM (SELECT * FROM activities WHERE potency IS NOT NULL AND potential_duplicate = 0
      AND standard_relation = '=' AND data_validity_comment IS NULL) a
JOIN molecule_hierarchy h USING (molregno) JOIN valid_assay x USING (assay_id) LEFT JOIN docs d USING (doc_id)
WHERE h.parent_molregno IN (SELECT molregno FROM molecule_dictionary)""",
    "literature": "SELECT * FROM measured WHERE src_id = 1",
    "compound": f"SELECT {COMPOUND_SELECT} FROM molecule_dictionary",
    "target": """
SELECT tid, public_id AS target_public_id, pref_name AS target_pref_name, target_type, nullif(organism, 'null') AS organism
FROM target_dictionary""",
    "pair_bf": pair_side("BF", "('B', 'F')", "literature"),
    "pair_b": pair_side("B", "('B')", "literature"),
    "pair": f"""
SELECT f.*, {listed(AGGREGATES[5:], "b.")} FROM pair_bf f LEFT JOIN pair_b b
ON f.parent_molregno = b.parent_molregno AND f.tid = b.tid AND f.mutation IS NOT DISTINCT FROM b.mutation""",
    # curated pairs
    "known_direct": """
SELECT DISTINCT h.parent_molregno, m.tid FROM drug_mechanism m JOIN molecule_hierarchy h USING (molregno)
WHERE m.disease_efficacy = 1 AND m.tid IS NOT NULL AND h.parent_molregno IN (SELECT molregno FROM molecule_dictionary)""",
    "mapping": f"""
SELECT DISTINCT r.tid, r.relationship, r.related_tid, a.pref_name AS pref_name_1, a.target_type AS target_type_1,
 a.organism AS organism_1, b.pref_name AS pref_name_2, b.target_type AS target_type_2, b.organism AS organism_2
FROM target_relations r, target_dictionary a, target_dictionary b
WHERE r.tid = a.tid AND r.related_tid = b.tid AND b.target_type = 'SINGLE PROTEIN'
AND (a.target_type, r.relationship) IN (('PROTEIN FAMILY', 'SUPERSET OF'), ('PROTEIN COMPLEX', 'SUPERSET OF'),
 ('PROTEIN COMPLEX GROUP', 'SUPERSET OF'), ('CHIMERIC PROTEIN', 'SUPERSET OF'), ('PROTEIN-PROTEIN INTERACTION', 'SUPERSET OF'),
 ('SINGLE PROTEIN', 'EQUIVALENT TO'))""",
    "known": """
SELECT parent_molregno, tid FROM known_direct
UNION SELECT k.parent_molregno, m.related_tid FROM known_direct k JOIN mapping m ON k.tid = m.tid""",
    "missing": """
SELECT parent_molregno, tid FROM known k WHERE NOT EXISTS (
 SELECT 1 FROM pair p WHERE p.parent_molregno = k.parent_molregno AND p.tid = k.tid AND p.mutation IS NULL)""",
    "universe": f"""
SELECT u.*, {text_keys("u")},
 concat_ws('_', u.parent_molregno, u.tid, u.mutation) IN (SELECT concat_ws('_', parent_molregno, tid) FROM known) AS pair_mutation_in_dm_table,
 concat_ws('_', u.parent_molregno, u.tid) IN (SELECT concat_ws('_', parent_molregno, tid) FROM known) AS pair_in_dm_table,
 u.tid IN (SELECT tid FROM known) AS therapeutic_target
FROM (SELECT * FROM pair UNION ALL BY NAME SELECT * FROM missing) u""",
    "classified": f"""
SELECT u.*, {s.value_column("mean", "B")} IS NOT NULL OR pair_mutation_in_dm_table AS keep_for_binding, {listed(COMPOUND[1:], "c.")},
 CASE WHEN pair_in_dm_table THEN CASE c.max_phase WHEN 4 THEN 'D_DT' WHEN 3 THEN 'C3_DT' WHEN 2 THEN 'C2_DT' WHEN 1 THEN 'C1_DT' ELSE 'C0_DT' END
      WHEN therapeutic_target THEN 'DT' ELSE 'NDT' END AS DTI
FROM universe u LEFT JOIN compound c USING (parent_molregno)""",
    "related": "SELECT * FROM classified WHERE DTI <> 'NDT'",
    # compounds
    "first_year": """
SELECT h.parent_molregno, min(d.year) AS first_publication_cpd
FROM compound_records r JOIN docs d USING (doc_id) JOIN molecule_hierarchy h USING (molregno)
WHERE d.year IS NOT NULL AND d.src_id = 1 GROUP BY h.parent_molregno""",
    "props": f"""
SELECT DISTINCT h.parent_molregno, {listed(PROPERTIES)}
FROM molecule_hierarchy h, compound_properties p, compound_structures t
WHERE h.parent_molregno = p.molregno AND h.parent_molregno = t.molregno""",
    "atc": """
SELECT parent_molregno, string_agg(label, ' | ' ORDER BY label) AS atc_level1 FROM (
 SELECT DISTINCT h.parent_molregno, a.level1 || '_' || a.level1_description AS label
 FROM molecule_atc_classification m JOIN atc_classification a USING (level5) JOIN molecule_hierarchy h USING (molregno))
GROUP BY parent_molregno""",
    "described": f"""
SELECT r.*, f.first_publication_cpd, {listed(PROPERTIES, "p.")}, a.atc_level1, {efficiency("BF")}, {efficiency("B")}
FROM related r LEFT JOIN first_year f USING (parent_molregno) LEFT JOIN props p USING (parent_molregno)
LEFT JOIN atc a USING (parent_molregno)""",
    "single": "SELECT * FROM described WHERE canonical_smiles IS NOT NULL AND NOT contains(canonical_smiles, '.')",
    # target classes
    "walk": """
SELECT protein_class_id, parent_id, class_level, pref_name AS names, [pref_name] AS path
FROM protein_classification WHERE parent_id IS NULL
UNION ALL SELECT c.protein_class_id, c.parent_id, c.class_level, w.names || '|' || c.pref_name, list_append(w.path, c.pref_name)
FROM protein_classification c JOIN walk w ON c.parent_id = w.protein_class_id""",
    "hierarchy_path": """
SELECT protein_class_id, parent_id, class_level, names, path[2] AS l1, path[3] AS l2 FROM walk WHERE protein_class_id <> 0""",
    "class_row": """
SELECT DISTINCT t.tid, p.l1, p.l2 FROM target_components t JOIN component_sequences q USING (component_id)
JOIN component_class c USING (component_id) JOIN protein_classification pc USING (protein_class_id)
LEFT JOIN hierarchy_path p ON p.protein_class_id = pc.protein_class_id
WHERE t.tid IN (SELECT tid FROM single)""",
    "level1": """
SELECT tid, string_agg(l1, '|' ORDER BY l1) AS target_class_l1
FROM (SELECT tid, l1, count(*) OVER (PARTITION BY tid) AS labels FROM (SELECT DISTINCT tid, l1 FROM class_row WHERE l1 IS NOT NULL))
WHERE labels = 1 OR l1 <> 'Unclassified protein' GROUP BY tid""",
    "level2": """
SELECT tid, string_agg(l2, '|' ORDER BY l2) AS target_class_l2
FROM (SELECT DISTINCT tid, l2 FROM class_row WHERE l2 IS NOT NULL) GROUP BY tid""",
    "labelled": f"""
SELECT g.*, {listed(TARGET, "t.")}, x.target_class_l1, y.target_class_l2, {smiles_select("g.canonical_smiles")}
FROM single g LEFT JOIN target t USING (tid) LEFT JOIN level1 x USING (tid) LEFT JOIN level2 y USING (tid)""",
    "clean": f"SELECT {cleaned(s.result_ddl(descriptors=True))} FROM labelled",
    **level_ctes("BF"),
    **level_ctes("B"),
    "flagged": f"SELECT *, {flag_select('BF')}, {flag_select('B')} FROM clean",
}


def query(select: str, **replaced: str) -> str:
    """``select`` over the fixture views and the CTEs above, some of them replaced."""
    parts = [f"{name} AS ({text.strip()}\n)" for name, text in {**duckdb_views(), **CTES, **replaced}.items()]
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + select.strip()


def all_sources(select: str) -> str:
    """Without the restriction to literature in measurements and first publications."""
    return query(
        select, literature="SELECT * FROM measured", first_year=CTES["first_year"].replace("AND d.src_id = 1", "")
    )


def described_rows(source: str) -> str:
    return f"""
SELECT m.potency, m.assay_type, m.tid, m.mutation, m.year, {listed(COMPOUND, "c.")}, {text_keys("m")},
 t.public_id AS target_public_id, t.pref_name AS target_pref_name, t.target_type, t.organism
FROM {source} m JOIN compound c ON c.parent_molregno = m.parent_molregno JOIN target_dictionary t ON t.tid = m.tid"""


def subset_select(suffix: str, condition: str) -> str:
    other = "B" if suffix == "BF" else "BF"
    kept = [c for c in columns_of(s.result_ddl()) if not c.endswith(f"_{other}")]
    return query(f"SELECT {listed(kept)} FROM flagged WHERE {condition}")


COUNTED = {
    "parent_molregno": "compound ID",
    "tid": "target ID",
    "tid_mutation": "target ID with mutation annotations",
    "cpd_target_pair": "compound-target pair",
    "cpd_target_pair_mutation": "compound-target pair with mutation annotations",
}
STEPS = [
    "measured pairs", "with curated pairs", "pairs on known targets", "with compound columns", "single structures",
    "with target classes", "cleaned table",
]


def stats_select() -> str:
    subsets = {"all": "true"} | {
        "comparators": "DTI = 'DT'",
        "drugs": "DTI = 'D_DT'",
        "candidates": "DTI IN ('C0_DT', 'C1_DT', 'C2_DT', 'C3_DT')",
        **{f"candidates_phase_{p}": f"DTI = 'C{p}_DT'" for p in (3, 2, 1, 0)},
    }
    rows = [
        f"""SELECT '{c}' AS "column", '{d}' AS column_description, '{k}' AS subset_type, count(DISTINCT {c}) FILTER ({cond}) AS counts FROM clean"""
        for c, d in COUNTED.items()
        for k, cond in subsets.items()
    ]
    return query("\nUNION ALL ".join(rows))


def sizes_select(measured_only: bool) -> str:
    """One SELECT per step over the table as it is after the step."""
    any_value = "coalesce(" + listed([c for c in AGGREGATES if c.startswith(s.VALUE)]) + ") IS NOT NULL"
    value_of = {x: f"{s.value_column('mean', x)} IS NOT NULL" for x in s.SUFFIXES}
    measured_pair = f"(SELECT * FROM classified WHERE {value_of['BF']})"
    sources = dict(
        zip(STEPS, [measured_pair, "classified", "related", "described", "single", "labelled", "clean"])
    )
    rows = []

    def add(label: str, source: str, drug: str, measured: str) -> None:
        where = f" WHERE {measured}" if measured_only else ""
        counts = ", ".join(
            f"count(DISTINCT {c}) AS {c}_all, count(DISTINCT {c}) FILTER ({drug}) AS {c}_drugs" for c in COUNTED
        )
        rows.append(f"SELECT '{label}' AS step, {counts} FROM {source}{where}")

    for i, (label, source) in enumerate(sources.items()):
        add(label, source, "max_phase = 4" if i < 2 else "DTI = 'D_DT'", any_value)
    for x in s.SUFFIXES:
        scope = "true" if x == "BF" else "keep_for_binding"
        for name, cond in [(x, scope), *((f, f) for f in s.flag_columns(x, MIN_PAIRS))]:
            add(name, f"(SELECT * FROM flagged WHERE {cond})", "DTI = 'D_DT'", value_of[x])
    return query("\nUNION ALL ".join(rows))


def quality_select() -> str:
    """Violations of the described table (mixtures included) and of the final one."""
    described, final = {}, {}
    for m in ("mean", "max", "median"):
        c = s.value_column(m, "BF")
        described[f"value_missing:{c}"] = f"{c} IS NULL AND NOT pair_mutation_in_dm_table"
    for c in PROPERTIES:
        described[f"property_null:{c}"] = (
            f"({c} IS NULL) <> (parent_molregno NOT IN (SELECT parent_molregno FROM props) "
            f"OR parent_molregno IN (SELECT parent_molregno FROM props WHERE {c} IS NULL))"
        )
    for x in s.SUFFIXES:
        mean = s.value_column("mean", x)
        for metric, c in (("LE", "heavy_atoms"), ("BEI", "mw_freebase"), ("SEI", "psa")):
            described[f"efficiency_null:{metric}_{x}"] = (
                f"({metric}_{x} IS NULL) <> ({mean} IS NULL OR {c} IS NULL OR coalesce({c} = 0, false))"
            )
        described[f"efficiency_null:LLE_{x}"] = f"(LLE_{x} IS NULL) <> ({mean} IS NULL OR alogp IS NULL)"
    described["keep_for_binding"] = (
        f"keep_for_binding <> ({s.value_column('mean', 'B')} IS NOT NULL OR pair_mutation_in_dm_table)"
    )
    described["label_null:atc_level1"] = (
        "(atc_level1 IS NULL) <> (parent_molregno NOT IN (SELECT parent_molregno FROM atc))"
    )
    for i in (1, 2):
        final[f"label_null:target_class_l{i}"] = f"(target_class_l{i} IS NULL) <> (tid NOT IN (SELECT tid FROM level{i}))"
    for c in DESCRIPTORS:
        described[f"descriptor_null:{c}"] = f"({c} IS NULL) <> (canonical_smiles IS NULL)"
    texts = [p.split()[0] for p in s.result_ddl(True).split(", ") if p.endswith("STRING")]
    for literal in ("nan", "null"):
        final[f"literal:{literal}"] = " OR ".join(f"coalesce({c} = '{literal}', false)" for c in texts)
    for x in s.SUFFIXES:
        scope = "true" if x == "BF" else "keep_for_binding"
        for level, name in zip(("enough", "known", "drug"), s.flag_columns(x, MIN_PAIRS)):
            final[f"subset_flag:{name}"] = (
                f"{name} <> ({scope} AND tid_mutation IN (SELECT tid_mutation FROM {level}_{x}))"
            )
    before = f"(SELECT *, {smiles_select()} FROM described)"
    rows = [
        f"""SELECT '{name}' AS "check", count(*) FILTER ({cond}) AS violations FROM {source_name}"""
        for checks, source_name in ((described, before), (final, "flagged"))
        for name, cond in checks.items()
    ]
    keys = {
        "molecule_dictionary": "molregno", "molecule_hierarchy": "molregno", "compound_properties": "molregno",
        "compound_structures": "molregno", "variant_sequences": "variant_id", "target_dictionary": "tid",
    }
    repeated = {f"unique:{table}": (table, key) for table, key in keys.items()}
    repeated["duplicate_row_key"] = ("flagged", "cpd_target_pair_mutation")
    rows += [
        f"""SELECT '{name}', count(*) FROM (SELECT {key} FROM {table} GROUP BY {key} HAVING count(*) > 1)"""
        for name, (table, key) in repeated.items()
    ]
    return query("\nUNION ALL ".join(rows))


CONSISTENCY_CTES = {
    "mixture": "SELECT DISTINCT parent_molregno, canonical_smiles FROM described WHERE contains(canonical_smiles, '.')",
    "source": "SELECT molregno, count(*) AS n, min(canonical_smiles) AS text FROM compound_structures GROUP BY molregno",
}
CONSISTENCY = """
SELECT (SELECT count(*) FROM mixture) AS checked, "check", violations FROM (
 SELECT 'mixture_is_no_parent' AS "check", count(*) AS violations FROM mixture WHERE parent_molregno NOT IN (SELECT parent_molregno FROM molecule_hierarchy)
 UNION ALL SELECT 'mixture_has_other_parent', count(*) FROM mixture WHERE parent_molregno IN (SELECT molregno FROM molecule_hierarchy WHERE molregno <> parent_molregno)
 UNION ALL SELECT 'mixture_structure_not_unique', count(*) FROM mixture m LEFT JOIN source ON molregno = parent_molregno WHERE n IS DISTINCT FROM 1
 UNION ALL SELECT 'mixture_structure_differs', count(*) FROM mixture m LEFT JOIN source ON molregno = parent_molregno WHERE text IS DISTINCT FROM canonical_smiles)"""


def oracle_queries() -> dict[str, str]:
    result = listed(columns_of(s.result_ddl()))
    full = f"{result}, {listed(FLAGS)}"
    described_pair = f"""
SELECT {listed(COMPOUND, "c.")}, p.tid, p.mutation, {listed(TARGET, "t.")}, {round_listed(AGGREGATES[:3] + AGGREGATES[5:8])},
 {listed(AGGREGATES[3:5] + AGGREGATES[8:])},
 {text_keys("p")}"""
    out = {
        "activity_pairs": query(described_rows("literature")),
        "activity_pairs_all_sources": query(described_rows("measured")),
        "pair_aggregates": query(f"""
SELECT parent_molregno, concat_ws('_', tid, mutation) AS tid_mutation, {round_listed(AGGREGATES[:3] + AGGREGATES[5:8])},
 {listed(AGGREGATES[3:5] + AGGREGATES[8:])} FROM pair"""),
        "pair_aggregates_selected": query(f"""
SELECT parent_molregno, concat_ws('_', tid, mutation) AS tid_mutation, {round_listed(AGGREGATES[:3] + AGGREGATES[5:8])},
 {listed(AGGREGATES[3:5] + AGGREGATES[8:])} FROM pair"""),
        "pair_attributes": query(
            f"{described_pair} FROM pair p LEFT JOIN compound c USING (parent_molregno) LEFT JOIN target t USING (tid)"
        ),
        "known_pairs": query("SELECT * FROM known_direct"),
        "target_mappings": query("SELECT * FROM mapping"),
        "known_pairs_expanded": query("SELECT * FROM known"),
        "mechanism_pairs": query(f"""
SELECT {listed(COMPOUND, "c.")}, k.tid, {listed(TARGET, "t.")}, CAST(k.tid AS VARCHAR) AS tid_mutation,
 concat_ws('_', k.parent_molregno, k.tid) AS cpd_target_pair, concat_ws('_', k.parent_molregno, k.tid) AS cpd_target_pair_mutation,
 true AS pair_mutation_in_dm_table, true AS pair_in_dm_table
FROM known k LEFT JOIN compound c USING (parent_molregno) LEFT JOIN target t USING (tid)"""),
        "missing_known_pairs": query("SELECT * FROM missing"),
        "pair_universe": query(
            f"{described_pair}, pair_mutation_in_dm_table, pair_in_dm_table, keep_for_binding "
            "FROM classified p LEFT JOIN compound c USING (parent_molregno) LEFT JOIN target t USING (tid)"
        ),
        "membership_flags": query(
            "SELECT cpd_target_pair_mutation, pair_mutation_in_dm_table, pair_in_dm_table, keep_for_binding, "
            "therapeutic_target FROM classified"
        ),
        "interaction_class": query("SELECT cpd_target_pair_mutation, max_phase, therapeutic_target, DTI FROM related"),
        "first_publication": query("SELECT * FROM first_year"),
        "compound_props": query("SELECT * FROM props"),
        "ligand_efficiency": query(f"SELECT cpd_target_pair_mutation, {round_listed(EFFICIENCIES)} FROM described"),
        "atc_labels": query("SELECT * FROM atc"),
        "drop_mixtures": query("SELECT cpd_target_pair_mutation, parent_molregno, canonical_smiles FROM single"),
        "parent_consistency": query(CONSISTENCY, **CONSISTENCY_CTES),
        "class_hierarchy": query("SELECT * FROM hierarchy_path"),
        "target_classes": query(
            "SELECT tid, target_class_l1, target_class_l2 FROM level1 FULL JOIN level2 USING (tid)"
        ),
        "ambiguous_targets": query("""
SELECT DISTINCT tid, target_pref_name, target_type, target_class_l1, target_class_l2 FROM labelled
WHERE contains(target_class_l1, '|') OR contains(target_class_l2, '|')"""),
        "clean_dataset": query(f"SELECT {result} FROM clean"),
        "subset_flags": query(f"SELECT cpd_target_pair_mutation, {listed(FLAGS)} FROM flagged"),
        "subset_flags_hot": query(f"SELECT cpd_target_pair_mutation, {listed(FLAGS)} FROM flagged"),
        "distinct_stats": stats_select(),
        "step_sizes": sizes_select(measured_only=False),
        "step_sizes_measured": sizes_select(measured_only=True),
        "dq_summary": quality_select(),
        "csv_roundtrip": query(f"SELECT {full} FROM flagged"),
        "union_counts": query(union_select()),
        "ordered_positions": query(
            "SELECT cpd_target_pair_mutation, row_number() OVER (ORDER BY cpd_target_pair_mutation) AS position FROM flagged"
        ),
        "database_files": """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_returnflag FROM lineitem
WHERE l_quantity >= 25 AND l_returnflag IN ('A', 'R')""",
        "rejected_values": """
WITH split AS (SELECT * FROM lineitem WHERE l_linenumber <> 6)
SELECT NULL AS "column", 'malformed record' AS reason, count(*) AS n, NULL::BIGINT AS quantity FROM lineitem WHERE l_linenumber = 6
HAVING count(*) > 0
UNION ALL
SELECT 'l_quantity', CASE l_linenumber WHEN 1 THEN 'no number' WHEN 2 THEN 'not whole' ELSE 'out of range' END, count(*), NULL
FROM split WHERE l_linenumber <= 3 GROUP BY l_linenumber
UNION ALL
SELECT 'l_extendedprice', 'no number', count(*), NULL FROM split WHERE l_partkey % 3 = 0 HAVING count(*) > 0
UNION ALL
SELECT NULL, 'accepted', count(*), sum(CASE l_linenumber WHEN 4 THEN 7 ELSE trunc(l_quantity) END)::BIGINT
FROM split WHERE l_linenumber > 3 AND l_partkey % 3 <> 0""",
        "smiles_descriptors": query(
            f"SELECT molregno, canonical_smiles, {smiles_select()} FROM compound_structures"
        ),
        "enrich_from_store": "SELECT doc_id, source, md5(strip_accents(text)) AS plain_md5 FROM documents",
        "enrich_by_key": "SELECT doc_id, source, strlen(text) AS text_bytes FROM documents",
        "full_dataset": query(f"SELECT {full} FROM flagged"),
        "full_dataset_hot": query(f"SELECT {full} FROM flagged"),
        "full_dataset_all_sources": all_sources(f"SELECT {full} FROM flagged"),
        "full_dataset_descriptors": query(f"SELECT {result}, {listed(DESCRIPTORS)}, {listed(FLAGS)} FROM flagged"),
    }
    for x in s.SUFFIXES:
        enough, with_known, with_drug = s.flag_columns(x, MIN_PAIRS)
        name = f"subset_{x.lower()}"
        out[name] = subset_select(x, "true" if x == "BF" else "keep_for_binding")
        out[f"{name}_n"] = subset_select(x, enough)
        out[f"{name}_n_known"] = subset_select(x, with_known)
        out[f"{name}_n_drug"] = subset_select(x, with_drug)
    return out
