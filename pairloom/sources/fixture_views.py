"""The test tables (star schema) seen as the 18 input tables.

One text per view, in the SQL that Spark and DuckDB share; ``{name}`` stands for a base table.
Every view has a row for each row of its base table (DISTINCT ones for each key). Where outer joins should meet
absent keys (properties, structures, components), a part of the rows has a negative key that nothing else has.
"""

from __future__ import annotations

import functools
import re

from pyspark.sql import DataFrame, SparkSession

from pairloom.sources.tables import Tables

ASSAY_ID = (
    "l_suppkey * 100 + l_linenumber * 10 + CASE l_returnflag WHEN 'A' THEN 0 WHEN 'R' THEN 1 ELSE 2 END AS assay_id"
)

VIEWS = {
    "molecule_dictionary": """
SELECT p_partkey AS molregno, 'CPD' || p_partkey AS public_id, p_name AS pref_name,
 CAST(CASE p_size % 8 WHEN 0 THEN 4 WHEN 1 THEN 3 WHEN 2 THEN 2 WHEN 3 THEN 1 WHEN 4 THEN 0.5 WHEN 5 THEN -1 END AS DOUBLE) AS max_phase,
 CASE WHEN p_size % 8 = 0 THEN 1950 + p_size END AS first_approval, CASE WHEN p_size % 4 = 0 THEN 1945 + p_size END AS usan_year,
 p_size % 2 AS black_box_warning, CASE WHEN p_size % 8 > 5 THEN -1 ELSE p_size % 2 END AS prodrug,
 CASE WHEN p_size % 3 = 0 THEN 1 ELSE 0 END AS oral, CASE WHEN p_size % 5 = 0 THEN 1 ELSE 0 END AS parenteral,
 CASE WHEN p_size % 7 = 0 THEN 1 ELSE 0 END AS topical
FROM {part}""",
    "molecule_hierarchy": """
SELECT p_partkey AS molregno, CASE WHEN p_partkey % 5 = 4 THEN p_partkey - 1 ELSE p_partkey END AS parent_molregno
FROM {part}""",
    "docs": """
SELECT o_orderkey AS doc_id, CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(year(o_orderdate) AS INT) END AS year,
 CASE WHEN o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW') THEN 37 ELSE 1 END AS src_id
FROM {orders}""",
    "assays": f"""
SELECT DISTINCT {ASSAY_ID}, l_suppkey AS tid,
 CASE l_returnflag WHEN 'A' THEN 'B' WHEN 'R' THEN 'F' ELSE 'A' END AS assay_type,
 CASE WHEN l_linenumber = 7 THEN l_suppkey * 10 + 1 END AS variant_id
FROM {{lineitem}}""",
    "variant_sequences": """
SELECT s_suppkey * 10 + 1 AS variant_id, 'V' || (600 + s_suppkey % 7) || 'E' AS mutation
FROM {supplier}""",
    "activities": f"""
SELECT l_partkey AS molregno, {ASSAY_ID}, l_orderkey AS doc_id,
 CASE WHEN l_discount >= 0.095 THEN NULL ELSE (400 + 12 * l_quantity) / 100 END AS potency,
 CASE WHEN l_tax >= 0.075 THEN 1 ELSE 0 END AS potential_duplicate,
 CASE WHEN l_linestatus = 'O' AND l_tax < 0.005 THEN '>' ELSE '=' END AS standard_relation,
 CASE WHEN l_quantity > 48 THEN 'Outside typical range' END AS data_validity_comment
FROM {{lineitem}}""",
    "target_dictionary": """
SELECT s_suppkey AS tid, 'TGT' || s_suppkey AS public_id, s_name AS pref_name,
 CASE WHEN s_suppkey % 8 < 3 THEN 'SINGLE PROTEIN' WHEN s_suppkey % 8 = 3 THEN 'PROTEIN FAMILY'
      WHEN s_suppkey % 8 = 4 THEN 'PROTEIN COMPLEX' WHEN s_suppkey % 8 = 5 THEN 'CHIMERIC PROTEIN'
      WHEN s_suppkey % 16 = 6 THEN 'PROTEIN COMPLEX GROUP' WHEN s_suppkey % 16 = 14 THEN 'PROTEIN-PROTEIN INTERACTION'
      ELSE 'ORGANISM' END AS target_type,
 CASE WHEN s_nationkey = 3 THEN 'null' ELSE n_name END AS organism
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey""",
    "target_relations": """
SELECT s_suppkey AS tid, CASE WHEN s_suppkey % 8 < 3 AND s_suppkey % 3 > s_suppkey % 8 THEN 'SUBSET OF'
  WHEN s_suppkey % 8 < 3 THEN 'EQUIVALENT TO' ELSE 'SUPERSET OF' END AS relationship,
 s_suppkey - s_suppkey % 8 + s_suppkey % 3 AS related_tid
FROM {supplier}
UNION ALL SELECT s_suppkey, 'OVERLAPS WITH', s_suppkey - 1 FROM {supplier}""",
    "drug_mechanism": """
SELECT l_partkey AS molregno, CASE WHEN l_tax >= 0.075 THEN NULL ELSE l_suppkey END AS tid,
 CASE WHEN l_discount >= 0.085 OR l_linenumber <> 1 OR l_quantity < 40 OR l_suppkey % 3 = 1 THEN 0 ELSE 1 END AS disease_efficacy
FROM {lineitem}""",
    "protein_classification": """
SELECT CAST(0 AS BIGINT) AS protein_class_id, CAST(NULL AS BIGINT) AS parent_id, 0 AS class_level, 'Protein class' AS pref_name
UNION ALL SELECT CAST(r_regionkey + 1 AS BIGINT), CAST(0 AS BIGINT), 1, CASE WHEN r_regionkey = 4 THEN 'Unclassified protein' ELSE r_name END FROM {region}
UNION ALL SELECT CAST(n_nationkey + 101 AS BIGINT), CAST(n_regionkey + 1 AS BIGINT), 2, n_name FROM {nation}
UNION ALL SELECT s_suppkey + 1001, CAST(s_nationkey + 101 AS BIGINT), 3, s_name FROM {supplier}""",
    "component_class": """
SELECT s_suppkey AS component_id, s_suppkey + 1001 AS protein_class_id FROM {supplier}
UNION ALL SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN 101 + s_suppkey % 25 ELSE -1 END FROM {supplier}
UNION ALL SELECT s_suppkey, CAST(CASE WHEN s_suppkey % 5 = 0 THEN 5 ELSE -1 END AS BIGINT) FROM {supplier}
UNION ALL SELECT s_suppkey, CAST(CASE WHEN s_suppkey % 10 = 3 THEN 0 ELSE -1 END AS BIGINT) FROM {supplier}""",
    "component_sequences": """
SELECT s_suppkey AS component_id FROM {supplier}""",
    "target_components": """
SELECT s_suppkey AS tid, CASE WHEN s_suppkey % 9 = 8 THEN -1 - s_suppkey ELSE s_suppkey END AS component_id FROM {supplier}
UNION ALL SELECT s_suppkey, CASE WHEN s_suppkey % 8 > 2 AND s_suppkey % 9 <> 8 THEN s_suppkey - s_suppkey % 8 ELSE -1 - s_suppkey END
FROM {supplier}""",
    "compound_records": """
SELECT DISTINCT l_orderkey AS doc_id, l_partkey AS molregno FROM {lineitem}""",
    "compound_properties": """
SELECT CASE WHEN p_partkey % 13 = 0 THEN -1 - p_partkey ELSE p_partkey END AS molregno, p_retailprice / 2 AS mw_freebase,
 CASE WHEN p_partkey % 31 = 0 THEN NULL ELSE (p_partkey % 90 - 20) / CAST(10 AS DOUBLE) END AS alogp,
 p_size % 11 AS hba, p_size % 6 AS hbd,
 CASE WHEN p_size % 10 = 0 THEN CAST(0 AS DOUBLE) ELSE p_size * CAST(2.5 AS DOUBLE) END AS psa, p_size % 9 AS rtb,
 CASE WHEN p_size % 2 = 0 THEN 'Y' ELSE 'N' END AS ro3_pass, p_size % 4 AS num_ro5_violations,
 CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_size / CAST(8 AS DOUBLE) END AS cx_most_apka,
 CASE WHEN p_size % 3 = 1 THEN NULL ELSE p_size / CAST(4 AS DOUBLE) END AS cx_most_bpka,
 (p_partkey % 70 - 10) / CAST(16 AS DOUBLE) AS cx_logp, (p_partkey % 50 - 10) / CAST(16 AS DOUBLE) AS cx_logd,
 CASE p_size % 4 WHEN 0 THEN 'ACID' WHEN 1 THEN 'BASE' WHEN 2 THEN 'NEUTRAL' ELSE '' END AS molecular_species,
 p_retailprice AS full_mwt, p_size % 5 AS aromatic_rings, CASE WHEN p_size = 50 THEN 0 ELSE p_size END AS heavy_atoms,
 p_size / CAST(64 AS DOUBLE) AS qed_weighted, p_retailprice / 4 AS mw_monoisotopic,
 'C' || p_size || 'H' || (p_partkey % 40) AS full_molformula,
 p_size % 12 AS hba_lipinski, p_size % 7 AS hbd_lipinski, p_size % 3 AS num_lipinski_ro5_violations
FROM {part}""",
    "compound_structures": """
SELECT CASE WHEN p_partkey % 11 = 0 THEN -1 - p_partkey ELSE p_partkey END AS molregno, 'InChI=1S/' || p_partkey AS standard_inchi, 'KEY' || p_partkey AS standard_inchi_key,
 CASE WHEN p_partkey % 19 = 0 THEN 'CC(=O)[O-].[Na+]' WHEN p_partkey % 23 = 0 THEN ''
      ELSE CASE p_size % 5 WHEN 0 THEN 'COc1ccc2[nH]cc(CCN)c2c1Cl' WHEN 1 THEN 'CC(C)Cc1ccc(cc1)[C@@H](C)C(=O)O'
           WHEN 2 THEN 'c1ccc2ncccc2c1' WHEN 3 THEN 'CCO' ELSE 'Cn1cnc2c1c(=O)n(C)c(=O)n2C' END END AS canonical_smiles
FROM {part}""",
    "atc_classification": """
SELECT DISTINCT p_brand AS level5,
 substr('ABCDGHJLMNPRSV', 1 + CAST(replace(p_brand, 'Brand#', '') AS INT) % 14, 1) AS level1,
 'ATC group ' || CAST(replace(p_brand, 'Brand#', '') AS INT) % 14 AS level1_description
FROM {part}""",
    "molecule_atc_classification": """
SELECT p_partkey AS molregno, CASE WHEN p_size % 8 = 0 THEN p_brand ELSE 'unlisted' END AS level5 FROM {part}
UNION ALL SELECT p_partkey, CASE WHEN p_size % 16 = 0 THEN 'Brand#' || (1 + p_partkey % 20) ELSE 'unlisted' END FROM {part}""",
}

# Rows of these views are told apart where their join shuffles them: one shuffle serves both.
SHUFFLED = {"compound_records": {"lineitem": "l_orderkey"}}

# Declared, so that no job reads file footers to infer them.
BASE_TABLES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": (
        "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE"
    ),
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, "
        "o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
        "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
        "l_shipdate TIMESTAMP_NTZ"
    ),
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
}


def base_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(BASE_TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def fixture_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The 18 input tables over the test tables in ``sf_dir``."""
    read = functools.cache(lambda name: base_table(spark, sf_dir, name))

    def load(name: str) -> DataFrame:
        text = VIEWS[name]
        keys = SHUFFLED.get(name, {})
        bases = {b: read(b).repartition(keys[b]) if b in keys else read(b) for b in re.findall(r"{(\w+)}", text)}
        return spark.sql(text, **bases)

    return Tables(load)


def duckdb_views() -> dict[str, str]:
    """The same views as plain SQL over the registered base tables."""
    return {name: text.format(**{b: b for b in BASE_TABLES}).strip() for name, text in VIEWS.items()}
