from __future__ import annotations

import pytest
from hand_tables import compounds, hand_tables

from pairloom.schema import INPUT_DDL
from pairloom.sources import Tables, read_tables
from pairloom.sources.fixture_views import fixture_tables

# Rows of the views at scale factor 0.001.
ROWS = {
    "molecule_dictionary": 200,
    "molecule_hierarchy": 200,
    "docs": 1500,
    "assays": 210,
    "variant_sequences": 10,
    "activities": 6000,
    "target_dictionary": 10,
    "target_relations": 20,
    "drug_mechanism": 6000,
    "protein_classification": 41,
    "component_class": 40,
    "component_sequences": 10,
    "target_components": 20,
    "compound_records": 5942,
    "compound_properties": 200,
    "compound_structures": 200,
    "atc_classification": 25,
    "molecule_atc_classification": 400,
}


def test_view_sizes(spark):
    tables = fixture_tables(spark, "/root/testdata/sf0.001")
    assert {name: tables[name].count() for name in tables} == ROWS


@pytest.mark.parametrize("source", ["parquet", "orc", "csv", "json"])
def test_tables_of_several_formats(spark, tmp_path, source):
    tables = hand_tables(spark, **compounds(1, 2, phase={1: 4.0}))
    options = {"header": "true"} if source == "csv" else {}
    for name in tables:
        tables[name].write.format(source).options(**options).save(f"{tmp_path}/{name}")
    read = read_tables(spark, str(tmp_path), source, **options)
    assert len(read) == len(INPUT_DDL) == 18
    assert read["molecule_dictionary"].schema == tables["molecule_dictionary"].schema
    assert sorted(read["molecule_dictionary"].collect()) == sorted(tables["molecule_dictionary"].collect())


def test_missing_column_is_named(spark):
    tables = Tables(lambda name: spark.range(1).withColumnRenamed("id", "molregno"))
    with pytest.raises(ValueError, match="molecule_hierarchy lacks the columns .*parent_molregno"):
        tables["molecule_hierarchy"]


def test_source_names_and_types(spark, tmp_path):
    """Columns under other names, decimals for doubles, whole doubles for integers; a fraction is an error."""
    own = "SELECT 1.0D AS molregno, 2L AS assay, 3 AS doc_id, 6.25BD AS value, 0 AS potential_duplicate, '=' AS standard_relation, CAST(NULL AS STRING) AS data_validity_comment"
    spark.sql(own).write.parquet(f"{tmp_path}/activities")
    names = {"assay": "assay_id", "value": "potency"}
    read = read_tables(spark, str(tmp_path), rename=names)["activities"]
    assert [f.dataType.simpleString() for f in read.schema][:4] == ["bigint", "bigint", "bigint", "double"]
    assert read.first()[:4] == (1, 2, 3, 6.25)
    spark.sql(own.replace("1.0D", "1.5D")).write.parquet(f"{tmp_path}/lossy/activities")
    with pytest.raises(Exception, match="activities.molregno holds 1.5"):
        read_tables(spark, f"{tmp_path}/lossy", rename=names)["activities"].collect()
    spark.sql(own).write.option("header", "true").csv(f"{tmp_path}/text/activities")
    text = read_tables(spark, f"{tmp_path}/text", "csv", rename=names, header="true")["activities"]
    assert text.select("assay_id", "potency").first() == (2, 6.25)
