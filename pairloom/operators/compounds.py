"""Compound side: first publication, properties, structures, ATC labels, efficiency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom import schema as s
from pairloom.config import PairConfig
from pairloom.functions.numeric import efficiency_metrics
from pairloom.functions.text import joined_labels
from pairloom.operators.joins import shuffled
from pairloom.operators.measurements import LITERATURE_SOURCE, compound_attributes
from pairloom.sources import Tables

ATC_SEPARATOR = " | "  # fixed value
MIXTURE_MARK = "."  # fixed value: joins the parts of a SMILES


def first_publication(tables: Tables, cfg: PairConfig) -> DataFrame:
    """First year in which a compound, in any salt form, was published.

    The minimum is taken per salt form before the forms are mapped to their parents, so the records
    themselves are shuffled once.
    """
    docs = tables["docs"].filter(F.col("year").isNotNull())
    if cfg.literature_only:
        docs = docs.filter(F.col("src_id") == LITERATURE_SOURCE)
    per_form = (
        tables["compound_records"]
        .join(shuffled(docs.select("doc_id", "year")), "doc_id")
        .groupBy("molregno")
        .agg(F.min("year").alias("year"))
    )
    return (
        per_form.join(shuffled(tables["molecule_hierarchy"]), "molregno")
        .groupBy(s.PARENT)
        .agg(F.min("year").alias("first_publication_cpd"))
    )


def compound_props(tables: Tables) -> DataFrame:
    """Properties and structures of compounds that have both and are parents.

    The hierarchy is a semi join: several salt forms of a parent do not repeat its row.
    """
    parents = tables["molecule_hierarchy"].select(F.col(s.PARENT).alias("molregno"))
    return (
        tables["compound_properties"]
        .join(shuffled(parents), "molregno", "left_semi")
        .join(shuffled(tables["compound_structures"]), "molregno")
        .withColumnRenamed("molregno", s.PARENT)
    )


def atc_labels(tables: Tables) -> DataFrame:
    """Sorted level 1 labels of a compound, over its salt forms, as one text."""
    label = F.concat("level1", F.lit("_"), "level1_description").alias("label")
    levels = tables["atc_classification"].select("level5", label)
    return (
        tables["molecule_atc_classification"]
        .join(levels, "level5")
        .join(shuffled(tables["molecule_hierarchy"]), "molregno")
        .groupBy(s.PARENT)
        .agg(joined_labels(F.collect_set("label"), ATC_SEPARATOR).alias("atc_level1"))
    )


def compound_profile(tables: Tables, cfg: PairConfig) -> DataFrame:
    """One row per compound with every compound-side column; all joins share the shuffle on the parent."""
    return (
        compound_attributes(tables)
        .join(shuffled(first_publication(tables, cfg)), s.PARENT, "left")
        .join(shuffled(compound_props(tables)), s.PARENT, "left")
        .join(shuffled(atc_labels(tables)), s.PARENT, "left")
    )


def has_single_structure() -> Column:
    """A structure text is present and is no mixture; an empty text passes and becomes NULL in cleaning."""
    return F.col(s.SMILES).isNotNull() & ~F.col(s.SMILES).contains(MIXTURE_MARK)


def single_structure_compounds(tables: Tables) -> DataFrame:
    return compound_props(tables).filter(has_single_structure()).select(s.PARENT)


def drop_mixtures(df: DataFrame) -> DataFrame:
    return df.filter(has_single_structure())


def add_efficiency(df: DataFrame) -> DataFrame:
    """Efficiency metrics from the unrounded means; NULL where an input is NULL or a denominator 0."""
    metrics = {}
    for suffix in s.SUFFIXES:
        metrics |= efficiency_metrics(F.col(s.value_column("mean", suffix)), suffix)
    return df.withColumns(metrics)
