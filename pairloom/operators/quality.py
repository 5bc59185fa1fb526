"""Invariants of the pair table as counted violations; 0 everywhere is a pass."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from pairloom import schema as s
from pairloom.config import PairConfig
from pairloom.operators.interaction import is_drug, is_known
from pairloom.operators.joins import shuffled
from pairloom.operators.known import IN_KNOWN_MUTATION, KEEP_BINDING
from pairloom.operators.subsets import GROUP, in_scope

UNRECOGNISED_NULLS = ("nan", "null")  # fixed values


def count_violations(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """(check, violations) rows from one pass over ``df``."""
    counted = df.agg(*[F.count_if(violated).alias(name) for name, violated in checks.items()])
    return counted.unpivot([], list(checks), "check", "violations")


def known_without_value_checks() -> dict[str, Column]:
    """Only curated pairs may lack a value."""
    columns = [s.value_column(m, "BF") for m in ("mean", "max", "median")]
    return {f"value_missing:{c}": F.col(c).isNull() & ~F.col(IN_KNOWN_MUTATION) for c in columns}


def property_checks(source: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    """A property is NULL exactly where the source has no row for the compound or has NULL itself.

    Returns the source's NULL flags per compound, to be joined by the caller, and the checks.
    """
    names = [c for c in source.columns if c != s.PARENT]
    flags = source.select(s.PARENT, *[F.col(c).isNull().alias(f"_null_{c}") for c in names])
    checks = {
        f"property_null:{c}": F.col(c).isNull() != F.coalesce(F.col(f"_null_{c}"), F.lit(True)) for c in names
    }
    return flags, checks


def efficiency_checks() -> dict[str, Column]:
    """An efficiency is NULL exactly where an input is NULL or its denominator is 0."""
    checks = {}
    for suffix in s.SUFFIXES:
        no_mean = F.col(s.value_column("mean", suffix)).isNull()
        for metric, other in (("LE", "heavy_atoms"), ("BEI", "mw_freebase"), ("SEI", "psa")):
            unusable = F.col(other).isNull() | F.coalesce(F.col(other) == 0, F.lit(False))
            checks[f"efficiency_null:{metric}_{suffix}"] = F.col(f"{metric}_{suffix}").isNull() != (no_mean | unusable)
        checks[f"efficiency_null:LLE_{suffix}"] = F.col(f"LLE_{suffix}").isNull() != (no_mean | F.col("alogp").isNull())
    return checks


def label_check(column: str, present: str) -> dict[str, Column]:
    """A label is NULL exactly where its source has no row for the key (``present`` is then NULL)."""
    return {f"label_null:{column}": F.col(column).isNull() != F.col(present).isNull()}


def descriptor_checks(ddl: str = s.DESCRIPTOR_DDL) -> dict[str, Column]:
    """A descriptor is NULL exactly where the structure is NULL."""
    return {
        f"descriptor_null:{f.name}": F.col(f.name).isNull() != F.col(s.SMILES).isNull()
        for f in StructType.fromDDL(ddl).fields
    }


def literal_null_checks(df: DataFrame) -> dict[str, Column]:
    """Rows with the text of a missing value in any column; only text columns can hold one."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    checks = {}
    for literal in UNRECOGNISED_NULLS:
        found = F.lit(False)
        for c in texts:
            found = found | F.coalesce(F.col(c) == literal, F.lit(False))
        checks[f"literal:{literal}"] = found
    return checks


def flag_levels(df: DataFrame, cfg: PairConfig) -> DataFrame:
    """Targets of each subset level by the defining steps: count, then keep, then look for a class."""
    levels = []
    for suffix in s.SUFFIXES:
        enough, with_known, with_drug = s.flag_columns(suffix, cfg.min_pairs(suffix))
        rows = df.filter(in_scope(suffix))
        measured = rows.filter(F.col(s.value_column("mean", suffix)).isNotNull()).groupBy(GROUP).count()
        targets = measured.filter(F.col("count") >= cfg.min_pairs(suffix)).select(GROUP)
        levels.append(targets.withColumn("level", F.lit(enough)))
        for name, cond in ((with_known, is_known()), (with_drug, is_drug())):
            marked = rows.filter(cond).select(GROUP).distinct()
            levels.append(targets.join(marked, GROUP, "left_semi").withColumn("level", F.lit(name)))
    all_levels = levels[0]
    for level in levels[1:]:
        all_levels = all_levels.unionByName(level)
    return all_levels.groupBy(GROUP).agg(F.collect_set("level").alias("_levels"))


def flag_checks(cfg: PairConfig) -> dict[str, Column]:
    """Each flag selects exactly the rows of its level; expects ``_levels`` joined on the group key."""
    checks = {}
    for suffix in s.SUFFIXES:
        for name in s.flag_columns(suffix, cfg.min_pairs(suffix)):
            expected = F.coalesce(F.array_contains("_levels", name), F.lit(False)) & in_scope(suffix)
            checks[f"subset_flag:{name}"] = F.col(name) != expected
    return checks


#: Lookup tables with the key that must not repeat: a repeated row would repeat pairs.
UNIQUE_KEYS = {
    "molecule_dictionary": "molregno",
    "molecule_hierarchy": "molregno",
    "compound_properties": "molregno",
    "compound_structures": "molregno",
    "variant_sequences": "variant_id",
    "target_dictionary": s.TID,
}


def repeated_keys(checked: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """(check, violations) rows: how many values of a key are on more than one row, for frames and keys by check. All of
    them are counted in one shuffle."""
    keys = [df.select(F.lit(check).alias("check"), F.col(key).cast("string").alias("key")) for check, (df, key) in checked.items()]
    counts = reduce(DataFrame.unionAll, keys).groupBy("check", "key").agg(F.count(F.lit(1)).alias("n"))
    found = counts.groupBy("check").agg(F.count_if(F.col("n") > 1).alias("violations"))
    every = keys[0].sparkSession.createDataFrame([(check,) for check in checked], "check string")
    return every.join(found, "check", "left").select("check", F.coalesce("violations", F.lit(0)).alias("violations"))


def bag_marks(df: DataFrame) -> list[Column]:
    """Aggregates that are equal for frames with the same rows, each equally often, in any order: the number of rows and
    the sums of two hashes of a row. NULLs are hashed as such, so they do not let values change columns."""
    parts = [p for c in df.columns for p in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    marks = [F.count(F.lit(1)).alias("rows")]
    for i in range(2):
        marks.append(F.sum(F.xxhash64(F.lit(i), *parts).cast("decimal(28,0)")).alias(f"mark_{i}"))
    return marks


def bag_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that do not occur equally often in both frames, with ``surplus`` of the left one.

    Rows are grouped by a 256-bit digest of all their columns, in both directions at once; whole rows are looked up
    only for digests that differ.
    """
    if [(f.name, f.dataType) for f in left.schema] != [(f.name, f.dataType) for f in right.schema]:
        raise ValueError("the frames have different columns or types")
    digest = F.sha2(F.to_json(F.struct(*left.columns), {"ignoreNullFields": "false"}), 256).alias("_digest")
    both = left.select(digest, F.lit(1).alias("_n")).unionAll(right.select(digest, F.lit(-1).alias("_n")))
    found = both.groupBy("_digest").agg(F.sum("_n").alias("surplus")).filter(F.col("surplus") != 0)
    rows = left.unionByName(right).withColumn("_digest", digest)
    return rows.join(found, "_digest").drop("_digest").distinct()


def parent_consistency(dataset_compounds: DataFrame, hierarchy: DataFrame, structures: DataFrame) -> DataFrame:
    """Checks on the mixtures among (compound, structure) rows before they are dropped.

    Each must be a parent, must not be mapped to another parent, and must carry the one structure that
    its source has.
    """
    mixtures = dataset_compounds.filter(F.col(s.SMILES).contains(".")).distinct()
    parents = hierarchy.select(s.PARENT).distinct().withColumn("_is_parent", F.lit(True))
    moved = (
        hierarchy.filter(F.col("molregno") != F.col(s.PARENT))
        .select(F.col("molregno").alias(s.PARENT), F.lit(True).alias("_is_moved"))
        .distinct()
    )
    known = (
        structures.withColumnRenamed("molregno", s.PARENT)
        .groupBy(s.PARENT)
        .agg(F.count(F.lit(1)).alias("_n"), F.min(s.SMILES).alias("_known"))
    )
    joined = (
        mixtures.join(shuffled(parents), s.PARENT, "left")
        .join(shuffled(moved), s.PARENT, "left")
        .join(shuffled(known), s.PARENT, "left")
    )
    checks = {
        "mixture": F.lit(True),
        "mixture_is_no_parent": F.col("_is_parent").isNull(),
        "mixture_has_other_parent": F.col("_is_moved").isNotNull(),
        "mixture_structure_not_unique": F.coalesce(F.col("_n") != 1, F.lit(True)),
        "mixture_structure_differs": ~F.col(s.SMILES).eqNullSafe(F.col("_known")),
    }
    counted = joined.agg(*[F.count_if(c).alias(name) for name, c in checks.items()])
    return counted.unpivot(["mixture"], list(checks)[1:], "check", "violations").withColumnRenamed(
        "mixture", "checked"
    )


def keep_for_binding_checks() -> dict[str, Column]:
    """Rows kept for binding data have a binding value or are curated."""
    has_value = F.col(s.value_column("mean", "B")).isNotNull()
    return {"keep_for_binding": F.col(KEEP_BINDING) != (has_value | F.col(IN_KNOWN_MUTATION))}
