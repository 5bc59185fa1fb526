"""From single measurements to one row per compound, target and mutation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom import schema as s
from pairloom.config import PairConfig
from pairloom.functions.numeric import ratio
from pairloom.functions.text import none_if, pair_keys
from pairloom.operators.joins import hot_keys, shuffled, sparse_lookup, spread_join
from pairloom.operators.selection import middle_values
from pairloom.sinks.staging import stage
from pairloom.sources import Tables

# Assay types and the validity rule of a measurement.
BINDING, FUNCTIONAL = "B", "F"
USED_ASSAYS = (BINDING, FUNCTIONAL)
EXACT_RELATION = "="
LITERATURE_SOURCE = 1
PROTEIN_TARGET = "%PROTEIN%"

# Attributes that depend on the compound or the target alone and travel with the rows.
PHASE = "max_phase"
THERAPEUTIC = "therapeutic_target"
CARRIED = [PHASE, THERAPEUTIC]


def parent_map(tables: Tables, compounds: DataFrame | None = None) -> DataFrame:
    """molregno -> parent compound and its phase, so that salt forms count for their parent.

    ``compounds`` restricts the parents.
    """
    parents = tables["molecule_dictionary"].select(F.col("molregno").alias(s.PARENT), PHASE)
    if compounds is not None:
        parents = parents.join(shuffled(compounds), s.PARENT, "left_semi")
    hierarchy = tables["molecule_hierarchy"]
    forms = spread_join(hierarchy, parents, s.PARENT, ["molregno"], hot_keys(hierarchy, s.PARENT), "inner")
    return forms.select("molregno", s.PARENT, PHASE)


def assay_targets(
    tables: Tables,
    cfg: PairConfig,
    known_targets: DataFrame | None = None,
    only_known: bool = False,
    assay_types: tuple[str, ...] = (),
) -> DataFrame:
    """assay_id -> assay type, protein target, mutation and whether the target is a known one.

    With ``only_known`` assays on other targets are left out, and so are their measurements at the first
    join already. Without ``known_targets`` the mark is NULL.
    """
    targets = tables["target_dictionary"].filter(F.col("target_type").ilike(PROTEIN_TARGET)).select(s.TID)
    if cfg.excluded_tids:
        targets = targets.filter(~F.col(s.TID).isin(*cfg.excluded_tids))
    if known_targets is None:
        targets = targets.withColumn(THERAPEUTIC, F.lit(None).cast("boolean"))
    elif only_known:
        targets = targets.join(shuffled(known_targets), s.TID, "left_semi").withColumn(THERAPEUTIC, F.lit(True))
    else:
        known = known_targets.select(s.TID, F.lit(True).alias(THERAPEUTIC))
        targets = targets.join(shuffled(known), s.TID, "left").withColumn(THERAPEUTIC, F.coalesce(THERAPEUTIC, F.lit(False)))

    def used(assays: DataFrame) -> DataFrame:
        return assays.filter(F.col("assay_type").isin(*assay_types)) if assay_types else assays

    # counted and joined, so staged; the filter on what is staged lets Spark cut measurements by these assays
    assays = used(stage(used(tables["assays"]), "assays").frame)
    assays = spread_join(assays, targets, s.TID, ["assay_id"], hot_keys(assays, s.TID), "inner")
    assays = sparse_lookup(assays, tables["variant_sequences"], "variant_id", "assay_id")
    return assays.select("assay_id", "assay_type", s.TID, s.MUTATION, THERAPEUTIC)


def measurement_rows(
    tables: Tables, cfg: PairConfig, assays: DataFrame, compounds: DataFrame | None = None
) -> DataFrame:
    """One row per valid measurement; equal measurements are all kept, as they count for the mean."""
    valid = (
        tables["activities"]
        .filter(F.col(s.VALUE).isNotNull())
        .filter(F.col("potential_duplicate") == 0)
        .filter(F.col("standard_relation") == EXACT_RELATION)
        .filter(F.col("data_validity_comment").isNull())
        .select("molregno", "assay_id", "doc_id", s.VALUE)
    )
    years, located = tables["docs"], valid.join(shuffled(assays), "assay_id")
    if cfg.literature_only:
        years = years.filter(F.col("src_id") == LITERATURE_SOURCE)
        dated = located.join(shuffled(years.select("doc_id", "year")), "doc_id")
    else:
        dated = sparse_lookup(located, years.select("doc_id", "year"), "doc_id", "molregno")
    return (
        dated.join(shuffled(parent_map(tables, compounds)), "molregno")
        .select(*s.PAIR_MUTATION, "assay_type", s.VALUE, "year", *CARRIED)
    )


def measurement_cells(rows: DataFrame) -> DataFrame:
    """Measurements folded to one row per pair and distinct value, with counts.

    Spark combines before the shuffle, and the value is part of the key, so a pair that holds much of
    the data is spread over tasks. Everything after this step works on distinct values.
    """
    binding = F.col("assay_type") == BINDING
    used = rows.filter(F.col("assay_type").isin(*USED_ASSAYS))
    return used.groupBy(*s.PAIR_MUTATION, *CARRIED, s.VALUE).agg(
        F.count(F.lit(1)).alias("n_BF"),
        F.count_if(binding).alias("n_B"),
        F.min("year").alias("year_BF"),
        F.min(F.when(binding, F.col("year"))).alias("year_B"),
    )


def _rank_columns(suffix: str) -> dict[str, Column]:
    """Measurements of a pair up to a cell in value order, and in all."""
    pair = Window.partitionBy(*s.PAIR_MUTATION)
    n = F.col(f"n_{suffix}")
    return {
        f"upto_{suffix}": F.sum(n).over(pair.orderBy(s.VALUE).rowsBetween(Window.unboundedPreceding, 0)),
        f"all_{suffix}": F.sum(n).over(pair),
    }


def _pair_measures(suffix: str, lower: Column, upper: Column) -> list[Column]:
    """Mean, maximum, exact median and first years of the cells of a pair for one assay subset.

    The median is the mean of the two middle measurements, which are the same one if their number is odd.
    """
    value, n, year = F.col(s.VALUE), F.col(f"n_{suffix}"), F.col(f"year_{suffix}")
    return [
        ratio(F.sum(value * n), F.sum(n)).alias(s.value_column("mean", suffix)),
        F.max(F.when(n > 0, value)).alias(s.value_column("max", suffix)),
        ((lower + upper) / 2).alias(s.value_column("median", suffix)),
        F.min(year).alias(s.first_year_column(suffix)),
        F.min(F.when(value.isNotNull(), year)).alias(s.first_measured_year_column(suffix)),
    ]


def _middle_by_rank(suffix: str) -> tuple[Column, Column]:
    """The two middle measurements of ranked cells."""
    upto, count = F.col(f"upto_{suffix}"), F.col(f"all_{suffix}")
    lower = F.min(F.when((count > 0) & (2 * upto >= count), F.col(s.VALUE)))
    return lower, F.min(F.when(2 * upto > count, F.col(s.VALUE)))


def pair_aggregates(cells: DataFrame, *more: Column, hot_values: int | None = None) -> DataFrame:
    """One row per pair with the measures of both assay subsets.

    The windows sort the cells of a pair and spill, so no pair has to fit into memory; grouping reuses
    their shuffle. ``more`` are further aggregates. With ``hot_values`` the cells are staged, and the medians of pairs
    with more different values than that are selected over all tasks instead of in one.
    """
    if hot_values is None:
        return _ranked_aggregates(cells, *more)
    cells = stage(cells, "cells").frame
    many = cells.groupBy(*s.PAIR_MUTATION).agg(F.count(s.VALUE).alias("_values")).filter(F.col("_values") > hot_values)
    hot = stage(many.select(*s.PAIR_MUTATION, F.monotonically_increasing_id().alias("_pair")), "hot-pairs")
    if not hot.rows:
        return _ranked_aggregates(cells, *more)
    names = hot.frame.toDF(*(f"_hot_{c}" for c in s.PAIR_MUTATION), "_pair")
    same = [cells[c].eqNullSafe(names[f"_hot_{c}"]) for c in s.PAIR_MUTATION]
    marked = cells.join(F.broadcast(names), same, "left").drop(*(f"_hot_{c}" for c in s.PAIR_MUTATION))
    few = _ranked_aggregates(marked.filter("_pair is null").drop("_pair"), *more)
    rows = stage(marked.filter("_pair is not null"), "hot-cells").frame
    middle = middle_values(rows, "_pair", s.VALUE, {suffix: f"n_{suffix}" for suffix in s.SUFFIXES})
    measures = [m for x in s.SUFFIXES for m in _pair_measures(x, F.max(f"lower_{x}"), F.max(f"upper_{x}"))]
    joined = rows.join(F.broadcast(middle), "_pair", "left")  # as many rows as there are hot pairs
    return few.unionByName(joined.groupBy(*s.PAIR_MUTATION, *CARRIED).agg(*measures, *more))


def _ranked_aggregates(cells: DataFrame, *more: Column) -> DataFrame:
    ranked = cells.withColumns({k: c for suffix in s.SUFFIXES for k, c in _rank_columns(suffix).items()})
    measures = [m for suffix in s.SUFFIXES for m in _pair_measures(suffix, *_middle_by_rank(suffix))]
    return ranked.groupBy(*s.PAIR_MUTATION, *CARRIED).agg(*measures, *more)


def compound_attributes(tables: Tables) -> DataFrame:
    """Descriptive columns of a parent compound."""
    renamed = {"molregno": s.PARENT, "public_id": "parent_public_id", "pref_name": "parent_pref_name"}
    return tables["molecule_dictionary"].withColumnsRenamed(renamed)


def target_attributes(tables: Tables, fix_organism: bool = True) -> DataFrame:
    """Descriptive columns of a target; the text ``null`` as organism stands for a missing one."""
    renamed = {"public_id": "target_public_id", "pref_name": "target_pref_name"}
    targets = tables["target_dictionary"].withColumnsRenamed(renamed)
    return targets.withColumn("organism", none_if(F.col("organism"), "null")) if fix_organism else targets


def describe_rows(rows: DataFrame, tables: Tables) -> DataFrame:
    """Measurement rows with compound and target columns and the text keys."""
    return (
        rows.drop(*CARRIED)
        .join(shuffled(compound_attributes(tables)), s.PARENT)
        .join(shuffled(target_attributes(tables, fix_organism=False)), s.TID)
        .withColumns(pair_keys())
    )


def describe_pairs(pairs: DataFrame, tables: Tables, how: str = "left") -> DataFrame:
    """Pair rows with compound and target columns and the text keys."""
    carried = [c for c in CARRIED if c in pairs.columns]
    return (
        pairs.drop(*carried)
        .join(shuffled(compound_attributes(tables)), s.PARENT, how)
        .join(shuffled(target_attributes(tables)), s.TID, how)
        .withColumns(pair_keys())
    )
