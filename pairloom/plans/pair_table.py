"""The pair table: measured and curated pairs, classified, described, cleaned and flagged.

The large input, the measurements, is read once. What can shrink it is joined first: assays are cut to
known targets and compounds to those with a single structure before any measurement is shuffled. The
narrow result, one row per pair, is staged; everything after works on that table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom import schema as s
from pairloom.config import PairConfig
from pairloom.functions.smiles import smiles_counts
from pairloom.functions.text import pair_keys
from pairloom.operators import (
    cleaning,
    compounds,
    interaction,
    known,
    measurements,
    quality,
    stats,
    subsets,
    targets,
)
from pairloom.operators.joins import HOT_ROWS, hot_keys, shuffled, spread_join
from pairloom.operators.measurements import PHASE
from pairloom.sinks.staging import Staged, stage
from pairloom.sources import Tables


# Labels of the steps whose sizes are reported.
STEPS = (
    "measured pairs",
    "with curated pairs",
    "pairs on known targets",
    "with compound columns",
    "single structures",
    "with target classes",
    "cleaned table",
)


def activity_rows(tables: Tables, cfg: PairConfig) -> DataFrame:
    """All valid measurements of any assay type, described."""
    rows = measurements.measurement_rows(tables, cfg, measurements.assay_targets(tables, cfg))
    return measurements.describe_rows(rows, tables)


def measured_pairs(tables: Tables, cfg: PairConfig) -> DataFrame:
    """Aggregated measurements, before curated pairs join."""
    assays = measurements.assay_targets(tables, cfg, assay_types=measurements.USED_ASSAYS)
    cells = measurements.measurement_cells(measurements.measurement_rows(tables, cfg, assays))
    return measurements.pair_aggregates(cells, hot_values=cfg.hot_values)


def expanded_known_pairs(tables: Tables) -> DataFrame:
    return known.expand_pairs(known.known_pairs(tables), known.target_mappings(tables))


def universe(
    tables: Tables, cfg: PairConfig, only_known_targets: bool = False, only_compounds: DataFrame | None = None
) -> DataFrame:
    """Measured and curated pairs with membership flags and interaction class.

    ``only_known_targets`` leaves out what would be dropped as unrelated: a known pair makes its target a
    known one, so the class of a pair on any other target is fixed. The curated pairs are staged, as they
    serve as targets and as pairs; the size of the written table decides how they are joined.
    """
    staged = stage(expanded_known_pairs(tables), "known")
    curated = staged.frame
    assays = measurements.assay_targets(
        tables, cfg, known.targets_of(curated), only_known_targets, measurements.USED_ASSAYS
    )
    cells = measurements.measurement_cells(measurements.measurement_rows(tables, cfg, assays, only_compounds))
    if only_compounds is not None:
        curated = spread_join(curated, only_compounds, s.PARENT, [s.TID], staged.hot(s.PARENT), "left_semi")
    return interaction.classify(known.pair_universe(cells, curated, cfg.hot_values))


def related_pairs(tables: Tables, cfg: PairConfig) -> DataFrame:
    """Classified pairs without the unrelated ones."""
    return interaction.keep_related(universe(tables, cfg, only_known_targets=True))


def describe_compounds(
    pairs: Staged, tables: Tables, cfg: PairConfig, counts: bool = False, profile: DataFrame | None = None
) -> DataFrame:
    """All compound columns and efficiencies, for mixtures too; with ``counts`` those of the structure text, taken once
    per compound. ``profile``: the compound columns, if they are there already."""
    profile = compounds.compound_profile(tables, cfg) if profile is None else profile
    if counts:
        profile = profile.withColumns(smiles_counts(F.col(s.SMILES)))
    hot = pairs.hot(s.PARENT)
    described = spread_join(pairs.frame.drop(PHASE), profile, s.PARENT, [s.TID, s.MUTATION], hot)
    return compounds.add_efficiency(described).withColumns(pair_keys())


def described_pairs(tables: Tables, cfg: PairConfig) -> DataFrame:
    """Related pairs with all compound columns, mixtures included."""
    return describe_compounds(stage(related_pairs(tables, cfg), "related"), tables, cfg)


def core(tables: Tables, cfg: PairConfig) -> Staged:
    """Related pairs of compounds with a single structure: keys, measures, flags, class."""
    single = compounds.single_structure_compounds(tables)
    staged = stage(interaction.keep_related(universe(tables, cfg, True, single)), "core")
    return Staged(staged.frame.withColumns(pair_keys()), staged.rows)


def target_profile(tables: Tables) -> DataFrame:
    """One row per target with every target-side column."""
    return measurements.target_attributes(tables).join(shuffled(targets.target_classes(tables)), s.TID, "left")


def add_compounds(
    pairs: DataFrame, hot: DataFrame | None, tables: Tables, cfg: PairConfig, profile: DataFrame | None = None
) -> DataFrame:
    """Compound columns, efficiencies and, if asked for, descriptors; ``hot`` are hot compounds, ``profile`` as in
    ``describe_compounds``."""
    profile = compounds.drop_mixtures(compounds.compound_profile(tables, cfg) if profile is None else profile)
    if cfg.descriptors:
        profile = profile.withColumns(smiles_counts(F.col(s.SMILES)))
    described = spread_join(pairs.drop(PHASE), profile, s.PARENT, [s.TID, s.MUTATION], hot, "inner")
    return compounds.add_efficiency(described)


def clean_table(pairs: Staged, tables: Tables, cfg: PairConfig, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The staged pairs with all columns but the subset flags, cleaned."""
    located = spread_join(pairs.frame, target_profile(tables), s.TID, [s.PARENT], pairs.hot(s.TID, hot_rows))
    described = add_compounds(located, pairs.hot(s.PARENT, hot_rows), tables, cfg)
    return cleaning.clean(described, s.result_ddl(cfg.descriptors))


def full_table(
    pairs: Staged, tables: Tables, cfg: PairConfig, hot_rows: int = HOT_ROWS, profile: DataFrame | None = None
) -> DataFrame:
    """The staged pairs with all columns and the subset flags, cleaned.

    Flags and target columns depend on target and mutation, so one lookup brings both. It comes before
    the wide compound columns, which are then shuffled once.
    """
    groups = stage(subsets.group_qualification(pairs.frame, cfg, keep=[s.TID]), "groups").frame
    hot = subsets.hot_groups(groups, hot_rows)
    lookup = groups.join(shuffled(target_profile(tables)), s.TID, "left").drop(s.TID, "n_rows")
    located = spread_join(pairs.frame, lookup, subsets.GROUP, [s.PARENT], hot)
    flagged = subsets.apply_scope(located, cfg)
    described = add_compounds(flagged, pairs.hot(s.PARENT, hot_rows), tables, cfg, profile)
    return cleaning.clean(described, s.full_ddl(cfg.min_pairs_bf, cfg.min_pairs_b, cfg.descriptors))


def step_sizes(tables: Tables, cfg: PairConfig, measured_only: bool, pairs: Staged | None = None) -> DataFrame:
    """Sizes after each step and of each subset, from one table of all pairs (``pairs``, if it is there already).

    Each step only removes rows, so a step is a condition on the rows of the first one; the pairs are
    computed once instead of once per step.
    """
    single = compounds.single_structure_compounds(tables).withColumn("_single", F.lit(True))
    staged = pairs or stage(universe(tables, cfg), "universe")
    marked = spread_join(staged.frame, single, s.PARENT, [s.TID, s.MUTATION], staged.hot(s.PARENT))
    pairs = stage(marked.withColumns(pair_keys()), "marked").frame
    related = F.col(s.INTERACTION) != s.OTHER_CLASS
    remaining = related & F.coalesce("_single", F.lit(False))
    kept = pairs.filter(remaining)
    groups = subsets.group_qualification(kept, cfg)
    flags = [f for x in s.SUFFIXES for f in s.flag_columns(x, cfg.min_pairs(x))]
    flagged = spread_join(pairs, groups.drop("n_rows"), subsets.GROUP, [s.PARENT], hot_keys(pairs, subsets.GROUP))
    flagged = subsets.apply_scope(flagged, cfg).withColumns({f: F.col(f) & remaining for f in flags})

    present = [stats.any_value(), F.lit(True), related, related, remaining, remaining, remaining]
    steps = {}
    for i, (label, rows) in enumerate(zip(STEPS, present)):
        drug = stats.drug_by_phase() if i < 2 else interaction.is_drug()
        steps[label] = (rows & stats.any_value() if measured_only else rows, drug)
    for x in s.SUFFIXES:
        whole = remaining & subsets.in_scope(x)
        for name, rows in [(x, whole), *((f, F.col(f)) for f in s.flag_columns(x, cfg.min_pairs(x)))]:
            steps[name] = (rows & stats.any_value((x,)) if measured_only else rows, interaction.is_drug())
    return stats.step_sizes(flagged, steps)


def quality_summary(
    described: Staged,
    pairs: Staged,
    final: DataFrame,
    tables: Tables,
    cfg: PairConfig,
    profile: DataFrame | None = None,
) -> DataFrame:
    """Violations of all invariants: on the described pairs (which may hold mixtures), and on the final
    table made of ``pairs``."""
    hot_compounds = described.hot(s.PARENT)
    before = describe_compounds(described, tables, cfg, counts=True, profile=profile)
    null_flags, property_checks = quality.property_checks(compounds.compound_props(tables))
    labelled = compounds.atc_labels(tables).select(s.PARENT, F.lit(True).alias("_has_atc"))
    for lookup in (null_flags, labelled):
        before = spread_join(before, lookup, s.PARENT, [s.TID, s.MUTATION], hot_compounds)
    checks = (
        quality.known_without_value_checks()
        | property_checks
        | quality.efficiency_checks()
        | quality.descriptor_checks()
        | quality.keep_for_binding_checks()
        | quality.label_check("atc_level1", "_has_atc")
    )
    found = quality.count_violations(before, checks)

    classes = targets.target_classes(tables).select(
        s.TID, *[F.when(F.col(f"target_class_l{i}").isNotNull(), True).alias(f"_has_l{i}") for i in (1, 2)]
    )
    levels = quality.flag_levels(pairs.frame, cfg)
    after = spread_join(final, classes, s.TID, [s.PARENT], pairs.hot(s.TID))
    after = spread_join(after, levels, subsets.GROUP, [s.PARENT], pairs.hot(subsets.GROUP))
    checks = quality.label_check("target_class_l1", "_has_l1") | quality.label_check("target_class_l2", "_has_l2")
    checks |= quality.literal_null_checks(final) | quality.flag_checks(cfg)
    found = found.unionByName(quality.count_violations(after, checks))
    unique = {f"unique:{name}": (tables[name], key) for name, key in quality.UNIQUE_KEYS.items()}
    return found.unionByName(quality.repeated_keys(unique | {"duplicate_row_key": (final, s.ROW_KEY)}))


def single_structure_pairs(related: Staged, tables: Tables) -> Staged:
    """The staged pairs without mixtures and compounds without a structure, staged."""
    single = compounds.single_structure_compounds(tables)
    kept = spread_join(related.frame, single, s.PARENT, [s.TID, s.MUTATION], related.hot(s.PARENT), "left_semi")
    return stage(kept.withColumns(pair_keys()), "single")
