"""Subsets of pairs on targets with enough measured pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom import schema as s
from pairloom.config import PairConfig
from pairloom.operators.interaction import is_drug, is_known
from pairloom.operators.joins import HOT_ROWS, SLOTS, slots, spread_join
from pairloom.operators.known import KEEP_BINDING
from pairloom.sinks.staging import stage

GROUP = "tid_mutation"


def in_scope(suffix: str) -> Column:
    """Rows that count for an assay subset: all, or those kept for binding data."""
    return F.lit(True) if suffix == "BF" else F.col(KEEP_BINDING)


def group_qualification(df: DataFrame, cfg: PairConfig, keep: list[str] | None = None) -> DataFrame:
    """One row per target (with mutation): rows, and the levels it qualifies for in each assay subset.

    A plain aggregation, combined before the shuffle: a window would put all rows of a target in one task.
    """
    aggregates = [F.count(F.lit(1)).alias("n_rows")]
    for suffix in s.SUFFIXES:
        enough, with_known, with_drug = s.flag_columns(suffix, cfg.min_pairs(suffix))
        scope = in_scope(suffix)
        has_enough = F.count(F.when(scope, F.col(s.value_column("mean", suffix)))) >= cfg.min_pairs(suffix)
        aggregates += [
            has_enough.alias(enough),
            (has_enough & F.bool_or(scope & is_known())).alias(with_known),
            (has_enough & F.bool_or(scope & is_drug())).alias(with_drug),
        ]
    return df.groupBy(GROUP, *(keep or [])).agg(*aggregates)


def apply_scope(df: DataFrame, cfg: PairConfig) -> DataFrame:
    """Group levels as row flags: a row outside the scope of a subset is never flagged for it."""
    flags = {
        name: F.coalesce(F.col(name), F.lit(False)) & in_scope(suffix)
        for suffix in s.SUFFIXES
        for name in s.flag_columns(suffix, cfg.min_pairs(suffix))
    }
    return df.withColumns(flags)


def hot_groups(groups: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Groups too large for one task, with the slots their rows are dealt over."""
    return groups.filter(F.col("n_rows") > hot_rows).select(GROUP, slots(F.col("n_rows"), hot_rows).alias(SLOTS))


def subset_flags(df: DataFrame, cfg: PairConfig, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add the six subset flags; ``df`` is read twice, so hand in a staged table."""
    groups = stage(group_qualification(df, cfg), "groups").frame
    hot = hot_groups(groups, hot_rows)
    any_level = [name for suffix in s.SUFFIXES for name in s.flag_columns(suffix, cfg.min_pairs(suffix))[:1]]
    qualified = groups.filter(F.col(any_level[0]) | F.col(any_level[1])).drop("n_rows")
    return apply_scope(spread_join(df, qualified, GROUP, [s.PARENT], hot), cfg)


def subset(full: DataFrame, suffix: str, flag: str | None = None) -> DataFrame:
    """Rows of one subset, without the columns of the other assay subset and without flags.

    The row key stays, so the rows stay distinct.
    """
    other = "B" if suffix == "BF" else "BF"
    dropped = [
        c for c in full.columns if c.endswith(f"_{other}") or c.startswith(("B_", "BF_"))
    ]
    rows = full.filter(F.col(flag)) if flag else full.filter(in_scope(suffix))
    return rows.drop(*dropped)
