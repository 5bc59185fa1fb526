"""Compute the pair table once, write the wanted artifacts, and make them the release all at once."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from pairloom import schema as s
from pairloom.config import OutputConfig, PairConfig
from pairloom.operators import interaction, known, quality, stats, subsets, targets
from pairloom.plans import pair_table
from pairloom.sinks import files
from pairloom.sinks.csv import write_csv, write_verified
from pairloom.sinks.staging import stage, steps
from pairloom.sources import Tables
from pairloom.sources.rejects import DealtTables

RUNS = "_runs"


def write_artifact(df: DataFrame, path: str, delimiter: str) -> None:
    """The rows in key order, checked after writing, and their distinct counts beside them."""
    write_verified(df.orderBy(s.ROW_KEY), path, delimiter)
    write_csv(stats.distinct_stats(df), f"{path}_stats", delimiter)


def require_no_violations(summary: DataFrame) -> None:
    """``summary`` has one row per check."""
    failed = {r["check"]: r["violations"] for r in summary.filter("violations > 0").collect()}
    if failed:
        raise ValueError(f"invariants of the pair table are violated: {failed}")


def release_name(cfg: PairConfig, out: OutputConfig) -> str:
    return f"{out.release}_CTI_{cfg.source_label}"


def manifest_path(path: str, release: str) -> str:
    return f"{path}/{release}.json"


def read_release(spark: SparkSession, path: str, release: str) -> dict[str, str]:
    """Where each artifact of the release lies now, by name."""
    listed = json.loads(files.text_of(spark, manifest_path(path, release)))
    return {name: f"{path}/{RUNS}/{listed['run']}/{name}" for name in listed["artifacts"]}


def drop_other_runs(spark: SparkSession, path: str, releases: list[str]) -> list[str]:
    """Deletes what runs have written below ``path`` that is part of none of ``releases``: runs that failed or were
    replaced. Only for a time when no run is under way. Returns the names of the deleted runs."""
    listed = {json.loads(files.text_of(spark, manifest_path(path, r)))["run"] for r in releases}
    others = [run for run in files.folders(spark, f"{path}/{RUNS}") if run not in listed]
    for run in others:
        files.delete(spark, f"{path}/{RUNS}/{run}")
    return others


def publish(tables: Tables, cfg: PairConfig, out: OutputConfig) -> list[str]:
    """Check the table, then write it, the wanted subsets with statistics, ambiguous targets and, if asked
    for, the sizes after each step, and make them the release.

    Artifacts are written and verified in a folder of this run. Then one file, the manifest, is replaced, which readers
    follow (``read_release``). A run that stops before leaves the old release as it was, and a repeated one meets none
    of its files. What is staged on the way is deleted at the end.

    Of tables whose rows are dealt, the rejected values are an artifact too. Such tables are read anew by each run.

    Returns the paths of the artifacts.
    """
    spark = tables["activities"].sparkSession
    run = uuid.uuid4().hex
    with steps():
        paths = _written(tables, cfg, out, f"{out.path}/{RUNS}/{run}")
    artifacts = [p.rsplit("/", 1)[1] for p in paths]
    release = release_name(cfg, out)
    files.replace(spark, manifest_path(out.path, release), json.dumps({"run": run, "artifacts": artifacts}))
    return paths


def _written(tables: Tables, cfg: PairConfig, out: OutputConfig, folder: str) -> list[str]:
    """The measurements are read once: all pairs (with sizes) or the related ones are staged, mixtures included, and
    checks, sizes and the full table derive from that. The full table is staged too, so each artifact is a filter on it.
    """
    base = f"{folder}/{release_name(cfg, out)}"
    every = stage(pair_table.universe(tables, cfg), "universe") if out.write_sizes else None
    kept = interaction.keep_related(every.frame) if every else pair_table.related_pairs(tables, cfg)
    related = stage(kept, "related")
    pairs = pair_table.single_structure_pairs(related, tables)
    full = stage(pair_table.full_table(pairs, tables, cfg), "full").frame
    require_no_violations(pair_table.quality_summary(related, pairs, full, tables, cfg))
    structures = pair_table.describe_compounds(related, tables, cfg).select(s.PARENT, s.SMILES)
    require_no_violations(
        quality.parent_consistency(structures, tables["molecule_hierarchy"], tables["compound_structures"])
    )
    paths = []

    if out.write_full:
        paths.append(f"{base}_full_dataset")
        write_artifact(full, paths[-1], out.delimiter)
    for suffix, wanted in (("BF", out.write_bf), ("B", out.write_b)):
        for flag in [None, *s.flag_columns(suffix, cfg.min_pairs(suffix))] if wanted else []:
            paths.append(f"{base}_{flag or suffix}")
            write_artifact(subsets.subset(full, suffix, flag), paths[-1], out.delimiter)

    present = known.targets_of(full)
    profile = pair_table.target_profile(tables).join(present, s.TID, "left_semi")
    paths.append(f"{base}_targets_w_more_than_one_tclass")
    write_csv(targets.ambiguous_targets(profile), paths[-1], out.delimiter)

    if out.write_sizes:
        for name, measured_only in (("all", False), ("measured", True)):
            paths.append(f"{folder}/debug_sizes_{name}")
            write_csv(pair_table.step_sizes(tables, cfg, measured_only, every), paths[-1], out.delimiter)

    if isinstance(tables, DealtTables):
        paths.append(f"{base}_rejected")
        write_csv(tables.rejected(full.sparkSession), paths[-1], out.delimiter)
    return paths
