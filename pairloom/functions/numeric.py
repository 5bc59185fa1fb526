"""Numeric column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Gas constant term of the ligand efficiency and the two scale factors.
LE_FACTOR = 2.303 * 298 * 0.00199
BEI_FACTOR = 1000
SEI_FACTOR = 100


def ratio(numerator: Column, denominator: Column) -> Column:
    """NULL where the denominator is 0 or NULL; plain division raises on 0 in ANSI mode."""
    return numerator / F.nullif(denominator, F.lit(0))


def efficiency_metrics(mean: Column, suffix: str) -> dict[str, Column]:
    """Ligand, binding, surface and lipophilic efficiency of a mean value."""
    per_atom = F.nullif(F.col("heavy_atoms"), F.lit(0))
    return {
        f"LE_{suffix}": mean / per_atom * F.lit(LE_FACTOR),
        f"BEI_{suffix}": ratio(mean * BEI_FACTOR, F.col("mw_freebase")),
        f"SEI_{suffix}": ratio(mean * SEI_FACTOR, F.col("psa")),
        f"LLE_{suffix}": mean - F.col("alogp"),
    }
