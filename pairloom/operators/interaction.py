"""Interaction class of a pair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom import schema as s
from pairloom.operators.known import IN_KNOWN
from pairloom.operators.measurements import PHASE, THERAPEUTIC

# The class of a known pair by the phase of its compound; any other phase, or none, is C0_DT.
CLASS_BY_PHASE = {4: "D_DT", 3: "C3_DT", 2: "C2_DT", 1: "C1_DT"}
UNKNOWN_PHASE_CLASS = "C0_DT"


def interaction_class() -> Column:
    """Known pairs by phase, other pairs on a known target, then the rest."""
    by_phase = F.lit(UNKNOWN_PHASE_CLASS)
    for phase, name in CLASS_BY_PHASE.items():
        by_phase = F.when(F.col(PHASE) == phase, name).otherwise(by_phase)
    return (
        F.when(F.col(IN_KNOWN), by_phase)
        .when(F.col(THERAPEUTIC), s.COMPARATOR_CLASS)
        .otherwise(s.OTHER_CLASS)
    )


def classify(universe: DataFrame) -> DataFrame:
    return universe.withColumn(s.INTERACTION, interaction_class())


def keep_related(classified: DataFrame) -> DataFrame:
    """Drop pairs that are neither known nor on a known target."""
    return classified.filter(F.col(s.INTERACTION) != s.OTHER_CLASS)


def is_known() -> Column:
    return F.col(s.INTERACTION).isin(*s.KNOWN_CLASSES)


def is_drug() -> Column:
    return F.col(s.INTERACTION) == s.DRUG_CLASS
