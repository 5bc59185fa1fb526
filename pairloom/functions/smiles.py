"""Atom and ring counts from the tokens of a SMILES text.

Holds for text in aromatic form with one- or two-digit ring closures; wildcard atoms and
``%(nnn)`` closures are not counted. The ring count is the number of closures (cycle rank).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# SMILES token patterns.
BRACKET = r"\[[^\]]*\]"
TWO_LETTER_HALOGEN = "Cl|Br"
PLAIN_AROMATIC = "[bcnops]"
BRACKET_AROMATIC = r"\[[0-9]*[a-z]"
BRACKET_AROMATIC_C = r"\[[0-9]*c"
BRACKET_AROMATIC_N = r"\[[0-9]*n"
BRACKET_CARBON_OR_H = r"\[[0-9]*[CcH][^a-z]"
PLAIN_HETERO = "Cl|Br|[BNOPSFIbnops]"
RING_CLOSURE = "%[0-9][0-9]|[0-9]"


def smiles_counts(smiles: Column) -> dict[str, Column]:
    """Ring, heteroatom and aromatic atom counts as INT columns."""
    plain = F.regexp_replace(smiles, BRACKET, "")
    organic = F.regexp_replace(plain, TWO_LETTER_HALOGEN, "")

    def n(text: Column, pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern))

    aromatic = n(organic, PLAIN_AROMATIC) + n(smiles, BRACKET_AROMATIC)
    carbon = n(organic, "c") + n(smiles, BRACKET_AROMATIC_C)
    nitrogen = n(organic, "n") + n(smiles, BRACKET_AROMATIC_N)
    hetero = n(plain, PLAIN_HETERO) + n(smiles, r"\[") - n(smiles, BRACKET_CARBON_OR_H)
    return {
        "ring_count": F.floor(n(plain, RING_CLOSURE) / 2).cast("int"),
        "num_heteroatoms": hetero,
        "aromatic_atoms": aromatic,
        "aromatic_c": carbon,
        "aromatic_n": nitrogen,
        "aromatic_hetero": aromatic - carbon,
    }
