from __future__ import annotations

from pairloom.functions.smiles import smiles_counts

# Counted by hand: rings, heteroatoms, aromatic atoms, aromatic carbon, aromatic nitrogen, other aromatic atoms.
COUNTED = {
    "CCO": (0, 1, 0, 0, 0, 0),
    "c1ccccc1": (1, 0, 6, 6, 0, 0),
    "c1ccc2ncccc2c1": (2, 1, 10, 9, 1, 1),
    "COc1ccc2[nH]cc(CCN)c2c1Cl": (2, 4, 9, 8, 1, 1),
    "CC(C)Cc1ccc(cc1)[C@@H](C)C(=O)O": (1, 2, 6, 6, 0, 0),
    "Cn1cnc2c1c(=O)n(C)c(=O)n2C": (2, 6, 9, 5, 4, 4),
    "c1cc[se]c1": (1, 1, 5, 4, 0, 1),
    "C[Sn](C)(C)C": (0, 1, 0, 0, 0, 0),
    "[2H]C([2H])Br": (0, 1, 0, 0, 0, 0),
    "[13cH]1ccccc1": (1, 0, 6, 6, 0, 0),
    "[Co]": (0, 1, 0, 0, 0, 0),
    "C%10CCCC%10": (1, 0, 0, 0, 0, 0),
    "ClCCl": (0, 2, 0, 0, 0, 0),
    "BrCBr": (0, 2, 0, 0, 0, 0),
    "": (0, 0, 0, 0, 0, 0),
}
NAMES = ("ring_count", "num_heteroatoms", "aromatic_atoms", "aromatic_c", "aromatic_n", "aromatic_hetero")


def test_counts(spark):
    df = spark.createDataFrame([(k,) for k in COUNTED], "smiles STRING")
    got = df.withColumns(smiles_counts(df.smiles)).collect()
    assert {r.smiles: tuple(r[n] for n in NAMES) for r in got} == COUNTED


def test_null_stays_null(spark):
    df = spark.createDataFrame([(None,)], "smiles STRING")
    row = df.withColumns(smiles_counts(df.smiles)).first()
    assert all(row[n] is None for n in NAMES)
