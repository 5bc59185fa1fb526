from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))

#: Nulls, empty and blank texts, one long text, repeated rows, equal ids, no id.
ODD = [
    (1, "alpha beta gamma delta epsilon zeta eta theta"),
    (2, None),
    (3, ""),
    (4, " \t\n\x0b\x0c\r "),
    (5, LONG),
    (5, LONG),
    (6, "alpha beta gamma delta epsilon zeta eta theta"),
    (7, "é\x1cß 中文 İ́ ﬁ"),
    (None, "alpha beta gamma delta epsilon zeta eta theta"),
    (None, None),
    (8, "alpha"),
    (8, "beta"),
    (-9, "alpha beta gamma delta epsilon zeta eta theta iota"),
]


@pytest.fixture(scope="session")
def odd():
    return ODD


@pytest.fixture(scope="session")
def frame(spark):
    """A documents table of (doc_id, text), with other columns whose names operators use themselves."""

    def make(rows, **others):
        wide = [(d, t, "xx", "s", None, "clash", 1.5, [1]) for d, t in rows]
        names = "doc_id long, text string, lang string, source string, n_chars long, fp string, score double, base array<int>"
        return spark.createDataFrame(wide, names).repartition(3)

    return make


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))
