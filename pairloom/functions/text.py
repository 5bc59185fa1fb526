"""Text column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pairloom import schema as s


def joined_key(*parts: str) -> Column:
    """``a_b`` or ``a_b_c``; a NULL part is left out, an empty one is kept."""
    return F.concat_ws("_", *[F.col(p).cast("string") for p in parts])


def pair_keys() -> dict[str, Column]:
    """The three composite text keys of a pair row."""
    return {
        "tid_mutation": joined_key(s.TID, s.MUTATION),
        "cpd_target_pair": joined_key(s.PARENT, s.TID),
        s.ROW_KEY: joined_key(s.PARENT, s.TID, s.MUTATION),
    }


def joined_labels(labels: Column, separator: str) -> Column:
    """Sorted labels of an array as one text; NULL if there are none."""
    return F.when(F.size(labels) > 0, F.array_join(F.sort_array(labels), separator))


def none_if(value: Column, literal: str) -> Column:
    return F.nullif(value, F.lit(literal))
