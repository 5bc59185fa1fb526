"""Distinct counts of the pair keys over many subsets of rows, in one pass."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom import schema as s
# The counted columns with their descriptions, and the row subsets by interaction class.
COUNTED = {
    "parent_molregno": "compound ID",
    "tid": "target ID",
    "tid_mutation": "target ID with mutation annotations",
    "cpd_target_pair": "compound-target pair",
    "cpd_target_pair_mutation": "compound-target pair with mutation annotations",
}
CLASS_SUBSETS = {
    "comparators": ["DT"],
    "drugs": ["D_DT"],
    "candidates": ["C0_DT", "C1_DT", "C2_DT", "C3_DT"],
    "candidates_phase_3": ["C3_DT"],
    "candidates_phase_2": ["C2_DT"],
    "candidates_phase_1": ["C1_DT"],
    "candidates_phase_0": ["C0_DT"],
}


def _small_frame(spark: SparkSession, columns: list[str], subsets: list[str]) -> DataFrame:
    rows = [(c, COUNTED.get(c, c), name, i) for c in columns for i, name in enumerate(subsets)]
    return spark.createDataFrame(rows, "column STRING, column_description STRING, subset_type STRING, slot INT")


SUBSETS_PER_NUMBER = 62  # bits of a long below its sign


def _bits(conditions: list[Column]) -> Column:
    out = F.lit(0).cast("long")
    for i, condition in enumerate(conditions):
        out = out.bitwiseOR(F.when(condition, F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return out


def distinct_counts(df: DataFrame, columns: list[str], subsets: Mapping[str, Column]) -> DataFrame:
    """Distinct non-NULL values of each column within each subset.

    A row is repeated once per column, not once per column and subset: its subsets travel as bits of
    numbers, SUBSETS_PER_NUMBER in each. The values are combined before the shuffle, so a value on most rows is
    no hot spot.
    """
    conditions = list(subsets.values())
    parts = [conditions[i : i + SUBSETS_PER_NUMBER] for i in range(0, len(conditions), SUBSETS_PER_NUMBER)]
    members = {f"member_{i}": _bits(part) for i, part in enumerate(parts)}
    in_any = F.greatest(*members, F.lit(0)) != 0
    in_subset = lambda i: F.col(f"member_{i // SUBSETS_PER_NUMBER}").bitwiseAND(F.lit(1 << i % SUBSETS_PER_NUMBER)) != 0
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    values = (
        df.select(*(c.alias(name) for name, c in members.items()), F.explode(entries).alias("entry"))
        .select("entry.column", "entry.value", *members)
        .filter(F.col("value").isNotNull() & in_any)
        .groupBy("column", "value")
        .agg(*(F.bit_or(name).alias(name) for name in members))
    )
    counts = values.groupBy("column").agg(
        F.array(*[F.count_if(in_subset(i)) for i in range(len(subsets))]).alias("n")
    )
    wanted = _small_frame(df.sparkSession, columns, list(subsets))
    return wanted.join(counts, "column", "left").select(
        "column",
        "column_description",
        "subset_type",
        F.coalesce(F.get("n", F.col("slot")), F.lit(0)).cast("long").alias("counts"),
    )


def distinct_stats(df: DataFrame) -> DataFrame:
    """Counts of all pair keys for all rows and for each group of interaction classes."""
    subsets = {"all": F.lit(True)}
    subsets |= {name: F.col(s.INTERACTION).isin(*classes) for name, classes in CLASS_SUBSETS.items()}
    return distinct_counts(df, list(COUNTED), subsets)


BITMAP_DDL = "column STRING, subset_type STRING, bucket BIGINT, bitmap BINARY"


def distinct_bitmaps(df: DataFrame, columns: list[str], subsets: Mapping[str, Column]) -> DataFrame:
    """Which values of whole-number columns each subset has, as bitmaps over ranges of values (BITMAP_DDL).

    Store them with a release: ``union_counts`` then counts any union of subsets, of one release or several, exactly and
    without the rows. A range that holds no value has no bitmap. NULL and negative values are not kept: they are no ids.
    """
    members = F.filter(F.array(*(F.when(c, name) for name, c in subsets.items())), lambda x: x.isNotNull())
    entries = F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("long").alias("value")) for c in columns))
    each = df.select(members.alias("subsets"), F.explode(entries).alias("e")).filter("e.value >= 0")
    each = each.select("e.column", F.explode("subsets").alias("subset_type"), F.col("e.value").alias("value"))
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("value")).alias("bitmap")
    return each.groupBy("column", "subset_type", F.bitmap_bucket_number("value").alias("bucket")).agg(bits)


def union_counts(bitmaps: DataFrame, unions: Mapping[str, list[str]]) -> DataFrame:
    """``column``, ``union_type``, ``counts``: different values of each column in the subsets of a union, from bitmaps of
    any number of releases. Unions without a value are left out."""
    wanted = bitmaps.sparkSession.createDataFrame(
        [(name, subset) for name, own in unions.items() for subset in own], "union_type STRING, subset_type STRING"
    )
    merged = bitmaps.join(F.broadcast(wanted), "subset_type").groupBy("column", "union_type", "bucket")
    merged = merged.agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return merged.groupBy("column", "union_type").agg(F.sum(F.bitmap_count("bitmap")).alias("counts"))


def step_sizes(df: DataFrame, steps: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """One row per step with the counts of all pair keys over its rows and over its drug rows.

    ``steps`` gives, by label, which rows of ``df`` are there after the step and which of them are drugs.
    """
    subsets = {}
    for label, (present, drug) in steps.items():
        subsets[f"{label}:all"] = present
        subsets[f"{label}:drugs"] = present & drug
    counts = distinct_counts(df, list(COUNTED), subsets)
    kind, label = F.substring_index("subset_type", ":", -1), F.substring_index("subset_type", ":", 1)
    sizes = [
        F.sum(F.when((F.col("column") == c) & (kind == k), F.col("counts"))).alias(f"{c}_{k}")
        for c in COUNTED
        for k in ("all", "drugs")
    ]
    return counts.groupBy(label.alias("step")).agg(*sizes)


def drug_by_phase() -> Column:
    """Before pairs have a class, drugs are compounds in phase 4."""
    return F.col("max_phase") == 4


def any_value(suffixes: tuple[str, ...] = s.SUFFIXES) -> Column:
    """At least one measured value in the given assay subsets."""
    columns = [s.value_column(m, x) for x in suffixes for m in ("mean", "max", "median")]
    return F.coalesce(*columns).isNotNull()
