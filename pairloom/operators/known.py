"""Curated pairs, their expansion through related targets, and membership in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom import schema as s
from pairloom.functions.text import pair_keys
from pairloom.operators.joins import shuffled
from pairloom.operators.measurements import CARRIED, PHASE, THERAPEUTIC, describe_pairs, pair_aggregates, parent_map
from pairloom.sources import Tables

# A pair known for a target of one of these types also holds for the related single protein.
SINGLE = "SINGLE PROTEIN"
SUPERSET_TYPES = (
    "PROTEIN FAMILY",
    "PROTEIN COMPLEX",
    "PROTEIN COMPLEX GROUP",
    "CHIMERIC PROTEIN",
    "PROTEIN-PROTEIN INTERACTION",
)
SUPERSET, EQUIVALENT = "SUPERSET OF", "EQUIVALENT TO"

IN_KNOWN_MUTATION = "pair_mutation_in_dm_table"
IN_KNOWN = "pair_in_dm_table"
KEEP_BINDING = "keep_for_binding"


def known_pairs(tables: Tables) -> DataFrame:
    """Distinct curated pairs of parent compound and target that matter for the disease."""
    curated = tables["drug_mechanism"].filter((F.col("disease_efficacy") == 1) & F.col(s.TID).isNotNull())
    return curated.join(shuffled(parent_map(tables)), "molregno").select(*s.PAIR, PHASE).distinct()


def target_mappings(tables: Tables) -> DataFrame:
    """Relations through which a curated pair carries over to a single protein."""
    targets = tables["target_dictionary"]

    def side(number: int, key: str) -> DataFrame:
        return targets.select(
            F.col(s.TID).alias(key),
            *[F.col(c).alias(f"{c}_{number}") for c in ("pref_name", "target_type", "organism")],
        )

    relation, source = F.col("relationship"), F.col("target_type_1")
    carries_over = (F.col("target_type_2") == SINGLE) & (
        (source.isin(*SUPERSET_TYPES) & (relation == SUPERSET)) | ((source == SINGLE) & (relation == EQUIVALENT))
    )
    related = tables["target_relations"].filter(relation.isin(SUPERSET, EQUIVALENT))
    return (
        related.join(shuffled(side(1, s.TID)), s.TID)
        .join(shuffled(side(2, "related_tid")), "related_tid")
        .filter(carries_over)
        .distinct()
    )


def expand_pairs(pairs: DataFrame, mappings: DataFrame) -> DataFrame:
    """The pairs and those of directly related targets (one hop); one pass and one distinct."""
    hops = mappings.select(s.TID, "related_tid").distinct()
    reached = F.array_compact(F.array(F.col(s.TID), F.col("related_tid")))
    return pairs.join(shuffled(hops), s.TID, "left").withColumn(s.TID, F.explode(reached)).drop("related_tid").distinct()


def targets_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(s.TID).distinct()


def mechanism_pairs(expanded: DataFrame, tables: Tables) -> DataFrame:
    """Curated pairs with the columns of measured pairs."""
    described = describe_pairs(expanded.select(*s.PAIR).withColumn(s.MUTATION, F.lit(None).cast("string")), tables)
    return described.drop(s.MUTATION).withColumns({IN_KNOWN_MUTATION: F.lit(True), IN_KNOWN: F.lit(True)})


def missing_known_pairs(expanded: DataFrame, measured: DataFrame) -> DataFrame:
    """Curated pairs that have no measured row without a mutation."""
    unmutated = measured.filter(F.col(s.MUTATION).isNull()).select(*s.PAIR)
    return expanded.select(*s.PAIR).join(shuffled(unmutated), s.PAIR, "left_anti")


def pair_universe(cells: DataFrame, expanded: DataFrame, hot_values: int | None = None) -> DataFrame:
    """Measured and curated pairs, aggregated and flagged in one grouping.

    Curated pairs enter the grouping as cells without a value: a pair that is also measured merges with
    them, any other one becomes a row of its own. So neither an anti join nor a membership join is
    needed, and the measurements are read once. All windows and the grouping share one shuffle on
    (compound, target) and one sort. ``hot_values`` as in ``pair_aggregates``.
    """
    curated = expanded.select(
        *s.PAIR, PHASE, F.lit(True).alias(THERAPEUTIC), F.lit(0).alias("n_BF"), F.lit(0).alias("n_B")
    )
    cells = cells.withColumn("_curated", F.lit(False)).unionByName(
        curated.withColumn("_curated", F.lit(True)), allowMissingColumns=True
    )
    if hot_values is None:
        cells = cells.repartition(*s.PAIR)
    pairs = pair_aggregates(cells, F.bool_or("_curated").alias(IN_KNOWN_MUTATION), hot_values=hot_values)
    any_mutation = F.max(IN_KNOWN_MUTATION).over(Window.partitionBy(*s.PAIR))
    return pairs.withColumn(IN_KNOWN, any_mutation).withColumn(KEEP_BINDING, keep_for_binding())


def keep_for_binding() -> Column:
    return F.col(s.value_column("mean", "B")).isNotNull() | F.col(IN_KNOWN_MUTATION)
