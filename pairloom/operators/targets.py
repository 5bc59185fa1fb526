"""Target side: class hierarchy, class labels, targets with several labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom import schema as s
from pairloom.functions.text import joined_labels
from pairloom.operators.joins import shuffled
from pairloom.sinks.staging import stage
from pairloom.sources import Tables

# Separator of class names, root of the hierarchy, the label that yields to any other.
CLASS_SEPARATOR = "|"
ROOT_CLASS = 0
UNCLASSIFIED = "Unclassified protein"


def class_hierarchy(tables: Tables) -> DataFrame:
    """Path of class names from the root, of any depth, and the names on levels 1 and 2.

    Each round doubles the paths: the path of a class continues with that of the class where it ended. A tree of
    depth d takes log2(d) rounds, each written to the shared folder. Classes that hang on no root are left out; a
    cycle of classes is an error. The names stay an array until the end, so a separator within a name does no harm.
    """
    classes = tables["protein_classification"].withColumn("up", F.col("parent_id"))
    paths = stage(classes.withColumn("path", F.array("pref_name")), "classes")
    for _ in range(max(1, paths.rows).bit_length() + 1):
        above = paths.frame.select(
            F.col("protein_class_id").alias("up"), F.col("up").alias("_up"), F.col("path").alias("_path")
        )
        done = paths.frame.filter(F.col("up").isNull())
        longer = paths.frame.join(shuffled(above), "up").withColumn("path", F.concat("_path", "path")).withColumn("up", F.col("_up"))
        paths = stage(done.unionByName(longer.select(*done.columns)), "classes")
        if paths.frame.filter(F.col("up").isNotNull()).isEmpty():
            break
    else:
        raise ValueError("protein_classification has a cycle")
    return paths.frame.filter(F.col("protein_class_id") != ROOT_CLASS).select(
        "protein_class_id",
        "parent_id",
        "class_level",
        F.array_join("path", CLASS_SEPARATOR).alias("names"),
        F.get("path", F.lit(1)).alias("l1"),
        F.get("path", F.lit(2)).alias("l2"),
    )


def target_class_rows(tables: Tables) -> DataFrame:
    """(target, level 1, level 2) over the components of a target; rows may repeat."""
    component_labels = (
        tables["component_class"]
        .join(shuffled(tables["component_sequences"]), "component_id", "left_semi")
        .join(shuffled(class_hierarchy(tables).select("protein_class_id", "l1", "l2")), "protein_class_id")
        .select("component_id", "l1", "l2")
    )
    return tables["target_components"].join(shuffled(component_labels), "component_id").select(s.TID, "l1", "l2")


def target_classes(tables: Tables, targets: DataFrame | None = None) -> DataFrame:
    """Level 1 and 2 labels of a target, sorted and joined; the level 1 label of unclassified proteins
    is kept only where it is the sole one. Targets without any label are left out."""
    rows = target_class_rows(tables)
    if targets is not None:
        rows = rows.join(shuffled(targets), s.TID, "left_semi")
    names = F.col("names_l1")
    level1 = F.when(F.size(names) > 1, F.array_remove(names, UNCLASSIFIED)).otherwise(names)
    return (
        rows.groupBy(s.TID)
        .agg(F.collect_set("l1").alias("names_l1"), F.collect_set("l2").alias("names_l2"))
        .select(
            s.TID,
            joined_labels(level1, CLASS_SEPARATOR).alias("target_class_l1"),
            joined_labels(F.col("names_l2"), CLASS_SEPARATOR).alias("target_class_l2"),
        )
        .filter(F.coalesce("target_class_l1", "target_class_l2").isNotNull())
    )


def ambiguous_targets(described_targets: DataFrame) -> DataFrame:
    """Targets with more than one label on a level, from one row per target."""
    several = [F.coalesce(F.col(c).contains(CLASS_SEPARATOR), F.lit(False)) for c in ("target_class_l1", "target_class_l2")]
    return described_targets.filter(several[0] | several[1]).select(
        s.TID, "target_pref_name", "target_type", "target_class_l1", "target_class_l2"
    )
