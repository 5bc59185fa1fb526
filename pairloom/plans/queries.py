"""One query per operator over the test tables."""

from __future__ import annotations

import hashlib
import unicodedata
import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom import schema as s
from pairloom.config import PairConfig
from pairloom.functions.smiles import smiles_counts
from pairloom.functions.text import pair_keys
from pairloom.operators import compounds, enrich, known, measurements, ordering, quality, stats, subsets, targets
from pairloom.operators.cleaning import round_doubles
from pairloom.operators.joins import HOT_ROWS
from pairloom.operators.known import IN_KNOWN, IN_KNOWN_MUTATION, KEEP_BINDING
from pairloom.operators.measurements import CARRIED, THERAPEUTIC
from pairloom.plans import pair_table
from pairloom.plans.oracle import MIN_PAIRS
from pairloom.sinks.csv import write_verified
from pairloom.sinks.staging import shared_folder, stage
from pairloom.sources import Tables, read_database, rejects, write_database
from pairloom.sources.fixture_views import base_table, fixture_tables

CONFIG = PairConfig(min_pairs_bf=MIN_PAIRS, min_pairs_b=MIN_PAIRS)
SELECTED = PairConfig(min_pairs_bf=MIN_PAIRS, min_pairs_b=MIN_PAIRS, hot_values=1)
ALL_SOURCES = PairConfig(literature_only=False, min_pairs_bf=MIN_PAIRS, min_pairs_b=MIN_PAIRS)
DESCRIBED = PairConfig(min_pairs_bf=MIN_PAIRS, min_pairs_b=MIN_PAIRS, descriptors=True)

DATABASE_FILES = 8
HOT = 5  # rows of a key in the variants that salt

Query = Callable[[SparkSession, str], DataFrame]


def on_tables(build: Callable[[Tables], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(fixture_tables(spark, sf_dir))


def pair_aggregates(tables: Tables, cfg: PairConfig = CONFIG) -> DataFrame:
    pairs = pair_table.measured_pairs(tables, cfg)
    keyed = pairs.withColumn("tid_mutation", pair_keys()["tid_mutation"])
    return round_doubles(keyed.drop(s.TID, s.MUTATION, *CARRIED))


def pair_attributes(tables: Tables) -> DataFrame:
    return round_doubles(measurements.describe_pairs(pair_table.measured_pairs(tables, CONFIG), tables))


def missing_known_pairs(tables: Tables) -> DataFrame:
    return known.missing_known_pairs(
        pair_table.expanded_known_pairs(tables), pair_table.measured_pairs(tables, CONFIG)
    )


def pair_universe(tables: Tables) -> DataFrame:
    pairs = pair_table.universe(tables, CONFIG).drop(s.INTERACTION)
    return round_doubles(measurements.describe_pairs(pairs, tables))


def membership_flags(tables: Tables) -> DataFrame:
    pairs = pair_table.universe(tables, CONFIG).withColumns(pair_keys())
    return pairs.select(s.ROW_KEY, IN_KNOWN_MUTATION, IN_KNOWN, KEEP_BINDING, THERAPEUTIC)


def interaction_class(tables: Tables) -> DataFrame:
    pairs = pair_table.related_pairs(tables, CONFIG).withColumns(pair_keys())
    return pairs.select(s.ROW_KEY, *CARRIED, s.INTERACTION)


def ligand_efficiency(tables: Tables) -> DataFrame:
    metrics = s.columns_of(s.EFFICIENCY_DDL)
    return round_doubles(pair_table.described_pairs(tables, CONFIG).select(s.ROW_KEY, *metrics))


def drop_mixtures(tables: Tables) -> DataFrame:
    return compounds.drop_mixtures(pair_table.described_pairs(tables, CONFIG)).select(s.ROW_KEY, s.PARENT, s.SMILES)


def parent_consistency(tables: Tables) -> DataFrame:
    pairs = pair_table.described_pairs(tables, CONFIG).select(s.PARENT, s.SMILES)
    return quality.parent_consistency(pairs, tables["molecule_hierarchy"], tables["compound_structures"])


def target_classes(tables: Tables) -> DataFrame:
    return targets.target_classes(tables, known.targets_of(pair_table.core(tables, CONFIG).frame))


def ambiguous_targets(tables: Tables) -> DataFrame:
    present = known.targets_of(pair_table.core(tables, CONFIG).frame)
    return targets.ambiguous_targets(pair_table.target_profile(tables).join(present, s.TID, "left_semi"))


def clean_dataset(tables: Tables) -> DataFrame:
    return pair_table.clean_table(pair_table.core(tables, CONFIG), tables, CONFIG)


def subset_flags(tables: Tables, hot_rows: int = HOT_ROWS) -> DataFrame:
    pairs = pair_table.core(tables, CONFIG)
    flagged = subsets.subset_flags(pairs.frame, CONFIG, hot_rows)
    names = [f for x in s.SUFFIXES for f in s.flag_columns(x, CONFIG.min_pairs(x))]
    return flagged.select(s.ROW_KEY, *names)


def full_dataset_hot(tables: Tables) -> DataFrame:
    """With a threshold so low that compounds and targets of the test tables are hot and their rows salted."""
    return pair_table.full_table(pair_table.core(tables, CONFIG), tables, CONFIG, HOT)


def full_dataset(cfg: PairConfig) -> Query:
    return on_tables(lambda tables: pair_table.full_table(pair_table.core(tables, cfg), tables, cfg))


def subset_query(suffix: str, level: int | None) -> Query:
    """``level`` 0 to 2 picks a flag, None the whole assay subset."""
    flag = None if level is None else s.flag_columns(suffix, CONFIG.min_pairs(suffix))[level]
    return on_tables(
        lambda tables: subsets.subset(
            pair_table.full_table(pair_table.core(tables, CONFIG), tables, CONFIG), suffix, flag
        )
    )


def distinct_stats(tables: Tables) -> DataFrame:
    return stats.distinct_stats(pair_table.core(tables, CONFIG).frame)


#: Unions of subsets that overlap in compounds and targets.
UNIONS = {
    "known": ["comparators", "drugs"],
    "late": ["drugs", "candidates_phase_3", "candidates_phase_2"],
    "early": ["candidates_phase_1", "candidates_phase_0"],
    "any": ["comparators", "drugs", "candidates"],
}


def union_counts(tables: Tables) -> DataFrame:
    """Unions counted from stored bitmaps of two parts of the table, as of two releases."""
    pairs = pair_table.core(tables, CONFIG).frame
    subset = {name: F.col(s.INTERACTION).isin(*classes) for name, classes in stats.CLASS_SUBSETS.items()}
    parts = [pairs.filter(F.col(s.PARENT) % 3 == 0), pairs.filter(F.col(s.PARENT) % 3 != 0)]
    stored = [stage(stats.distinct_bitmaps(p, [s.PARENT, s.TID], subset), "bitmaps").frame for p in parts]
    return stats.union_counts(stored[0].unionByName(stored[1]), UNIONS)


def step_sizes(measured_only: bool) -> Query:
    return on_tables(lambda tables: pair_table.step_sizes(tables, CONFIG, measured_only))


def dq_summary(tables: Tables) -> DataFrame:
    related = stage(pair_table.related_pairs(tables, DESCRIBED), "related")
    pairs = pair_table.single_structure_pairs(related, tables)
    profile = stage(compounds.compound_profile(tables, DESCRIBED), "profile").frame
    final = stage(pair_table.full_table(pairs, tables, DESCRIBED, profile=profile), "full").frame
    return pair_table.quality_summary(related, pairs, final, tables, DESCRIBED, profile)


def csv_roundtrip(tables: Tables) -> DataFrame:
    full = pair_table.full_table(pair_table.core(tables, CONFIG), tables, CONFIG)
    path = f"{shared_folder(full.sparkSession)}/roundtrip-{uuid.uuid4().hex}"
    return write_verified(full, path)


def ordered_positions(tables: Tables) -> DataFrame:
    """The place of each row of an artifact."""
    keys = pair_table.core(tables, CONFIG).frame.select(s.ROW_KEY)
    return ordering.positions(keys, [s.ROW_KEY])


def database_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written by executors to several database files, read back in ranges with conditions decided in the files."""
    names = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag"]
    rows = base_table(spark, sf_dir, "lineitem").select(*names, "l_discount", "l_shipdate")
    path = f"{shared_folder(spark)}/database-{uuid.uuid4().hex}"
    write_database(rows.repartition(DATABASE_FILES, "l_orderkey"), path, "lineitem")
    where = [("l_quantity", ">=", 25.0), ("l_returnflag", "in", ["A", "R"])]
    return read_database(spark, path, "lineitem", rows.select(names).schema, where, keys_per_range="50000")


def rejected_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text file with records at fault, dealt by whether they fit the declared types: values by reason, and rows."""
    quantity = """CASE l_linenumber WHEN 1 THEN 'n/a' WHEN 2 THEN '1.5' WHEN 3 THEN '99999999999' WHEN 4 THEN '7.0'
        ELSE CAST(CAST(l_quantity AS INT) AS STRING) END"""
    price = "CASE WHEN l_partkey % 3 = 0 THEN 'unknown' ELSE CAST(l_extendedprice AS STRING) END"
    line = f"concat_ws(';', l_orderkey, {quantity}, {price}) || CASE WHEN l_linenumber = 6 THEN ';surplus' ELSE '' END"
    path = f"{shared_folder(spark)}/dealt-{uuid.uuid4().hex}"
    base_table(spark, sf_dir, "lineitem").selectExpr(f"{line} AS value").write.text(path)
    names = ["l_orderkey", "l_quantity", "l_extendedprice"]
    schema = ", ".join(f"{c} STRING" for c in [*names, rejects.CORRUPT])
    read = spark.read.schema(schema).options(sep=";", columnNameOfCorruptRecord=rejects.CORRUPT).csv(path)
    dealt = rejects.deal(read, "l_orderkey BIGINT, l_quantity INT, l_extendedprice DOUBLE", "lineitem")
    accepted = dealt.accepted.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("quantity"))
    none = F.lit(None).cast("string")
    counts = rejects.reject_counts(dealt.rejected).select("column", "reason", "n", F.lit(None).cast("long").alias("quantity"))
    return counts.unionByName(accepted.select(none.alias("column"), F.lit("accepted").alias("reason"), "n", "quantity"))


def smiles_descriptors(tables: Tables) -> DataFrame:
    structures = tables["compound_structures"].select("molregno", s.SMILES)
    return structures.withColumns(smiles_counts(F.col(s.SMILES)))


def enrich_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    def text_bytes(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"text_bytes": texts.str.encode("utf-8").str.len()})

    documents = base_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    compute = enrich.per_batch("text", text_bytes, "text_bytes BIGINT")
    return enrich.enrich_by_key(documents, "text", compute, ["doc_id"]).drop("text")


def plain_letters(texts: pd.Series) -> pd.DataFrame:
    """Digest of a text without the marks on its letters: nothing that Spark has built in."""

    def plain(text: str) -> str:
        marked = unicodedata.normalize("NFD", text)
        return unicodedata.normalize("NFC", "".join(c for c in marked if unicodedata.category(c) != "Mn"))

    digests = [hashlib.md5(plain(t).encode()).hexdigest() for t in texts]
    return pd.DataFrame({"plain_md5": digests})


def enrich_from_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs on one store: the first half of the documents, then all of them, of which only the others are computed."""
    documents = base_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    compute = enrich.per_batch("text", plain_letters, "plain_md5 STRING")
    path = f"{shared_folder(spark)}/store-{uuid.uuid4().hex}"
    for rows in (documents.filter("doc_id % 2 = 0"), documents):
        found, _ = enrich.enrich_with_store(rows, "text", compute, "plain_md5 STRING", path, ["doc_id"])
    return found.drop("text")


def all_queries() -> dict[str, Query]:
    out = {
        "activity_pairs": on_tables(lambda t: pair_table.activity_rows(t, CONFIG)),
        "activity_pairs_all_sources": on_tables(lambda t: pair_table.activity_rows(t, ALL_SOURCES)),
        "pair_aggregates": on_tables(pair_aggregates),
        "pair_aggregates_selected": on_tables(lambda t: pair_aggregates(t, SELECTED)),
        "pair_attributes": on_tables(pair_attributes),
        "known_pairs": on_tables(lambda t: known.known_pairs(t).select(*s.PAIR)),
        "target_mappings": on_tables(known.target_mappings),
        "known_pairs_expanded": on_tables(lambda t: pair_table.expanded_known_pairs(t).select(*s.PAIR)),
        "mechanism_pairs": on_tables(lambda t: known.mechanism_pairs(pair_table.expanded_known_pairs(t), t)),
        "missing_known_pairs": on_tables(missing_known_pairs),
        "pair_universe": on_tables(pair_universe),
        "membership_flags": on_tables(membership_flags),
        "interaction_class": on_tables(interaction_class),
        "first_publication": on_tables(lambda t: compounds.first_publication(t, CONFIG)),
        "compound_props": on_tables(compounds.compound_props),
        "ligand_efficiency": on_tables(ligand_efficiency),
        "atc_labels": on_tables(compounds.atc_labels),
        "drop_mixtures": on_tables(drop_mixtures),
        "parent_consistency": on_tables(parent_consistency),
        "class_hierarchy": on_tables(targets.class_hierarchy),
        "target_classes": on_tables(target_classes),
        "ambiguous_targets": on_tables(ambiguous_targets),
        "clean_dataset": on_tables(clean_dataset),
        "subset_flags": on_tables(subset_flags),
        "subset_flags_hot": on_tables(lambda t: subset_flags(t, HOT)),
        "distinct_stats": on_tables(distinct_stats),
        "union_counts": on_tables(union_counts),
        "step_sizes": step_sizes(measured_only=False),
        "step_sizes_measured": step_sizes(measured_only=True),
        "dq_summary": on_tables(dq_summary),
        "csv_roundtrip": on_tables(csv_roundtrip),
        "ordered_positions": on_tables(ordered_positions),
        "database_files": database_files,
        "rejected_values": rejected_values,
        "smiles_descriptors": on_tables(smiles_descriptors),
        "enrich_by_key": enrich_by_key,
        "enrich_from_store": enrich_from_store,
        "full_dataset": full_dataset(CONFIG),
        "full_dataset_hot": on_tables(full_dataset_hot),
        "full_dataset_all_sources": full_dataset(ALL_SOURCES),
        "full_dataset_descriptors": full_dataset(DESCRIBED),
    }
    for x in s.SUFFIXES:
        for level, name in ((None, ""), (0, "_n"), (1, "_n_known"), (2, "_n_drug")):
            out[f"subset_{x.lower()}{name}"] = subset_query(x, level)
    return out
