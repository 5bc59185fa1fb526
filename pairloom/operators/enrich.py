"""Compute once per distinct key and map the result back to the rows."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from pairloom.operators.joins import HOT_ROWS, hot_keys, spread_join
from pairloom.sinks import files
from pairloom.sinks.staging import stage

DIGEST = "_digest"
PART_BYTES = 1 << 22  # of text that a function gets at a time, one longer key aside
LISTED = "parts.json"  # readers pass over names that begin with an underscore


def enrich_by_key(
    df: DataFrame,
    key: str,
    compute: Callable[[DataFrame], DataFrame],
    spread_by: list[str],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left join of ``compute(distinct keys)``, which returns the key and the columns to add.

    Rows with a NULL key get NULLs. Keys travel as a 256-bit digest of their text: what is counted, broadcast and
    joined has 64 characters, however long a key is. Keys with many copies are spread over tasks by ``spread_by``.
    """
    rows = df.withColumn(DIGEST, F.sha2(F.col(key).cast("string"), 256))
    keys = rows.filter(F.col(key).isNotNull()).groupBy(DIGEST).agg(F.any_value(key).alias(key))
    added = compute(keys.select(key)).withColumn(DIGEST, F.sha2(F.col(key).cast("string"), 256)).drop(key)
    return spread_join(rows, added, DIGEST, spread_by, hot_keys(rows, DIGEST, hot_rows)).drop(DIGEST)


def cut_by_bytes(batch: pa.RecordBatch, column: int, most: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batch`` in order, in slices with about ``most`` bytes of a text column; other kinds stay whole."""
    values = batch.column(column)
    if not (pa.types.is_string(values.type) or pa.types.is_large_string(values.type)):
        yield batch
        return
    sizes = pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes.astype(np.int64)) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def per_batch(key: str, function: Callable[[pd.Series], pd.DataFrame], ddl: str) -> Callable[[DataFrame], DataFrame]:
    """A ``compute`` for any vectorised function of a key batch; ``ddl`` declares the columns it returns.

    This is the place for descriptors from a library that the cluster ships. The function gets at most PART_BYTES of text
    keys at a time, however many rows the batches of the session have: Python holds several copies of what it gets.
    """

    def compute(keys: DataFrame) -> DataFrame:
        key_type = keys.schema[key].dataType
        wanted = StructType.fromDDL(ddl)
        schema = to_arrow_schema(wanted)

        def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in cut_by_bytes(batch, 0):
                    added = function(part.column(0).to_pandas())
                    columns = [pa.Array.from_pandas(added[f.name], type=f.type) for f in schema]
                    yield pa.record_batch([part.column(0), *columns], names=[key, *schema.names])

        return keys.select(key).mapInArrow(parts, StructType([StructField(key, key_type), *wanted.fields]))

    return compute


def enrich_with_store(
    df: DataFrame,
    key: str,
    compute: Callable[[DataFrame], DataFrame],
    ddl: str,
    path: str,
    spread_by: list[str],
    hot_rows: int = HOT_ROWS,
    most_parts: int = 32,
) -> tuple[DataFrame, int]:
    """As ``enrich_by_key``, with what was computed kept at ``path`` from run to run, by digest of the key.

    Only keys that the store does not hold are computed; ``ddl`` declares the columns that ``compute`` adds. The store is
    a folder of parts, one from each run that found new keys, listed by a file that is replaced when a part is complete:
    a run that fails leaves the store as it was. When ``most_parts`` are listed they are merged into one. A store is for
    one function: another one, or another version of it, needs another path. One run at a time may write to a store.

    Returns the enriched rows and how many keys were computed.
    """
    spark = df.sparkSession
    parts = _listed(spark, path)
    stored_ddl = f"{DIGEST} STRING, {ddl}"
    held = _stored(spark, path, parts, stored_ddl)
    rows = df.withColumn(DIGEST, F.sha2(F.col(key).cast("string"), 256))
    keys = rows.filter(F.col(key).isNotNull()).groupBy(DIGEST).agg(F.any_value(key).alias(key))
    new = stage(keys.join(held.select(DIGEST), DIGEST, "left_anti"), "new-keys")
    if new.rows:
        added = compute(new.frame.select(key)).withColumn(DIGEST, F.sha2(F.col(key).cast("string"), 256))
        part = f"part-{uuid.uuid4().hex}"
        added.selectExpr(*(f"`{f.name}`" for f in held.schema.fields)).write.parquet(f"{path}/{part}")
        parts = [*parts, part]
        if len(parts) > most_parts:
            whole = f"part-{uuid.uuid4().hex}"
            _stored(spark, path, parts, stored_ddl).write.parquet(f"{path}/{whole}")
            parts = [whole]
        files.replace(spark, f"{path}/{LISTED}", json.dumps(parts))
        held = _stored(spark, path, parts, stored_ddl)
    return spread_join(rows, held, DIGEST, spread_by, hot_keys(rows, DIGEST, hot_rows)).drop(DIGEST), new.rows


def _listed(spark: SparkSession, path: str) -> list[str]:
    return json.loads(files.text_of(spark, f"{path}/{LISTED}")) if files.exists(spark, f"{path}/{LISTED}") else []


def _stored(spark: SparkSession, path: str, parts: list[str], ddl: str) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], ddl)
    return spark.read.schema(ddl).parquet(*(f"{path}/{p}" for p in parts))


def drop_unlisted(spark: SparkSession, path: str) -> list[str]:
    """Deletes parts of a store that its list does not name: merged ones, and those of runs that failed. For a time when
    nobody reads or writes the store. Returns their names."""
    gone = sorted(set(files.folders(spark, path)) - set(_listed(spark, path)))
    for part in gone:
        files.delete(spark, f"{path}/{part}")
    return gone
