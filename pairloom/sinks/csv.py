"""Delimited text with a header, written so that it reads back unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructType

from pairloom.operators.quality import bag_difference, bag_marks


def text_options(delimiter: str) -> dict[str, str]:
    """Quotes are doubled, line breaks in quoted text and outer blanks are kept, NULL is an empty field."""
    return {
        "header": "true",
        "sep": delimiter,
        "quote": '"',
        "escape": '"',
        "multiLine": "true",
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
    }


def write_csv(df: DataFrame, path: str, delimiter: str = ";") -> None:
    """One folder of part files; truth values are written as True and False.

    Empty text would read back as NULL, so clean the frame before.
    """
    truths = [f.name for f in df.schema.fields if isinstance(f.dataType, BooleanType)]
    shown = df.withColumns({c: F.initcap(F.col(c).cast("string")) for c in truths}) if truths else df
    shown.write.options(**text_options(delimiter)).csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType, delimiter: str = ";") -> DataFrame:
    """Read with declared types; text that does not fit its type fails instead of becoming NULL."""
    return spark.read.schema(schema).options(**text_options(delimiter), mode="FAILFAST").csv(path)


def write_verified(df: DataFrame, path: str, delimiter: str = ";") -> DataFrame:
    """Write, read back, compare as bags; returns the table that was read.

    The rows' marks are summed while they are written and while they are read, so nothing is shuffled and ``df`` is
    evaluated once. Only if the sums differ are the rows compared, to name some that do.
    """
    marks, seen = bag_marks(df), Observation()
    write_csv(df.observe(seen, *marks), path, delimiter)
    read = read_csv(df.sparkSession, path, df.schema, delimiter)
    found = read.agg(*marks).first().asDict()
    if found != seen.get:
        some = bag_difference(df, read).limit(3).collect()
        raise ValueError(f"the table written to {path} differs from its source: {found}, not {seen.get}; {some}")
    return read
